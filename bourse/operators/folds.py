"""A function of a key's rows in order, without the rows of a key in one task
(UDF-2).

The reference calls a function with all rows of a symbol.  Here the function is a
fold: ``update`` makes a state of one segment of a key's rows (a month of daily
bars by default), ``merge`` makes one state of consecutive ones, ``finish`` turns
states into results.  Segments are folded wherever they lie; states are then
merged ``FAN_IN`` at a time, in as many rounds as a key's number of segments needs.
So a symbol that holds a third of all rows is as many tasks as it has months.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourse.operators.series import DEFAULT_SEGMENT, NO_SEGMENT, SEGMENT, segment_of
from bourse.session import ensure_checkpoint_dir

FAN_IN = 256
_PLACE = "_place"


@dataclass(frozen=True)
class Fold:
    """``update(rows)``: the state of a segment's rows, in order; ``merge(states)``:
    one state of several, in order; ``finish(states)``: a frame of results for a
    frame with one state a key.  ``state`` and ``result`` are their columns (DDL),
    without the key; ``merge`` must not depend on how the states are cut."""

    state: str
    update: Callable[[pd.DataFrame], dict]
    merge: Callable[[pd.DataFrame], dict]
    finish: Callable[[pd.DataFrame], pd.DataFrame]
    result: str


def per_key_fold(df: DataFrame, key: str, order: str, fold: Fold, segment=DEFAULT_SEGMENT, fan_in: int = FAN_IN) -> DataFrame:
    """``fold`` over each key's rows by ``order``, which must sort them entirely;
    rows without an order value come first, rows without a key are one key."""
    kind = dict(df.dtypes)[key]
    number = F.coalesce(segment_of(F.col(order), segment, dict(df.dtypes)[order]).cast("long"), F.lit(NO_SEGMENT))

    def update(names: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, na_position="first", ignore_index=True).drop(columns=[SEGMENT])
        return pd.DataFrame([{key: names[0], _PLACE: names[1], **fold.update(rows)}])

    def merge(names: tuple, states: pd.DataFrame) -> pd.DataFrame:
        states = states.sort_values(_PLACE, ignore_index=True)
        return pd.DataFrame([{key: names[0], _PLACE: names[1], **fold.merge(states.drop(columns=[key, _PLACE, "_lot"]))}])

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for states in batches:
            out = fold.finish(states.drop(columns=[key]))
            yield pd.concat([states[[key]].reset_index(drop=True), out.reset_index(drop=True)], axis=1)

    schema = f"`{key}` {kind}, {_PLACE} long, {fold.state}"
    ensure_checkpoint_dir(df.sparkSession)
    # one row a segment; kept, as the number of rounds has to be known
    states = df.withColumn(SEGMENT, number).groupBy(key, SEGMENT).applyInPandas(update, schema).checkpoint()
    most = states.groupBy(key).count().agg(F.max("count")).first()[0] or 1
    by = Window.partitionBy(key).orderBy(_PLACE)
    while most > 1:
        lots = states.withColumn("_lot", F.floor((F.row_number().over(by) - 1) / fan_in).cast("long"))
        states = lots.groupBy(key, "_lot").applyInPandas(merge, schema)
        most = -(-most // fan_in)
    return states.drop(_PLACE).mapInPandas(finish, f"`{key}` {kind}, {fold.result}")


def longest_rise(value: str) -> Fold:
    """The most consecutive rows of which each is above the one before."""
    def update(rows: pd.DataFrame) -> dict:
        x = rows[value].to_numpy(dtype=float)
        starts = [0, *[i for i in range(1, len(x)) if not x[i] > x[i - 1]], len(x)]
        runs = [b - a for a, b in zip(starts, starts[1:])]
        return {"n": len(x), "first": x[0], "last": x[-1], "head": runs[0], "tail": runs[-1], "best": max(runs)}

    def merge(states: pd.DataFrame) -> dict:
        parts = states.to_dict("records")
        out = parts[0]
        for s in parts[1:]:
            on = s["first"] > out["last"]
            out = {"n": out["n"] + s["n"], "first": out["first"], "last": s["last"],
                   "head": out["head"] + s["head"] if on and out["head"] == out["n"] else out["head"],
                   "tail": out["tail"] + s["tail"] if on and s["tail"] == s["n"] else s["tail"],
                   "best": max(out["best"], s["best"], out["tail"] + s["head"] if on else 0)}
        return out

    return Fold("n long, first double, last double, head long, tail long, best long", update, merge,
                lambda states: states[["n", "best"]].rename(columns={"n": "n_rows", "best": "longest_rise"}),
                "n_rows long, longest_rise long")
