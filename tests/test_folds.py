"""Folds over a key's rows against the same function over all its rows at once."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bourse.operators.folds import Fold, longest_rise, per_key_fold
from bourse.plans import adapters as A


def brute(pdf):
    out = {}
    for k, g in pdf.groupby("k", dropna=False):
        x = g.sort_values("d", na_position="first")["v"].tolist()
        best = run = 1
        for a, b in zip(x, x[1:]):
            run = run + 1 if b > a else 1
            best = max(best, run)
        out[None if pd.isna(k) else k] = (len(x), best)
    return out


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    made = [(rng.choice(["a", "a", "a", "b", "c", None]), d, float(rng.randint(0, 30)) + d / 40 * rng.randint(0, 1)) for d in range(900)]
    made += [("one", 5, 1.0)] + [("up", d, float(d)) for d in range(400)]
    return spark.createDataFrame(made, "k string, d int, v double").selectExpr("k", "date_add(DATE '2020-01-01', d) AS d", "v")


@pytest.mark.parametrize("segment, fan_in", [("month", 256), ("day", 2), ("day", 7), ("year", 3)])
def test_segments_and_rounds_do_not_change_the_result(spark, rows, segment, fan_in):
    got = per_key_fold(rows, "k", "d", longest_rise("v"), segment=segment, fan_in=fan_in).collect()
    assert {r["k"]: (r["n_rows"], r["longest_rise"]) for r in got} == brute(rows.toPandas())
    assert len(got) == 6


def test_no_task_sees_a_whole_key(spark):
    """Segments of a hot key come one by one."""
    df = spark.range(24 * 40).selectExpr("'hot' AS k", "date_add(DATE '2020-01-01', CAST(id AS INT)) AS d", "CAST(id AS DOUBLE) AS v")
    most = Fold("n long, most long", lambda rows: {"n": len(rows), "most": len(rows)},
                lambda s: {"n": int(s["n"].sum()), "most": int(s["most"].max())}, lambda s: s, "n long, most long")
    r, = per_key_fold(df, "k", "d", most).collect()
    assert (r["n"], r["most"]) == (960, 31)


def test_empty_and_missing_order(spark, rows):
    assert per_key_fold(rows.limit(0), "k", "d", longest_rise("v")).collect() == []
    df = spark.createDataFrame([("a", None, 5.0), ("a", 1, 6.0), ("a", 2, 7.0)], "k string, d int, v double")
    assert [tuple(r) for r in per_key_fold(df, "k", "d", longest_rise("v"), segment=1).collect()] == [("a", 3, 3)]


def test_bars_of_the_test_tables(spark):
    bars = A.bars(spark, "/root/testdata/sf0.001")
    got = {r["symbol"]: r["longest_rise"] for r in per_key_fold(bars, "symbol", "date", longest_rise("close")).collect()}
    pdf = bars.select(F.col("symbol").alias("k"), F.col("date").alias("d"), F.col("close").alias("v")).toPandas()
    assert got == {k: b for k, (_, b) in brute(pdf).items()}
