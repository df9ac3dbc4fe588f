"""Per-symbol series: pandas differential tests, border defects (D-1, D-2),
segmented == unsegmented, and properties."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bourse.operators.series import (SeriesPass, ffill, ffill_pct_change, latest,
                                     next_value, pct_change, sort_desc, zscore)

SCHEMA = "k string, t int, v double"


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_ffill_never_crosses_symbols_d1(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("B", 1, None), ("B", 2, 5.0)], SCHEMA)
    for seg in ("month", None, 1):
        out = ffill(df, "k", "t", ["v"], segment=seg if seg != "month" else 1)
        assert _rows(out, ["k", "t", "v"]) == [("A", 1, 1.0), ("B", 1, None), ("B", 2, 5.0)]


def test_pct_change_first_row_per_symbol_d2(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0), ("B", 1, 10.0), ("B", 2, 20.0)],
                               SCHEMA)
    out = pct_change(df, "k", "t", "v", "chg", fill=0.0, segment=1)
    assert _rows(out, ["k", "t", "chg"]) == [("A", 1, 0.0), ("A", 2, 1.0),
                                             ("B", 1, 0.0), ("B", 2, 1.0)]


def test_pct_change_zero_base(spark):
    df = spark.createDataFrame([("A", 1, 0.0), ("A", 2, 5.0), ("A", 3, 0.0)], SCHEMA)
    out = pct_change(df, "k", "t", "v", "chg", fill=0.0, segment=2)
    assert [r.chg for r in out.orderBy("t").collect()] == [0.0, None, -1.0]


def _random_frame(seed, n_keys=4, n=60, null_rate=0.3, gaps=True):
    rnd = random.Random(seed)
    rows = []
    for k in range(n_keys):
        t = 0
        for _ in range(rnd.randint(0, n)):
            t += rnd.choice([1, 1, 2, 7]) if gaps else 1
            v = None if rnd.random() < null_rate else round(rnd.uniform(-5, 50), 2)
            rows.append((f"S{k}", t, v))
    return rows


def _pandas_reference(rows):
    """The reference's pandas semantics, applied per symbol."""
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).sort_values(["k", "t"])
    out = []
    for k, g in pdf.groupby("k", sort=True):
        g = g.copy()
        g["ff"] = g["v"].ffill()
        with np.errstate(all="ignore"):
            prev = g["v"].shift(1)
            g["chg"] = np.where(prev == 0, np.nan, g["v"] / prev - 1)
        g["nxt"] = g["v"].shift(-1)
        out.append(g)
    return pd.concat(out) if out else pdf


def _norm(x):
    return None if x is None or (isinstance(x, float) and np.isnan(x)) else round(float(x), 9)


def test_segmented_matches_pandas_and_unsegmented(spark):
    rows = _random_frame(7)
    df = spark.createDataFrame(rows, SCHEMA)
    ref = _pandas_reference(rows)
    exp_ff = sorted((r.k, r.t, _norm(r.ff)) for r in ref.itertuples())
    exp_chg = sorted((r.k, r.t, _norm(r.chg)) for r in ref.itertuples())
    exp_nxt = sorted((r.k, r.t, _norm(r.nxt)) for r in ref.itertuples())
    for seg in (None, 3, 10, 1000):
        ff = ffill(df, "k", "t", ["v"], segment=seg)
        assert sorted((r.k, r.t, _norm(r.v)) for r in ff.collect()) == exp_ff, seg
        ch = pct_change(df, "k", "t", "v", "chg", segment=seg)
        assert sorted((r.k, r.t, _norm(r.chg)) for r in ch.collect()) == exp_chg, seg
        nx = next_value(df, "k", "t", "v", "nxt", segment=seg)
        assert sorted((r.k, r.t, _norm(r.nxt)) for r in nx.collect()) == exp_nxt, seg


@settings(max_examples=8, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.sampled_from([1, 2, 5, None]))
def test_fused_ffill_pct_change_equals_chain(spark, seed, seg):
    rows = _random_frame(seed, n_keys=3, n=30, null_rate=0.4)
    df = spark.createDataFrame(rows, SCHEMA)
    chain = pct_change(ffill(df, "k", "t", ["v"], segment=seg).dropna(subset=["v"]),
                       "k", "t", "v", "chg", fill=0.0, segment=seg)
    fused = ffill_pct_change(df, "k", "t", "v", "chg", fill=0.0, segment=seg)
    cols = ["k", "t", "v", "chg"]
    assert _rows(chain, cols) == _rows(fused, cols)


@settings(max_examples=6, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_ffill_is_idempotent_and_keeps_keys(spark, seed):
    df = spark.createDataFrame(_random_frame(seed, n_keys=3, n=25), SCHEMA)
    once = ffill(df, "k", "t", ["v"], segment=4)
    twice = ffill(once, "k", "t", ["v"], segment=4)
    assert _rows(once, ["k", "t", "v"]) == _rows(twice, ["k", "t", "v"])
    assert once.count() == df.count()


def test_pct_change_compounding_restores_series(spark):
    rows = [("A", t, float(v)) for t, v in enumerate([10, 11, 9, 12, 15], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = pct_change(df, "k", "t", "v", "chg", fill=0.0, segment=2).orderBy("t").collect()
    level = out[0].v
    for r in out[1:]:
        level = level * (1 + r.chg)
        assert abs(level - r.v) < 1e-9


def test_hot_key_is_split_across_segments(spark):
    """One key with a third of the rows: the segmented window gives the same
    answer and its largest window group is one segment, not the whole key."""
    rows = [("HOT", t, float(t % 13) if t % 5 else None) for t in range(1, 901)]
    rows += [(f"K{k}", t, float(t)) for k in range(30) for t in range(1, 61)]
    df = spark.createDataFrame(rows, SCHEMA)
    seg = 50
    a = ffill(df, "k", "t", ["v"], segment=seg)
    b = ffill(df, "k", "t", ["v"], segment=None)
    assert _rows(a, ["k", "t", "v"]) == _rows(b, ["k", "t", "v"])
    biggest = (df.withColumn("s", F.floor(F.col("t") / seg)).groupBy("k", "s").count()
                 .agg(F.max("count")).first()[0])
    assert biggest <= seg


def test_latest_zscore_next(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 5.0), ("B", 1, 1.0), ("B", 2, 3.0)],
                               SCHEMA)
    lt = {r.k: (r.t, r.v) for r in latest(df, "k", "t").collect()}
    assert lt == {"A": (2, 5.0), "B": (2, 3.0)}
    z = {(r.k, r.t): r.z for r in zscore(df, "k", "v", "z").collect()}
    assert z[("A", 1)] == 0.0 and z[("A", 2)] == 0.0      # constant series -> 0
    assert z[("B", 1)] == -1.0 and z[("B", 2)] == 1.0
    nx = {(r.k, r.t): r.n for r in next_value(df, "k", "t", "v", "n").collect()}
    assert nx[("A", 2)] is None and nx[("B", 1)] == 3.0


def test_first_last_flags(spark):
    df = spark.createDataFrame(_random_frame(3, n_keys=3, n=20), SCHEMA)
    out = SeriesPass(keys=["k"], order=["t"], segment=3).apply(df)
    firsts = out.filter("_first").groupBy("k").count().collect()
    lasts = out.filter("_last").groupBy("k").count().collect()
    assert all(r["count"] == 1 for r in firsts + lasts)
    assert len(firsts) == df.select("k").distinct().count()


def test_time_segments_agree(spark):
    rows = [("A", f"2024-01-{d:02d} {h:02d}:15:00", None if (d + h) % 3 else float(d * 100 + h))
            for d in (1, 2, 15, 31) for h in (0, 9, 23)]
    df = spark.createDataFrame(rows, "k string, t string, v double") \
        .selectExpr("k", "cast(t as timestamp_ntz) t", "v")
    want = _rows(ffill(df, "k", "t", ["v"], segment=None), ["k", "t", "v"])
    for seg in ("hour", "day", "week", "month", "year"):
        assert _rows(ffill(df, "k", "t", ["v"], segment=seg), ["k", "t", "v"]) == want, seg


def test_sort_desc_missing_last(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (4, 3.0)],
                               "id int, v double")
    ids = [r.id for r in sort_desc(df, "v", "id").collect()]
    assert ids[:2] == [4, 1] and set(ids[2:]) == {2, 3}


@pytest.mark.parametrize("seg", ["auto", 2, "range"])
def test_missing_keys_orders_and_nan_as_in_the_plain_window(spark, seg):
    import datetime as dt
    day = lambda m, d: dt.date(2020, m, d)
    rows = [(None, day(1, 1), 3.0), (None, day(2, 5), None), (None, day(3, 5), 4.0), ("a", None, 7.0),
            ("a", day(1, 3), None), ("a", day(2, 3), float("nan")), ("a", day(4, 3), 2.0), ("b", day(1, 1), float("nan")),
            ("b", day(5, 1), 1.0)]
    df = spark.createDataFrame(rows, "k string, t date, v double")
    if seg == 2:
        df = df.withColumn("t", F.datediff("t", F.lit("2020-01-01").cast("date")))
    for op in (lambda s: ffill(df, "k", "t", ["v"], segment=s), lambda s: pct_change(df, "k", "t", "v", "c", fill=0.0, segment=s),
               lambda s: next_value(df, "k", "t", "v", "n", segment=s)):
        a, b = op(seg), op(None)
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    filled = {(r.k, str(r.t)): r.v for r in ffill(df, "k", "t", ["v"], segment=seg).collect()}
    assert len(filled) == 9 and not [v for v in filled.values() if v is not None and v != v]
    assert None not in [r.v for r in ffill(df, "k", "t", ["v"], segment=seg).filter("k is null").collect()]


def test_zscore_takes_nan_as_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", float("nan"))], "k string, v double")
    assert sorted(str(r.z) for r in zscore(df, "k", "v", "z").collect()) == ["-1.0", "1.0", "None"]


def test_ranges_split_a_hot_key(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                  F.col("id").alias("t"), F.when(F.col("id") % 7 == 0, F.col("id") * 1.0).alias("v"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"     # AQE would merge ranges this small
    spark.conf.set(merge, "false")
    try:
        p = SeriesPass(keys=["k"], order=["t"], ffill=["v"], segment="range", keep_segment=True).apply(df)
        sizes = [r["count"] for r in p.filter("k = 'hot'").groupBy("_seg").count().collect()]
    finally:
        spark.conf.set(merge, "true")
    assert len(sizes) > 1 and max(sizes) <= 1200
    assert sorted(map(str, ffill(df, "k", "t", ["v"], segment="range").collect())) == \
        sorted(map(str, ffill(df, "k", "t", ["v"], segment=None).collect()))


def test_packed_order_sorts_as_its_columns(spark):
    import itertools
    from pyspark.sql import functions as F
    from bourse.operators.series import packed_order
    days = [None, "0001-01-01", "1969-12-31", "1970-01-01", "2024-02-29", "9999-12-31"]
    longs = [None, -2 ** 63, -1, 0, 1, 2 ** 63 - 1]
    small = [None, -128, 127]
    rows = list(itertools.product(days, longs, small))
    df = spark.createDataFrame(rows, "d string, n bigint, b tinyint").withColumn("d", F.col("d").cast("date"))
    got = [tuple(r)[:3] for r in df.withColumn("p", packed_order(df, ["d", "n", "b"])).orderBy("p").collect()]
    want = [tuple(r) for r in df.orderBy("d", "n", "b").collect()]
    assert got == want
    assert df.select(F.countDistinct(packed_order(df, ["d", "n", "b"]))).first()[0] == len(rows)
    two = df.withColumn("m", F.col("n"))
    assert packed_order(two, ["n", "m"]) is None and packed_order(df.withColumn("t", F.lit("x")), ["t"]) is None


def test_latest_and_fill_by_hash_aggregates(spark):
    from bourse.operators import keep_first, latest
    from bourse.plans import adapters as A
    prices = A.prices(spark, "/root/testdata/sf0.001")
    bars = A.bars(spark, "/root/testdata/sf0.001")
    for df in (latest(bars, "symbol", "date", ["date", "close", "volume"]), latest(prices, "code", ["date", "rid"]),
               keep_first(prices, ["code"], ["date", "rid"]),
               ffill(prices, "code", ["date", "rid"], ["close"])):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    got = {r["code"]: (r["date"], r["rid"]) for r in latest(prices, "code", ["date", "rid"]).collect()}
    pdf = prices.toPandas().sort_values(["date", "rid"]).groupby("code").tail(1)
    assert got == {c: (d, r) for c, d, r in zip(pdf["code"], pdf["date"], pdf["rid"])}


def test_latest_of_text_and_missing_order(spark):
    from bourse.operators import latest
    df = spark.createDataFrame([("a", None, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, t int, v string")
    assert sorted(map(tuple, latest(df, "k", "t").collect())) == [("a", 2, "y"), ("b", None, "z")]
    num = df.selectExpr("k", "t", "length(v) AS v")
    assert sorted((r["k"], r["t"], r["v"]) for r in latest(num, "k", "t").collect()) == [("a", 2, 1), ("b", None, 1)]
