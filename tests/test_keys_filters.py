"""Keys, sets, filters, nulls and projections."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bourse.operators import (KeyViolation, assert_key, delete_like, delete_where,
                              distinct_keys, distinct_rows, drop_all_nan,
                              drop_col_at, drop_cols, drop_nan, fill_const,
                              filter_in, keep_first, key_violations, lookback,
                              quarantine, rename_positional, union_all,
                              with_row_index)


def test_keep_first_takes_smallest_order(spark):
    df = spark.createDataFrame([("A", 1, 3, "c"), ("A", 1, 1, "a"), ("A", 2, 2, "b"),
                                ("B", 1, 9, "z")], "k string, d int, rid int, v string")
    out = {(r.k, r.d): r.v for r in keep_first(df, ["k", "d"], ["rid"]).collect()}
    assert out == {("A", 1): "a", ("A", 2): "b", ("B", 1): "z"}


def test_keep_first_with_awkward_column_names(spark):
    df = spark.createDataFrame([("A", 2, 1.0), ("A", 1, 2.0)],
                               "`k.x` string, rid int, `USD (PM)` double")
    out = keep_first(df, ["k.x"], ["rid"]).collect()
    assert [tuple(r) for r in out] == [("A", 1, 2.0)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=40))
def test_keep_first_output_keys_are_unique(spark, pairs):
    rows = [(a, b, i) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "a int, b int, rid int")
    out = keep_first(df, ["a", "b"], ["rid"])
    assert out.count() == len(set(pairs))
    assert key_violations(out, ["a", "b"]).count() == 0


def test_key_audit(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), (None, 2), ("B", 3)], "k string, d int")
    v = {(r.k, r.d): (r.n_rows, r.reason) for r in key_violations(df, ["k", "d"]).collect()}
    assert v == {("A", 1): (2, "duplicate key"), (None, 2): (1, "null key")}
    with pytest.raises(KeyViolation):
        assert_key(df, ["k", "d"])
    with pytest.raises(KeyViolation):   # unique key, but a required column is NULL
        assert_key(df.filter("d > 1"), ["d"], required=["k"])
    assert_key(df.filter("d = 3"), ["k"], required=["d"])


def test_distinct_and_union(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    assert distinct_rows(df).count() == 2
    assert sorted(r.x for r in distinct_keys(df, "x").collect()) == [1, 2]
    other = spark.createDataFrame([(3, 1.5)], "x int, z double")
    u = union_all(df, other)
    assert set(u.columns) == {"x", "y", "z"} and u.count() == 4
    assert u.filter("x = 3").first().y is None


def test_delete_where_keeps_null(spark):
    df = spark.createDataFrame([(None,), ("Code",), ("a",), ("xCodex",)], "c string")
    assert sorted(r.c or "" for r in delete_like(df, "c", "%Code%").collect()) == ["", "a"]
    # plain filter(~pred) would lose the NULL row
    assert df.filter(~F.col("c").like("%Code%")).count() == 1
    assert delete_where(df, F.col("c") == "a").count() == 3


def test_dropna_variants_treat_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, None), (2.0, None)],
                               "v double, s string")
    assert drop_nan(df, ["v"]).count() == 2
    assert drop_nan(df).count() == 1
    assert drop_all_nan(df).count() == 3


def test_fill_const(spark):
    df = spark.createDataFrame([(None, None, "x"), (1.0, 2, None)], "a double, b bigint, s string")
    one = fill_const(df, "a", 0.0).collect()
    assert sorted(r.a for r in one) == [0.0, 1.0]
    alln = fill_const(df, None, -1).collect()
    assert sorted((r.a, r.b) for r in alln) == [(-1.0, -1), (1.0, 2)]


def test_filter_in_list_and_frame(spark):
    df = spark.createDataFrame([(i, i * 1.0) for i in range(10)], "s int, v double")
    assert filter_in(df, "s", [1, 3]).count() == 2
    keys = spark.createDataFrame([(2,), (4,), (40,)], "s int")
    assert sorted(r.s for r in filter_in(df, "s", F.broadcast(keys)).collect()) == [2, 4]
    labels = spark.createDataFrame([(2, "two"), (5, "five")], "code int, name string")
    got = filter_in(df, "s", labels, value_col="code", keep=["name"]).collect()
    assert sorted((r.s, r.name) for r in got) == [(2, "two"), (5, "five")]


def test_lookback(spark):
    df = spark.createDataFrame([("2000-01-01",), ("2019-06-01",), ("2020-06-01",)], "d string") \
        .select(F.to_date("d").alias("d"))
    assert lookback(df, "d", 1, "2020-12-31").count() == 1
    assert lookback(df, "d", 20, "2020-12-31").count() == 2


def test_quarantine_returns_rejects_with_reason(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 1.0, None), (3, 2.0, 4.0)],
                               "s int, prev double, cap double")
    good, bad = quarantine(df, {"zero base": F.col("prev") != 0,
                                "no cap": F.col("cap").isNotNull()})
    assert [r.s for r in good.collect()] == [3]
    assert sorted((r.s, r._reason) for r in bad.collect()) == [(1, "zero base"), (2, "no cap")]


def test_projections(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert drop_cols(df, ["b"]).columns == ["a", "c", "d"]
    with pytest.raises(KeyError):
        drop_cols(df, ["nope"])
    assert drop_col_at(df, 3).columns == ["a", "b", "c"]
    assert rename_positional(df, ["w", "x", "y", "z"]).columns == ["w", "x", "y", "z"]


def test_row_index_is_consecutive_across_partitions(spark):
    df = spark.range(0, 2500).select((F.col("id") * 7 % 2500).alias("v")).repartition(5)
    out = with_row_index(df, [F.col("v").desc()], "index")
    rows = out.orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(1, 2501))
    assert [r.v for r in rows] == sorted((r.v for r in rows), reverse=True)


def test_dropna_variants_match_pandas(spark):
    import pandas as pd
    rows = [(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, None), (4, 2.0, None),
            (5, float("nan"), None)]
    df = spark.createDataFrame(rows, "id int, v double, s string")
    pdf = pd.DataFrame(rows, columns=["id", "v", "s"])
    cases = [(drop_nan(df, ["v"]), pdf.dropna(subset=["v"])),
             (drop_nan(df), pdf.dropna()),
             (drop_all_nan(df.select("v", "s")), pdf[["v", "s"]].dropna(how="all"))]
    for got, want in cases:
        assert got.count() == len(want)
    assert sorted(r.id for r in drop_nan(df, ["v"]).collect()) == list(pdf.dropna(subset=["v"]).id)


def test_history_keeps_the_whole_last_day(spark):
    from bourse.operators.filters import scan_history
    df = spark.sql("SELECT explode(array(timestamp'2020-12-31 15:00:00', timestamp'2021-01-01 00:00:00', timestamp'2019-01-01')) AS t")
    assert [str(r.t) for r in scan_history(df, "t", "2020-01-01", "2020-12-31").collect()] == ["2020-12-31 15:00:00"]
    days = df.selectExpr("to_date(t) AS t")
    assert [str(r.t) for r in scan_history(days, "t", "2020-01-01", "2020-12-31").collect()] == ["2020-12-31"]
