"""Scalar functions (SCL-*), checked against pandas where the reference used it."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bourse.functions import (cast_columns, conform, direction, format_date,
                              has_json_key, json_field, limit_text, parse_date,
                              pct_diff, text_too_long, to_numeric, zfill)
from bourse.schemas import ddl

NUMBER_TEXT = ["1234.0", "abc", "", " 12 ", "1,234", "12d", "1e3", "0x10", ".5", "-3", "5."]
NUMBER_EXPECTED = [1234.0, None, None, 12.0, None, None, 1000.0, None, 0.5, -3.0, 5.0]


def test_to_numeric_matches_fixture_and_pandas(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(NUMBER_TEXT)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", to_numeric("t").alias("v")).collect()}
    assert [got[i] for i in range(len(NUMBER_TEXT))] == NUMBER_EXPECTED
    pd_vals = pd.to_numeric(pd.Series(NUMBER_TEXT), errors="coerce")
    for i, v in enumerate(pd_vals):
        if i in (3,):          # pandas keeps ' 12 ' too
            continue
        exp = None if math.isnan(v) else float(v)
        assert got[i] == exp, NUMBER_TEXT[i]


def test_to_numeric_special_values_match_pandas(spark):
    vals = ["inf", "-inf", "+inf", "INF", "infinity", "-Infinity", " inf ", "1e400", "+5",
            "1.5e-3", "nan"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(vals)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", to_numeric("t").alias("v")).collect()}
    for i, v in enumerate(pd.to_numeric(pd.Series(vals, dtype=object), errors="coerce")):
        exp = None if math.isnan(v) else float(v)
        assert got[i] == exp, vals[i]


def test_zfill(spark):
    df = spark.createDataFrame([("5930",), ("1234567",), (None,), ("005930",)], "c string")
    assert [r.z for r in df.select(zfill("c", 6).alias("z")).collect()] == \
        ["005930", "1234567", None, "005930"]
    # the same as Python's str.zfill on every non-null value
    for s in ["5930", "1234567", "005930"]:
        assert s.zfill(6) == df.filter(F.col("c") == s).select(zfill("c", 6)).first()[0]


def test_pct_diff_direction(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 1.0), (0.5, 1.0), (1.0, 0.0), (None, 1.0)],
                               "a double, b double")
    rows = df.select(pct_diff("a", "b", 4).alias("p"), direction("a", "b").alias("d"),
                     pct_diff("a", "b", None).alias("raw")).collect()
    assert [r.p for r in rows] == [100.0, 0.0, -50.0, None, None]
    assert [r.d for r in rows] == ["up", "down", "down", "up", "down"]
    assert rows[3].raw is None


def test_limit_text_and_dates(spark):
    df = spark.createDataFrame([("abcdefghijkl", "2024-01-05")], "s string, d string")
    r = df.select(limit_text("s", 5).alias("t"), text_too_long("s", 5).alias("long"),
                  parse_date("d").alias("pd"), format_date(parse_date("d")).alias("fd")).first()
    assert r.t == "abcde" and r.long is True
    assert str(r.pd) == "2024-01-05" and r.fd == "2024-01-05"


def test_limit_text_fail_mode(spark):
    ok = spark.createDataFrame([("abc",)], "s string")
    assert ok.select(limit_text("s", 5, "fail")).first()[0] == "abc"
    bad = spark.createDataFrame([("abcdefg",)], "s string")
    with pytest.raises(Exception, match="too long"):
        bad.select(limit_text("s", 5, "fail")).collect()


def test_json_field(spark):
    df = spark.createDataFrame([('{"k": 3}',), ('{"Error Message": "bad"}',)], "j string")
    rows = df.select(json_field("j", "k").alias("k"),
                     has_json_key("j", "Error Message").alias("e")).collect()
    assert [(r.k, r.e) for r in rows] == [("3", False), (None, True)]


def test_strict_cast_fails_the_load(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    with pytest.raises(Exception):
        cast_columns(df, {"v": "int"}).collect()


def test_conform_overflow_raises(spark):
    df = spark.createDataFrame([(2 ** 40,)], "v bigint")
    with pytest.raises(Exception):
        conform(df, ddl("v int")).collect()
    ok = spark.createDataFrame([(7,)], "v bigint")
    assert conform(ok, ddl("v int")).schema["v"].dataType.typeName() == "integer"
