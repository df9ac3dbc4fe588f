"""Driver contract: entry smoke run, and every registered query against its
DuckDB oracle on the smallest fixture (the driver repeats this at sf0.01)."""

import math
import os
import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
NO_ORACLE: set[str] = set()
# the training-data operators have their own tests in tests/llm
OWN = {k for k in queries() if not re.match(r"op\d+_|pipeline$", k)}


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["date", "code", "close", "change"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert OWN - set(oracle_sql()) == NO_ORACLE
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v.isoformat() if hasattr(v, "isoformat") else v
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(OWN - NO_ORACLE))
def test_query_matches_oracle(spark, con, name):
    if not os.path.isdir(SF):
        pytest.skip("no fixture")
    df = queries()[name](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert _canon(rows, cols) == _canon(res.fetchall(), ocols)
