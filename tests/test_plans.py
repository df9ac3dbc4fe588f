"""Plan shape: windows are always keyed, the listing join is broadcast after
its size check, filters and column lists reach the Parquet scan."""

import re

from bourse.operators.forecast import feature_frame
from bourse.operators import ffill, keep_first, next_value, pct_change
from bourse.operators.joins import enrich_bars
from bourse.plans import adapters as A
from bourse.plans.catalog import src_history
from bourse.plans.jobs import snp_stock_frame

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _window_partition_specs(plan: str):
    # Window [exprs], [partition spec], [order spec]
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)


def test_every_series_window_is_keyed(spark):
    for df in (snp_stock_frame(spark, SF), feature_frame(A.bars(spark, SF))):
        specs = _window_partition_specs(_plan(df))
        assert specs, "expected window operators"
        assert all(s.strip() for s in specs), specs


def test_flagship_shuffles_are_bounded(spark):
    plan = _plan(snp_stock_frame(spark, SF))
    # keep-first (2: partial agg + carry summary reuse), summary -> carry,
    # carry -> join side, main -> (code, segment): no exchange on a lone key
    assert plan.count("Exchange hashpartitioning") <= 6
    assert "SinglePartition" not in plan


def test_listing_join_has_no_hint(spark):
    """A broadcast is Spark's choice by real size, never ours."""
    df = enrich_bars(A.prices(spark, SF), A.listing(spark, SF))
    assert "rightHint" not in df._jdf.queryExecution().optimizedPlan().toString()


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_series_read_their_input_once(spark):
    bars = A.bars(spark, SF).select("symbol", "date", "close")
    for df in (snp_stock_frame(spark, SF), pct_change(bars, "symbol", "date", "close", "c"),
               next_value(bars, "symbol", "date", "close", "n"), ffill(bars, "symbol", "date", ["close"])):
        plan = _executed(df)
        assert plan.count("FileScan parquet") == 1, plan
        assert "ReusedExchange" in plan


def test_fixed_width_keep_first_is_a_hash_aggregate(spark):
    df = keep_first(A.table(spark, SF, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey"),
                    ["o_custkey", "o_orderdate"], ["o_orderkey"])
    assert "SortAggregate" not in _executed(df)


def test_history_filter_is_pushed_down(spark):
    plan = _plan(src_history(spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
