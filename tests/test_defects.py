"""One test per reference defect the build fixes: each fails
if the defect comes back."""

from pyspark.sql import functions as F

from bourse.operators import distinct_rows, ffill, pct_change, quarantine
from bourse.plans import adapters as A
from bourse.plans.jobs import co_overview, nas_list, snapshot

SF = "/root/testdata/sf0.001"


def test_d1_forward_fill_stays_inside_a_symbol(spark):
    df = spark.createDataFrame([("A", 1, 9.0), ("B", 1, None), ("B", 2, 5.0)],
                               "k string, t int, v double")
    b1 = ffill(df, "k", "t", ["v"]).filter("k = 'B' and t = 1").first()
    assert b1.v is None


def test_d2_first_change_of_every_symbol_is_zero(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0), ("B", 1, 10.0)],
                               "k string, t int, v double")
    out = pct_change(df, "k", "t", "v", "chg", fill=0.0)
    assert out.filter("k = 'B'").first().chg == 0.0


def test_d3_dedup_result_is_kept(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "x int, y string")
    assert distinct_rows(df).count() == 1


def test_d4_listing_holds_no_header_rows(spark):
    out = nas_list(spark, SF)
    assert out.filter(F.col("Symbol").isin("Symbol", "Name")).count() == 0


def test_d6_first_company_of_a_headerless_file_is_kept(spark):
    out = co_overview(spark, SF)
    expected = A.table(spark, SF, "customer").filter("c_acctbal >= 0").count()
    assert out.count() == expected


def test_d7_snapshot_writes_its_own_table(spark):
    a = snapshot(spark, SF).inputFiles()
    b = nas_list(spark, SF).inputFiles()
    assert a and b and not set(a) & set(b)


def test_d12_rejects_are_returned_with_a_reason(spark):
    s = A.snapshot(spark, SF)
    good, bad = quarantine(s, {"previous close is zero": F.col("previousClose") != 0})
    assert bad.count() > 0
    assert bad.filter(F.col("_reason").isNull()).count() == 0
    assert good.count() + bad.count() == s.count()


def test_d8_listing_job_does_not_touch_the_bars_table(spark):
    from bourse.plans.jobs import snp_list, snp_stock
    listing = snp_list(spark, SF)
    bars = snp_stock(spark, SF)
    assert listing.columns == ["Symbol", "Name", "Sector", "Industry"]
    assert bars.columns == ["date", "code", "close", "change"]
    assert not set(listing.inputFiles()) & set(bars.inputFiles())
