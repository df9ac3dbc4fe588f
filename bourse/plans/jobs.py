"""Composed jobs PIP-1..15: each lands its input the way the reference
receives it, cleans it with the operators, writes an audited table under the
shared scratch folder and returns the table as read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.functions.scalar import cast_columns, conform, json_field, limit_text, zfill
from bourse.operators.filters import drop_nan, filter_in, lookback, scan_history
from bourse.operators.forecast import fit_linear, forecast_report
from bourse.operators.joins import enrich_bars, enrich_listing
from bourse.operators.keys import keep_first
from bourse.operators.projection import drop_cols, rename_positional, with_key
from bourse.operators.series import ffill, ffill_pct_change
from bourse.plans import adapters as A
from bourse.plans import markets as M
from bourse.schemas import ddl
from bourse.session import scratch_path
from bourse.sinks.tables import (publish, read_rejects, read_table, refresh_table, write_csv,
                                 write_market_partitioned, write_partitioned, write_per_value_files)
from bourse.sources.files import scan_csv, scan_csv_positional, scan_symbol_files

HISTORY_START = "1992-01-01"


def krx_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-1: landed listing CSV -> drop missing Code/Name -> audited table."""
    base = scratch_path(spark, "krx_list")
    cols = ["code", "name", "market", "marcap"]
    write_csv(A.listing(spark, sf_dir), f"{base}/landed")
    raw = scan_csv(spark, f"{base}/landed", cols, keep_text=["code"])
    clean = drop_nan(raw, ["code", "name"])
    refresh_table(clean, f"{base}/table", key=["code"], required=["name"],
                  types={"marcap": "double"})
    return read_table(spark, f"{base}/table")


def krx_co_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-2: landed company info -> drop missing Code/Sector -> audited table."""
    base = scratch_path(spark, "krx_co_info")
    cols = ["code", "sector", "region"]
    write_csv(A.info(spark, sf_dir), f"{base}/landed")
    raw = scan_csv(spark, f"{base}/landed", cols, keep_text=["code"])
    refresh_table(drop_nan(raw, ["code", "sector"]), f"{base}/table", key=["code"])
    return read_table(spark, f"{base}/table")


def krx_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-3: bars of listed codes since the history start -> first row per
    (code, date) -> drop missing Date/Code -> forward fill per code -> table."""
    base = scratch_path(spark, "krx_stock")
    p = filter_in(A.prices(spark, sf_dir), "code", A.listing(spark, sf_dir))
    p = scan_history(p, "date", HISTORY_START)
    p = keep_first(p, ["code", "date"], ["rid"])
    p = drop_nan(p, ["date", "code"])
    p = ffill(p, "code", "date", ["close"])
    p = p.select("date", zfill("code", A.CODE_WIDTH).alias("code"), "close")
    # sorted by code and date, so that later reads can skip files
    refresh_table(p, f"{base}/table", key=["date", "code"], order=["code", "date"])
    return read_table(spark, f"{base}/table")


def krx_stock_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-4: one landed file set per symbol -> drop Change -> drop incomplete
    rows -> typed bars."""
    base = scratch_path(spark, "krx_stock_legacy")
    b = A.bars(spark, sf_dir)
    landed = b.withColumn("change", F.try_divide(F.col("close") - F.col("open"), F.col("open")))
    write_per_value_files(landed.select("symbol", "date", "open", "high", "low", "close",
                                        "volume", "change"), f"{base}/landed", "symbol", ["date"])
    names = ["date", "open", "high", "low", "close", "volume", "change"]
    raw = scan_symbol_files(spark, f"{base}/landed", names, r"symbol=([^/]+)/", "symbol")
    raw = drop_nan(drop_cols(raw, ["change"]))
    bars = raw.select("symbol", "date", "open", "high", "low", "close", "volume")
    return cast_columns(bars, {"symbol": "bigint", "date": "date", "open": "double",
                         "high": "double", "low": "double", "close": "double",
                         "volume": "bigint"})


def nas_listing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NASDAQ-style listing with repeated symbols (segment + nation code)."""
    c = A.table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.upper(F.substring("c_mktsegment", 1, 4)),
                 F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("Symbol"),
        F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Industry"),
        F.col("c_nationkey").cast("string").alias("IndustryCode"),
        F.col("c_custkey").alias("rid"))


def nas_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-5: landed list -> keep the first row per Symbol -> table.  Landed
    in source order: part files follow the sort, so file order is row order."""
    base = scratch_path(spark, "nas_list")
    write_csv(nas_listing_source(spark, sf_dir).orderBy("rid").drop("rid"), f"{base}/landed")
    return M.nas_list(spark, f"{base}/landed", f"{base}/table")


def nas_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-6: per-symbol extracts with repeated dates -> keep first per
    (Date, Symbol) -> table."""
    base = scratch_path(spark, "nas_stock")
    e = A.table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("symbol"), F.col("ts").cast("date").alias("date"),
                    F.col("value").alias("close"),
                    json_field("props", "k").cast("double").alias("volume"),
                    F.col("event_id").alias("rid"))
    rows = scan_history(rows, "date", "2003-01-01")
    first = keep_first(rows, ["symbol", "date"], ["rid"]).drop("rid")
    first = with_key(first, "exchange", "NASDAQ")      # PRJ-5: the feed's key
    refresh_table(first, f"{base}/table", key=["date", "symbol"])
    return read_table(spark, f"{base}/table")


def overview_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON reply per company; companies in debt get an error reply."""
    c = A.table(spark, sf_dir, "customer")
    n = F.broadcast(A.table(spark, sf_dir, "nation"))  # 25 rows at every scale
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    code = zfill("c_custkey", A.CODE_WIDTH)
    body = F.to_json(F.struct(
        code.alias("Symbol"), F.lit("Common Stock").alias("AssetType"),
        F.col("c_name").alias("Name"),
        F.concat(F.col("c_name"), F.lit(", a "), F.lower("c_mktsegment"),
                 F.lit(" company")).alias("Description"),
        F.col("c_mktsegment").alias("Exchange"), F.col("n_name").alias("Sector"),
        F.col("c_acctbal").alias("MarketCapitalization")))
    err = F.to_json(F.struct(F.concat(F.lit("Invalid API call for "), code)
                             .alias("Error Message")))
    return j.select(code.alias("code"),
                    F.when(F.col("c_acctbal") >= 0, body).otherwise(err).alias("reply"))


def co_overview(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """PIP-7: JSON replies of listed companies -> the overview table; its columns
    that the replies fill."""
    base = base or scratch_path(spark, "co_overview")
    replies = filter_in(overview_records(spark, sf_dir), "code", A.listing(spark, sf_dir))
    table, _errors = M.company_overview(spark, replies, f"{base}/table")
    cols = ["Symbol", "AssetType", "Name", "Exchange", "Sector"]
    return table.select(*cols, F.col("MarketCapitalization").cast("double").alias("MarketCapitalization"))


def snapshot(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """PIP-8: snapshot -> % change open vs previous close -> quotes that cannot
    be computed refused -> rows without a name dropped -> table by market cap."""
    base = base or scratch_path(spark, "snapshot")
    table, _rejects = M.market_snapshot(spark, A.snapshot(spark, sf_dir, with_volume=True), f"{base}/table")
    return table.drop("volume")


def snp_listing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S&P-style listing; companies without info have no sector."""
    return enrich_listing(A.listing(spark, sf_dir), A.info(spark, sf_dir)).select(
        F.col("code").alias("Symbol"), F.col("name").alias("Name"),
        F.col("sector").alias("Sector"), F.col("market").alias("Industry"))


def snp_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-9: landed S&P list -> drop rows with any missing field -> table."""
    base = scratch_path(spark, "snp_list")
    write_csv(snp_listing_source(spark, sf_dir), f"{base}/landed")
    return M.snp_list(spark, f"{base}/landed", f"{base}/table")


def snp_stock_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship plan without the write: first row per (code, date) ->
    forward fill per code -> drop still-missing -> % change (0 on each code's
    first row).  The rows are exchanged twice: by the keep-first aggregate
    (map-side combined) and once by (code, month) for the fused fill and
    change; the per-(code, month) carry summary is a small partial aggregate
    that AQE broadcasts back."""
    p = scan_history(A.prices(spark, sf_dir), "date", HISTORY_START)
    p = keep_first(p, ["code", "date"], ["rid"])
    p = ffill_pct_change(p, "code", "date", "close", "change", fill=0.0)
    return p.select("date", "code", "close", "change")


def snp_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-10: the flagship plan, written as an audited table."""
    base = scratch_path(spark, "snp_stock")
    refresh_table(snp_stock_frame(spark, sf_dir), f"{base}/table", key=["date", "code"])
    return read_table(spark, f"{base}/table")


def materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-11: 20 years back from the latest quote -> drop rows without the
    required price -> header-less cp949 CSV, date first -> table."""
    base = scratch_path(spark, "materials")
    c = A.commodity(spark, sf_dir)
    asof = c.select(F.max("date")).scalar()
    c = drop_nan(lookback(c, "date", 20, asof), ["value"])
    write_csv(c.select("date", "material", "value"), f"{base}/landed", header=False,
              encoding="cp949")
    raw = scan_csv_positional(spark, f"{base}/landed", ["c0", "c1", "c2"], encoding="cp949")
    renamed = rename_positional(raw, ["date", "material", "value"])
    refresh_table(renamed.select("material", "date", "value"), f"{base}/table",
                  key=["material", "date"], types={"date": "date", "value": "double"})
    return read_table(spark, f"{base}/table")


LIST_BY_MARKET = ddl(
    "code string, name string, market string, marcap double, sector string, region string")


def list_by_market(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """PIP-12: listing LEFT JOIN info -> table types -> names must fit 40
    characters -> key (code, market) -> one child per market group."""
    base = base or scratch_path(spark, "list_by_market")
    j = conform(enrich_listing(A.listing(spark, sf_dir), A.info(spark, sf_dir)),
                LIST_BY_MARKET)
    j = j.withColumn("name", limit_text("name", 40, "fail"))
    write_market_partitioned(j, f"{base}/table", "market", A.SEGMENT_GROUPS,
                             key=["code", "market"], order=["code"])
    return read_table(spark, f"{base}/table")


def bars_by_market(spark: SparkSession, sf_dir: str, base: str | None = None) -> DataFrame:
    """PIP-13: bars INNER JOIN listing -> key (date, code, market) -> one child
    per market group."""
    base = base or scratch_path(spark, "bars_by_market")
    listing = A.listing(spark, sf_dir)
    p = filter_in(A.prices(spark, sf_dir), "code", listing)     # before the shuffle of keep-first
    j = enrich_bars(keep_first(p, ["code", "date"], ["rid"]).drop("rid"), listing)
    write_market_partitioned(j, f"{base}/table", "market", A.SEGMENT_GROUPS,
                             key=["date", "code", "market"], order=["code", "date"])
    return read_table(spark, f"{base}/table")


BARS_TABLE = ddl(
    "symbol bigint, date date, open double, high double, low double, close double, volume int")


def bars_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-14: bars -> narrowed to the table types -> key (date, symbol) ->
    hashed-bucket list partitions."""
    base = scratch_path(spark, "bars_by_symbol")
    b = conform(A.bars(spark, sf_dir), BARS_TABLE)
    write_partitioned(b, f"{base}/table", "symbol", order=["date"],
                      refresh_key=["date", "symbol"])
    return read_table(spark, f"{base}/table").drop("bucket")


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIP-15: features per symbol -> linear fit per symbol -> report with a
    1-based index -> result table replaced."""
    base = scratch_path(spark, "forecast")
    rep = forecast_report(fit_linear(A.bars(spark, sf_dir)))
    publish(rep, f"{base}/table")
    return read_table(spark, f"{base}/table")


def rejects_of(job, rename=None, drop=()):
    """A query for the rows a job's load refused, with their reasons."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = scratch_path(spark, job.__name__)
        job(spark, sf_dir, base)
        return read_rejects(spark, f"{base}/table").withColumnsRenamed(rename or {}).drop(*drop)
    return run


JOBS = {
    "pip_krx_list": krx_list,
    "pip_krx_co_info": krx_co_info,
    "pip_krx_stock": krx_stock,
    "pip_krx_stock_legacy": krx_stock_legacy,
    "pip_nas_list": nas_list,
    "pip_nas_stock": nas_stock,
    "pip_co_overview": co_overview,
    "pip_snapshot": snapshot,
    "pip_snp_list": snp_list,
    "pip_snp_stock": snp_stock,
    "pip_materials": materials,
    "pip_list_by_market": list_by_market,
    "pip_bars_by_market": bars_by_market,
    "pip_bars_by_symbol": bars_by_symbol,
    "pip_forecast": forecast,
}

#: What the jobs that refuse rows refused.
REJECTS = {
    "pip_co_overview_rejects": rejects_of(co_overview, rename={"request_code": "code"}),
    "pip_snapshot_rejects": rejects_of(snapshot, drop=["volume"]),
    "pip_list_by_market_rejects": rejects_of(list_by_market),
    "pip_bars_by_market_rejects": rejects_of(bars_by_market),
}
