"""Query catalog: one Spark plan per operator of the survey (and one per
composed job), each with a DuckDB oracle over the same Parquet tables.

Every query runs over whole tables.  Where a query lands files first (the
source and sink operators), it writes under the session's shared scratch
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.functions.scalar import (cast_columns, conform, direction, format_date,
                                     json_field, limit_text, parse_date,
                                     parse_timestamp, pct_diff, text_too_long,
                                     to_numeric, zfill)
from bourse.operators.filters import (delete_like, drop_all_nan, drop_nan,
                                      filter_in, lookback, quarantine,
                                      scan_history)
from bourse.operators.forecast import (FEATURES, feature_frame, fit_linear, forecast_report,
                                       forecast_ridge, ridge_steps)
from bourse.operators.folds import longest_rise, per_key_fold
from bourse.operators.joins import enrich_bars, enrich_listing
from bourse.operators.keys import (distinct_keys, distinct_rows, keep_first,
                                   key_violations, union_all)
from bourse.operators.nulls import fill_const
from bourse.operators.projection import (drop_col_at, drop_cols,
                                         rename_positional, with_row_index)
from bourse.operators.series import (ffill, latest, next_value, pct_change,
                                     zscore)
from bourse.plans import adapters as A
from bourse.plans.adapters import with_sql
from bourse.plans import markets as M
from bourse.plans.daily import run_krx_day, run_nas_day, run_snp_day
from bourse.plans.jobs import BARS_TABLE, JOBS, REJECTS, nas_listing_source, overview_records, snp_listing_source
from bourse.session import scratch_path
from bourse.sinks.tables import (append_rows, partition_view,
                                 publish, read_table, refresh_table,
                                 replace_result, write_csv,
                                 write_market_partitioned, write_partitioned,
                                 write_per_value_files)
from bourse.schemas import (KRX_MARKET_GROUPS, MATERIAL_COLUMNS, MATERIAL_REQUIRED,
                            OVERVIEW_FIELDS)
from bourse.sources.files import (scan_csv, scan_csv_positional,
                                  scan_json_records, scan_symbol_files,
                                  scan_table)

LISTING_COLS = ["code", "name", "market", "marcap"]
BAR_TYPES = {"symbol": "bigint", "date": "date", "open": "double", "high": "double",
             "low": "double", "close": "double", "volume": "bigint"}


def _desc_missing_last(c: str):
    col = F.col(c)
    return F.when(~F.isnan(col), col).desc_nulls_last()


# --- sources -----------------------------------------------------------------

def src_csv_roundtrip(spark, d):
    base = scratch_path(spark, "src_csv")
    write_csv(A.listing(spark, d), base)
    raw = scan_csv(spark, base, LISTING_COLS, keep_text=["code"])
    return cast_columns(raw, {"marcap": "double"})


def _odd_names(spark, d):
    """Company names with quotes, commas, line breaks, blanks around them and
    backslashes, as landed text may hold them."""
    c = A.table(spark, d, "customer")
    name, kind = F.col("c_name"), F.col("c_custkey") % 6
    text = (F.when(kind == 0, F.concat(name, F.lit(', "Inc"')))
             .when(kind == 1, F.concat(name, F.lit("\nsecond line, \"quoted\"")))
             .when(kind == 2, F.concat(F.lit("  "), name, F.lit("  ")))
             .when(kind == 3, F.concat(name, F.lit('\\path\\"x"\\')))
             .when(kind == 4, F.concat(F.lit('"'), name)).otherwise(name))
    return c.select(F.col("c_custkey").cast("string").alias("code"), text.alias("name"),
                    F.col("c_mktsegment").alias("market"))


def src_csv_dialect(spark, d):
    base = scratch_path(spark, "src_csv_dialect")
    odd, names = _odd_names(spark, d), ["code", "name", "market"]
    write_csv(odd, f"{base}/header")
    write_csv(odd, f"{base}/plain", header=False)
    a = scan_csv(spark, f"{base}/header", names, multiline=True)
    b = scan_csv_positional(spark, f"{base}/plain", names, multiline=True)
    return union_all(a.withColumn("layout", F.lit("header")), b.withColumn("layout", F.lit("positional")))


def src_csv_positional(spark, d):
    base = scratch_path(spark, "src_positional")
    c = A.commodity(spark, d)
    write_csv(c.select("date", "material", "value"), base, header=False)
    raw = rename_positional(scan_csv_positional(spark, base, ["f0", "f1", "f2"]),
                            ["date", "material", "value"])
    return raw.select("material", parse_date("date").alias("date"),
                      F.col("value").cast("double").alias("value"))


def src_symbol_files(spark, d):
    base = scratch_path(spark, "src_symbol_files")
    write_per_value_files(A.bars(spark, d), base, "symbol", ["date"])
    raw = scan_symbol_files(spark, base, ["date", "open", "high", "low", "close", "volume"],
                            r"symbol=([^/]+)/", "symbol")
    return cast_columns(raw, BAR_TYPES).select(*BAR_TYPES)


def src_encoded(spark, d):
    base = scratch_path(spark, "src_encoded")
    lst = A.listing(spark, d)
    write_csv(lst, f"{base}/bom", bom=True)
    write_csv(lst, f"{base}/cp949", encoding="cp949")
    a = scan_csv(spark, f"{base}/bom", LISTING_COLS, keep_text=["code"]) \
        .withColumn("encoding", F.lit("utf-8-sig"))
    b = scan_csv(spark, f"{base}/cp949", LISTING_COLS, encoding="cp949", keep_text=["code"]) \
        .withColumn("encoding", F.lit("cp949"))
    return cast_columns(union_all(a, b), {"marcap": "double"})


def _replies(spark, d):
    e = A.table(spark, d, "events")
    err = F.to_json(F.struct(F.concat(F.lit("invalid call for "),
                                      F.col("event_id").cast("string")).alias("Error Message")))
    return e.select("event_id", F.when(F.col("event_type") == "error", err)
                    .otherwise(F.col("props")).alias("reply"))


def src_json(spark, d):
    good, bad = scan_json_records(_replies(spark, d), "reply",
                                  T.StructType([T.StructField("k", T.LongType())]))
    return union_all(good, bad).select("event_id", "k", "error_message")


def src_table_pruned(spark, d):
    return scan_table(spark, f"{d.rstrip('/')}/orders.parquet",
                      ["o_orderkey", "o_custkey", "o_totalprice"])


def src_history(spark, d):
    return scan_history(A.prices(spark, d), "date", "1996-01-01", "1997-12-31")


# --- sinks -------------------------------------------------------------------

def snk_append(spark, d):
    base = scratch_path(spark, "snk_append")
    p = A.prices(spark, d)
    early = F.coalesce(F.col("date") < F.lit("1996-01-01").cast("date"), F.lit(False))
    append_rows(p.filter(early), base)
    append_rows(p.filter(~early), base)
    return spark.read.parquet(base)


def snk_publish(spark, d):
    base = scratch_path(spark, "snk_publish")
    p = A.prices(spark, d)
    publish(p.filter(F.col("date") < F.lit("1996-01-01").cast("date")), base)
    publish(p, base)
    return read_table(spark, base)


def snk_refresh(spark, d):
    base = scratch_path(spark, "snk_refresh")
    write_csv(A.dirty(spark, d), f"{base}/landed", header=False)
    raw = scan_csv_positional(spark, f"{base}/landed", ["code", "close_text", "rid"])
    clean = drop_nan(delete_like(raw, "code", "%Code%"), ["code"])
    clean = clean.select("code", to_numeric("close_text").alias("close"), "rid")
    refresh_table(clean, f"{base}/table", key=["rid"], required=["code"],
                  types={"rid": "bigint"})
    return read_table(spark, f"{base}/table")


def _bars_table(spark, d):
    return conform(A.bars(spark, d), BARS_TABLE)


def snk_list_partition(spark, d):
    base = scratch_path(spark, "snk_list_partition")
    write_partitioned(_bars_table(spark, d), base, "symbol", order=["date"],
                      per_value=True, refresh_key=["date", "symbol"])
    return read_table(spark, base).select(*BARS_TABLE.fieldNames())


def snk_partition_view(spark, d):
    base = scratch_path(spark, "snk_partition_view")
    b = _bars_table(spark, d)
    write_partitioned(b, base, "symbol", order=["date"])
    busiest = (b.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.desc("n"), "symbol").first()["symbol"])
    return partition_view(spark, base, "symbol", busiest).select(*BARS_TABLE.fieldNames())


def snk_market_groups(spark, d):
    base = scratch_path(spark, "snk_market_groups")
    _, rejects = write_market_partitioned(A.listing(spark, d), base, "market",
                                          A.SEGMENT_GROUPS, key=["code"], order=["code"])
    return union_all(read_table(spark, base), rejects) \
        .select("code", "name", "market", "marcap", "market_group")


def snk_ranked_result(spark, d):
    base = scratch_path(spark, "snk_ranked_result")
    s = A.snapshot(spark, d).select("symbol", "shortName", "marketCap")
    replace_result(s, base, [_desc_missing_last("marketCap"), F.col("symbol")])
    return read_table(spark, base)


# --- projections, filters, nulls --------------------------------------------

def prj_drop(spark, d):
    return drop_cols(A.listing(spark, d), ["marcap"])


def prj_drop_at(spark, d):
    return drop_col_at(A.listing(spark, d), 2)


def prj_rename(spark, d):
    return rename_positional(A.listing(spark, d), ["Code", "Name", "Market", "Marcap"])


def flt_dropna_subset(spark, d):
    return drop_nan(A.snapshot(spark, d), ["shortName"])


def flt_dropna_any(spark, d):
    return drop_nan(A.snapshot(spark, d))


def flt_dropna_all(spark, d):
    return drop_all_nan(A.snapshot(spark, d).select("shortName", "marketCap"))


def flt_delete_like(spark, d):
    return delete_like(A.dirty(spark, d), "code", "%Code%").select("code", "rid")


def _busiest_symbols(b: DataFrame, k: int = 10) -> DataFrame:
    return (b.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "symbol").limit(k).select("symbol"))


def flt_in_list(spark, d):
    b = A.bars(spark, d)
    return filter_in(b, "symbol", _busiest_symbols(b))


def flt_lookback(spark, d):
    p = A.prices(spark, d)
    return lookback(p, "date", 2, p.select(F.max("date")).scalar())


def quarantine_checks():
    return {"previous close is zero": F.col("previousClose") != 0,
            "market cap missing": F.col("marketCap").isNotNull()}


def flt_quarantine(spark, d):
    s = A.snapshot(spark, d).withColumn(
        "change", pct_diff("regularMarketOpen", "previousClose", 4))
    good, bad = quarantine(s, quarantine_checks())
    return union_all(good.select("symbol", "change"),
                     bad.select("symbol", F.col("_reason").alias("reason"))) \
        .select("symbol", "change", "reason")


def nul_ffill(spark, d):
    # several rows a day and code: segments by range, so that any code is split
    return ffill(A.prices(spark, d), "code", ["date", "rid"], ["close"], segment="range")


def nul_const(spark, d):
    return fill_const(A.prices(spark, d), "close", 0.0)


def nul_const_all(spark, d):
    return fill_const(A.prices(spark, d), None, -1.0)


# --- joins, keys, sets ---------------------------------------------------------

def join_inner_bars_listing(spark, d):
    return enrich_bars(A.prices(spark, d), A.listing(spark, d))


def join_left_listing_info(spark, d):
    return enrich_listing(A.listing(spark, d), A.info(spark, d))


def agg_distinct_keys(spark, d):
    return distinct_keys(A.prices(spark, d), "code")


def agg_distinct_rows(spark, d):
    return distinct_rows(A.prices(spark, d).select("date", "code"))


def agg_keep_first(spark, d):
    return keep_first(A.prices(spark, d), ["code", "date"], ["rid"])


def agg_key_violations(spark, d):
    return key_violations(A.prices(spark, d), ["code", "date"])


def agg_zscore(spark, d):
    b = A.bars(spark, d).withColumn("volume", F.col("volume").cast("double"))
    z = zscore(b, "symbol", "volume", "volume_z")
    return z.select("symbol", "date", F.round("volume_z", 6).alias("volume_z"))


def agg_mse(spark, d):
    """In-sample error of the per-symbol linear fit (its training objective)."""
    fit = fit_linear(A.bars(spark, d)).filter("n_train > 0")
    return fit.select("symbol", F.round("mse", 6).alias("mse"))


def set_union_all(spark, d):
    return union_all(A.bars(spark, d), A.commodity(spark, d))


def udf_key_fold(spark, d):
    return per_key_fold(A.bars(spark, d), "symbol", "date", longest_rise("close"))


# --- series ------------------------------------------------------------------

def win_pct_change(spark, d):
    r = pct_change(A.bars(spark, d), "symbol", "date", "close", "change", fill=0.0)
    return r.select("symbol", "date", "close", F.round("change", 6).alias("change"))


def win_next_value(spark, d):
    r = next_value(A.bars(spark, d), "symbol", "date", "close", "next_close")
    return r.select("symbol", "date", "close", "next_close")


def win_latest(spark, d):
    return latest(A.bars(spark, d), "symbol", "date", ["date", "close", "volume"])


def srt_marketcap(spark, d):
    s = A.snapshot(spark, d).select("symbol", "marketCap")
    return with_row_index(s, [_desc_missing_last("marketCap"), F.col("symbol")], "rank")


# --- scalar functions ----------------------------------------------------------

def scl_zfill(spark, d):
    return A.dirty(spark, d).select("rid", "code", zfill("code", 6).alias("code6"))


def scl_to_numeric(spark, d):
    return A.dirty(spark, d).select("rid", to_numeric("close_text").alias("close"))


def scl_limit_text(spark, d):
    return A.listing(spark, d).select("code", limit_text("name", 10).alias("name10"),
                                      text_too_long("name", 10).alias("too_long"))


def scl_dates(spark, d):
    o = A.table(spark, d, "orders")
    text = format_date("o_orderdate")
    return o.select("o_orderkey", text.alias("date_text"), parse_date(text).alias("date"),
                    parse_timestamp(text).alias("ts"))


def scl_pct_diff(spark, d):
    return A.snapshot(spark, d).select(
        "symbol", pct_diff("regularMarketOpen", "previousClose", 4).alias("change"))


def scl_direction(spark, d):
    return A.snapshot(spark, d).select(
        "symbol", direction("regularMarketOpen", "previousClose").alias("direction"),
        pct_diff("regularMarketOpen", "previousClose", None).alias("diff"))


# --- market-shaped entry points (plans.markets) on landed test tables -------------

def _land_bars(spark, d, base, code_col, extra=()):
    b = A.bars(spark, d)
    cols = [F.col("date").cast("string").alias("Date"), F.col("open").alias("Open"),
            F.col("high").alias("High"), F.col("low").alias("Low"),
            F.col("close").alias("Close"), F.col("volume").alias("Volume"), *extra,
            F.col("symbol").cast("string").alias(code_col)]
    write_csv(b.select(*cols), f"{base}/landed")
    return f"{base}/landed"


def mkt_snp_stock(spark, d):
    base = scratch_path(spark, "mkt_snp_stock")
    return M.snp_stock(spark, _land_bars(spark, d, base, "Symbol"), f"{base}/table")


def mkt_krx_stock(spark, d):
    base = scratch_path(spark, "mkt_krx_stock")
    change = F.try_divide(F.col("close") - F.col("open"), F.col("open")).alias("Change")
    landed = _land_bars(spark, d, base, "Code", extra=[change])
    return M.krx_stock(spark, landed, f"{base}/table")


def mkt_nas_list(spark, d):
    return JOBS["pip_nas_list"](spark, d)


def _land_nas_bars(spark, d, base):
    e = A.table(spark, d, "events").orderBy("event_id")
    v = F.col("value")
    landed = e.select(F.col("ts").cast("date").cast("string").alias("Date"),
                      v.alias("Open"), v.alias("High"), v.alias("Low"), v.alias("Close"),
                      v.alias("Adj_Close"), json_field("props", "k").alias("Volume"),
                      F.col("user_id").cast("string").alias("Symbol"))
    write_csv(landed, f"{base}/landed")
    return f"{base}/landed"


def mkt_nas_stock(spark, d):
    base = scratch_path(spark, "mkt_nas_stock")
    return M.nas_stock(spark, _land_nas_bars(spark, d, base), f"{base}/table")


def mkt_snapshot(spark, d):
    base = scratch_path(spark, "mkt_snapshot")
    table, _rejects = M.market_snapshot(spark, A.snapshot(spark, d, with_volume=True), base)
    return table


def mkt_krx_list(spark, d):
    base = scratch_path(spark, "mkt_krx_list")
    write_csv(A.krx_listing_file(spark, d), f"{base}/landed")
    return M.krx_list(spark, f"{base}/landed", f"{base}/table")


def mkt_krx_co_info(spark, d):
    base = scratch_path(spark, "mkt_krx_co_info")
    write_csv(A.krx_info_file(spark, d), f"{base}/landed")
    return M.krx_co_info(spark, f"{base}/landed", f"{base}/table")


def mkt_krx_by_code(spark, d):
    base = scratch_path(spark, "mkt_krx_by_code")
    change = F.try_divide(F.col("close") - F.col("open"), F.col("open")).alias("Change")
    stock = M.krx_stock(spark, _land_bars(spark, d, base, "Code", extra=[change]), f"{base}/krx_stock")
    return M.stock_by_symbol(spark, stock, "Code", f"{base}/table", narrow=M.KRX_BY_CODE).drop("bucket")


def mkt_nas_by_symbol(spark, d):
    base = scratch_path(spark, "mkt_nas_by_symbol")
    return M.stock_by_symbol(spark, mkt_nas_stock(spark, d), "Symbol", f"{base}/table").drop("bucket")


def material_query(material):
    """PIP-11 for one material in its own columns: the daily price of all
    events, a little higher in each further column; none on Sundays."""
    columns = MATERIAL_COLUMNS[material]

    def run(spark, d):
        base = scratch_path(spark, f"mkt_{material}")
        daily = A.table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("date")).agg(F.max("value").alias("v"))
        quote = F.when(F.weekday("date") != 6, F.col("v"))
        write_csv(daily.select("date", *[(quote + i).alias(c) for i, c in enumerate(columns)]), f"{base}/landed",
                  header=False, encoding="cp949")
        return M.materials(spark, {material: f"{base}/landed"}, f"{base}/table")[material]
    return run


def material_sql(material):
    columns = ", ".join(f'CASE WHEN isodow(date) <> 7 THEN v + {i} END AS "{c}"'
                        for i, c in enumerate(MATERIAL_COLUMNS[material]))
    needed = " AND ".join(f'"{c}" IS NOT NULL' for c in MATERIAL_REQUIRED[material])
    return f"""WITH daily AS (SELECT CAST(ts AS DATE) AS date, max(value) AS v FROM events GROUP BY 1),
        m AS (SELECT date, {columns} FROM daily)
    SELECT * FROM m WHERE {needed} AND date >= (SELECT max(date) FROM m) - INTERVAL 20 YEAR"""


def mkt_forecast_list(spark, d):
    base = scratch_path(spark, "mkt_forecast_list")
    b = A.bars(spark, d)
    chosen = [r["symbol"] for r in _busiest_symbols(b).collect()]      # ten symbols
    rep = M.next_close_report(spark, b, "symbol", f"{base}/report", symbols=chosen)
    return rep.select("index", "symbol", F.round("tomorrow_close", 6).alias("tomorrow_close"),
                      "direction", F.round("diff", 6).alias("diff"))


def mkt_krx_list_by_market(spark, d):
    base = scratch_path(spark, "mkt_krx_list_by_market")
    write_csv(A.krx_listing_file(spark, d), f"{base}/landed/list")
    write_csv(A.krx_info_file(spark, d), f"{base}/landed/info")
    listing = M.krx_list(spark, f"{base}/landed/list", f"{base}/krx_list")
    info = M.krx_co_info(spark, f"{base}/landed/info", f"{base}/krx_co_info")
    table, _rejects = M.krx_list_by_market(spark, listing, info, f"{base}/table")
    return table


def mkt_krx_stock_by_market(spark, d):
    base = scratch_path(spark, "mkt_krx_stock_by_market")
    write_csv(A.krx_listing_file(spark, d), f"{base}/landed/list")
    listing = M.krx_list(spark, f"{base}/landed/list", f"{base}/krx_list")
    change = F.try_divide(F.col("close") - F.col("open"), F.col("open")).alias("Change")
    stock = M.krx_stock(spark, _land_bars(spark, d, base, "Code", extra=[change]),
                        f"{base}/krx_stock", listing=listing)
    table, _rejects = M.krx_stock_by_market(spark, stock, listing, f"{base}/table")
    return table


def mkt_krx_forecast(spark, d):
    base = scratch_path(spark, "mkt_krx_forecast")
    write_csv(A.krx_listing_file(spark, d), f"{base}/landed/list")
    listing = M.krx_list(spark, f"{base}/landed/list", f"{base}/krx_list")
    change = F.try_divide(F.col("close") - F.col("open"), F.col("open")).alias("Change")
    stock = M.krx_stock(spark, _land_bars(spark, d, base, "Code", extra=[change]),
                        f"{base}/krx_stock", listing=listing)
    rep = M.next_close_report(spark, stock, "Code", f"{base}/report",
                              symbols=listing.select("Code", "Name"), label="Name")
    return rep.select("index", "symbol", F.round("tomorrow_close", 6).alias("tomorrow_close"),
                      "direction", F.round("diff", 6).alias("diff"))


def mkt_snp_list(spark, d):
    return JOBS["pip_snp_list"](spark, d)


def mkt_snp_stock_by_symbol(spark, d):
    base = scratch_path(spark, "mkt_snp_stock_by_symbol")
    stock = M.snp_stock(spark, _land_bars(spark, d, base, "Symbol"), f"{base}/snp_stock")
    by_symbol = M.stock_by_symbol(spark, stock, "Symbol", f"{base}/table",
                                  narrow=M.SNP_BY_SYMBOL)
    return by_symbol.drop("bucket")


def mkt_co_overview(spark, d):
    base = scratch_path(spark, "mkt_co_overview")
    table, _errors = M.company_overview(spark, overview_records(spark, d), base)
    return table.withColumn("MarketCapitalization",
                            F.col("MarketCapitalization").cast("double"))


# --- the daily runs (plans.daily): every table of a run, its rows and a sum over them ---

def _tables_of(run: dict, sums: dict) -> DataFrame:
    """(table, n_rows, total) of the tables that a daily run returned."""
    return union_all(*[run[t].agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("n_rows"),
                                  F.round(F.sum(F.expr(x).cast("double")), 3).alias("total")) for t, x in sums.items()])


def _tables_sql(parts: dict) -> str:
    """``parts``: table -> (rows, expression)."""
    return " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows, round(sum(CAST({x} AS DOUBLE)), 3) AS total FROM ({q})"
                              for t, (q, x) in parts.items())


def mkt_krx_day(spark, d):
    base = scratch_path(spark, "mkt_krx_day")
    write_csv(A.krx_listing_file(spark, d), f"{base}/list")
    write_csv(A.krx_info_file(spark, d), f"{base}/info")
    change = F.try_divide(F.col("close") - F.col("open"), F.col("open")).alias("Change")
    landed = {"krx_list": f"{base}/list", "krx_co_info": f"{base}/info",
              "krx_stock": _land_bars(spark, d, base, "Code", extra=[change])}
    run = run_krx_day(spark, landed, f"{base}/day")
    return _tables_of(run, {"krx_list": "Marcap", "krx_co_info": "length(Sector)", "krx_stock": "Close", "list_by_market": "marcap",
                            "list_rejects": "marcap", "stock_by_market": "close", "stock_rejects": "close",
                            "stock_by_code": "high - low", "forecast": "tomorrow_close"})


def mkt_nas_day(spark, d):
    base = scratch_path(spark, "mkt_nas_day")
    write_csv(nas_listing_source(spark, d).orderBy("rid").drop("rid"), f"{base}/list")
    run = run_nas_day(spark, {"nas_list": f"{base}/list", "nas_stock": _land_nas_bars(spark, d, base)}, f"{base}/day")
    return _tables_of(run, {"nas_list": "length(Name)", "nas_stock": "Close", "stock_by_symbol": "volume", "forecast": "tomorrow_close"})


def mkt_snp_day(spark, d):
    base = scratch_path(spark, "mkt_snp_day")
    write_csv(snp_listing_source(spark, d), f"{base}/list")
    run = run_snp_day(spark, {"snp_list": f"{base}/list", "snp_stock": _land_bars(spark, d, base, "Symbol")}, f"{base}/day")
    return _tables_of(run, {"snp_stock_list": "length(Name)", "snp_stock": "Close", "stock_by_symbol": "change", "forecast": "tomorrow_close"})


# --- forecast ----------------------------------------------------------------

def fct_features(spark, d):
    f = feature_frame(A.bars(spark, d))
    return f.select("symbol", "date", "open", "close", "high", "low",
                    F.round("volume_z", 6).alias("volume_z"),
                    F.round("daily_return", 6).alias("daily_return"), "label")


def fct_linear(spark, d):
    fc = fit_linear(A.bars(spark, d))
    return fc.select("symbol", F.round("slope", 6).alias("slope"),
                     F.round("intercept", 6).alias("intercept"), "n_train", "today_close",
                     F.round("tomorrow_close", 6).alias("tomorrow_close"))


def fct_report(spark, d):
    rep = forecast_report(fit_linear(A.bars(spark, d)))
    return rep.select("index", "symbol", F.round("tomorrow_close", 6).alias("tomorrow_close"),
                      "direction", F.round("diff", 6).alias("diff"))


def fct_ridge(spark, d):
    fc = forecast_ridge(feature_frame(A.bars(spark, d)))
    return fc.select("symbol", "n_train", "today_close",
                     F.round("tomorrow_close", 4).alias("tomorrow_close"))


def _pip_forecast(spark, d):
    rep = JOBS["pip_forecast"](spark, d)
    return rep.select("index", "symbol", F.round("tomorrow_close", 6).alias("tomorrow_close"),
                      "direction", F.round("diff", 6).alias("diff"))


QUERIES = {
    "src_csv_roundtrip": src_csv_roundtrip,
    "src_csv_positional": src_csv_positional,
    "src_csv_dialect": src_csv_dialect,
    "src_symbol_files": src_symbol_files,
    "src_encoded": src_encoded,
    "src_json": src_json,
    "src_table_pruned": src_table_pruned,
    "src_history": src_history,
    "snk_append": snk_append,
    "snk_publish": snk_publish,
    "snk_refresh": snk_refresh,
    "snk_list_partition": snk_list_partition,
    "snk_partition_view": snk_partition_view,
    "snk_market_groups": snk_market_groups,
    "snk_ranked_result": snk_ranked_result,
    "prj_drop": prj_drop,
    "prj_drop_at": prj_drop_at,
    "prj_rename": prj_rename,
    "flt_dropna_subset": flt_dropna_subset,
    "flt_dropna_any": flt_dropna_any,
    "flt_dropna_all": flt_dropna_all,
    "flt_delete_like": flt_delete_like,
    "flt_in_list": flt_in_list,
    "flt_lookback": flt_lookback,
    "flt_quarantine": flt_quarantine,
    "nul_ffill": nul_ffill,
    "nul_const": nul_const,
    "nul_const_all": nul_const_all,
    "join_inner_bars_listing": join_inner_bars_listing,
    "join_left_listing_info": join_left_listing_info,
    "agg_distinct_keys": agg_distinct_keys,
    "agg_distinct_rows": agg_distinct_rows,
    "agg_keep_first": agg_keep_first,
    "agg_key_violations": agg_key_violations,
    "agg_zscore": agg_zscore,
    "agg_mse": agg_mse,
    "set_union_all": set_union_all,
    "udf_key_fold": udf_key_fold,
    "win_pct_change": win_pct_change,
    "win_next_value": win_next_value,
    "win_latest": win_latest,
    "srt_marketcap": srt_marketcap,
    "scl_zfill": scl_zfill,
    "scl_to_numeric": scl_to_numeric,
    "scl_limit_text": scl_limit_text,
    "scl_dates": scl_dates,
    "scl_pct_diff": scl_pct_diff,
    "scl_direction": scl_direction,
    "mkt_snp_stock": mkt_snp_stock,
    "mkt_krx_stock": mkt_krx_stock,
    "mkt_nas_list": mkt_nas_list,
    "mkt_nas_stock": mkt_nas_stock,
    "mkt_co_overview": mkt_co_overview,
    "mkt_snapshot": mkt_snapshot,
    "mkt_krx_list_by_market": mkt_krx_list_by_market,
    "mkt_krx_list": mkt_krx_list,
    "mkt_krx_co_info": mkt_krx_co_info,
    "mkt_krx_by_code": mkt_krx_by_code,
    "mkt_nas_by_symbol": mkt_nas_by_symbol,
    "mkt_forecast_list": mkt_forecast_list,
    **{f"mkt_{m}": material_query(m) for m in MATERIAL_COLUMNS},
    **REJECTS,
    "mkt_krx_stock_by_market": mkt_krx_stock_by_market,
    "mkt_krx_forecast": mkt_krx_forecast,
    "mkt_krx_day": mkt_krx_day,
    "mkt_nas_day": mkt_nas_day,
    "mkt_snp_day": mkt_snp_day,
    "mkt_snp_list": mkt_snp_list,
    "mkt_snp_stock_by_symbol": mkt_snp_stock_by_symbol,
    "fct_features": fct_features,
    "fct_linear": fct_linear,
    "fct_report": fct_report,
    "fct_ridge": fct_ridge,
}
QUERIES.update({k: v for k, v in JOBS.items() if k != "pip_forecast"})
QUERIES["pip_forecast"] = _pip_forecast


# --- oracle SQL (DuckDB) ---------------------------------------------------------

NUM_RE = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"
TO_NUMERIC_SQL = (f"CASE WHEN regexp_matches(close_text, {NUM_RE}) "
                  "AND NOT isinf(TRY_CAST(trim(close_text) AS DOUBLE)) "
                  "THEN CAST(trim(close_text) AS DOUBLE) "
                  "WHEN regexp_matches(close_text, '(?i)^[+-]?(inf|infinity)$') "
                  "THEN CASE WHEN starts_with(close_text, '-') THEN -'inf'::DOUBLE "
                  "ELSE 'inf'::DOUBLE END END")
GROUP_SQL = ("CASE market WHEN 'BUILDING' THEN 'building' WHEN 'FURNITURE' THEN 'furniture' "
             "WHEN 'AUTOMOBILE' THEN 'vehicles' WHEN 'MACHINERY' THEN 'vehicles' END")
BUSIEST_SQL = "SELECT symbol FROM bars GROUP BY symbol ORDER BY count(*) DESC, symbol LIMIT {k}"
FIRST_PRICE_SQL = """first_price AS (SELECT date, code, close, rid FROM (
        SELECT *, row_number() OVER (PARTITION BY code, date ORDER BY rid) AS rn FROM prices)
        WHERE rn = 1)"""
FEATURES_SQL = """r AS (SELECT *, (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0)
                          AS daily_return
                   FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)),
   n AS (SELECT * FROM r WHERE daily_return IS NOT NULL),
   feat AS (SELECT symbol, date, open, close, high, low,
       coalesce((volume - avg(volume) OVER (PARTITION BY symbol))
                / nullif(stddev_pop(volume) OVER (PARTITION BY symbol), 0), 0.0) AS volume_z,
       daily_return,
       lead(close) OVER (PARTITION BY symbol ORDER BY date) AS label FROM n)"""
LINEAR_SQL = """fit AS (SELECT symbol, regr_slope(label, close) AS slope,
        regr_intercept(label, close) AS intercept,
        CAST(regr_count(label, close) AS BIGINT) AS n_train,
        arg_max(close, date) AS today_close FROM feat GROUP BY symbol),
   fc AS (SELECT *, intercept + slope * today_close AS tomorrow_close FROM fit)"""
REPORT_SQL = """SELECT row_number() OVER (ORDER BY symbol) AS index, symbol,
        round(tomorrow_close, 6) AS tomorrow_close,
        CASE WHEN tomorrow_close > today_close THEN 'up' ELSE 'down' END AS direction,
        round((tomorrow_close - today_close) / nullif(today_close, 0) * 100, 6) AS diff
   FROM fc WHERE tomorrow_close IS NOT NULL"""
FLAGSHIP_SQL = f"""WITH prices AS ({A.SQL['prices']}),
   {FIRST_PRICE_SQL},
   b AS (SELECT * FROM first_price WHERE date >= DATE '1992-01-01'),
   f AS (SELECT date, code, last_value(close IGNORE NULLS) OVER (PARTITION BY code ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close FROM b),
   g AS (SELECT * FROM f WHERE close IS NOT NULL)
SELECT date, code, close,
       CASE WHEN row_number() OVER w = 1 THEN 0.0
            ELSE (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) END AS change
FROM g WINDOW w AS (PARTITION BY code ORDER BY date)"""
BAR_COLS = "symbol, date, open, high, low, close, volume"
BAR_INT_COLS = "symbol, date, open, high, low, close, CAST(volume AS INTEGER) AS volume"
SNAP_CHANGE = ('round(("regularMarketOpen" - "previousClose") / nullif("previousClose", 0) '
               '* 100, 4)')

NAS_LIST_SQL = """SELECT "Symbol", "Name", "Industry", "IndustryCode" FROM (
        SELECT upper(substring(c_mktsegment, 1, 4)) || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
                   AS "Symbol",
               c_name AS "Name", c_mktsegment AS "Industry",
               CAST(c_nationkey AS VARCHAR) AS "IndustryCode",
               row_number() OVER (PARTITION BY upper(substring(c_mktsegment, 1, 4))
                   || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ORDER BY c_custkey) AS rn
        FROM customer) WHERE rn = 1"""
# 45 overview columns; the replies carry six of them, the rest are NULL
OVERVIEW_SQL = (
    "SELECT " + ", ".join(
        {"Symbol": f'{A.zfill_sql("c_custkey")} AS "Symbol"',
         "AssetType": "'Common Stock' AS \"AssetType\"",
         "Name": 'c_name AS "Name"', "Exchange": 'c_mktsegment AS "Exchange"',
         "Sector": 'n_name AS "Sector"',
         "MarketCapitalization": 'c_acctbal AS "MarketCapitalization"'}.get(
            f, f'CAST(NULL AS VARCHAR) AS "{f}"') for f in OVERVIEW_FIELDS)
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0")

KRX_MARKET_SQL = ("CASE c_mktsegment " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in A.SEGMENT_KRX_MARKET.items()) + " END")
KRX_GROUP_SQL = ("CASE l.market " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in KRX_MARKET_GROUPS.items()) + " END")
KRX_LIST_SQL = f"""SELECT {A.zfill_sql('c_custkey')} AS "Code", 'KR' || {A.zfill_sql('c_custkey')} AS "ISU_CD",
    c_name AS "Name", {KRX_MARKET_SQL} AS "Market", CAST(NULL AS VARCHAR) AS "Dept",
    CAST(c_nationkey AS INTEGER) AS "Close", CAST(NULL AS INTEGER) AS "ChangeCode",
    CAST(NULL AS INTEGER) AS "Changes", CAST(NULL AS DOUBLE) AS "ChangesRatio",
    CAST(NULL AS INTEGER) AS "Open", CAST(NULL AS INTEGER) AS "High", CAST(NULL AS INTEGER) AS "Low",
    CAST(NULL AS INTEGER) AS "Volume", CAST(NULL AS BIGINT) AS "Amount",
    CAST(c_custkey * 1000 AS BIGINT) AS "Marcap", CAST(NULL AS BIGINT) AS "Stocks", 'STK' AS "MarketId"
    FROM customer"""
KRX_INFO_SQL = f"""SELECT {A.zfill_sql('c_custkey')} AS "Code", c_name AS "Name", {KRX_MARKET_SQL} AS "Market",
    n_name AS "Sector", r_name AS "Industry",
    CAST(DATE '1990-01-01' + CAST(c_custkey AS INTEGER) AS TIMESTAMP) AS "ListingDate", '12' AS "SettleMonth",
    CAST(NULL AS VARCHAR) AS "Representative", CAST(NULL AS VARCHAR) AS "HomePage", r_name AS "Region"
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE c_acctbal >= 0"""
KRX_LIST_BY_MARKET_SQL = f"""WITH l AS (
    SELECT {A.zfill_sql('c_custkey')} AS code, 'KR' || {A.zfill_sql('c_custkey')} AS isu_cd,
           c_name AS name, {KRX_MARKET_SQL} AS market, CAST(NULL AS VARCHAR) AS dept,
           CAST(c_nationkey AS INTEGER) AS close, CAST(NULL AS INTEGER) AS changecode,
           CAST(NULL AS INTEGER) AS changes, CAST(NULL AS DOUBLE) AS changesratio,
           CAST(NULL AS INTEGER) AS open, CAST(NULL AS INTEGER) AS high,
           CAST(NULL AS INTEGER) AS low, CAST(NULL AS INTEGER) AS volume,
           CAST(NULL AS BIGINT) AS amount, CAST(c_custkey * 1000 AS BIGINT) AS marcap,
           CAST(NULL AS BIGINT) AS stocks, 'STK' AS marketid FROM customer),
  i AS (
    SELECT {A.zfill_sql('c_custkey')} AS code, n_name AS sector, r_name AS industry,
           CAST(DATE '1990-01-01' + CAST(c_custkey AS INTEGER) AS TIMESTAMP) AS listingdate,
           '12' AS settlemonth, CAST(NULL AS VARCHAR) AS representative,
           CAST(NULL AS VARCHAR) AS homepage, r_name AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal >= 0)
SELECT * FROM (
    SELECT l.*, i.sector, i.industry, i.listingdate, i.settlemonth, i.representative,
           i.homepage, i.region, {KRX_GROUP_SQL} AS market_group
    FROM l LEFT JOIN i ON l.code = i.code) WHERE market_group IS NOT NULL"""

KRX_STOCK_BY_MARKET_SQL = f"""SELECT * FROM (
    SELECT CAST(b.date AS TIMESTAMP) AS date, CAST(trunc(b.open) AS BIGINT) AS open,
           CAST(trunc(b.high) AS BIGINT) AS high, CAST(trunc(b.low) AS BIGINT) AS low,
           CAST(trunc(b.close) AS BIGINT) AS close, b.volume AS volume,
           {A.zfill_sql('b.symbol')} AS code, l.c_name AS name, l.market AS market,
           CAST(l.c_custkey * 1000 AS BIGINT) AS marcap, {KRX_GROUP_SQL} AS market_group
    FROM bars b JOIN (SELECT *, {KRX_MARKET_SQL} AS market FROM customer) l
      ON b.symbol = l.c_custkey) WHERE market_group IS NOT NULL"""

# KRX bars as loaded (prices truncated to integers), labelled by company name
KRX_NAMED_BARS_SQL = f"""krx_bars AS ({A.SQL['bars']}),
   bars AS (SELECT c.c_name AS symbol, b.date,
                   CAST(trunc(b.open) AS DOUBLE) AS open, CAST(trunc(b.high) AS DOUBLE) AS high,
                   CAST(trunc(b.low) AS DOUBLE) AS low, CAST(trunc(b.close) AS DOUBLE) AS close,
                   CAST(b.volume AS DOUBLE) AS volume
            FROM krx_bars b JOIN customer c ON b.symbol = c.c_custkey)"""

SNP_LIST_SQL = with_sql("""SELECT l.code AS "Symbol", l.name AS "Name",
            i.sector AS "Sector", l.market AS "Industry"
        FROM listing l LEFT JOIN info i ON l.code = i.code
        WHERE l.code IS NOT NULL AND l.name IS NOT NULL AND i.sector IS NOT NULL
          AND l.market IS NOT NULL""", "listing", "info")

def _ridge_sql(cols, lam):
    """The same sums and the same solve as ``forecast_ridge``, as nested SELECTs."""
    terms = ["1.0", *cols]
    k = len(terms)
    sums = [f"sum(CASE WHEN label IS NOT NULL THEN {terms[i]} * {terms[j]} END) AS _g{i}_{j}"
            for i in range(k) for j in range(i, k)]
    sums += [f"sum(CASE WHEN label IS NOT NULL THEN {terms[i]} * label END) AS _b{i}" for i in range(k)]
    sums += [f"arg_max({c}, date) AS _x{i + 1}" for i, c in enumerate(cols)]
    sql = (f"SELECT symbol, {', '.join(sums)}, CAST(count(label) AS BIGINT) AS n_train, "
           "arg_max(close, date) AS today_close FROM feat GROUP BY symbol")
    for stage in ridge_steps(k, lam):
        sql = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in stage.items())} FROM ({sql})"
    tomorrow = " + ".join(["_beta0", *[f"_beta{i} * _x{i}" for i in range(1, k)]])
    return f"SELECT symbol, n_train, today_close, round({tomorrow}, 4) AS tomorrow_close FROM ({sql})"


ORACLE = {
    "src_csv_roundtrip": with_sql("SELECT code, name, market, marcap FROM listing", "listing"),
    "src_csv_dialect": """WITH odd AS (SELECT CAST(c_custkey AS VARCHAR) AS code,
            CASE c_custkey % 6 WHEN 0 THEN c_name || ', "Inc"'
                WHEN 1 THEN c_name || chr(10) || 'second line, "quoted"'
                WHEN 2 THEN '  ' || c_name || '  '
                WHEN 3 THEN c_name || '\\path\\"x"\\'
                WHEN 4 THEN '"' || c_name ELSE c_name END AS name,
            c_mktsegment AS market FROM customer)
        SELECT *, 'header' AS layout FROM odd UNION ALL SELECT *, 'positional' AS layout FROM odd""",
    "src_csv_positional": with_sql("SELECT material, date, value FROM commodity", "commodity"),
    "src_symbol_files": with_sql(f"SELECT {BAR_COLS} FROM bars", "bars"),
    "src_encoded": with_sql("SELECT *, 'utf-8-sig' AS encoding FROM listing "
                            "UNION ALL SELECT *, 'cp949' AS encoding FROM listing", "listing"),
    "src_json": r"""SELECT event_id,
        CASE WHEN event_type = 'error' THEN NULL
             ELSE CAST(regexp_extract(props, '"k":\s*(-?\d+)', 1) AS BIGINT) END AS k,
        CASE WHEN event_type = 'error' THEN 'invalid call for ' || CAST(event_id AS VARCHAR)
             END AS error_message FROM events""",
    "src_table_pruned": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "src_history": with_sql("SELECT * FROM prices WHERE date BETWEEN DATE '1996-01-01' "
                            "AND DATE '1997-12-31'", "prices"),
    "snk_append": with_sql("SELECT * FROM prices", "prices"),
    "snk_publish": with_sql("SELECT * FROM prices", "prices"),
    "snk_refresh": with_sql(f"""SELECT code, {TO_NUMERIC_SQL} AS close, rid FROM dirty
        WHERE NOT coalesce(code LIKE '%Code%', false) AND code IS NOT NULL""", "dirty"),
    "snk_list_partition": with_sql(f"SELECT {BAR_INT_COLS} FROM bars", "bars"),
    "snk_partition_view": with_sql(f"""SELECT {BAR_INT_COLS} FROM bars
        WHERE symbol = ({BUSIEST_SQL.format(k=1)})""", "bars"),
    "snk_market_groups": with_sql(f"SELECT code, name, market, marcap, {GROUP_SQL} AS market_group "
                                  "FROM listing", "listing"),
    "snk_ranked_result": with_sql("""SELECT symbol, "shortName", "marketCap",
        row_number() OVER (ORDER BY "marketCap" DESC NULLS LAST, symbol) AS index
        FROM snapshot""", "snapshot"),
    "prj_drop": with_sql("SELECT code, name, market FROM listing", "listing"),
    "prj_drop_at": with_sql("SELECT code, name, marcap FROM listing", "listing"),
    "prj_rename": with_sql('SELECT code AS "Code", name AS "Name", market AS "Market", '
                           'marcap AS "Marcap" FROM listing', "listing"),
    "flt_dropna_subset": with_sql('SELECT * FROM snapshot WHERE "shortName" IS NOT NULL',
                                  "snapshot"),
    "flt_dropna_any": with_sql("""SELECT * FROM snapshot WHERE symbol IS NOT NULL
        AND "shortName" IS NOT NULL AND sector IS NOT NULL
        AND "marketCap" IS NOT NULL AND NOT isnan("marketCap")
        AND "previousClose" IS NOT NULL AND NOT isnan("previousClose")
        AND "regularMarketOpen" IS NOT NULL AND NOT isnan("regularMarketOpen")""", "snapshot"),
    "flt_dropna_all": with_sql("""SELECT "shortName", "marketCap" FROM snapshot
        WHERE "shortName" IS NOT NULL OR "marketCap" IS NOT NULL""", "snapshot"),
    "flt_delete_like": with_sql("SELECT code, rid FROM dirty "
                                "WHERE NOT coalesce(code LIKE '%Code%', false)", "dirty"),
    "flt_in_list": with_sql(f"SELECT {BAR_COLS} FROM bars WHERE symbol IN "
                            f"({BUSIEST_SQL.format(k=10)})", "bars"),
    "flt_lookback": with_sql("""SELECT * FROM prices
        WHERE date >= (SELECT max(date) FROM prices) - INTERVAL 2 YEAR
          AND date <= (SELECT max(date) FROM prices)""", "prices"),
    "flt_quarantine": with_sql(f"""SELECT symbol,
            CASE WHEN reason IS NULL THEN {SNAP_CHANGE} END AS change, reason
        FROM (SELECT *, CASE WHEN NOT coalesce("previousClose" <> 0, false)
                                  THEN 'previous close is zero'
                             WHEN "marketCap" IS NULL THEN 'market cap missing' END AS reason
              FROM snapshot)""", "snapshot"),
    "nul_ffill": with_sql("""SELECT date, code, last_value(close IGNORE NULLS) OVER (
            PARTITION BY code ORDER BY date, rid
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close, rid
        FROM prices""", "prices"),
    "nul_const": with_sql("SELECT date, code, coalesce(close, 0.0) AS close, rid FROM prices",
                          "prices"),
    "nul_const_all": with_sql("SELECT date, code, coalesce(close, -1.0) AS close, "
                              "coalesce(rid, -1) AS rid FROM prices", "prices"),
    "join_inner_bars_listing": with_sql("""SELECT p.date, p.code, p.close, p.rid, l.name,
        l.market, l.marcap FROM prices p JOIN listing l ON p.code = l.code""",
                                        "prices", "listing"),
    "join_left_listing_info": with_sql("""SELECT l.code, l.name, l.market, l.marcap,
        i.sector, i.region FROM listing l LEFT JOIN info i ON l.code = i.code""",
                                       "listing", "info"),
    "agg_distinct_keys": with_sql("SELECT DISTINCT code FROM prices", "prices"),
    "agg_distinct_rows": with_sql("SELECT DISTINCT date, code FROM prices", "prices"),
    "agg_keep_first": with_sql("SELECT * FROM first_price", "prices", more=FIRST_PRICE_SQL),
    "agg_key_violations": with_sql("""SELECT code, date, count(*) AS n_rows,
            CASE WHEN code IS NULL OR date IS NULL THEN 'null key' ELSE 'duplicate key' END
            AS reason
        FROM prices GROUP BY code, date
        HAVING count(*) > 1 OR code IS NULL OR date IS NULL""", "prices"),
    "agg_zscore": with_sql("""SELECT symbol, date, round(coalesce(
            (volume - avg(volume) OVER (PARTITION BY symbol))
            / nullif(stddev_pop(volume) OVER (PARTITION BY symbol), 0), 0.0), 6) AS volume_z
        FROM bars""", "bars"),
    "agg_mse": with_sql("""SELECT f.symbol,
            round(avg(pow(f.label - (fc.intercept + fc.slope * f.close), 2)), 6) AS mse
        FROM feat f JOIN fc ON f.symbol = fc.symbol WHERE f.label IS NOT NULL
        GROUP BY f.symbol""", "bars", more=FEATURES_SQL + ",\n" + LINEAR_SQL),
    "set_union_all": with_sql("SELECT * FROM bars UNION ALL BY NAME SELECT * FROM commodity",
                              "bars", "commodity"),
    "udf_key_fold": with_sql("""SELECT symbol, CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS longest_rise FROM (
            SELECT symbol, run, count(*) AS n FROM (
                SELECT symbol, sum(falls) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM (
                    SELECT symbol, date, CASE WHEN close > lag(close) OVER (PARTITION BY symbol ORDER BY date)
                        THEN 0 ELSE 1 END AS falls FROM bars))
            GROUP BY symbol, run) GROUP BY symbol""", "bars"),
    "win_pct_change": with_sql("""SELECT symbol, date, close,
            CASE WHEN row_number() OVER w = 1 THEN 0.0
                 ELSE round((close - lag(close) OVER w) / nullif(lag(close) OVER w, 0), 6)
            END AS change
        FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)""", "bars"),
    "win_next_value": with_sql("""SELECT symbol, date, close,
            lead(close) OVER (PARTITION BY symbol ORDER BY date) AS next_close FROM bars""",
                               "bars"),
    "win_latest": with_sql("""SELECT symbol, max(date) AS date, arg_max(close, date) AS close,
            arg_max(volume, date) AS volume FROM bars GROUP BY symbol""", "bars"),
    "srt_marketcap": with_sql("""SELECT symbol, "marketCap",
            row_number() OVER (ORDER BY "marketCap" DESC NULLS LAST, symbol) AS rank
        FROM snapshot""", "snapshot"),
    "scl_zfill": with_sql("""SELECT rid, code, CASE WHEN length(code) < 6 THEN lpad(code, 6, '0')
            ELSE code END AS code6 FROM dirty""", "dirty"),
    "scl_to_numeric": with_sql(f"SELECT rid, {TO_NUMERIC_SQL} AS close FROM dirty", "dirty"),
    "scl_limit_text": with_sql("""SELECT code, substring(name, 1, 10) AS name10,
            coalesce(length(name) > 10, false) AS too_long FROM listing""", "listing"),
    "scl_dates": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text,
            CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS date,
            CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS ts FROM orders""",
    "scl_pct_diff": with_sql(f"SELECT symbol, {SNAP_CHANGE} AS change FROM snapshot",
                             "snapshot"),
    "scl_direction": with_sql("""SELECT symbol,
            CASE WHEN "regularMarketOpen" > "previousClose" THEN 'up' ELSE 'down' END
            AS direction,
            ("regularMarketOpen" - "previousClose") / nullif("previousClose", 0) * 100 AS diff
        FROM snapshot""", "snapshot"),
    "fct_features": with_sql("""SELECT symbol, date, open, close, high, low,
       round(volume_z, 6) AS volume_z, round(daily_return, 6) AS daily_return, label
       FROM feat""", "bars", more=FEATURES_SQL),
    "fct_linear": with_sql("""SELECT symbol, round(slope, 6) AS slope,
       round(intercept, 6) AS intercept, n_train, today_close,
       round(tomorrow_close, 6) AS tomorrow_close FROM fc""", "bars",
                           more=FEATURES_SQL + ",\n" + LINEAR_SQL),
    "fct_ridge": with_sql(_ridge_sql(FEATURES, 1.0), "bars", more=FEATURES_SQL),
    "fct_report": with_sql(REPORT_SQL, "bars", more=FEATURES_SQL + ",\n" + LINEAR_SQL),
    # pipelines
    "pip_krx_list": with_sql("SELECT code, name, market, marcap FROM listing "
                             "WHERE code IS NOT NULL AND name IS NOT NULL", "listing"),
    "pip_krx_co_info": with_sql("SELECT code, sector, region FROM info "
                                "WHERE code IS NOT NULL AND sector IS NOT NULL", "info"),
    "pip_krx_stock": with_sql("""SELECT date, code, last_value(close IGNORE NULLS) OVER (
        PARTITION BY code ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS close FROM b""", "prices", "listing", more=FIRST_PRICE_SQL + """,
   b AS (SELECT * FROM first_price WHERE date IS NOT NULL AND code IS NOT NULL
            AND date >= DATE '1992-01-01' AND code IN (SELECT code FROM listing))"""),
    "pip_krx_stock_legacy": with_sql(f"SELECT {BAR_COLS} FROM bars", "bars"),
    "pip_nas_list": NAS_LIST_SQL,
    "pip_nas_stock": r"""SELECT symbol, date, close, volume, 'NASDAQ' AS exchange FROM (
        SELECT user_id AS symbol, CAST(ts AS DATE) AS date, value AS close,
               CAST(regexp_extract(props, '"k":\s*(-?\d+)', 1) AS DOUBLE) AS volume,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn
        FROM events WHERE CAST(ts AS DATE) >= DATE '2003-01-01') WHERE rn = 1""",
    "pip_co_overview": f"""SELECT {A.zfill_sql('c_custkey')} AS "Symbol",
            'Common Stock' AS "AssetType", c_name AS "Name", c_mktsegment AS "Exchange",
            n_name AS "Sector", c_acctbal AS "MarketCapitalization"
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0""",
    "pip_snapshot": with_sql(f"""SELECT CAST(symbol AS VARCHAR) AS symbol, "shortName" AS name,
            sector, "marketCap" AS marcap, "previousClose" AS previous_close,
            "regularMarketOpen" AS regular_market_open, {SNAP_CHANGE} AS changesratio
        FROM snapshot WHERE "shortName" IS NOT NULL AND "previousClose" <> 0""", "snapshot"),
    "pip_snp_list": SNP_LIST_SQL,
    "pip_snp_stock": FLAGSHIP_SQL,
    "pip_materials": with_sql("""SELECT material, date, value FROM commodity
        WHERE value IS NOT NULL AND date <= (SELECT max(date) FROM commodity)
          AND date >= (SELECT max(date) FROM commodity) - INTERVAL 20 YEAR""", "commodity"),
    "pip_list_by_market": with_sql(f"""SELECT * FROM (
        SELECT l.code, l.name, l.market, l.marcap, i.sector, i.region,
               {GROUP_SQL.replace('market', 'l.market', 1)} AS market_group
        FROM listing l LEFT JOIN info i ON l.code = i.code) WHERE market_group IS NOT NULL""",
                                   "listing", "info"),
    "pip_bars_by_market": with_sql(f"""SELECT * FROM (
        SELECT p.date, p.code, p.close, l.name, l.market, l.marcap,
               {GROUP_SQL.replace('market', 'l.market', 1)} AS market_group
        FROM first_price p JOIN listing l ON p.code = l.code) WHERE market_group IS NOT NULL""",
                                   "prices", "listing", more=FIRST_PRICE_SQL),
    "pip_bars_by_symbol": with_sql(f"SELECT {BAR_INT_COLS} FROM bars", "bars"),
    "pip_forecast": with_sql(REPORT_SQL, "bars", more=FEATURES_SQL + ",\n" + LINEAR_SQL),
    # market-shaped entry points
    "mkt_snp_stock": with_sql("""SELECT CAST(date AS TIMESTAMP) AS "Date", open AS "Open",
            high AS "High", low AS "Low", close AS "Close", CAST(volume AS DOUBLE) AS "Volume",
            CAST(symbol AS VARCHAR) AS "Symbol",
            CASE WHEN row_number() OVER w = 1 THEN 0.0
                 ELSE (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) END AS "Change"
        FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)""", "bars"),
    "mkt_krx_stock": with_sql(f"""SELECT CAST(date AS TIMESTAMP) AS "Date",
            CAST(trunc(open) AS BIGINT) AS "Open", CAST(trunc(high) AS BIGINT) AS "High",
            CAST(trunc(low) AS BIGINT) AS "Low", CAST(trunc(close) AS BIGINT) AS "Close",
            volume AS "Volume", {A.zfill_sql('symbol')} AS "Code" FROM bars""", "bars"),
    "mkt_nas_list": NAS_LIST_SQL,
    "mkt_nas_stock": r"""SELECT date AS "Date", value AS "Open", value AS "High",
            value AS "Low", value AS "Close", value AS "Adj_Close",
            CAST(regexp_extract(props, '"k":\s*(-?\d+)', 1) AS DOUBLE) AS "Volume",
            CAST(user_id AS VARCHAR) AS "Symbol" FROM (
        SELECT *, CAST(ts AS DATE) AS date, row_number() OVER (
            PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn FROM events)
        WHERE rn = 1 AND date >= DATE '2003-01-01'""",
    "mkt_co_overview": OVERVIEW_SQL,
    "mkt_krx_list_by_market": KRX_LIST_BY_MARKET_SQL,
    "mkt_krx_list": KRX_LIST_SQL,
    "mkt_krx_co_info": KRX_INFO_SQL,
    "mkt_krx_by_code": with_sql(f"""SELECT CAST(date AS TIMESTAMP) AS date, CAST(trunc(open) AS INTEGER) AS open,
            CAST(trunc(high) AS INTEGER) AS high, CAST(trunc(low) AS INTEGER) AS low,
            CAST(trunc(close) AS INTEGER) AS close, CAST(volume AS INTEGER) AS volume,
            {A.zfill_sql('symbol')} AS code FROM bars""", "bars"),
    "mkt_nas_by_symbol": r"""SELECT date, value AS open, value AS high, value AS low, value AS close,
            value AS adj_close, CAST(regexp_extract(props, '"k":\s*(-?\d+)', 1) AS DOUBLE) AS volume,
            CAST(user_id AS VARCHAR) AS symbol FROM (
        SELECT *, CAST(ts AS DATE) AS date, row_number() OVER (
            PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn FROM events)
        WHERE rn = 1 AND date >= DATE '2003-01-01'""",
    "mkt_forecast_list": with_sql(REPORT_SQL, more=f"all_bars AS ({A.SQL['bars']}),\n   bars AS (SELECT * FROM "
                                  f"all_bars WHERE symbol IN ({BUSIEST_SQL.format(k=10).replace('bars', 'all_bars')})),\n"
                                  + FEATURES_SQL + ",\n" + LINEAR_SQL),
    **{f"mkt_{m}": material_sql(m) for m in MATERIAL_COLUMNS},
    "pip_list_by_market_rejects": with_sql(f"""SELECT *, 'no child for market ' || coalesce(market, 'NULL') AS _reason
        FROM (SELECT l.code, l.name, l.market, l.marcap, i.sector, i.region,
               {GROUP_SQL.replace('market', 'l.market', 1)} AS market_group
        FROM listing l LEFT JOIN info i ON l.code = i.code) WHERE market_group IS NULL""", "listing", "info"),
    "pip_bars_by_market_rejects": with_sql(f"""SELECT *, 'no child for market ' || coalesce(market, 'NULL') AS _reason
        FROM (SELECT p.date, p.code, p.close, l.name, l.market, l.marcap,
               {GROUP_SQL.replace('market', 'l.market', 1)} AS market_group
        FROM first_price p JOIN listing l ON p.code = l.code) WHERE market_group IS NULL""",
                                           "prices", "listing", more=FIRST_PRICE_SQL),
    "pip_co_overview_rejects": f"""SELECT {A.zfill_sql('c_custkey')} AS code,
            'Invalid API call for ' || {A.zfill_sql('c_custkey')} AS error_message
        FROM customer WHERE c_acctbal < 0""",
    "pip_snapshot_rejects": with_sql("""SELECT *, CAST(NULL AS DOUBLE) AS change,
            'previous close is zero' AS _reason FROM snapshot WHERE NOT coalesce("previousClose" <> 0, false)""",
                                     "snapshot"),
    "mkt_krx_stock_by_market": with_sql(KRX_STOCK_BY_MARKET_SQL, "bars"),
    "mkt_snp_list": SNP_LIST_SQL,
    "mkt_snp_stock_by_symbol": with_sql("""SELECT date, open, high, low, close,
            CAST(volume AS DOUBLE) AS volume, CAST(symbol AS VARCHAR) AS symbol,
            CASE WHEN row_number() OVER w = 1 THEN 0.0
                 ELSE (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) END AS change
        FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)""", "bars"),
    "mkt_krx_forecast": with_sql(REPORT_SQL, more=KRX_NAMED_BARS_SQL + ",\n"
                                 + FEATURES_SQL + ",\n" + LINEAR_SQL),
    "mkt_snapshot": with_sql(f"""SELECT CAST(s.symbol AS VARCHAR) AS symbol,
            s."shortName" AS name, s.sector, s."marketCap" AS marcap,
            CAST(v.volume AS DOUBLE) AS volume, s."previousClose" AS previous_close,
            s."regularMarketOpen" AS regular_market_open, {SNAP_CHANGE} AS changesratio
        FROM snapshot s JOIN v ON s.symbol = v.symbol
        WHERE s."shortName" IS NOT NULL AND s."previousClose" <> 0""", "snapshot",
                             more="v AS (SELECT p_partkey AS symbol, p_size * 100.0 AS volume "
                                  "FROM part)"),
}

_NAS_STOCK = ORACLE["mkt_nas_stock"]


def _report_sql(bars: str) -> str:
    return f"WITH bars AS ({bars}),\n{FEATURES_SQL},\n{LINEAR_SQL}\n{REPORT_SQL}".replace("round(tomorrow_close, 6) AS", "tomorrow_close AS")


ORACLE["mkt_krx_day"] = _tables_sql({
    "krx_list": (KRX_LIST_SQL, '"Marcap"'), "krx_co_info": (KRX_INFO_SQL, 'length("Sector")'),
    "krx_stock": (ORACLE["mkt_krx_stock"], '"Close"'), "list_by_market": (KRX_LIST_BY_MARKET_SQL, "marcap"),
    "list_rejects": (KRX_LIST_BY_MARKET_SQL.replace("market_group IS NOT NULL", "market_group IS NULL"), "marcap"),
    "stock_by_market": (ORACLE["mkt_krx_stock_by_market"], "close"),
    "stock_rejects": (ORACLE["mkt_krx_stock_by_market"].replace("market_group IS NOT NULL", "market_group IS NULL"), "close"),
    "stock_by_code": (ORACLE["mkt_krx_by_code"], "high - low"),
    "forecast": (with_sql(REPORT_SQL.replace("round(tomorrow_close, 6) AS", "tomorrow_close AS"),
                          more=KRX_NAMED_BARS_SQL + ",\n" + FEATURES_SQL + ",\n" + LINEAR_SQL), "tomorrow_close")})
ORACLE["mkt_nas_day"] = _tables_sql({
    "nas_list": (NAS_LIST_SQL, 'length("Name")'), "nas_stock": (_NAS_STOCK, '"Close"'),
    "stock_by_symbol": (ORACLE["mkt_nas_by_symbol"], "volume"),
    "forecast": (_report_sql('SELECT "Symbol" AS symbol, "Date" AS date, "Open" AS open, "High" AS high, "Low" AS low, '
                             f'"Close" AS close, "Volume" AS volume FROM ({_NAS_STOCK})'), "tomorrow_close")})
ORACLE["mkt_snp_day"] = _tables_sql({
    "snp_stock_list": (SNP_LIST_SQL, 'length("Name")'), "snp_stock": (ORACLE["mkt_snp_stock"], '"Close"'),
    "stock_by_symbol": (ORACLE["mkt_snp_stock_by_symbol"], "change"),
    "forecast": (_report_sql(A.SQL["bars"]), "tomorrow_close")})
