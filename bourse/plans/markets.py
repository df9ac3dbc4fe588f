"""The market tables in their own shapes, from landed files.

These are the entry points for real landed data: column names, keys and
final types are those of the market tables (``bourse.schemas``).  Each is a
composition of the library's operators; ``plans.jobs`` runs the same
compositions on the driver's test tables.  Every function writes an audited
table version under ``base`` and returns the table as read back (plus the
rejected rows where the job has any).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.functions.scalar import conform, limit_text, pct_diff, to_numeric, zfill
from bourse.operators.filters import (delete_like, delete_where, drop_all_nan,
                                      drop_nan, filter_in, lookback, scan_history, tag)
from bourse.operators.forecast import fit_linear, forecast_report
from bourse.operators.joins import enrich_bars, enrich_listing
from bourse.operators.keys import distinct_rows, keep_first
from bourse.operators.projection import drop_col_at, drop_cols, rename_positional
from bourse.operators.series import ffill, missing_last, pct_change
from bourse.schemas import (KRX_CO_INFO_TYPES, KRX_LIST_TYPES, KRX_MARKET_GROUPS,
                            KRX_STOCK_TYPES, MATERIAL_COLUMNS, MATERIAL_REQUIRED,
                            NAS_LIST_TYPES, NAS_STOCK_TYPES, OVERVIEW_FIELDS,
                            SNAPSHOT_FILE_FIELDS, SNAPSHOT_TABLE_TYPES, SNP_LIST_TYPES,
                            SNP_STOCK_TYPES, ddl, struct_of)
from bourse.sinks.tables import (REJECTED, publish, read_rejects, read_table, refresh_split, refresh_table,
                                 rejected, write_market_partitioned, write_partitioned)
from bourse.sources.files import scan_csv, scan_csv_positional, tag_json_records

KRX_CODE_WIDTH = 6
PRICES = ["Open", "High", "Low", "Close", "Volume"]
# Column order of the landed bar files.
KRX_STOCK_LANDED = ["Date", "Open", "High", "Low", "Close", "Volume", "Change", "Code"]
NAS_STOCK_LANDED = ["Date", "Open", "High", "Low", "Close", "Adj_Close", "Volume", "Symbol"]
SNP_STOCK_LANDED = ["Date", "Open", "High", "Low", "Close", "Volume", "Symbol"]
# Info columns added to the KRX listing by market, with their
# text limits (characters; None = timestamp).
KRX_INFO_EXTRA = {"sector": 40, "industry": 300, "listingdate": None, "settlemonth": 40,
                  "representative": 300, "homepage": 300, "region": 40}


def _no_header_rows(df: DataFrame, col: str) -> DataFrame:
    """FLT-4: header lines that were loaded as data (``col LIKE '%<col>%'``)."""
    return delete_like(df, col, f"%{col}%")


# --- KRX -------------------------------------------------------------------

def krx_list(spark: SparkSession, landed: str, base: str) -> DataFrame:
    """PIP-1: listing snapshot -> rows missing Code or Name dropped -> typed,
    keyed table.  Codes are zero-filled so they join with the bars."""
    raw = scan_csv(spark, landed, list(KRX_LIST_TYPES), keep_text=["Code"], multiline=True)
    raw = drop_nan(_no_header_rows(raw, "Code"), ["Code", "Name"])
    raw = raw.withColumn("Code", zfill("Code", KRX_CODE_WIDTH))
    refresh_table(raw, base, key=["Code"], required=["Name"], types=KRX_LIST_TYPES)
    return read_table(spark, base)


def krx_co_info(spark: SparkSession, landed: str, base: str) -> DataFrame:
    """PIP-2: company descriptions -> rows missing Code, Name or Sector
    dropped -> Market cut to 40 characters -> typed, keyed table."""
    raw = scan_csv(spark, landed, list(KRX_CO_INFO_TYPES), keep_text=["Code"], multiline=True)
    raw = drop_nan(_no_header_rows(raw, "Code"), ["Code", "Name", "Sector"])
    raw = raw.withColumn("Code", zfill("Code", KRX_CODE_WIDTH)) \
             .withColumn("Market", limit_text("Market", 40))
    refresh_table(raw, base, key=["Code"], types=KRX_CO_INFO_TYPES)
    return read_table(spark, base)


def krx_stock(spark: SparkSession, landed: str, base: str, listing: DataFrame | None = None,
              start: str = "2003-01-01") -> DataFrame:
    """PIP-3: daily bars -> Change dropped -> codes zero-filled -> rows missing
    Date or Code dropped -> bars of listed codes since ``start`` -> prices
    forward-filled per code in date order -> typed table keyed (Date, Code)."""
    raw = scan_csv(spark, landed, KRX_STOCK_LANDED, keep_text=["Code"])
    raw = drop_cols(_no_header_rows(raw, "Code"), ["Change"])
    raw = drop_nan(raw.withColumn("Code", zfill("Code", KRX_CODE_WIDTH)), ["Date", "Code"])
    bars = raw.select(F.col("Date").cast("timestamp_ntz").alias("Date"),
                      *[F.col(c).cast("double").alias(c) for c in PRICES], "Code")
    if listing is not None:
        bars = filter_in(bars, "Code", listing)
    bars = ffill(scan_history(bars, "Date", start), "Code", "Date", PRICES)
    refresh_table(bars.select(*KRX_STOCK_TYPES), base, key=["Date", "Code"],
                  types=KRX_STOCK_TYPES, order=["Code", "Date"])
    return read_table(spark, base)


KRX_LIST_BY_MARKET = struct_of({**{k.lower(): v for k, v in KRX_LIST_TYPES.items()},
                                **{k: ("timestamp_ntz" if n is None else "string")
                                   for k, n in KRX_INFO_EXTRA.items()}})


def krx_list_by_market(spark: SparkSession, listing: DataFrame, info: DataFrame,
                       base: str) -> tuple[DataFrame, DataFrame]:
    """PIP-12: listing LEFT JOIN company info on Code -> table types -> text
    limits enforced (an over-long value fails the load) -> key (code, market)
    -> one child per market group.  Returns (table, rejected rows)."""
    extra = info.select("Code", *[F.col(k).alias(k) for k in KRX_INFO_EXTRA])
    j = enrich_listing(listing, extra, key="Code")
    j = conform(j.toDF(*[c.lower() for c in j.columns]), KRX_LIST_BY_MARKET)
    limits = {"code": 40, "isu_cd": 40, "dept": 40, "marketid": 40, "name": 40, "market": 40, **{k: n for k, n in KRX_INFO_EXTRA.items() if n}}
    j = j.select(*[limit_text(c, limits[c], "fail").alias(c) if c in limits else c
                   for c in j.columns])
    _, rejects = write_market_partitioned(j, base, "market", KRX_MARKET_GROUPS,
                                          key=["code", "market"], required=["name"],
                                          order=["code"])
    return read_table(spark, base), rejects


def krx_stock_by_market(spark: SparkSession, stock: DataFrame, listing: DataFrame,
                        base: str) -> tuple[DataFrame, DataFrame]:
    """PIP-13: bars INNER JOIN listing on Code (name, market, marcap added) ->
    key (date, code, market) -> one child per market group."""
    j = enrich_bars(stock, listing, key="Code", cols=("Name", "Market", "Marcap"))
    j = j.toDF(*[c.lower() for c in j.columns])
    _, rejects = write_market_partitioned(j, base, "market", KRX_MARKET_GROUPS,
                                          key=["date", "code", "market"],
                                          order=["code", "date"])
    return read_table(spark, base), rejects


def stock_by_symbol(spark: SparkSession, stock: DataFrame, key: str, base: str,
                    narrow: T.StructType | None = None, buckets: int = 64) -> DataFrame:
    """PIP-14: bars narrowed to the table types (KRX prices to int, S&P dates
    to date) -> key (date, symbol) -> hashed-bucket list partitions; one
    symbol is read back with ``sinks.partition_view``."""
    df = stock.toDF(*[c.lower() for c in stock.columns])
    if narrow is not None:
        df = conform(df, narrow)
    write_partitioned(df, base, key.lower(), order=["date"], buckets=buckets,
                      refresh_key=["date", key.lower()])
    return read_table(spark, base)


KRX_BY_CODE = ddl("date timestamp_ntz, open int, high int, low int, close int, volume int, "
                  "code string")


# --- NASDAQ ------------------------------------------------------------------

def nas_list(spark: SparkSession, landed: str, base: str) -> DataFrame:
    """PIP-5: listing -> header lines dropped (the source writes two) -> the
    first row of each Symbol in file order -> table.  The ticker ``NA`` is a
    symbol, not a missing value."""
    raw = scan_csv(spark, landed, list(NAS_LIST_TYPES), keep_text=["Symbol"],
                   with_order=True, multiline=True)
    raw = delete_where(raw, F.col("Symbol") == "Symbol")
    first = keep_first(raw, ["Symbol"], ["_order"]).drop("_order")
    refresh_table(first, base)
    return read_table(spark, base)


def nas_stock(spark: SparkSession, landed: str, base: str,
              start: str = "2003-01-01") -> DataFrame:
    """PIP-6: per-symbol bars -> since ``start`` -> the first row of each
    (Date, Symbol) in file order -> typed table keyed (Date, Symbol)."""
    raw = scan_csv(spark, landed, NAS_STOCK_LANDED, keep_text=["Symbol"], with_order=True)
    raw = delete_where(raw, F.col("Symbol") == "Symbol")
    raw = drop_nan(raw.withColumn("Date", F.to_date("Date")), ["Date", "Symbol"])
    first = keep_first(scan_history(raw, "Date", start), ["Symbol", "Date"], ["_order"])
    refresh_table(first.drop("_order"), base, key=["Date", "Symbol"], types=NAS_STOCK_TYPES)
    return read_table(spark, base)


OVERVIEW_REPLY = T.StructType([T.StructField(f, T.StringType())
                               for f in OVERVIEW_FIELDS[:3] + ["Description"]
                               + OVERVIEW_FIELDS[3:]])


def company_overview(spark: SparkSession, replies: DataFrame, base: str,
                     reply_col: str = "reply") -> tuple[DataFrame, DataFrame]:
    """PIP-7: one JSON reply per company -> error replies set apart -> the
    fourth field (Description) dropped -> rows without the first field
    dropped -> 45 text columns keyed by Symbol.  Returns (table, errors)."""
    # request columns (e.g. the symbol asked for) are kept apart from the reply's fields
    tagged = replies.select(*[F.col(c).alias(f"request_{c}") for c in replies.columns
                              if c != reply_col], reply_col)
    request = [c for c in tagged.columns if c != reply_col]
    rows = rejected(tag_json_records(tagged, reply_col, OVERVIEW_REPLY), [*request, "error_message"], "error_message")
    recs = drop_col_at(rows.select("_rec.*", REJECTED), 3)
    recs = recs.filter(F.col(REJECTED).isNotNull() | F.col(recs.columns[0]).isNotNull())
    refresh_split(recs, base, key=["Symbol"])
    return read_table(spark, base), read_rejects(spark, base)


def market_snapshot(spark: SparkSession, quotes: DataFrame, base: str
                    ) -> tuple[DataFrame, DataFrame]:
    """PIP-8: quotes (symbol, shortName, sector, marketCap, volume,
    previousClose, regularMarketOpen) -> change of the open against the
    previous close in percent (4 digits) -> a quote that cannot be computed is
    refused (key + NULLs would fall to the next step) -> rows without a name
    dropped -> the table's column names -> table, by market cap, missing last.
    Returns (table, rejects); quotes are read once and written once."""
    s = quotes.withColumn("change", pct_diff("regularMarketOpen", "previousClose", 4))
    s = rejected(tag(s, {"previous close missing": F.col("previousClose").isNotNull(),
                         "previous close is zero": F.col("previousClose") != 0,
                         "open missing": F.col("regularMarketOpen").isNotNull()}))
    s = s.filter(F.col(REJECTED).isNotNull() | F.col("shortName").isNotNull())
    table = rename_positional(s.select(*SNAPSHOT_FILE_FIELDS, REJECTED), [*SNAPSHOT_TABLE_TYPES, REJECTED])
    refresh_split(table, base, types=SNAPSHOT_TABLE_TYPES, order=[missing_last(table, "marcap"), "symbol"])
    return read_table(spark, base), read_rejects(spark, base)


# --- S&P 500 -----------------------------------------------------------------

def snp_list(spark: SparkSession, landed: str, base: str, how: str = "any") -> DataFrame:
    """PIP-9: listing -> rows with a missing field dropped (``how='all'``:
    only empty rows, the older script) -> table keyed by Symbol."""
    raw = _no_header_rows(scan_csv(spark, landed, list(SNP_LIST_TYPES), keep_text=["Symbol"], multiline=True),
                          "Symbol")
    raw = drop_nan(raw) if how == "any" else drop_all_nan(raw)
    refresh_table(raw, base, key=["Symbol"])
    return read_table(spark, base)


def snp_stock(spark: SparkSession, landed: str, base: str,
              start: str = "2023-01-01") -> DataFrame:
    """PIP-10: bars -> prices parsed leniently (junk -> missing) -> rows with
    a missing price dropped -> duplicate rows dropped -> Change = percent
    change of Close per symbol (0 on each symbol's first row) -> typed table
    keyed (Date, Symbol)."""
    raw = _no_header_rows(scan_csv(spark, landed, SNP_STOCK_LANDED, keep_text=["Symbol"]),
                          "Symbol")
    bars = raw.select(F.col("Date").cast("timestamp_ntz").alias("Date"),
                      *[to_numeric(c).alias(c) for c in PRICES], "Symbol")
    bars = distinct_rows(drop_nan(scan_history(bars, "Date", start), PRICES))
    bars = pct_change(bars, "Symbol", "Date", "Close", "Change", fill=0.0)
    refresh_table(bars.select(*SNP_STOCK_TYPES), base, key=["Date", "Symbol"],
                  types=SNP_STOCK_TYPES, order=["Symbol", "Date"])
    return read_table(spark, base)


SNP_BY_SYMBOL = ddl("date date, open double, high double, low double, close double, "
                    "volume double, symbol string, change double")


# --- raw materials -------------------------------------------------------------

def materials(spark: SparkSession, landed: dict[str, str], base: str, asof=None,
              years: int = 20, encoding: str = "cp949") -> dict[str, DataFrame]:
    """PIP-11: per material table (gold, silver, cme, orb): header-less file,
    date first -> the last ``years`` years up to ``asof`` (default: the
    newest date in the file) -> rows missing a required price dropped ->
    table keyed by date.  The four tables are a fixed list."""
    out = {}
    for name, cols in MATERIAL_COLUMNS.items():
        if name not in landed:
            continue
        raw = scan_csv_positional(spark, landed[name], ["date"] + cols, encoding=encoding)
        typed = raw.select(F.to_date("date").alias("date"),
                           *[F.col(c).cast("double").alias(c) for c in cols])
        when = asof if asof is not None else typed.select(F.max("date")).scalar()
        typed = drop_nan(lookback(typed, "date", years, when), MATERIAL_REQUIRED[name])
        refresh_table(typed, f"{base}/{name}", key=["date"])
        out[name] = read_table(spark, f"{base}/{name}")
    return out


# --- forecast --------------------------------------------------------------------

def next_close_report(spark: SparkSession, stock: DataFrame, key: str, base: str,
                      symbols=None, label: str | None = None) -> DataFrame:
    """PIP-15: per symbol (all of them, or a list / a DataFrame of keys with an
    optional ``label`` column such as the KRX name): features -> linear fit by
    key -> report (index, symbol or label, tomorrow_close, direction, diff) ->
    result table replaced."""
    cols = {c.lower(): c for c in stock.columns}
    bars = stock.select(F.col(cols[key.lower()]).alias("symbol"),
                        F.to_date(F.col(cols["date"])).alias("date"),
                        *[F.col(cols[c]).cast("double").alias(c)
                          for c in ["open", "high", "low", "close", "volume"]])
    labels = None
    if symbols is not None:
        frame = isinstance(symbols, DataFrame)
        bars = filter_in(bars, "symbol", symbols, value_col=key if frame else None)
        if label and frame:
            labels = symbols.select(F.col(key).alias("symbol"), label)
    rep = forecast_report(fit_linear(bars), labels=labels)
    publish(rep, base)
    return read_table(spark, base)
