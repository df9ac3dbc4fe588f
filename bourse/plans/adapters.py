"""Adapters: the driver's test tables in market shapes.

Each adapter is a Spark plan over the given Parquet tables, so its work grows
with them, and has a DuckDB twin (``SQL``) used by the oracle queries.  Gaps
and dirt come from rules on the data itself (a pending order has no settled
price, no commodity quote on Sundays, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.functions.scalar import zfill
from bourse.sources.files import scan_table

CODE_WIDTH = 6

# Listing segments and the child table each is stored in.
# AUTOMOBILE and MACHINERY share a child; HOUSEHOLD has none (rejected),
# like KOSDAQ / KOSDAQ GLOBAL and an unknown market in the KRX listing.
SEGMENT_GROUPS = {"BUILDING": "building", "FURNITURE": "furniture",
                  "AUTOMOBILE": "vehicles", "MACHINERY": "vehicles"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, code, close, rid) from orders; a pending order has no close."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").cast("date").alias("date"),
        zfill(F.col("o_custkey"), CODE_WIDTH).alias("code"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("close"),
        F.col("o_orderkey").alias("rid"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per user from events: open/close = first/last value by
    event id, high/low, volume = number of events."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("symbol"),
                     F.col("ts").cast("date").alias("date")).agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
        F.count(F.lit(1)).alias("volume"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(zfill(F.col("c_custkey"), CODE_WIDTH).alias("code"),
                    F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("market"),
                    F.col("c_acctbal").alias("marcap"))


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company info (sector = nation, region); companies in debt have none."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    # nation and region are fixed-size dimensions (25 and 5 rows at every scale).
    n = F.broadcast(table(spark, sf_dir, "nation"))
    r = F.broadcast(table(spark, sf_dir, "region"))
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]) \
         .join(r, F.col("n_regionkey") == r["r_regionkey"])
    return j.select(zfill(F.col("c_custkey"), CODE_WIDTH).alias("code"),
                    F.col("n_name").alias("sector"), F.col("r_name").alias("region"))


def snapshot(spark: SparkSession, sf_dir: str, with_volume: bool = False) -> DataFrame:
    """Quotes per part; ``with_volume`` adds a traded volume (size x 100)."""
    p = table(spark, sf_dir, "part")
    extra = [(F.col("p_size") * 100.0).alias("volume")] if with_volume else []
    return p.select(
        F.col("p_partkey").alias("symbol"),
        F.when(F.col("p_brand") != "Brand#13", F.col("p_name")).alias("shortName"),
        F.col("p_type").alias("sector"),
        F.when(F.col("p_size") > 2, F.col("p_retailprice") * F.col("p_size")).alias("marketCap"),
        F.when(F.col("p_size") == 50, F.lit(0.0)).otherwise(F.col("p_retailprice"))
         .alias("previousClose"),
        (F.col("p_retailprice") + (F.col("p_size") - 25) / 10.0).alias("regularMarketOpen"),
        *extra)


def commodity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily price per material (event type); no quote on Sundays."""
    e = table(spark, sf_dir, "events")
    d = e.groupBy(F.col("event_type").alias("material"),
                  F.col("ts").cast("date").alias("date")).agg(F.max("value").alias("value"))
    return d.withColumn("value", F.when(F.weekday("date") != 6, F.col("value")))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed-as-text prices: unpadded codes, missing codes, junk prices and
    one stray header row."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("string")
    text = (F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
             .when(F.col("o_orderpriority") == "5-LOW", F.concat(price, F.lit("d")))
             .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit(" "), price, F.lit(" ")))
             .otherwise(price))
    rows = o.select(
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED",
               F.col("o_custkey").cast("string")).alias("code"),
        text.alias("close_text"),
        F.col("o_orderkey").alias("rid"))
    header = spark.range(1).select(F.lit("Code").alias("code"), F.lit("Close").alias("close_text"),
                                   F.lit(None).cast("bigint").alias("rid"))
    return rows.unionByName(header)


# The KRX market each listing segment is landed under; the
# household segment gets a market code outside the market-group mapping.
SEGMENT_KRX_MARKET = {"BUILDING": "KOSPI", "FURNITURE": "KOSDAQ",
                      "AUTOMOBILE": "KOSDAQ GLOBAL", "MACHINERY": "KONEX",
                      "HOUSEHOLD": "KSM"}


def _krx_market(col: str):
    expr = None
    for seg, market in SEGMENT_KRX_MARKET.items():
        expr = (F.when(F.col(col) == seg, F.lit(market)) if expr is None
                else expr.when(F.col(col) == seg, F.lit(market)))
    return expr


def krx_listing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KRX listing rows (17 text columns, file order) from customer."""
    c = table(spark, sf_dir, "customer")
    code = F.col("c_custkey").cast("string")
    none = F.lit(None).cast("string")
    return c.select(code.alias("Code"),
                    F.concat(F.lit("KR"), zfill(code, CODE_WIDTH)).alias("ISU_CD"),
                    F.col("c_name").alias("Name"), _krx_market("c_mktsegment").alias("Market"),
                    none.alias("Dept"), F.col("c_nationkey").cast("string").alias("Close"),
                    none.alias("ChangeCode"), none.alias("Changes"), none.alias("ChangesRatio"),
                    none.alias("Open"), none.alias("High"), none.alias("Low"),
                    none.alias("Volume"), none.alias("Amount"),
                    (F.col("c_custkey") * 1000).cast("string").alias("Marcap"),
                    none.alias("Stocks"), F.lit("STK").alias("MarketId"))


def krx_info_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KRX company info rows (10 text columns) for companies not in debt."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    n = F.broadcast(table(spark, sf_dir, "nation"))   # 25 rows at every scale
    r = F.broadcast(table(spark, sf_dir, "region"))   # 5 rows at every scale
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]) \
         .join(r, F.col("n_regionkey") == r["r_regionkey"])
    none = F.lit(None).cast("string")
    return j.select(F.col("c_custkey").cast("string").alias("Code"),
                    F.col("c_name").alias("Name"), _krx_market("c_mktsegment").alias("Market"),
                    F.col("n_name").alias("Sector"), F.col("r_name").alias("Industry"),
                    F.date_add(F.lit("1990-01-01").cast("date"), F.col("c_custkey").cast("int"))
                     .cast("string").alias("ListingDate"),
                    F.lit("12").alias("SettleMonth"), none.alias("Representative"),
                    none.alias("HomePage"), F.col("r_name").alias("Region"))


# --- DuckDB twins -----------------------------------------------------------

def zfill_sql(x: str, n: int = CODE_WIDTH) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return f"CASE WHEN length({s}) < {n} THEN lpad({s}, {n}, '0') ELSE {s} END"


SQL = {
    "prices": f"""SELECT CAST(o_orderdate AS DATE) AS date, {zfill_sql('o_custkey')} AS code,
        CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS close,
        o_orderkey AS rid FROM orders""",
    "bars": """SELECT user_id AS symbol, CAST(ts AS DATE) AS date,
        arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
        arg_max(value, event_id) AS close, count(*) AS volume
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "listing": f"""SELECT {zfill_sql('c_custkey')} AS code, c_name AS name,
        c_mktsegment AS market, c_acctbal AS marcap FROM customer""",
    "info": f"""SELECT {zfill_sql('c_custkey')} AS code, n_name AS sector, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal >= 0""",
    "snapshot": """SELECT p_partkey AS symbol,
        CASE WHEN p_brand <> 'Brand#13' THEN p_name END AS "shortName",
        p_type AS sector,
        CASE WHEN p_size > 2 THEN p_retailprice * p_size END AS "marketCap",
        CASE WHEN p_size = 50 THEN 0.0 ELSE p_retailprice END AS "previousClose",
        p_retailprice + (p_size - 25) / 10.0 AS "regularMarketOpen" FROM part""",
    "commodity": """SELECT material, date, CASE WHEN isodow(date) <> 7 THEN value END AS value
        FROM (SELECT event_type AS material, CAST(ts AS DATE) AS date, max(value) AS value
              FROM events GROUP BY 1, 2)""",
    "dirty": """SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                     THEN CAST(o_custkey AS VARCHAR) END AS code,
        CASE WHEN o_orderstatus = 'P' THEN 'n/a'
             WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS VARCHAR) || 'd'
             WHEN o_orderpriority = '3-MEDIUM' THEN ' ' || CAST(o_totalprice AS VARCHAR) || ' '
             ELSE CAST(o_totalprice AS VARCHAR) END AS close_text,
        o_orderkey AS rid FROM orders
        UNION ALL SELECT 'Code', 'Close', CAST(NULL AS BIGINT)""",
}


def with_sql(body: str, *names: str, more: str = "") -> str:
    """Prefix a query with the adapter CTEs it uses, then ``more`` CTEs."""
    parts = [f"{n} AS ({SQL[n]})" for n in names] + ([more] if more else [])
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body
