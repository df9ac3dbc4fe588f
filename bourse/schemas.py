"""Table shapes.

Landed files are always scanned with an all-string schema (no inference: it
turns ``005930`` into ``5930``), then cast once by a typed projection.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names and final types of the market tables ------
KRX_LIST_TYPES = {
    "Code": "string", "ISU_CD": "string", "Name": "string", "Market": "string",
    "Dept": "string", "Close": "int", "ChangeCode": "int", "Changes": "int",
    "ChangesRatio": "double", "Open": "int", "High": "int", "Low": "int",
    "Volume": "int", "Amount": "bigint", "Marcap": "bigint", "Stocks": "bigint",
    "MarketId": "string",
}
KRX_CO_INFO_TYPES = {
    "Code": "string", "Name": "string", "Market": "string", "Sector": "string",
    "Industry": "string", "ListingDate": "timestamp_ntz", "SettleMonth": "string",
    "Representative": "string", "HomePage": "string", "Region": "string",
}
KRX_STOCK_TYPES = {
    "Date": "timestamp_ntz", "Open": "bigint", "High": "bigint", "Low": "bigint",
    "Close": "bigint", "Volume": "bigint", "Code": "string",
}
NAS_LIST_TYPES = {"Symbol": "string", "Name": "string", "Industry": "string",
                  "IndustryCode": "string"}
NAS_STOCK_TYPES = {
    "Date": "date", "Open": "double", "High": "double", "Low": "double",
    "Close": "double", "Adj_Close": "double", "Volume": "double", "Symbol": "string",
}
OVERVIEW_FIELDS = [
    "Symbol", "AssetType", "Name", "CIK", "Exchange", "Currency", "Country",
    "Sector", "Industry", "Address", "FiscalYearEnd", "LatestQuarter",
    "MarketCapitalization", "EBITDA", "PERatio", "PEGRatio", "BookValue",
    "DividendPerShare", "DividendYield", "EPS", "RevenuePerShareTTM",
    "ProfitMargin", "OperatingMarginTTM", "ReturnOnAssetsTTM",
    "ReturnOnEquityTTM", "RevenueTTM", "GrossProfitTTM", "DilutedEPSTTM",
    "QuarterlyEarningsGrowthYOY", "QuarterlyRevenueGrowthYOY",
    "AnalystTargetPrice", "TrailingPE", "ForwardPE", "PriceToSalesRatioTTM",
    "PriceToBookRatio", "EVToRevenue", "EVToEBITDA", "Beta", "Week52High",
    "Week52Low", "Day50MovingAverage", "Day200MovingAverage",
    "SharesOutstanding", "DividendDate", "ExDividendDate",
]
SNAPSHOT_FILE_FIELDS = ["symbol", "shortName", "sector", "marketCap", "volume",
                        "previousClose", "regularMarketOpen", "change"]
SNAPSHOT_TABLE_TYPES = {
    "symbol": "string", "name": "string", "sector": "string", "marcap": "double",
    "volume": "double", "previous_close": "double",
    "regular_market_open": "double", "changesratio": "double",
}
SNP_LIST_TYPES = {"Symbol": "string", "Name": "string", "Sector": "string",
                  "Industry": "string"}
SNP_STOCK_TYPES = {
    "Date": "timestamp_ntz", "Open": "double", "High": "double", "Low": "double",
    "Close": "double", "Volume": "double", "Symbol": "string", "Change": "double",
}
MATERIAL_COLUMNS = {
    "gold_price": ["USD_AM", "USD_PM", "GBP_AM", "GBP_PM", "EURO_AM", "EURO_PM"],
    "silver_price": ["USD", "GBP", "EURO"],
    "cme_price": ["open", "high", "low", "last", "change", "settle", "volume",
                  "Previous_Day_Open_Interest"],
    "orb_price": ["value"],
}
MATERIAL_REQUIRED = {
    "gold_price": ["USD_PM"],
    "silver_price": ["USD"],
    "cme_price": ["open", "high", "low", "last", "settle"],
    "orb_price": ["value"],
}
# KRX markets and the child table each one is stored in.
KRX_MARKET_GROUPS = {"KOSPI": "kospi", "KOSDAQ": "kosdaq",
                     "KOSDAQ GLOBAL": "kosdaq", "KONEX": "konex"}
# ---------------------------------------------------------------------------


_SIMPLE = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}


def ddl(spec: str) -> T.StructType:
    """``"a string, b bigint"`` -> StructType, without needing a session."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name.strip("`"), _SIMPLE[typ.lower()], True))
    return T.StructType(fields)


def strings(names) -> T.StructType:
    """All-string schema for a landed file, bound by position."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def struct_of(types: dict) -> T.StructType:
    return ddl(", ".join(f"{k} {v}" for k, v in types.items()))
