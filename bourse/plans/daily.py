"""The daily KRX run as one chain of data dependencies.

The reference starts its loads and its ELT at fixed times and hopes the
loads are done; here each table is an input of the next, so the order is the
data's.  Every step writes an audited table version under ``base``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bourse.plans import markets as M


def run_krx_day(spark: SparkSession, landed: dict[str, str], base: str,
                start: str = "2003-01-01", forecast_symbols: DataFrame | None = None
                ) -> dict[str, DataFrame]:
    """``landed`` holds the paths of the day's ``krx_list``, ``krx_co_info`` and
    ``krx_stock`` files.  Returns every table of the run (and the rejects)."""
    base = base.rstrip("/")
    listing = M.krx_list(spark, landed["krx_list"], f"{base}/raw/krx_list")
    info = M.krx_co_info(spark, landed["krx_co_info"], f"{base}/raw/krx_co_info")
    stock = M.krx_stock(spark, landed["krx_stock"], f"{base}/raw/krx_stock",
                        listing=listing, start=start)
    by_market, list_rejects = M.krx_list_by_market(
        spark, listing, info, f"{base}/analytics/krx_partition_of_list_by_market")
    stock_by_market, stock_rejects = M.krx_stock_by_market(
        spark, stock, listing, f"{base}/analytics/krx_partition_of_stock_by_market")
    by_code = M.stock_by_symbol(spark, stock, "Code",
                                f"{base}/analytics/krx_partition_of_stock_by_code",
                                narrow=M.KRX_BY_CODE)
    names = forecast_symbols if forecast_symbols is not None else listing.select("Code", "Name")
    report = M.next_close_report(spark, stock, "Code", f"{base}/analytics/ml_krx",
                                 symbols=names, label="Name")
    return {"krx_list": listing, "krx_co_info": info, "krx_stock": stock,
            "list_by_market": by_market, "list_rejects": list_rejects,
            "stock_by_market": stock_by_market, "stock_rejects": stock_rejects,
            "stock_by_code": by_code, "forecast": report}


def run_nas_day(spark: SparkSession, landed: dict[str, str], base: str,
                start: str = "2003-01-01", forecast_symbols=None) -> dict[str, DataFrame]:
    """NASDAQ: listing and bars, bars by symbol, next-close report."""
    base = base.rstrip("/")
    listing = M.nas_list(spark, landed["nas_list"], f"{base}/raw/nas_list")
    stock = M.nas_stock(spark, landed["nas_stock"], f"{base}/raw/nas_stock", start=start)
    by_symbol = M.stock_by_symbol(spark, stock, "Symbol",
                                  f"{base}/analytics/nas_partition_of_stock_by_symbol")
    report = M.next_close_report(spark, stock, "Symbol", f"{base}/analytics/ml_nas",
                                 symbols=forecast_symbols)
    return {"nas_list": listing, "nas_stock": stock, "stock_by_symbol": by_symbol,
            "forecast": report}


def run_snp_day(spark: SparkSession, landed: dict[str, str], base: str,
                start: str = "2023-01-01", forecast_symbols=None) -> dict[str, DataFrame]:
    """S&P 500: listing and bars (with Change), bars by symbol with dates
    narrowed to DATE, next-close report."""
    base = base.rstrip("/")
    listing = M.snp_list(spark, landed["snp_list"], f"{base}/raw/snp_stock_list")
    stock = M.snp_stock(spark, landed["snp_stock"], f"{base}/raw/snp_stock", start=start)
    by_symbol = M.stock_by_symbol(spark, stock, "Symbol",
                                  f"{base}/analytics/snp_partition_of_stock_by_symbol",
                                  narrow=M.SNP_BY_SYMBOL)
    report = M.next_close_report(spark, stock, "Symbol", f"{base}/analytics/ml_snp",
                                 symbols=forecast_symbols)
    return {"snp_stock_list": listing, "snp_stock": stock, "stock_by_symbol": by_symbol,
            "forecast": report}
