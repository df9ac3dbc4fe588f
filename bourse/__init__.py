"""bourse — a PySpark-native library for daily market-data tables.

Landed listings, company facts, daily bars and commodity prices are read into
typed DataFrames, cleaned, joined, turned into per-symbol series and written
as audited, full-refresh or partitioned tables.  Every operator is a plain
DataFrame plan so Catalyst can prune, push down and pick the join strategy.

Layout:
    functions/   column expressions (zero fill, coercing casts, percent diffs)
    operators/   DataFrame operators (projections, filters, nulls, keys,
                 series windows, joins, forecast)
    sources/     landed CSV / JSON / Parquet scans
    sinks/       CSV, append, publish, audited refresh and partitioned tables
    plans/       adapters from the test tables, composed jobs, query catalog
"""

from bourse.session import get_session, scale_conf, scratch_path

__all__ = ["get_session", "scale_conf", "scratch_path"]
