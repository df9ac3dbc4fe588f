"""Joins (JOI-*).

No side is broadcast by a hint: AQE knows the real size of a side once it is
shuffled, switches to a broadcast below its byte threshold and splits a
skewed key otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def enrich_bars(bars: DataFrame, listing: DataFrame, key: str = "code",
                cols=("name", "market", "marcap")) -> DataFrame:
    """JOI-1: bars of currently listed codes, with listing attributes."""
    return bars.join(listing.select(key, *cols), key, "inner")


def enrich_listing(listing: DataFrame, info: DataFrame, key: str = "code",
                   cols=None) -> DataFrame:
    """JOI-2: every listed company, with company info where there is some.

    Both sides are one row per company, so this is a plain shuffle (or AQE
    broadcast) join; no hint.
    """
    cols = [c for c in (cols or info.columns) if c != key]
    return listing.join(info.select(key, *cols), key, "left")
