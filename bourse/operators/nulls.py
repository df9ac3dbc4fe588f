"""Missing values (NUL-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.operators.series import DEFAULT_SEGMENT
from bourse.operators.series import ffill as _ffill


def ffill(df: DataFrame, key, order, cols, segment=DEFAULT_SEGMENT) -> DataFrame:
    """NUL-1: per-key forward fill (see ``operators.series``)."""
    return _ffill(df, key, order, cols, segment=segment)


def fill_const(df: DataFrame, col, value) -> DataFrame:
    """NUL-2 / NUL-3: fill one column (``col``) or every type-compatible column
    (``col=None``) with a constant.  NaN counts as missing, as in pandas."""
    if col is None:
        return df.fillna(value)
    cols = [col] if isinstance(col, str) else list(col)
    return df.fillna({c: value for c in cols})


def normalize_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column (do it at every scan)."""
    return df.select(*[
        F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if t in ("double", "float")
        else F.col(f"`{c}`") for c, t in df.dtypes
    ])
