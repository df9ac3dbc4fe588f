"""Filters and predicates (FLT-*), plus the bounded history scan (SRC-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.functions.scalar import add_years
from bourse.session import scratch_path

REASON = "_reason"


def drop_nan(df: DataFrame, cols=None) -> DataFrame:
    """FLT-1 / FLT-2: drop rows with a missing value (NULL or NaN) in ``cols``,
    or in any column when ``cols`` is None."""
    if cols is None:
        return df.dropna(how="any")
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.dropna(how="any", subset=cols)


def drop_all_nan(df: DataFrame) -> DataFrame:
    """FLT-3: drop rows where every column is missing."""
    return df.dropna(how="all")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """FLT-4: SQL ``DELETE ... WHERE predicate``: rows where the predicate is
    NULL survive, exactly as in a database."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def delete_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """FLT-4 as used for stray header rows: ``col LIKE pattern`` (case-sensitive)."""
    return delete_where(df, F.col(col).like(pattern))


def filter_in(df: DataFrame, col: str, values, value_col: str | None = None,
              keep=()) -> DataFrame:
    """FLT-5: restrict ``col`` to a set.

    ``values`` may be a Python list (an ``IN`` list, pushed to Parquet) or a
    DataFrame holding the keys (a left-semi join; repeated keys do no
    harm).  ``keep`` names label columns
    of that DataFrame to carry along (the KRX code + name pairs): then it is
    an inner join on the key.
    """
    if isinstance(values, DataFrame):
        keep = [keep] if isinstance(keep, str) else list(keep)
        right = values.select(F.col(value_col or col).alias("_in_key"), *keep)
        how = "inner" if keep else "left_semi"
        out = df.join(right, df[col] == right["_in_key"], how)
        return out.drop("_in_key") if keep else out
    return df.filter(F.col(col).isin(list(values)))


def scan_history(df: DataFrame, col: str, start, end=None) -> DataFrame:
    """SRC-7: rows with start <= col <= end (end open when None); pushed to the
    scan.  The end is a day: of a timestamp column the whole day is kept."""
    c = F.col(col)
    cond = c >= F.lit(start).cast("date") if start is not None else F.lit(True)
    if end is not None:
        last = F.lit(end).cast("date")
        whole_day = dict(df.dtypes)[col].startswith("timestamp")
        cond = cond & (c < F.date_add(last, 1) if whole_day else c <= last)
    return df.filter(cond)


def lookback(df: DataFrame, col: str, years: int, asof) -> DataFrame:
    """FLT-6: the last ``years`` years up to ``asof`` (a date literal or a
    scalar Column, e.g. ``df.select(F.max(col)).scalar()``).  Taking ``asof``
    as an argument keeps results reproducible."""
    asof_c = asof if isinstance(asof, Column) else F.lit(asof).cast("date")
    c = F.col(col)
    return df.filter((c >= add_years(asof_c, -years)) & (c <= asof_c))


def tag(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """FLT-7: ``_reason``, the first check that a record fails (``checks`` maps a
    reason to a predicate that must hold; NULL does not), or NULL."""
    reason = F.lit(None).cast("string")
    for why, holds in reversed(list(checks.items())):
        reason = F.when(~F.coalesce(holds, F.lit(False)), F.lit(why)).otherwise(reason)
    return df.withColumn(REASON, reason)


def split_tagged(tagged: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a tagged frame, which is computed and written once, to the
    shared folder, in two partitions: each frame is a read of its own.  So both
    are halves of the same rows even if the input changes meanwhile or has
    expressions that answer otherwise next time.  Who needs one of them, or both
    in one write (``refresh_split``), takes the tagged frame as it is."""
    spark = tagged.sparkSession
    flag = "refused"
    while flag in tagged.columns:
        flag += "_"
    marked = tagged.withColumn(flag, F.col(reason).isNotNull())
    path = scratch_path(spark, "tagged")
    marked.write.partitionBy(flag).parquet(path)
    rows = spark.read.schema(marked.schema).parquet(path)
    return rows.filter(~F.col(flag)).drop(flag, reason), rows.filter(F.col(flag)).drop(flag)


def quarantine(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """FLT-7: split records into (good, bad), the input being read once.

    A record failing any check goes to ``bad`` with the first failing reason in
    ``_reason``.  Nothing is printed and forgotten: the rejects are a DataFrame.
    """
    return split_tagged(tag(df, checks))
