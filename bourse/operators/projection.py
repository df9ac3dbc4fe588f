"""Projections (PRJ-*) and the distributed 1-based row index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourse.session import ensure_checkpoint_dir


def select_cols(df: DataFrame, *cols) -> DataFrame:
    """PRJ-1: plain projection; Catalyst prunes the Parquet read schema."""
    return df.select(*cols)


def drop_cols(df: DataFrame, cols) -> DataFrame:
    """PRJ-2: drop columns by name; unlike ``DataFrame.drop`` an absent name raises."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def drop_col_at(df: DataFrame, i: int) -> DataFrame:
    """PRJ-3: drop the i-th column (0-based)."""
    return df.drop(df.columns[i])


def rename_positional(df: DataFrame, names) -> DataFrame:
    """PRJ-4: give the columns new names by position."""
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def with_key(df: DataFrame, name: str, value) -> DataFrame:
    """PRJ-5: attach the entity key as a constant column."""
    return df.withColumn(name, F.lit(value))


def with_row_index(df: DataFrame, order: list, name: str = "index",
                   checkpoint: bool = True) -> DataFrame:
    """PRJ-6: 1-based, gap-free row index in ``order`` without a one-task window.

    Rows are range-partitioned on the order (sampled bounds, so a hot value
    still spreads), sorted within partitions, and numbered locally; each
    partition then adds the row count of all earlier partitions.  The
    offset table has one row per partition, a proven bound, so it is
    broadcast.  The tagged rows are checkpointed to the shared folder so a
    lost executor cannot re-sample different bounds.  ``order`` must be a
    total order (end it with a unique column).
    """
    spark = df.sparkSession
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    pid = F.spark_partition_id().cast("long")
    # no fixed count: AQE sizes the ranges (a small result is not spread over
    # a large cluster's reducer count); partition ids follow range order
    tagged = (df.repartitionByRange(*order)
                .sortWithinPartitions(*order)
                .withColumn("_pid", pid)
                .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid, 33)))
    if checkpoint:
        ensure_checkpoint_dir(spark)
        tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      (F.col("_off") + F.col("_pos") + 1).alias(name))
