"""Distinct, keep-first, key audit (AGG-1..4) and union (SET-1).

All of these are aggregates that Spark combines map-side before the shuffle:
a key holding a third of the rows reaches the reducer as one partial row per
input task, never as a third of the data in one task.  They are hash
aggregates, but for a keep-first that carries text or goes by several order
columns: Spark sorts for that one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.operators.series import ordering_of, plain_order


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def distinct_keys(df: DataFrame, key) -> DataFrame:
    """AGG-1: the key universe, as a DataFrame (never collected)."""
    return df.select(*_list(key)).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    """AGG-2: drop rows equal in every column."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """AGG-3: the first row per key in ``order`` (a total order, e.g. a source
    row id).  ``dropDuplicates(keys)`` would keep an arbitrary survivor."""
    keys, order = _list(keys), _list(order)
    others = [c for c in df.columns if c not in keys]
    ordering = ordering_of(df, order, others)
    if plain_order(df, order, others):
        firsts = [F.min_by(F.col(f"`{c}`"), ordering).alias(c) for c in others]
        return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*firsts) \
                 .select(*[F.col(f"`{c}`") for c in df.columns])
    agg = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in others]), ordering).alias("_first"))
    return agg.select(*[F.col(f"`{k}`") for k in keys],
                      *[F.col("_first").getField(c).alias(c) for c in others]) \
              .select(*[F.col(f"`{c}`") for c in df.columns])


def key_violations(df: DataFrame, keys) -> DataFrame:
    """AGG-4: every key value that is duplicated or has a NULL part, with its
    row count and a reason."""
    keys = _list(keys)
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return (counted.filter((F.col("n_rows") > 1) | null_key)
                   .withColumn("reason", F.when(null_key, F.lit("null key"))
                                          .otherwise(F.lit("duplicate key"))))


def required_violations(df: DataFrame, required) -> DataFrame:
    """Count of NULLs per required (NOT NULL) column, one row."""
    required = _list(required)
    return df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c)
                    for c in required])


class KeyViolation(ValueError):
    pass


def assert_key(df: DataFrame, keys=None, required=()) -> None:
    """AGG-4 as a gate: raise when the key is not unique and not null, or a
    required column holds NULL.  One aggregate over the key answers both;
    only a bounded sample of violations reaches the driver."""
    keys = _list(keys) if keys else []
    required = _list(required) if required else []
    if not keys and not required:
        return
    if not keys:
        row = required_violations(df, required).collect()[0].asDict()
        bad = {k: v for k, v in row.items() if v}
        if bad:
            raise KeyViolation(f"NULL in required columns: {bad}")
        return
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    nulls = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"_null_{c}")
             for c in required]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *nulls)
    req_bad = reduce(lambda a, b: a | b, [F.col(f"_null_{c}") > 0 for c in required],
                     F.lit(False))
    sample = per_key.filter((F.col("n_rows") > 1) | null_key | req_bad).limit(5).collect()
    if sample:
        dup = [r for r in sample if r["n_rows"] > 1 or any(r[k] is None for k in keys)]
        if dup:
            raise KeyViolation(f"key {keys} violated, e.g. {dup}")
        raise KeyViolation(f"NULL in required columns {required}, e.g. {sample}")


def union_all(*dfs: DataFrame) -> DataFrame:
    """SET-1: union by name; a column missing on one side becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
