"""Shards along a Hilbert curve over document metadata, so that a filter on any
of the dimensions can skip most files.

Each dimension is cut into at most 2^``BITS`` bins at the corpus's own quantiles,
a text by its whole order: its values are counted, sorted by range and added up,
so URLs or names that all begin alike are told apart, and a file's smallest and
largest values stay close.  A cell's place on the curve
comes from its bins by bit operations on columns.  Rows sorted by that place are
cut into runs of equal length, at most one row apart: shard 0, 1, ...  Within a
cell, equal texts lie next to each other, then ids ascend.

Everything is DataFrame operations.  The sort is a range partitioning on place,
text and id, so a cell that holds a third of all rows is spread like any other;
only a few numbers of each row are sorted and kept, never its text.  What comes
to the driver are the bins' edges, one row a dimension.

Defined results.  Null metadata are in the first bin; a null text has no bytes
and the checksum of an empty one, and null ids come first among equal texts.
Repeated rows lie next to each other in no defined order.  Extra columns play no
part.  An empty table gives an empty one; with fewer rows than shards the last
shards are empty.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.llm.common import stored, table
from bourse.operators.projection import with_row_index

SHARDS = 24
BITS = 5
DIMENSIONS = ("lang", "source", "n_chars")
ACCURACY = 10_000


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _value(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    return col if _is_text(df, name) else col.cast("double")


def text_edges(df: DataFrame, name: str, shares: list[float]) -> list[str]:
    """The smallest values of a text dimension up to which ``shares`` of its rows lie."""
    counted = df.where(F.col(f"`{name}`").isNotNull()).groupBy(F.col(f"`{name}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    # stored, as bounds come from a sample and both readings must have the same
    ranged = stored(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "hilbert-values")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("n").alias("held"))        # a row a range
    total = parts.agg(F.sum("held")).first()[0] or 0
    before = parts.select("part", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("before"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    summed = ranged.join(F.broadcast(before), "part").select("v", upto.alias("upto"))
    edges = summed.agg(*[F.min(F.when(F.col("upto") >= s * total, F.col("v"))).alias(f"e{i}") for i, s in enumerate(shares)]).first()
    return [e for e in edges if e is not None]


def bins(df: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> list[Column]:
    """Each dimension's bin, 0 to 2^bits - 1, cut at quantiles of ``df``."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    edges = {d: text_edges(df, d, shares) for d in dimensions if _is_text(df, d)}
    numbers = [d for d in dimensions if d not in edges]
    if numbers:
        got = df.agg(*[F.percentile_approx(_value(df, d), shares, ACCURACY).alias(f"e{i}") for i, d in enumerate(numbers)]).first()
        edges |= dict(zip(numbers, got))
    out = []
    for d in dimensions:
        value = _value(df, d)
        # a value that fills several bins takes the first of them, the next value the one after
        found = [F.when(value > F.lit(e), 1).otherwise(0) for e in edges[d] or []]
        # without edges (no values) the bin is 0, but never a constant: the steps
        # of the curve would be folded into one expression that doubles with each
        zero = F.least(F.coalesce(F.length(F.col(f"`{d}`").cast("string")), F.lit(0)), F.lit(0))
        out.append(reduce(add, found, zero).cast("int"))
    return out


def curve_place(df: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """``df`` with ``name``: the place on the Hilbert curve of the cell whose
    bins are in the int columns ``axes`` (which it uses up).

    Skilling's transform, a projection for each step so that no expression
    grows: the highest bits first, an axis whose bit is set flips the lower
    bits of the first axis, one whose bit is not set swaps them with it."""
    others = [c for c in df.columns if c not in axes]
    x = [F.col(a) for a in axes]

    def step(frame: DataFrame, new: dict[str, Column]) -> DataFrame:
        return frame.select(*[F.col(f"`{c}`") for c in others], *[new.get(a, F.col(a)).alias(a) for a in axes])

    for q in range(bits - 1, 0, -1):
        bit, low = 1 << q, (1 << q) - 1
        for i, axis in enumerate(axes):
            set_ = x[i].bitwiseAND(F.lit(bit)) != 0
            if i == 0:
                df = step(df, {axis: F.when(set_, x[0].bitwiseXOR(F.lit(low))).otherwise(x[0])})
                continue
            swap = x[0].bitwiseXOR(x[i]).bitwiseAND(F.lit(low))
            df = step(df, {axes[0]: F.when(set_, x[0].bitwiseXOR(F.lit(low))).otherwise(x[0].bitwiseXOR(swap)),
                           axis: F.when(set_, x[i]).otherwise(x[i].bitwiseXOR(swap))})
    for i in range(1, len(axes)):       # Gray code
        df = step(df, {axes[i]: x[i].bitwiseXOR(x[i - 1])})
    last = x[-1]
    flips = [F.when(last.bitwiseAND(F.lit(1 << q)) != 0, F.lit((1 << q) - 1)).otherwise(F.lit(0))
             for q in range(1, bits)]
    flip = reduce(lambda a, b: a.bitwiseXOR(b), flips, F.lit(0))
    df = step(df, {a: x[i].bitwiseXOR(flip) for i, a in enumerate(axes)})
    place = F.lit(0).cast("long")
    for q in range(bits - 1, -1, -1):
        for col in x:
            place = place * 2 + F.shiftright(col, q).bitwiseAND(F.lit(1)).cast("long")
    return df.select(*[F.col(f"`{c}`") for c in others], place.alias(name))


def cut_runs(df: DataFrame, order: list[str], shards: int = SHARDS) -> DataFrame:
    """``df`` with shard and slot: runs of equal length, at most one row apart,
    of the rows in ``order`` (ties in any order)."""
    kept = [F.col(f"`{c}`") for c in df.columns]
    numbered = with_row_index(df.withColumn("_tie", F.monotonically_increasing_id()), [*order, "_tie"], "_row")
    rows = numbered.count()
    size, longer = divmod(rows, shards)
    row = F.col("_row") - 1
    ahead = longer * (size + 1)
    shard = F.when(row < ahead, F.floor(row / (size + 1))).otherwise(longer + F.floor((row - ahead) / max(1, size)))
    slot = F.when(row < ahead, row % (size + 1)).otherwise((row - ahead) % max(1, size))
    return numbered.select(*kept, shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS,
                   bits: int = BITS, order: tuple[str, ...] = ("doc_id",),
                   keep: list[Column] | None = None) -> DataFrame:
    """``docs`` with shard, slot and hilbert (its place on the curve), in place
    of columns so called.  ``keep``
    are the columns to carry (all of ``docs`` by default); ``order`` names those
    of them that decide within a cell."""
    axes = [f"_axis{i}" for i in range(len(dimensions))]
    taken = {"shard", "slot", "hilbert", "_tie", "_row", *axes}
    keep = keep or [F.col(f"`{c}`") for c in docs.columns if c not in taken]
    placed = docs.select(*keep, *[b.alias(a) for a, b in zip(axes, bins(docs, dimensions, bits))])
    placed = curve_place(placed, axes, bits, "hilbert")
    return cut_runs(placed, ["hilbert", *order], shards)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS) -> None:
    """Write ``docs`` as Parquet, a folder for each shard, sorted by slot: files
    whose statistics a filter on any dimension can use."""
    done = hilbert_shards(docs, shards, dimensions)
    (done.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
         .write.partitionBy("shard").parquet(path))


# --- query ---------------------------------------------------------------------

def op8_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    done = hilbert_shards(docs, keep=[
        F.col("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")], order=("text_crc32", "doc_id"))
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "hilbert")
