"""Helpers that the operators of this subpackage share: table access, shared
intermediate tables, hash-split label samples and a vectorised word hasher."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.session import scratch_path

#: Stands for a null id wherever an id is a join or group key.
NULL_ID = -(2 ** 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """``df`` written as Parquet to the cluster's shared folder and read again:
    cuts the lineage, so a lost executor costs no recomputation, and what
    several consumers read is computed once."""
    return stored_at(df, name, level)[0]


def stored_at(df: DataFrame, name: str, level: int = 3) -> tuple[DataFrame, str]:
    """``stored``, and the folder, for ``remove`` once the table has been read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


#: Tasks for each core that write a small table.
TASKS_A_CORE = 4


def stored_small(df: DataFrame, name: str) -> DataFrame:
    """``stored`` for a few bytes a document: written by a few tasks a core,
    whatever the shuffle partitions.  Where Hadoop's native library is missing,
    each file starts processes that share the executor's memory for a moment
    and count once more."""
    return stored(df.coalesce(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism), name)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of few rows: what Python makes of one at a time is bounded."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table that no later step reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def row_keyed(docs: DataFrame, name: str) -> DataFrame:
    """(_key, _order, row) of each row of ``docs``, through a table: ``_key`` is
    the row's own number, whatever its doc_id; ``_order`` sorts by doc_id, rows
    without one last, then by a hash of the row, then by ``_key``."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    rows = docs.select(F.monotonically_increasing_id().alias("_key"), F.xxhash64(*plain).alias("_hash"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    order = F.struct(F.col("row.doc_id").isNull().alias("nameless"), F.col("row.doc_id").cast("long").alias("id"),
                     F.col("_hash").alias("hash"), F.col("_key").alias("key"))
    return stored(rows, name).select("_key", order.alias("_order"), "row")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_key(col: str = "doc_id") -> Column:
    """A never-null long for an id, so that joins keep rows without one."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def fold(col: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % folds, F.lit(0)).cast("int")


def label_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """Texts of at most ``per_class`` labelled documents of either class, all
    from outside fold 0, as (doc_id, text, y, part); ``part`` in 0..3 splits
    them by a second hash into fitting and calibration rows.

    The bound holds on the label table, before any text is read: what leaves
    here is at most 2 x ``per_class`` ids (broadcast) and their texts.  An id
    that is labelled twice keeps its smaller label, a text that is repeated
    under one id is taken once, null labels and null ids are left out."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 0))
             .groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(*order).limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return (texts.join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
            .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int")))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``label_sample`` without a bound: the texts of all documents of either
    class outside fold 0, as (doc_id, text, y, part)."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 0))
             .groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y")))
    texts = docs.where(fold() != 0).select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return (texts.join(known, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
            .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int")))


#: Keys that ``hot_join`` broadcasts are at most so many.
SHARE = 1000


def hot_join(rows: DataFrame, side: DataFrame, on: list[str], n: str, deal: Column) -> DataFrame:
    """``rows`` LEFT JOIN ``side`` on ``on``, without bringing the rows of a
    frequent key together.

    ``side`` is a stored table with one row a key, never null, and the number
    ``n`` of its rows in ``rows``.  Keys that hold over 1/SHARE of the rows
    counted there are at most SHARE and are broadcast; rows that found theirs,
    or have no key, are dealt out by ``deal``, a hash of the row; the others
    meet by key in groups of at most 1/SHARE."""
    total = side.agg(F.sum(n)).first()[0] or 0
    values = [c for c in side.columns if c not in on]
    hot = F.col(n) * SHARE > F.lit(total)
    early = side.where(hot).select(*on, F.struct(*values).alias("_early"))
    left = rows.join(F.broadcast(early), on, "left")
    done = F.col("_early").isNotNull()
    for c in on:
        done = done | F.col(c).isNull()
    left = left.withColumn("_spread", F.when(done, deal)).withColumn("_spread", F.coalesce("_spread", F.lit(0)))
    left = left.withColumn("_wait", ~done)
    late = side.where(~hot).select(*on, F.lit(0).cast("long").alias("_spread"), F.lit(True).alias("_wait"),
                                   F.struct(*values).alias("_late"))
    # a null key would take part in the shuffle as one more frequent key
    filled = {c: F.coalesce(F.col(c), F.lit("").cast(rows.schema[c].dataType) if rows.schema[c].dataType.typeName() == "string"
                            else F.lit(0).cast(rows.schema[c].dataType)) for c in on}
    left = left.withColumns({f"_on_{c}": x for c, x in filled.items()})
    late = late.withColumnsRenamed({c: f"_on_{c}" for c in on})
    both = left.join(late, [*[f"_on_{c}" for c in on], "_spread", "_wait"], "left")
    got = F.coalesce("_early", "_late")
    return both.select(*[F.col(f"`{c}`") for c in rows.columns if c not in values], *[got[v].alias(v) for v in values])


# --- words of many texts at once ---------------------------------------------

_P = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20
_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Letters of a word that are hashed one step at a time.
_STEPS = 64
_POW = _powers(int(_P), 1 << 12)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: list[str], prefix: int = 0) -> tuple[np.ndarray, ...]:
    """Hashes of all lower-cased words (runs of ASCII letters, digits and any
    other-than-ASCII characters) of many texts, in order, and the index of
    each word's text; with ``prefix``, also hashes of the words' first bytes,
    as many.  One pass of array operations; no loop over words."""
    parts = [[np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]]
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _BLOCK):
            size += len(texts[end])
            end += 1
        w, o, p = _block_hashes(texts[at:end], prefix)
        for to, x in zip(parts, (w, o + at, p)):
            to.append(x)
        at = end
    return tuple(map(np.concatenate, parts[:3 if prefix else 2]))


def _block_hashes(texts: list[str], prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    inside = _WORD_BYTE[data]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    start, stop = edge[0::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64)
    first = h = np.zeros(len(start), dtype=np.uint64)
    length = stop - start
    # one step for each letter position; only words that are long enough take part
    todo = np.arange(len(start))
    for k in range(min(_STEPS, int(length.max()))):
        if k:
            todo = todo[length[todo] > k]
        h[todo] = (h[todo] ^ (data[start[todo] + k].astype(np.uint64) + np.uint64(1))) * _P
        if k == prefix - 1:
            first = h.copy()
    for i in np.flatnonzero(length > _STEPS):      # what is left of a very long word, in one go
        chunk = data[start[i] + _STEPS:stop[i]].astype(np.uint64) + np.uint64(1)
        x = h[i:i + 1]
        for a in range(0, len(chunk), len(_POW)):
            part = chunk[a:a + len(_POW)]
            x = x * _POW[len(part) - 1] * _P + (part * _POW[:len(part)][::-1]).sum(dtype=np.uint64)
        h[i] = x[0]
    return mix(h), np.searchsorted(ends, start, side="right"), mix(first)
