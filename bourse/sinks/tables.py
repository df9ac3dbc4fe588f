"""Writes (SNK-1..9): CSV, append, publish, audited full refresh, partitioned
tables and per-value views.

A full refresh never overwrites in place.  Each run writes a new version
folder ``<base>/v=<time>-<id>``, audits what was written (key unique and not
null, required columns not null), and only then drops an ``_AUDITED`` marker
carrying the schema.  Readers take the newest marked version, so the old
table survives a failed run (the reference's rollback) and the switch is one
rename of a complete file.  ``keep`` versions stay: frames that still read an
older one fail once it is removed, so keep as many as are read at a time.

A load that refuses rows writes once, too: rows and rejects are partitions of one
audited version (``refresh_split``), and table and rejects are two reads of it.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.functions.scalar import cast_columns
from bourse.operators.filters import REASON
from bourse.operators.keys import KeyViolation, assert_key
from bourse.operators.projection import with_row_index
from bourse.session import listing, writing

MARKER = "_AUDITED"
# Of a version written by ``refresh_split``: the partition that parts refused rows
# from those of the table, and the column that holds a refused row.
REFUSED, REJECTED = "load_refused", "rejected"
BUCKET = "bucket"
DEFAULT_BUCKETS = 64
# Recorded with a key that has a folder for each value, and the types of key that are
# read from the folders' names.
PER_VALUE = "folder_per_value"
FOLDER_TYPES = (T.StringType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Parquet keeps a checksum of each page, whatever store holds the file; reads check it.
WRITE_PAGE_SUMS = {"parquet.page.write.checksum.enabled": "true"}
CHECK_PAGE_SUMS = {"parquet.page.verify-checksum.enabled": "true"}


# --- files ---------------------------------------------------------------

def write_csv(df: DataFrame, path: str, header: bool = True, encoding: str | None = None,
              bom: bool = False, mode: str = "overwrite") -> str:
    """SNK-1 / SNK-2: CSV with or without a header line (key column first is the
    caller's ``select``).  ``bom`` starts each file's header with a UTF-8 BOM."""
    out = df
    from bourse.sources.files import CSV_DIALECT, allow_charset
    if bom and header:
        first = df.columns[0]
        out = df.withColumnRenamed(first, "\ufeff" + first)
    w = out.write.mode(mode).options(**CSV_DIALECT).option("header", header)
    if encoding:
        allow_charset(df.sparkSession, encoding)
        w = w.option("encoding", encoding)
    w.csv(path)
    return path


def write_per_value_files(df: DataFrame, path: str, key: str, order=(),
                          header: bool = True) -> str:
    """Land one CSV file set per key value (``key=<value>/part-*.csv``), the
    shape an extractor that writes a file per symbol leaves behind.  Rows are
    range-partitioned on (key, order) first: about one file per value, and a
    hot value is still split over several tasks."""
    # Writers sized by AQE from the bytes, as for tables (see session defaults
    # for the small-partition floor that keeps small landings parallel).
    from bourse.sources.files import CSV_DIALECT
    cols = [key] + list(order)
    (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
       .write.partitionBy(key).options(**CSV_DIALECT).option("header", header).csv(path))
    return path


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """SNK-3: add rows to a dataset; Spark's commit protocol replaces the
    reference's unsynchronised appends to one file."""
    df.write.mode("append").format(fmt).save(path)
    return path


# --- Hadoop filesystem helpers (the cluster's shared storage) --------------

def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under another name and rename: a reader sees the whole file or none."""
    fs, p = _fs(spark, path)
    _, part = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(part, p):
        raise OSError(f"cannot rename to {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _versions(spark: SparkSession, base: str) -> list[str]:
    """Audited version folders of a table, oldest first."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and fs.exists(
                spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), MARKER)):
            out.append(name)
    return sorted(out)


# --- tables ----------------------------------------------------------------

def refresh_table(df: DataFrame, base: str, *, key=None, required=(), types=None,
                  partition_by=None, order=None, audit: bool = True,
                  keep: int = 2, derived: bool = False, per_value: bool = False) -> str:
    """SNK-5: full refresh, all or nothing.

    ``types`` is a strict cast map (SCL-3: a bad value fails the job);
    ``key``/``required`` are audited on the written files (AGG-4), or, where the
    rows are written sorted by columns of the key, on the way (``_checked``);
    ``order`` without ``partition_by`` writes files sorted by it;
    ``derived`` says that the key determines the columns of ``partition_by``;
    ``per_value`` that its folders may be as many as a key's values;
    ``partition_by`` writes Hive-style folders, range-partitioned on the
    partition columns plus ``order`` so a hot partition value is spread over
    several tasks and files stay sorted for min/max pruning.
    Returns the version folder.
    """
    typed = cast_columns(df, types) if types else df
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    order = [order] if isinstance(order, str) else list(order or [])
    return _write_version(typed, base, parts, order, key if audit else None, required if audit else (), keep,
                          derived or not parts, per_value)


def refresh_split(df: DataFrame, base: str, *, key=None, required=(), types=None, partition_by=None,
                  order=None, keep: int = 2, derived: bool = False) -> str:
    """SNK-5 + FLT-7: one write, two destinations.  ``df`` holds the table's
    columns and ``rejected``, a struct that is NULL for a row of the table and
    holds the refused row and its reason otherwise.  Both go into one version, as
    partitions; ``read_table`` reads the one and ``read_rejects`` the other, and
    both change with one rename.  ``key``, ``required`` and the strict casts of
    ``types`` concern the table's rows.  Refused rows keep their values in the
    columns of ``order`` alone (they spread the writers), and take part in the
    partitions of ``partition_by``."""
    types = types or {}
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    order = [order] if isinstance(order, str) else list(order or [])
    kept = {*parts, *[o for o in order if isinstance(o, str)]}
    good = F.col(REJECTED).isNull()
    cols = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c != REJECTED:
            own = x.cast(types[c]) if c in types else x
            x = F.when(good, own).otherwise(x.try_cast(types[c]) if c in types else x) if c in kept else F.when(good, own)
        cols.append(x.alias(c))
    split = df.select(*cols, F.col(REJECTED).isNotNull().alias(REFUSED))
    return _write_version(split, base, [REFUSED, *parts], order, key, required, keep, derived or not parts)


VIOLATION = "[KEY_VIOLATION]"


def _checked(ranged: DataFrame, place: list, key: list, required) -> DataFrame:
    """AGG-4 on the way to the files: ``ranged`` rows lie in ranges of ``place``,
    columns that the key determines, so rows with one key lie in one range and
    are neighbours once sorted.  Their count needs no exchange and no second look
    at the table; a repeated or missing key, or a missing required value, stops
    the write."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*[F.col(f"`{c}`") for c in dict.fromkeys([*place, *key])]))
    missing = [F.col(f"`{c}`").isNull() for c in dict.fromkeys([*key, *required])]
    bad = reduce(lambda a, b: a | b, missing, n > 1)
    if REFUSED in ranged.columns:
        bad = bad & ~F.col(REFUSED)
    what = F.concat(F.lit(f"{VIOLATION} key {key}, required {list(required)}: "),
                    F.to_json(F.struct(n.alias("n_rows"), *[F.col(f"`{c}`") for c in key])))
    first = next(c for c in ranged.columns if c not in place) if set(ranged.columns) - set(place) else ranged.columns[0]
    return ranged.withColumn(first, F.when(bad, F.raise_error(what)).otherwise(F.col(f"`{first}`")))


def _small_files(spark: SparkSession) -> dict:
    """Options of a write of very many small files.  Hadoop's local file system puts
    a file of checksums beside each one, and without its native library starts a
    process (``chmod``) for either; the pages' own checksums are kept instead.  Other
    stores, and a local one that the cluster has set itself, stay as they are."""
    if spark._jsc.hadoopConfiguration().get("fs.file.impl"):
        return WRITE_PAGE_SUMS
    return WRITE_PAGE_SUMS | {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def _write_version(typed: DataFrame, base: str, parts: list, order: list, key, required, keep: int,
                   derived: bool, per_value: bool = False) -> str:
    """A new version of a table: written, audited, marked; older ones go."""
    spark = typed.sparkSession
    key = [key] if isinstance(key, str) else list(key or [])
    required = [required] if isinstance(required, str) else list(required or [])
    on_the_way = bool(key and derived and order) and all(isinstance(o, str) and o in key for o in order)
    version = f"v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{base.rstrip('/')}/{version}"
    try:
        if order or (parts and parts != [REFUSED]):
            sort_cols = parts + order
            # No fixed writer count: AQE sizes the ranges by bytes, so a small
            # table is not spread over a large cluster's reducer count.  Ranges
            # keep each partition value contiguous: files number at most
            # writers + partition values.
            ranged = typed.repartitionByRange(*sort_cols)
            if on_the_way:
                ranged = _checked(ranged, sort_cols, key, required)
            options = _small_files(spark) if per_value else {}
            with writing(spark) if per_value else nullcontext():
                (ranged.sortWithinPartitions(*sort_cols).write.mode("errorifexists").options(**options)
                       .partitionBy(*parts).parquet(path))
        else:
            typed.write.mode("errorifexists").partitionBy(*parts).parquet(path)
        schema = typed.schema
        if per_value:
            schema = T.StructType([T.StructField(f.name, f.dataType, f.nullable, f.metadata | {PER_VALUE: True} if f.name in parts else f.metadata)
                                   for f in schema])
        if (key or required) and not on_the_way:
            assert_key(_table_rows(_rows(spark, path, schema)), key, required)
    except Exception as failed:
        _delete(spark, path)      # never marked, so never read; remove the debris
        if VIOLATION in str(failed):
            found = str(failed).split(VIOLATION, 1)[1].splitlines()[0].strip()
            raise KeyViolation(f"violated or NULL: {found[:500]}") from failed
        raise
    _write_text(spark, f"{path}/{MARKER}", schema.json())
    for old in _versions(spark, base)[:-keep]:
        _delete(spark, f"{base.rstrip('/')}/{old}")
    return path


def read_table(spark: SparkSession, base: str) -> DataFrame:
    """Read the newest audited version of a table with its recorded schema
    (partition values such as ``005930`` stay text)."""
    path, schema = _newest(spark, base)
    return _table_rows(_rows(spark, path, schema))


def read_rejects(spark: SparkSession, base: str) -> DataFrame:
    """The rows that the newest load of a table refused, with their reasons."""
    path, schema = _newest(spark, base)
    return spark.read.schema(schema).parquet(path).filter(F.col(REFUSED)).select(f"{REJECTED}.*")


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a version, whose folders may be as many as a key's values.  Then
    the key is read from each file's path: Spark's own finding of partitions takes
    driver time that grows with the square of the folders.  A filter on the key
    still leaves out the other values' files."""
    reader = spark.read.options(**CHECK_PAGE_SUMS)
    key = next((f for f in schema if f.metadata.get(PER_VALUE) and isinstance(f.dataType, FOLDER_TYPES)), None)
    with listing(spark):
        if key is None:
            return reader.schema(schema).parquet(path)
        inside = T.StructType([f for f in schema if f.name != key.name])
        rows = reader.schema(inside).option("recursiveFileLookup", True).parquet(path)
    folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
    value = _unescaped(F.substring_index(_unescaped(folder), "=", -1))
    kept = {k: v for k, v in key.metadata.items() if k != PER_VALUE}
    return rows.select(*[F.col(f"`{f.name}`") for f in inside],
                       F.when(value != NO_VALUE, value).cast(key.dataType).alias(key.name, metadata=kept))


def _unescaped(text):
    """``%XX`` turned back; a literal ``+`` stays."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _table_rows(version: DataFrame) -> DataFrame:
    """The table's own rows and columns; the partition of refused rows is not read."""
    return version.filter(~F.col(REFUSED)).drop(REFUSED, REJECTED) if REFUSED in version.columns else version


def _newest(spark: SparkSession, base: str) -> tuple[str, T.StructType]:
    """Folder and recorded schema of the newest audited version."""
    versions = _versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no audited version under {base}")
    path = f"{base.rstrip('/')}/{versions[-1]}"
    return path, T.StructType.fromJson(json.loads(_read_text(spark, f"{path}/{MARKER}")))


def register_view(spark: SparkSession, name: str, base: str) -> DataFrame:
    """Expose the newest audited version of a table under ``name`` (a session
    view with the recorded schema), so scans by name (SRC-6) see it.  The
    durable pointer stays the ``_AUDITED`` marker: re-register after a
    refresh to move the name to the new version."""
    df = read_table(spark, base)
    df.createOrReplaceTempView(name)
    return df


def publish(df: DataFrame, uri: str) -> str:
    """SNK-4: replace a published dataset; readers see the old one until the
    new version is complete."""
    return refresh_table(df, uri, audit=False)


def bucket_of(c, buckets: int):
    """Hashed bucket of a key column (or literal) -- the layout's partition value."""
    return F.pmod(F.xxhash64(c), F.lit(buckets))


def write_partitioned(df: DataFrame, base: str, key: str, *, order=None,
                      buckets: int = DEFAULT_BUCKETS, per_value: bool = False,
                      refresh_key=None) -> str:
    """SNK-6: list partitioning by key.  Default layout: ``bucket =
    pmod(xxhash64(key), buckets)`` folders, so thousands of symbols give a
    bounded number of folders; ``per_value=True`` writes one folder per key
    value (the reference's one child table per symbol).  The number of buckets
    is recorded with the table's schema, for ``partition_view``."""
    order = [order] if isinstance(order, str) else list(order or [])
    if per_value:
        return refresh_table(df, base, key=refresh_key, partition_by=[key], order=order, derived=key in (refresh_key or ()),
                             per_value=True)
    withb = (df.withColumn(BUCKET, bucket_of(F.col(key), buckets).cast("int"))
             .withMetadata(BUCKET, {"buckets": buckets}))
    return refresh_table(withb, base, key=refresh_key, partition_by=[BUCKET],
                         order=[key] + order, derived=key in (refresh_key or ()))


def partition_view(spark: SparkSession, base: str, key: str, value) -> DataFrame:
    """SNK-8: one key's rows as its own relation.  The bucket predicate is a
    constant after folding, so the scan shows it under PartitionFilters and
    reads one folder; the key predicate is pushed into the Parquet reader.
    The number of buckets is the one the table was written with."""
    path, schema = _newest(spark, base)
    df = _table_rows(_rows(spark, path, schema))
    key_type = schema[key].dataType
    lit = F.lit(value).cast(key_type)
    if BUCKET in df.columns:
        buckets = schema[BUCKET].metadata["buckets"]
        df = df.filter(F.col(BUCKET) == bucket_of(lit, buckets).cast("int")).drop(BUCKET)
    return df.filter(F.col(key) == lit)


def route(df: DataFrame, col: str, mapping: dict, out: str = "market_group") -> DataFrame:
    """SNK-7 routing: ``out``, the child that each value of ``col`` maps to
    (several values may share one), and ``_reason`` for a value without a child:
    a list partition without a default child rejects it.  The mapping is a handful
    of literals, compiled into a CASE expression (no join)."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(F.col(col) == F.lit(k), F.lit(v)))
    reason = F.concat(F.lit(f"no child for {col} "), F.coalesce(F.col(col).cast("string"), F.lit("NULL")))
    return df.withColumn(out, expr).withColumn(REASON, F.when(F.col(out).isNull(), reason))


def market_groups(df: DataFrame, col: str, mapping: dict, out: str = "market_group"):
    """``route`` as two frames: (routed, rejects with a ``_reason``)."""
    tagged = route(df, col, mapping, out)
    return tagged.filter(F.col(out).isNotNull()).drop(REASON), tagged.filter(F.col(out).isNull())


def rejected(df: DataFrame, cols=None, reason: str = REASON) -> DataFrame:
    """``df``, tagged with ``reason`` (NULL for a good row), in the shape that
    ``refresh_split`` writes: a bad row's ``cols`` (all of them) as one struct."""
    row = F.struct(*[F.col(f"`{c}`") for c in cols or df.columns])
    return df.withColumn(REJECTED, F.when(F.col(reason).isNotNull(), row)).drop(reason)


def write_market_partitioned(df: DataFrame, base: str, col: str, mapping: dict, *,
                             key=None, required=(), order=None, out: str = "market_group"):
    """SNK-7: grouped list partition; routed rows and rejects in one write.
    Returns (version path, rejects)."""
    path = refresh_split(rejected(route(df, col, mapping, out)), base, key=key, required=required,
                         partition_by=[out], order=order, derived=col in (key or ()))
    return path, read_rejects(df.sparkSession, base)


def replace_result(df: DataFrame, base: str, order, name: str = "index") -> str:
    """SNK-9: replace a small result table, with a 1-based index in ``order``."""
    return publish(with_row_index(df, order, name), base)
