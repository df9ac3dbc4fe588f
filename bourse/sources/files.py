"""Scans of landed files (SRC-1..7).

Every CSV is read with an explicit all-string schema (never ``inferSchema``)
and typed afterwards, so text keys keep their leading zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.operators.filters import split_tagged
from bourse.operators.filters import scan_history  # noqa: F401  (SRC-7)
from bourse.operators.nulls import normalize_nan
from bourse.schemas import strings
from bourse.session import listing

# The text tokens pandas' CSV reader treats as missing by
# default.  Spark treats only the empty field as NULL.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


# Charsets Spark's CSV source accepts without the JDK charset table.
_STANDARD_CHARSETS = {"utf-8", "utf8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be",
                      "utf-16le", "utf-32"}


def allow_charset(spark: SparkSession, encoding: str | None) -> None:
    """Legacy charsets such as cp949 need ``spark.sql.legacy.javaCharsets``."""
    if encoding and encoding.lower() not in _STANDARD_CHARSETS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


# One dialect for every reader and writer (SNK-1/2), that of pandas and of
# Postgres COPY: quotes inside a quoted field are doubled, a backslash is an
# ordinary character, blanks around a value belong to it.
CSV_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
RECORD = "_record"


def _reader(spark: SparkSession, schema, header: bool, encoding: str | None,
            multiline: bool = False, rejects: bool = False):
    """A reader that fails on a row with too many or too few fields, or, with
    ``rejects``, keeps such a row's text in ``_record``.  All columns are
    parsed, whatever the query needs, so that no bad row goes unseen."""
    if rejects:
        schema = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    r = (spark.read.schema(schema).options(**CSV_DIALECT).option("header", header)
         .option("mode", "PERMISSIVE" if rejects else "FAILFAST")
         .option("columnNameOfCorruptRecord", RECORD)
         .option("columnPruning", "false").option("multiLine", multiline))
    if encoding:
        allow_charset(spark, encoding)
        r = r.option("encoding", encoding)
    return r


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT-7 for a scan made with ``rejects=True``: (rows, bad rows).  A bad
    row has its text in ``_record``, a ``_reason`` and what could be parsed;
    Spark reads the text only together with a parsed column."""
    bad = df.filter(F.col(RECORD).isNotNull()).withColumn("_reason", F.lit("wrong number of fields"))
    return df.filter(F.col(RECORD).isNull()).drop(RECORD), bad


def na_to_null(df: DataFrame, tokens=PANDAS_NA_TOKENS, keep=()) -> DataFrame:
    """Map pandas' missing-value tokens to NULL in text columns, except in
    ``keep`` (key columns: the ticker ``NA`` is a real symbol)."""
    cols = []
    for c, t in df.dtypes:
        if t == "string" and c not in keep:
            cols.append(F.when(~F.col(f"`{c}`").isin(list(tokens)), F.col(f"`{c}`")).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return df.select(*cols)


def file_order(df: DataFrame) -> DataFrame:
    """Add ``_order``: a row's place in the landed files (file, split start,
    position within the split).  Names of one length go by text, shorter ones
    first, so part-99999 comes before part-100000.  "Keep the first row" in a
    file means the smallest ``_order``; it must be taken on the scan, before
    any projection."""
    return df.withColumn("_order", F.struct(
        F.length("_metadata.file_path").alias("len"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("pos")))


def scan_csv(spark: SparkSession, path, names, *, encoding: str | None = None,
             na_values=PANDAS_NA_TOKENS, keep_text=(), with_order: bool = False,
             multiline: bool = False, rejects: bool = False) -> DataFrame:
    """SRC-1: CSV whose first line holds the names, as strings.  A header that
    does not hold exactly ``names`` in their order fails the read, as does a
    row with another number of fields (``rejects``: see ``split_rejects``).
    ``multiline`` is for text that may hold line breaks (names, addresses,
    descriptions); such files are not split, so leave it off for bars.  A
    UTF-8 byte-order mark is dropped by Spark."""
    df = (_reader(spark, strings(names), True, encoding, multiline, rejects)
          .option("enforceSchema", "false").csv(path))
    if with_order:
        df = file_order(df)
    return na_to_null(df, na_values, [*keep_text, RECORD]) if na_values else df


def scan_csv_positional(spark: SparkSession, path, names, *, skip_first_line: bool = False,
                        encoding: str | None = None, with_order: bool = False,
                        multiline: bool = False, rejects: bool = False) -> DataFrame:
    """SRC-2: header-less CSV bound by position (``COPY ... CSV``); with
    ``skip_first_line`` the first line of each file is skipped unread (``COPY
    FROM stdin`` after a header).  Rows with another number of fields fail the
    read, as they fail COPY (``rejects``: see ``split_rejects``)."""
    df = _reader(spark, strings(names), skip_first_line, encoding, multiline, rejects).csv(path)
    return file_order(df) if with_order else df


def scan_symbol_files(spark: SparkSession, path, names, pattern: str,
                      key: str = "symbol", header: bool = True,
                      unescape: bool = True) -> DataFrame:
    """SRC-3 (+ PRJ-5 for file sets): a file set with one file (or folder) per
    symbol, the symbol encoded in the path; ``pattern`` has one group
    capturing it.  Folder names escape characters such as ``/`` and ``=`` as
    ``%XX``; ``unescape`` turns them back (a literal ``+`` stays ``+``)."""
    with listing(spark):
        df = (_reader(spark, strings(names), header, None)
              .option("recursiveFileLookup", True).csv(path))
    raw = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    if unescape:
        # the metadata path is a URI (first decode gives the folder name), and
        # the folder name escapes special characters (second decode)
        for _ in range(2):
            raw = F.url_decode(F.regexp_replace(raw, r"\+", "%2B"))
    return df.withColumn(key, raw)


def scan_json_records(df: DataFrame, col: str, schema: T.StructType,
                      error_key: str = "Error Message") -> tuple[DataFrame, DataFrame]:
    """SRC-5 + SCL-12: parse one flat JSON object per row; objects carrying
    ``error_key`` (a failed API reply) go to the second frame with the
    message, as do records that do not parse or do not fit the types.
    Returns (records, errors); replies are read and parsed once."""
    good, bad = split_tagged(tag_json_records(df, col, schema, error_key), "error_message")
    keep = [F.col(f"`{c}`") for c in df.columns if c != col]
    return good.select(*keep, "_rec.*"), bad.select(*keep, "error_message")


def tag_json_records(df: DataFrame, col: str, schema: T.StructType,
                     error_key: str = "Error Message") -> DataFrame:
    """The other columns of ``df``, ``_rec`` (the parsed fields) and
    ``error_message`` (NULL for a good record)."""
    full = T.StructType(list(schema.fields) + [T.StructField(error_key, T.StringType()),
                                               T.StructField(RECORD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    # a row of its own, so that no later filter or field makes Spark parse again
    parsed = df.select("*", F.explode(F.array(F.from_json(F.col(col), full, options))).alias("_rec"))
    err = F.col(f"_rec.`{error_key}`")
    broken = F.col("_rec").isNull() | F.col(f"_rec.{RECORD}").isNotNull()
    fields = F.struct(*[F.col(f"_rec.`{f.name}`").alias(f.name) for f in schema.fields])
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns if c != col], fields.alias("_rec"),
                         F.when(err.isNotNull(), err).when(broken, F.lit("unparsable record")).alias("error_message"))


def scan_json_files(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """SRC-5 for landed JSON-lines files."""
    return spark.read.schema(schema).json(path)


def scan_table(spark: SparkSession, path_or_name: str, cols=None, fmt: str = "parquet",
               nan_as_null: bool = True) -> DataFrame:
    """SRC-6: a table (catalog name or Parquet path) restricted to ``cols``;
    Catalyst prunes the read schema to them.  NaN in floating columns becomes
    NULL (pandas treats both as missing; Spark's ``ignorenulls`` and sorts
    do not)."""
    if "/" in path_or_name or ":" in path_or_name:
        df = spark.read.format(fmt).load(path_or_name)
    else:
        df = spark.table(path_or_name)
    df = df.select(*cols) if cols else df
    return normalize_nan(df) if nan_as_null else df
