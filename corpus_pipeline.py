"""The corpus pipeline: documents in, training windows out.

Each stage is (name, function of (spark, docs, sf_dir) -> DataFrame); its result
is written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of documents.

1. toxicity: documents that the classifier calls toxic go.
2. line dedup: passages that repeat across documents go from all but the first.
3. near duplicates: one document of each SimHash component stays.
4. benchmark leaks: documents that hold a test item, edited or not, go.
5. packing: what is left fills training windows, each with a seed document and
   its nearest neighbours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.llm.common import stored, table
from bourse.llm.decontaminate import drop_leaks
from bourse.llm.line_dedup import dedup_lines
from bourse.llm.packing import pack
from bourse.llm.simhash import drop_near_duplicates
from bourse.llm.toxicity import fit, score_toxicity


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: a model of this stage's own labelled documents scores them all."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    scored = score_toxicity(docs.select(kept, F.col("text")), model)
    return scored.where(F.col("predicted") == 0).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: texts lose repeated passages; n_chars follows."""
    done = dedup_lines(docs)
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = (F.when(F.col("n_lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
                              .cast(docs.schema["n_chars"].dataType))
    return done.select(*[x.alias(c) for c, x in columns.items()])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the smallest doc_id of each component stays."""
    return drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that leak an item go."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of windows, with their token ids."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", keep_clean),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_copies),
    ("benchmark leaks", drop_benchmark_leaks),
    ("packing", pack_windows),
]

#: No SQL expresses a trained network, SimHash over XXH64 or byte-pair encoding;
#: tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each through a table in the
    shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: each piece's place and a checksum of its ids."""
    return run(spark, sf_dir).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                     "sequence_id", "offset")
