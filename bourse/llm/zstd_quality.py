"""Quality by compression: a text is good if a dictionary made from good texts
compresses it better than one made from bad texts.

Two zstandard dictionaries are trained on labelled documents, one a class.
Each text is compressed whole, in pieces of ``PIECE_BYTES`` (a dictionary works
at the start of a frame, so pieces let it work on all of a long text), once with
either dictionary.  The difference of the two sizes over the text's size is the
one feature; isotonic calibration on labelled documents that trained no
dictionary turns it into a probability of label 1, at the classes' true shares.

Fitting takes at most ``PER_CLASS`` labelled documents of either class, outside
fold 0 and of at most ``FIT_CHARS`` characters; scoring takes every text whole.

Defined results.  Null and empty texts have the difference 0 and its score.
Without labels of both classes every score is the share of label 1 (one half
without any).  Repeated rows are scored alike; extra columns pass through, and
score and predicted replace columns of these names.  An empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.llm.common import fold, label_sample, table

PER_CLASS = 1500
FIT_CHARS = 200_000
DICTIONARY_BYTES = 112 << 10
PIECE_BYTES = 2048
TEXT_PIECES = 8
LEVEL = 3
THRESHOLD = 0.3


def pieces(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[i:i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; too few texts to train on are one as they are.
    Of a long text it takes ``TEXT_PIECES`` evenly spread pieces, so that no
    text rules the dictionary."""
    samples = []
    for t in texts:
        own = [p for p in pieces(t) if len(p) >= 8]
        spread = sorted({i * len(own) // TEXT_PIECES for i in range(TEXT_PIECES)}) if len(own) > TEXT_PIECES else range(len(own))
        samples.extend(own[i] for i in spread)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


class Compressor:
    """Sizes of texts compressed with one dictionary."""

    def __init__(self, data: bytes):
        kind = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        if data:
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=LEVEL)
            kind["dict_data"] = known
        self._own = zstandard.ZstdCompressor(level=LEVEL, **kind)

    def size(self, parts: list[bytes]) -> int:
        return sum(len(self._own.compress(p)) for p in parts)


def difference(text: str | None, good: Compressor, bad: Compressor) -> float:
    parts = pieces(text or "")
    if not parts:
        return 0.0
    return (bad.size(parts) - good.size(parts)) / sum(map(len, parts))


@dataclass
class Model:
    good: bytes
    bad: bytes
    at: np.ndarray          # differences, ascending
    share: np.ndarray       # probability of label 1 there; in between, by interpolation

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.at, self.share)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Monotone calibration by pooling adjacent violators: the mean difference
    and the smoothed share of label 1 of each pool."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []           # [weight, weighted y, weighted x]
    for k in order:
        pools.append([weight[k], weight[k] * y[k], weight[k] * x[k]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    total, ones, mean = np.array(pools).T
    one = weight.sum() / len(weight)        # what a row counts for on average
    share = np.maximum.accumulate((ones + one * 0.5) / (total + one))
    at = mean / total
    # beyond the outermost pools the score goes on towards 0 and 1
    wide = max(float(np.ptp(x)), 1e-6)
    return (np.concatenate([[at[0] - wide], at, [at[-1] + wide]]),
            np.concatenate([[share[0] / 2], share, [(1 + share[-1]) / 2]]))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    sample = (label_sample(docs, labels, "quality", per_class)
              .where(F.length("text") <= FIT_CHARS).orderBy("doc_id").collect())
    shares = {r["y"]: r["n"] for r in
              labels.where(F.col("quality").isin(0, 1) & (fold() != 0))
              .groupBy(F.col("quality").cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    sampled = {y: sum(r["y"] == y for r in sample) for y in (0, 1)}
    if not all(sampled.values()):
        p = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)
        return Model(b"", b"", np.zeros(1), np.array([p]))
    # three parts make the dictionaries, the fourth calibrates (all, if a class has none in it)
    made = {y: dictionary([r["text"] for r in sample if r["y"] == y and r["part"] != 3]) for y in (0, 1)}
    good, bad = Compressor(made[1]), Compressor(made[0])
    held = [r for r in sample if r["part"] == 3]
    if {r["y"] for r in held} != {0, 1}:
        held = sample
    x = np.array([difference(r["text"], good, bad) for r in held])
    y = np.array([r["y"] for r in held], dtype=float)
    weight = np.array([shares[r["y"]] / sampled[r["y"]] for r in held])
    return Model(made[1], made[0], *isotonic(x, y, weight))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, ...) with score and predicted."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = Compressor(model.good), Compressor(model.bad)
        for b in batches:
            x = np.array([difference(t, good, bad) for t in b.column("text").to_pylist()], dtype=float)
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)


# --- query ---------------------------------------------------------------------

def op3_zstd_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return (score_quality(docs, model)
            .select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted"))
