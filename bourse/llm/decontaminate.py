"""Benchmark leaks: rare n-gram seeds join passages to test items, and a
Smith-Waterman alignment of words scores the copy, edited or not.

1. Words are lower-cased runs of letters and digits; an item's seeds are the
   rarer ``RARE_SHARE`` of its n-grams (``SEED_WORDS`` words) that occur at all,
   by the number of documents that hold them, counted over the whole corpus.
   Ranks are relative to the item: a passage that a third of all documents
   contain still has its seeds.
2. Seeds found in a document vote for (item, diagonal): where the passage
   would begin.  Votes that lie within ``BAND`` words of one another make one
   passage; it needs ``MIN_SEEDS`` of them (or all seeds the item has).
3. Each passage, with ``BAND`` words on either side, is aligned with its item:
   match 1, mismatch and gap -0.5 a word, over the item's length.  A score of
   ``MIN_SCORE`` or more is a leak.

Items that hold fewer words than a seed are sought as they are.

Scale.  The benchmark is taken in blocks of about ``BLOCK_WORDS`` words, a
bound that is kept by dealing items out by their running number of words, so
what a task holds of it is bounded; the corpus is read once per block for
counts and once for alignment, and never shuffled.  What moves are counts of
seeds, pre-aggregated in each task to at most the block's n-grams.  An item
longer than a block makes a block of its own.

Defined results.  Null and empty texts leak nothing, nor do null and empty
items.  Equal scores give the first place in the document.  Rows that are
repeated give repeated rows; a null id gives null.  Extra columns play no part.
An empty corpus or benchmark gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import mix, row_keyed, stored, table, word_hashes

SEED_WORDS = 3
RARE_SHARE = 0.75
MIN_SEEDS = 2
BAND = 12
MIN_SCORE = 0.5
GAP = 0.5
BLOCK_WORDS = 1 << 20

_STEP = np.uint64(0x9FB21C651E98DF25)
_FILTER_BITS = 20


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.full(n, np.uint64(size))
    for k in range(size):
        h = h * _STEP + words[k:k + n]
    return mix(h)


class Lookup:
    """Sorted hashes with a bit table in front that most others miss."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.bits[self.sorted >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known hashes, and their index in ``sorted``."""
        at = np.flatnonzero(self.bits[hashes >> np.uint64(64 - _FILTER_BITS)])
        if not len(at) or not len(self.sorted):
            return at[:0], at[:0]
        index = np.minimum(np.searchsorted(self.sorted, hashes[at]), len(self.sorted) - 1)
        known = self.sorted[index] == hashes[at]
        return at[known], index[known]


def _gram_size(words: np.ndarray) -> int:
    return min(SEED_WORDS, len(words))


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 256):
    for b in batches:
        for k in range(0, b.num_rows, rows):
            part = b.slice(k, rows)
            ids = part.column("id").to_pylist()
            words, owner = word_hashes([t or "" for t in part.column("text").to_pylist()])
            yield ids, words, owner


def gram_counts(docs: DataFrame, items: list[np.ndarray]) -> DataFrame:
    """(gram, n): documents of ``docs`` (id, text) that hold each n-gram of the items."""
    sizes = sorted({_gram_size(w) for w in items})
    known = Lookup(np.concatenate([grams(w, _gram_size(w)) for w in items]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(known.sorted), dtype=np.int64)
        for _, words, owner in _texts(batches):
            for size in sizes:
                at, index = known.find(grams(words, size))
                inside = owner[at] == owner[at + size - 1]
                pairs = np.unique(owner[at[inside]] * len(counts) + index[inside])
                np.add.at(counts, pairs % len(counts), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(known.sorted[some].view(np.int64)), pa.array(counts[some])],
                                         names=["gram", "n"])

    return docs.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def seeds_of(items: list[np.ndarray], counts: dict[int, int], rare_share: float = RARE_SHARE):
    """Seed hash, item and place of each seed; sorted by hash."""
    hashes, owner, place = [], [], []
    for i, words in enumerate(items):
        g = grams(words, _gram_size(words))
        n = np.array([counts.get(x, 0) for x in g.view(np.int64).tolist()])
        known = np.sort(n[n > 0])
        limit = known[int(np.ceil(len(known) * rare_share)) - 1] if len(known) else 0
        rare = np.flatnonzero((n > 0) & (n <= limit))
        hashes.append(g[rare])
        owner.append(np.full(len(rare), i))
        place.append(rare)
    hashes, owner, place = map(np.concatenate, (hashes, owner, place))
    order = np.argsort(hashes, kind="stable")
    return hashes[order], owner[order], place[order]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Best local alignment of two word sequences over the item's length, and
    the index after its last word in the passage."""
    m, n = len(item), len(passage)
    best, end = 0.0, 0
    drift = GAP * np.arange(n + 1)
    row = np.zeros(n + 1)
    for i in range(m):
        new = np.zeros(n + 1)
        new[1:] = np.maximum(row[:-1] + np.where(passage == item[i], 1.0, -0.5), 0)
        new = np.maximum(new, row - GAP)
        row = np.maximum.accumulate(new + drift) - drift      # gaps along the passage
        k = int(row.argmax())
        if row[k] > best:
            best, end = float(row[k]), k
    return best / m, end


def leaks_in(words: np.ndarray, items: list[np.ndarray], item: np.ndarray, diagonal: np.ndarray,
             seeds: np.ndarray, min_score: float) -> list[tuple[int, float, int, int]]:
    """(item, score, first word, word after the last) of the items whose seeds
    were found in a document at the given diagonals; the best place of each.
    ``seeds``: the number of seeds of each item."""
    out: dict[int, tuple[float, int, int]] = {}
    order = np.lexsort((diagonal, item))
    item, diagonal = item[order], diagonal[order]
    breaks = np.flatnonzero((np.diff(item) != 0) | (np.diff(diagonal) > BAND)) + 1
    for lo, hi in zip([0, *breaks], [*breaks, len(item)]):
        i = int(item[lo])
        if hi - lo < min(MIN_SEEDS, seeds[i]):
            continue
        start = max(0, int(diagonal[lo]) - BAND)
        stop = min(len(words), int(diagonal[hi - 1]) + len(items[i]) + BAND)
        score, end = align(items[i], words[start:stop])
        if score >= min_score and (i not in out or score > out[i][0]):
            back, length = align(items[i][::-1], words[start:start + end][::-1])
            out[i] = (score, start + end - length, start + end)
    return [(i, *x) for i, x in sorted(out.items())]


def _blocks(benchmark: DataFrame) -> DataFrame:
    """(item_id, text, block): items dealt by hash into as many blocks as
    ``BLOCK_WORDS`` asks for, at least; one that comes out twice as large is cut."""
    words = F.size(F.split(F.col("text"), r"\s+"))
    items = (benchmark.where(F.col("text").isNotNull() & (F.length("text") > 0))
             .select(F.col("item_id").cast("long").alias("item_id"), "text"))
    w = Window.partitionBy("lot").orderBy(F.xxhash64("text"), "item_id").rowsBetween(Window.unboundedPreceding, 0)
    total = items.agg(F.sum(words)).first()[0] or 0
    lots = max(1, -(-total // BLOCK_WORDS))
    if lots == 1:
        return items.withColumn("block", F.lit(0).cast("long"))
    run = (F.sum(words).over(w) / F.lit(2 * BLOCK_WORDS)).cast("long")
    dealt = items.withColumn("lot", F.pmod(F.xxhash64("item_id", "text"), F.lit(lots)))
    return dealt.withColumn("block", run * lots + F.col("lot")).drop("lot")


def leaks(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): each item a document
    leaks, at its best place; words counted from 0, end exclusive."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, first_word long, end_word long"
    dealt = stored(_blocks(benchmark), "benchmark-blocks")
    out = None
    for (block,) in sorted(dealt.select("block").distinct().collect()):
        found = _leaks_of_block(spark, rows, dealt.where(F.col("block") == block), min_score, schema)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _leaks_of_block(spark, rows: DataFrame, block: DataFrame, min_score: float, schema: str) -> DataFrame | None:
    known = block.select("item_id", "text").distinct().orderBy("item_id", "text").collect()
    words, owner = word_hashes([r["text"] for r in known])
    split = [words[owner == i] for i in range(len(known))]
    ids = [r["item_id"] for r, w in zip(known, split) if len(w)]
    items = [w for w in split if len(w)]
    if not items:
        return None
    counts = {r["gram"]: r["n"] for r in gram_counts(rows, items).collect()}     # at most the block's n-grams
    hashes, of_item, place = seeds_of(items, counts)
    per_item = np.bincount(of_item, minlength=len(items))
    sizes = np.array([_gram_size(w) for w in items])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = {int(s): Lookup(hashes[sizes[of_item] == s]) for s in np.unique(sizes)}
        for doc_ids, words, owner in _texts(batches):
            doc, item, diagonal = [], [], []
            starts = np.searchsorted(owner, np.arange(len(doc_ids) + 1))
            for size, known_seeds in lookup.items():
                at, index = known_seeds.find(grams(words, size))
                inside = owner[at] == owner[at + size - 1]
                at, h = at[inside], known_seeds.sorted[index[inside]]
                # a hash may be a seed of several items, or of one more than once
                lo, hi = np.searchsorted(hashes, h), np.searchsorted(hashes, h, side="right")
                many = hi - lo
                which = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
                at = np.repeat(at, many)
                doc.append(owner[at])
                item.append(of_item[which])
                diagonal.append(at - starts[owner[at]] - place[which])
            doc, item, diagonal = map(np.concatenate, (doc, item, diagonal))
            out = []
            order = np.argsort(doc, kind="stable")
            cuts = np.searchsorted(doc[order], np.arange(len(doc_ids) + 1))
            for d in np.unique(doc):
                own = order[cuts[d]:cuts[d + 1]]
                for i, score, first, end in leaks_in(words[starts[d]:starts[d + 1]], items, item[own], diagonal[own],
                                                     per_item, min_score):
                    out.append((doc_ids[d], ids[i], score, first, end))
            cols = list(zip(*out)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "item_id", "score", "first_word", "end_word"])

    return rows.mapInArrow(run, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows that leak an item, whatever their doc_id."""
    rows = row_keyed(docs, "leak-rows")
    bad = (leaks(rows.select(F.col("_key").alias("doc_id"), F.col("row.text").alias("text")), benchmark, min_score)
           .select(F.col("doc_id").alias("_key")).distinct())
    return rows.join(bad, "_key", "left_anti").select("row.*")


# --- query ---------------------------------------------------------------------

def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
