"""Lexical retrieval packing: training windows filled with a seed document and
its nearest unused neighbours by BM25.

Texts become token ids once, in a table.  Document frequencies and the mean
length are counted over all documents, so a score does not depend on the shard.

Documents are dealt into shards of about ``SHARD_BYTES`` of text by shared rare
terms.  A document's topic is its ``TOPIC`` terms of the greatest BM25 weight that
another document holds too; documents are ordered by these as paths of a prefix
tree, and the order is cut into shards.  First in a path is the term that is most
often a topic where it occurs at all (topics squared over documents).  So documents
about the same thing meet, in whatever part of the corpus they lie.  The order is
Spark's sort by ranges of (path, hash of id and text, row), so a path that a third
of all documents share is cut like any other; a range holds about
``SHARDS_A_RANGE`` shards, which one task takes in turn.  Neighbours whose paths
differ from the first term on may still lie in two shards: a window's neighbours
are the best of its shard, not of the corpus.  ``shard_bytes`` as large as the
corpus makes one index of it, which is the exact way and one task's memory.

What comes to the driver is bounded by the vocabulary: each term's counts.  Ids
travel as 16-bit numbers where the vocabulary fits.

Each shard is one index: a BM25 inverted index over the ids is built, and
windows are filled in turn.  A window's seed is
the rest of the document that the last window cut, or else the next unused one.
When a document ends inside a window, all of the seed's ids that another document
of the shard holds are looked up in the index, and the best unused neighbours follow, the last of them
cut where the window is full.  Where no unused document shares an id with the
seed, the next in order follows.  So all windows but a shard's last are full; the
last is cut into pieces whose lengths are powers of two, which need no padding.

Defined results.  A null text is an empty one: one piece that holds the end mark.
Equal BM25 scores go by order (id, then token ids); a null id comes last.  Repeated
rows are documents each.  Extra columns play no part.  An empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import remove, slices, stored, stored_at, table

WINDOW = 1024
END = 0
SHARD_BYTES = 4 << 20
SHARDS_A_RANGE = 8
#: Ranges of any corpus; beyond this many times the above they grow.
MAX_RANGES = 20_000
#: No cut: every term of a seed takes part.
QUERY_TERMS = None
#: Terms that more than one in this many of a shard's documents hold are kept as rows of a matrix.
DENSE = 4
TOPIC = 8
#: Terms of a path that shards are cut by.
LEVELS = 3
K1, B = 1.2, 0.75
SPECIAL = "<|endoftext|>"

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Encoder:
    """Token ids of texts by a tokenizer file; ``ranks``, the same vocabulary
    as ranks, gives the same ids in a quarter of the time."""

    def __init__(self, tokenizer: str, ranks: str | None):
        self._tokenizer, self._own, self._fast = tokenizer, None, None
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                known = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            # never allowed, so never an id; without any special token tiktoken stops at each character to look for one
            special = {SPECIAL: max(known.values(), default=-1) + 1}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known,
                                           special_tokens=special)

    def _plain(self, text: str) -> list[int]:
        """By the tokenizer file, which is read for the first text that needs it."""
        if self._own is None:
            from tokenizers import Tokenizer
            self._own = Tokenizer.from_file(self._tokenizer)
        return self._own.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if self._fast is None or SPECIAL in text:
            ids = self._plain(text)
        else:
            ids = self._fast.encode_to_numpy(text, disallowed_special=())
        out = np.empty(len(ids) + 1, dtype="<u4")
        out[:-1], out[-1] = ids, END
        return out


def encoder(tokenizer: str, ranks: str | None) -> Encoder:
    """One encoder for each Python worker, whatever number of tasks it runs."""
    kept = sys.modules.setdefault("_packing_encoders", types.ModuleType("_packing_encoders"))
    if (tokenizer, ranks) not in kept.__dict__:
        kept.__dict__[tokenizer, ranks] = Encoder(tokenizer, ranks)
    return kept.__dict__[tokenizer, ranks]


class Corpus(NamedTuple):
    """Counts over all documents: terms in order, how many documents hold
    each, number of documents and mean number of ids."""
    terms: np.ndarray
    frequency: np.ndarray
    n: int
    mean: float

    def idf(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight and document frequency of each term."""
        frequency = self.frequency[np.searchsorted(self.terms, terms)]
        return np.log1p((self.n - frequency + 0.5) / (frequency + 0.5)), frequency

    def weights(self) -> np.ndarray:
        """Weight by term number; 0 for terms that fewer than two documents hold."""
        out = np.zeros(int(self.terms.max(initial=0)) + 1)
        out[self.terms] = np.where(self.frequency > 1, self.idf(self.terms)[0], 0.0)
        return out


def corpus_of(docs: list[np.ndarray]) -> Corpus:
    terms, frequency = np.unique(np.concatenate([np.unique(d[:-1]) for d in docs]), return_counts=True)
    return Corpus(terms, frequency, len(docs), float(np.mean([len(d) - 1 for d in docs])))


def saturated(count: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    """BM25's part for a term's count in a document of that length."""
    return count * (K1 + 1) / (count + K1 * (1 - B + B * length / max(1.0, mean)))


class Index:
    """BM25 inverted index over the token ids of a shard's documents, weighted
    by the counts of the whole corpus, by default the shard alone."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        n = len(docs)
        corpus = corpus or corpus_of(docs)
        owner, term, count = distinct(docs)
        sizes = np.bincount(owner, minlength=n)
        order = np.argsort(term, kind="stable")
        self.terms, first = np.unique(term[order], return_index=True)
        self.bounds = np.append(first, len(term))
        frequency = np.diff(self.bounds)
        idf, _ = corpus.idf(self.terms)
        length = np.array([len(d) - 1 for d in docs], dtype=float)
        weight = saturated(count, length[owner], corpus.mean)
        self.owner = owner[order]
        self.weight = (weight[order] * np.repeat(idf, frequency))
        # frequent terms as rows of weights for each document: DENSE entries a posting at most
        heavy = np.flatnonzero(frequency * DENSE > n)
        self.row = np.full(len(self.terms), -1)
        self.row[heavy] = np.arange(len(heavy))
        self.dense = np.zeros((len(heavy), n), dtype=np.float32)
        row = np.repeat(self.row, frequency)
        self.dense[row[row >= 0], self.owner[row >= 0]] = self.weight[row >= 0]
        # each document's query: its terms that another document holds too
        rank = np.searchsorted(self.terms, term)
        shared = frequency[rank] > 1
        self.queries = []
        at = 0
        for size in sizes:
            self.queries.append(rank[at:at + size][shared[at:at + size]])
            at += size

    def scores(self, doc: int, n: int) -> np.ndarray:
        query = self.queries[doc]
        row = self.row[query]
        light = query[row < 0]
        size = self.bounds[light + 1] - self.bounds[light]
        at = np.repeat(self.bounds[light] - np.cumsum(size) + size, size) + np.arange(size.sum())
        heavy = np.zeros(len(self.dense), dtype=np.float32)
        heavy[row[row >= 0]] = 1
        return np.bincount(self.owner[at], self.weight[at], minlength=n) + heavy @ self.dense


def fill(docs: list[np.ndarray], window: int = WINDOW, corpus: Corpus | None = None) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) over the token ids of one shard."""
    n = len(docs)
    if not n:
        return []
    index = Index(docs, corpus)
    free = np.ones(n, dtype=bool)
    upcoming, left = 0, n
    windows: list[list[tuple[int, int, int]]] = []
    rest: tuple[int, int] | None = None           # (document, start) that the last window cut
    while rest is not None or left:
        room, pieces, ranked, seed = window, [], None, None
        while room:
            if rest is None:
                if not left:
                    break
                chosen = -1
                if seed is not None:
                    if ranked is None:
                        ranked = index.scores(seed, n)
                    found = np.where(free, ranked, 0.0)
                    best = int(found.argmax())
                    chosen = best if found[best] > 0 else -1
                if chosen < 0:
                    while not free[upcoming]:
                        upcoming += 1
                    chosen = upcoming
                free[chosen] = False
                left -= 1
                rest = (chosen, 0)
            doc, start = rest
            seed = doc if seed is None else seed
            length = min(room, len(docs[doc]) - start)
            pieces.append((doc, start, length))
            room -= length
            rest = (doc, start + length) if start + length < len(docs[doc]) else None
        windows.append(pieces)
    windows[-1:] = _powers(windows[-1])
    return windows


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A part-filled window as windows whose lengths are powers of two."""
    left = sum(p[2] for p in pieces)
    out, pieces = [], list(pieces)[::-1]
    while left:
        size = room = 1 << (left.bit_length() - 1)
        own = []
        while room:
            doc, start, length = pieces.pop()
            if length > room:
                pieces.append((doc, start + room, length - room))
                length = room
            own.append((doc, start, length))
            room -= length
        out.append(own)
        left -= size
    return out


# --- dealing -------------------------------------------------------------------

def _arrays(b: pa.RecordBatch, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=kind) for x in b.column("ids").to_pylist()]


def distinct(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, term and count of the terms of each document (end marks apart),
    by one sort of (owner, term) numbers."""
    sizes = [len(d) - 1 for d in docs]
    term = np.concatenate([d[:-1] for d in docs]) if docs else np.empty(0, np.uint32)
    if term.dtype not in (np.uint16, np.uint32):
        term = term.astype(np.uint32)
    wide = np.uint64 if term.dtype.itemsize > 2 or len(docs) > 1 << 16 else np.uint32
    bits = wide(8 * term.dtype.itemsize)
    both = np.sort(np.repeat(np.arange(len(docs), dtype=wide) << bits, sizes) | term)
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, np.int64)
    own = both[first]
    return (own >> bits).astype(np.int64), (own & ((wide(1) << bits) - wide(1))).astype(np.int64), np.diff(np.append(first, len(both)))


class Counts:
    """How many of a task's documents hold each term; -1 stands for the number
    of documents and -2 for that of all ids."""

    def __init__(self):
        self.held, self.docs, self.ids = np.zeros(0, dtype=np.int64), 0, 0

    def add(self, docs: list[np.ndarray]) -> None:
        if docs:
            here = np.bincount(distinct(docs)[1], minlength=len(self.held))
            here[:len(self.held)] += self.held
            self.held, self.docs, self.ids = here, self.docs + len(docs), self.ids + sum(len(d) - 1 for d in docs)

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        term = np.flatnonzero(self.held)
        return np.append(term, [-1, -2]), np.append(self.held[term], [self.docs, self.ids])


def corpus_counts(tokens: DataFrame, kind: str = "<u4") -> Corpus:
    """``Corpus`` of all documents (ids, numbers of ``kind``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for b in slices(batches):
            counts.add(_arrays(b, kind))
        yield pa.RecordBatch.from_arrays([*map(pa.array, counts.columns())], names=["term", "n"])

    return summed(tokens.select("ids").mapInArrow(run, "term long, n long"))


def summed(counts: DataFrame) -> Corpus:
    """``Corpus`` of each task's (term, n): what is shuffled and collected is
    bounded by the vocabulary."""
    got = {r["term"]: r["n"] for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n, ids = got.pop(-1, 0), got.pop(-2, 0)
    terms = np.array(sorted(got), dtype=np.int64)
    return Corpus(terms, np.array([got[t] for t in terms.tolist()], dtype=np.int64), n, ids / max(1, n))


def topics(docs: list[np.ndarray], weights: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """Owner and term of each document's ``TOPIC`` weightiest terms that another
    document holds too."""
    owner, term, count = distinct(docs)
    weight = weights[term] * saturated(count, np.array([len(d) - 1 for d in docs], dtype=float)[owner], mean)
    shared = weight > 0
    owner, term, weight = owner[shared], term[shared], weight[shared]
    # a positive float's bits sort as the float does: heaviest first within each owner
    order = np.argsort(owner.astype(np.uint64) << np.uint64(32) | ~weight.astype(np.float32).view(np.uint32), kind="stable")
    owner, term = owner[order], term[order]
    top = np.arange(len(owner)) - np.searchsorted(owner, np.arange(len(docs)))[owner] < TOPIC
    return owner[top], term[top]


def with_topics(tokens: DataFrame, corpus: Corpus, kind: str) -> DataFrame:
    """``tokens`` with each document's topic."""
    schema = tokens.schema
    weights = corpus.weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            owner, terms = topics(_arrays(b, kind), weights, corpus.mean)
            bounds = np.searchsorted(owner, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(bounds), pa.array(terms))],
                                             names=[*schema.names, "topic"])

    return tokens.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", topic array<long>")


def path_ranks(known: DataFrame, corpus: Corpus) -> np.ndarray:
    """Place of each term in a path: first the term that is most often a topic
    where it occurs at all."""
    listed = {r["term"]: r["count"] for r in known.select(F.explode("topic").alias("term")).groupBy("term").count().collect()}
    often = np.array([listed.get(t, 0) for t in corpus.terms.tolist()], dtype=float) ** 2 / corpus.frequency
    rank = np.zeros(int(corpus.terms.max(initial=0)) + 1, dtype=np.int64)
    rank[corpus.terms[np.lexsort((corpus.terms, -often))]] = np.arange(len(often))
    return rank


def in_path_order(known: DataFrame, rank: np.ndarray, ranges: int) -> DataFrame:
    """``known`` in ranges of path order: by the ranks of the first ``LEVELS``
    terms of a path (documents without a topic last), ``own`` and ``row``."""
    last = len(rank)

    @F.arrow_udf("array<long>")
    def path(topics: pa.Array) -> pa.Array:
        bounds, terms = topics.offsets.to_numpy(), rank[topics.flatten().to_numpy()]
        out = np.full((len(topics), LEVELS), last, dtype=np.int64)
        owner = np.repeat(np.arange(len(topics)), np.diff(bounds))
        order = np.lexsort((terms, owner))
        place = np.arange(len(owner)) - (bounds[owner] - bounds[0])
        first = place < LEVELS
        out[owner[first], place[first]] = terms[order][first]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(topics) + 1, dtype=np.int32) * LEVELS), pa.array(out.reshape(-1)))

    order = [*[F.col("path")[k] for k in range(LEVELS)], F.col("own"), F.col("row")]
    return known.withColumn("path", path("topic")).repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def cut_shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[list[tuple]]:
    """Rows (doc_id, ids, size) in order, as shards of ``shard_bytes`` or more;
    a rest of less than half a shard goes to the last one."""
    whole: list[tuple] = []
    held: list[tuple] = []
    size = 0
    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "ids", "size"))):
            held.append(r)
            size += r[2]
            if whole and 2 * size >= shard_bytes:
                yield whole
                whole = []
            if size >= shard_bytes:
                whole, held, size = held, [], 0
    if whole or held:
        yield whole + held


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, ranks: str | None = None,
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, start, length, doc_tokens,
    sequence_id, offset and the ids themselves (little-endian, 32 bits each).

    ``tokenizer`` is a tokenizer file that every worker can read, by default
    the 50k byte-level one with its ranks; ``ranks`` must then hold the same
    vocabulary, or be left out."""
    if tokenizer is None:
        tokenizer, ranks = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    from tokenizers import Tokenizer
    kind = "<u2" if Tokenizer.from_file(str(tokenizer)).get_vocab_size() <= 1 << 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, counts = encoder(str(tokenizer), None if ranks is None else str(ranks)), Counts()
        for b in slices(batches):
            ids = [enc.ids(t).astype(kind) for t in b.column("text").to_pylist()]
            counts.add(ids)
            none = pa.nulls(b.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array([x.tobytes() for x in ids], pa.binary()), none, none],
                                             names=[*names, "ids", "term", "n"])
        # one more row: what the task counted
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(1, pa.int64()) for _ in names), pa.nulls(1, pa.binary()),
             *(pa.array([x], pa.list_(pa.int64())) for x in counts.columns())], names=[*names, "ids", "term", "n"])

    names = ["doc_id", "own", "row", "size"]
    sized = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("own"), F.monotonically_increasing_id().alias("row"),
                        (F.octet_length("text") + 16).cast("long").alias("size"), "text")
    table_of = "doc_id long, own long, row long, size long, ids binary, term array<long>, n array<long>"
    tokens, encoded = stored_at(sized.mapInArrow(encode, table_of), "packing-tokens", 1)
    corpus = summed(tokens.where(F.col("term").isNotNull()).select(F.inline(F.arrays_zip("term", "n"))))
    tokens = tokens.where(F.col("ids").isNotNull()).select(*names, "ids")
    known = stored(with_topics(tokens, corpus, kind), "packing-topics", 1)
    remove(docs.sparkSession, encoded)      # ``known`` holds all of it; the disk is for the exchange
    total = known.agg(F.sum("size")).first()[0] or 0
    ranges = min(MAX_RANGES, max(1, -(-total // (SHARDS_A_RANGE * shard_bytes))))
    placed = in_path_order(known, path_ranks(known, corpus), ranges).select("doc_id", "ids", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for nth, shard in enumerate(cut_shards(batches, shard_bytes)):
            if nth >= 1 << 11:
                raise ValueError("over 2,048 shards in a range: raise shard_bytes")
            shard.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
            number = (part << 11 | nth) << 32
            ids = [np.frombuffer(r[1], dtype=kind) for r in shard]
            cols: list[list] = [[] for _ in range(7)]
            for k, pieces in enumerate(fill(ids, window, corpus)):
                offset = 0
                for doc, start, length in pieces:
                    for col, x in zip(cols, (shard[doc][0], start, length, len(ids[doc]), number + k, offset,
                                             ids[doc][start:start + length].astype("<u4").tobytes())):
                        col.append(x)
                    offset += length
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:-1]), pa.array(cols[-1], pa.binary())],
                                             names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return placed.mapInArrow(run, SCHEMA)


# --- query ---------------------------------------------------------------------

def op10_bm25_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
