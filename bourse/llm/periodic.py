"""Stretches of words that repeat with a short period, found with a dictionary of
basic factors.

1. Words are the runs of anything but ASCII white space.  Level 0 of the
   dictionary names each word of a text; level k names each factor of 2^k words,
   by sorting the pairs of names of its two halves.  A factor that stands only
   once in its text is dropped, and so is every longer one that begins there: in
   ordinary prose few places are left after three levels.
2. At each level every place knows the next one of the same name.  Where three
   such places follow each other with one difference d of at most twice the
   factor's length, they are an arithmetic progression and propose the period d.
   Nothing is missed: in a run of smallest period q and at least 4 q words take
   the level with q <= 2^k < 2 q.  The run's first q words are not a power of a
   shorter word, so the factors of that length at its start and one and two
   periods on are neighbours in the list of that name; the third ends within 4 q.
   Nor is a period proposed that is not the smallest: a shorter one would divide
   it, and the next place of that name would be nearer.
3. Neighbouring places that propose the same period count as one.  A proposal is
   extended to both sides as far as words d apart are equal, in steps of factors,
   longest first, by the same dictionary.
4. Proposals that end as the same run are one, and runs that are too short go.

A text is the unit of work: texts are never brought together, nothing is
shuffled, and a group of texts of about ``BLOCK_WORDS`` words (or one longer
text) is named in one go with array operations.  Memory is four bytes a word and
level: a text of 10 million words takes about 1 GB.

Defined results.  A null text is an empty one: no words, no runs, an empty
collapsed text.  A null id is kept and plays no part.  Rows that are repeated are
each searched.  Extra columns, whatever their names, are not carried along.  An
empty table gives an empty result.  ``[start, length, period]`` are sorted by
start, then period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.llm.common import table

MIN_WORDS = 6            # of a run
MIN_PERIODS = 4          # that a run must hold; the proof above needs 4
BLOCK_WORDS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"


# --- the dictionary ---------------------------------------------------------------

class Factors:
    """The dictionary of basic factors of several texts, each a list of words.

    ``names[k][i]`` is the name of the factor of 2^k words at place i, equal for
    equal factors of one text, or -1 where it stands once only."""

    def __init__(self, texts: list[list[bytes]]):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        self.start = np.repeat(ends - sizes, sizes)
        self.end = np.repeat(ends, sizes)
        self.n = int(ends[-1]) if len(ends) else 0
        raw = np.empty(self.n, dtype=np.int64)
        base = at = 0
        for words in texts:      # a name belongs to one text
            seen: dict[bytes, int] = {}
            for w in words:
                raw[at] = base + seen.setdefault(w, len(seen))
                at += 1
            base += len(seen)
        self.names: list[np.ndarray] = []
        self.proposals = [np.empty((2, 0), dtype=np.int64)]
        longest = int(sizes.max()) if len(sizes) else 0
        place, key = np.arange(self.n), raw
        k = 0
        while len(place) and (k == 0 or (1 << k) < longest // 2 + 1):
            place, key = self._level(place, key, 1 << k)
            half = 1 << k
            place = place[place + 2 * half <= self.end[place]]
            now = self.names[k]
            left, right = now[place], now[place + half]
            both = (left >= 0) & (right >= 0)
            place = place[both]
            key = left[both].astype(np.int64) * (int(now.max(initial=0)) + 1) + right[both]
            k += 1

    def _level(self, place: np.ndarray, key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Name the factors of ``size`` words at ``place`` by ``key``; note the
        proposals; the places whose factor stands more than once."""
        order = np.argsort(key, kind="stable")
        key, at = key[order], place[order]
        same = key[1:] == key[:-1]
        again = np.zeros(len(key), dtype=bool)
        again[1:] = same
        again[:-1] |= same
        name = np.cumsum(np.concatenate([[0], ~same])) if len(key) else key
        names = np.full(self.n, -1, dtype=np.int32)
        names[at[again]] = name[again]
        self.names.append(names)
        # each place's successor, as a difference
        step = np.zeros(self.n, dtype=np.int64)
        step[at[:-1][same]] = (at[1:] - at[:-1])[same]
        i = np.flatnonzero((step > 0) & (step <= 2 * size))
        i = i[step[i + step[i]] == step[i]]
        d = step[i]
        new = np.ones(len(i), dtype=bool)
        new[1:] = (i[1:] != i[:-1] + 1) | (d[1:] != d[:-1]) | (self.start[i[1:]] != self.start[i[:-1]])
        self.proposals.append(np.stack([i[new], d[new]]))
        kept = np.sort(at[again])
        return kept, names[kept]

    def _equal(self, k: int, a: np.ndarray, b: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Whether the factors of 2^k words at ``a`` and ``b`` are equal, where ``inside``."""
        out = inside.copy()
        x = self.names[k][a[inside]]
        out[inside] = (x >= 0) & (x == self.names[k][b[inside]])
        return out

    def _reach(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` (a < b) on are equal, or, with
        ``back``, how many before them."""
        first, last = self.start[a], self.end[a]
        done = np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            size = 1 << k
            todo = np.arange(len(a))
            while len(todo):
                shift = -done[todo] - size if back else done[todo]
                x, y = a[todo] + shift, b[todo] + shift
                inside = x >= first[todo] if back else y + size <= last[todo]
                todo = todo[self._equal(k, x, y, inside)]
                done[todo] += size
                if k + 1 < len(self.names):     # a longer factor would have been taken
                    break
        return done

    def runs(self) -> np.ndarray:
        """(place, length, period) of all runs, by place and period."""
        i, d = np.concatenate(self.proposals, axis=1)
        ahead = self._reach(i, i + d, back=False)
        behind = self._reach(i, i + d, back=True)
        found = np.stack([i - behind, d, behind + ahead + d], axis=1)
        found = found[found[:, 2] >= np.maximum(MIN_WORDS, MIN_PERIODS * found[:, 1])]
        found = np.unique(found, axis=0)
        return found[:, [0, 2, 1]]


def _collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined, without those that any run holds after its first period."""
    if len(runs):
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _searched(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
    found = Factors(texts).runs()
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    cuts = np.searchsorted(found[:, 0], starts)
    found[:, 0] -= np.repeat(starts[:-1], np.diff(cuts))
    values = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in range(3)], fields=list(_RUN))
    runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)
    left = [_collapse(t, found[a:b]) for t, a, b in zip(texts, cuts, cuts[1:])]
    return pa.RecordBatch.from_arrays([ids, runs, pa.array(left, pa.binary())], names=["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs: array of (start, length, period), collapsed: string) of
    each row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            begin = size = 0
            texts: list[list[bytes]] = []
            for at, raw in enumerate(b.column("text")):
                words = (raw.as_py() or b"").split()
                if texts and size + len(words) > BLOCK_WORDS:
                    yield _searched(b.column("doc_id").slice(begin, len(texts)), texts)
                    begin, size, texts = at, 0, []
                texts.append(words)
                size += len(words)
            if texts:
                yield _searched(b.column("doc_id").slice(begin, len(texts)), texts)

    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    return out.select("doc_id", "runs", F.col("collapsed").cast("string").alias("collapsed"))


# --- the query ---------------------------------------------------------------------

def planted(doc_id: Column, text: Column) -> Column:
    """``text`` with the tail that the contract plants: of a document whose
    h = crc32(id) is divisible by 10, each word i >= a becomes word a + (i - a) % p,
    where g = h div 10, a = g % n, p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("bigint")

    def made(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("bigint")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")

    # a variable, so that a text is cut once and not once a word
    bound = F.get(F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), made), F.lit(0))
    return F.when((h % 10 == 0) & text.rlike(WORD), bound).otherwise(text)


def op13_basic_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of every document, the one of greatest exponent, and digests of
    the runs and of the collapsed text."""
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda top, r: F.when(
        r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
