"""SimHash near-duplicates found through Golay-code fuzzy hashing.

1. Each document gets a 64-bit SimHash over word shingles.
2. Equal fingerprints are one class from here on, however many copies there
   are: the search below works on distinct fingerprints only.
3. A fingerprint is cut into three segments of at most 22 bits, each padded to
   a 23-bit word.  The perfect Golay code [23, 12] maps every word to exactly
   one codeword (12-bit index) at distance 3 or less.  A word within one bit of
   the segment may decode elsewhere, so a segment has its own index and up to
   five nearby ones.
4. Pigeonhole: if two fingerprints differ in at most 4 bits, two of the three
   segments together hold at most 2 of them, so a word halfway lies within one
   bit of either.  Keys are (pair of segments, index, index), with at most one
   of the indices a nearby one; two such fingerprints share a key for certain.
5. Fingerprints meet by key; those that share one are compared exactly, and
   each key's links go on as a spanning forest rather than as all pairs.
6. Connected components of the forest, by repeated minimum labels.

Nothing of all documents reaches the driver.  A key with more than
``block_rows`` fingerprints is split: its members are dealt into blocks and
every two blocks meet in a task of their own, so all links are still found.

Defined results.  A null text is an empty one; without words the fingerprint is
0, and such documents are linked like any others.  Ties do not arise: a
component is named by its smallest id.  A null id is a document like any other
and comes after all others; rows that are repeated keep one row each.  Extra
columns play no part.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import row_keyed, slices, stored, stored_small, table

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))      # (first bit, bits)
PAIRS = ((0, 1), (0, 2), (1, 2))
MAX_BITS = 4                                  # what two segments of three cover, see above
BLOCK_ROWS = 2048

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_LAST_ID = 2 ** 63 - 1


# --- fingerprints --------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash: a bit is 1 if set in over half of the shingles' XXH64."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [" ".join(words)]
    else:
        shingles = map(" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s.encode("utf-8", "surrogatepass"), SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 15):
        part = h[at:at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(id: long or null, fp: long) of each row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(fp.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


# --- Golay code ----------------------------------------------------------------

_GENERATOR = 0xC75        # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


def _code_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits, and the error of at most 3 bits that
    belongs to each of the 2,048 remainders."""
    upper = np.array([_remainder(u << 11) for u in range(1 << 12)], dtype=np.int64)
    one = [_remainder(1 << b) for b in range(23)]
    errors = np.zeros(1 << 11, dtype=np.int64)
    for a in range(23):
        errors[one[a]] = 1 << a
        for b in range(a):
            errors[one[a] ^ one[b]] = 1 << a | 1 << b
            for c in range(b):
                errors[one[a] ^ one[b] ^ one[c]] = 1 << a | 1 << b | 1 << c
    return upper, errors


_UPPER, _ERRORS = _code_tables()


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    error = _ERRORS[(words & 0x7FF) ^ _UPPER[words >> 11]]
    return (words ^ error) >> 11


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of each fingerprint (uint64), as (position, key), each once."""
    own, near = [], []
    for first, bits in SEGMENTS:
        word = (fps >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1)
        own.append(decode(word))
        near.append(np.stack([decode(word ^ (1 << b)) for b in range(bits)], axis=1))
    at, keys = [], []
    for p, (a, b) in enumerate(PAIRS):
        found = np.concatenate([(own[a] << 12 | own[b])[:, None],
                                near[a] << 12 | own[b][:, None],
                                own[a][:, None] << 12 | near[b]], axis=1) | p << 24
        found.sort(axis=1)
        new = np.ones(found.shape, dtype=bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        rows, cols = np.nonzero(new)
        at.append(rows)
        keys.append(found[rows, cols])
    return np.concatenate(at), np.concatenate(keys)


# --- links ---------------------------------------------------------------------

def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column("fp").to_numpy(zero_copy_only=False)
        for k in range(0, len(fps), 4096):
            part = fps[k:k + 4096]
            at, keys = keys_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[at])], names=["key", "fp"])


def _settle(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each component, given labels so far and new links."""
    while True:
        new = labels.copy()
        low = np.minimum(labels[a], labels[b])
        for side in (labels[a], labels[b], a, b):
            np.minimum.at(new, side, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, labels):
            return labels
        labels = new


def forest(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows sorted by group: row i with the smallest row of
    its component among the group's links of ``max_bits`` or fewer."""
    n = len(fps)
    labels = np.arange(n)
    active = labels[:-1]
    left, right, waiting, step = [], [], 0, 1
    while len(active):
        active = active[active + step < n]
        active = active[group[active] == group[active + step]]
        if len(active):
            near = np.bitwise_count(fps[active] ^ fps[active + step]) <= max_bits
            hit = active[near]
            left.append(hit)
            right.append(hit + step)
            waiting += len(hit)
            if waiting > 1 << 18:
                labels = _settle(labels, np.concatenate(left), np.concatenate(right))
                left, right, waiting = [], [], 0
        step += 1
    if waiting:
        labels = _settle(labels, np.concatenate(left), np.concatenate(right))
    member = np.flatnonzero(labels != np.arange(n))
    return member, labels[member]


def _linked(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (key, part); a group may span batches, and none
        is larger than a block pair."""
        def links(key, part, fps):
            new = np.ones(len(key), dtype=np.int64)
            new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            member, low = forest(np.cumsum(new), fps.view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(fps[member]), pa.array(fps[low])], names=["a", "b"])

        held = None
        for b in batches:
            rows = [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "part", "fp")]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            key, part, _ = rows
            cut = int(np.searchsorted(key == key[-1], True)) if len(key) else 0
            cut += int(np.searchsorted(part[cut:], part[-1])) if len(key) else 0
            if cut:
                yield links(*(x[:cut] for x in rows))
            held = [x[cut:] for x in rows]
        if held is not None and len(held[0]):
            yield links(*held)
    return run


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) that connect what links of ``max_bits`` or fewer connect,
    among distinct fingerprints (fp)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys cover 0 to {MAX_BITS} differing bits")
    keyed = distinct.select("fp").mapInArrow(_keyed, "key long, fp long")
    sizes = keyed.groupBy("key").count().where(F.col("count") > 1)
    large = stored(sizes.where(F.col("count") > block_rows)
                   .select("key", F.ceil(F.col("count") * 2 / block_rows).cast("int").alias("blocks")), "simhash-large")
    if large.isEmpty():
        dealt = keyed.withColumn("part", F.lit(0).cast("long"))
    else:
        # every two blocks of a large key meet: (i, j) with i <= j
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long")
        other = F.col("other").cast("long")
        dealt = (keyed.join(large, "key", "left")
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
                 .withColumn("part", F.coalesce(F.least(own, other) * F.col("blocks") + F.greatest(own, other), F.lit(0)))
                 .select("key", "fp", "part"))
    rows = dealt.repartition("key", "part").sortWithinPartitions("key", "part", "fp")
    return rows.select("key", "part", "fp").mapInArrow(_linked(max_bits), "a long, b long").distinct()


# --- components ----------------------------------------------------------------

def connected_components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for each node of a link.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label.  Rounds go through tables in the shared folder; they
    end when no label becomes smaller, seen by their sum (one row)."""
    both = stored_small(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                        .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "links")

    def total(df):
        return df.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]

    labels = stored_small(both.groupBy("u").agg(F.min("v").alias("low"))
                          .select(F.col("u").alias("node"), F.least("u", "low").alias("label")), "labels")
    was = total(labels)
    while was is not None:
        around = (both.join(labels, F.col("v") == F.col("node"))
                  .groupBy("u").agg(F.min("label").alias("low")))
        hooked = (labels.join(around, F.col("node") == F.col("u"))
                  .select("node", F.least("label", "low").alias("label")))
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("top"))
        labels = stored_small(hooked.join(up, "label").select("node", F.col("top").alias("label")), "labels")
        now = total(labels)
        if now == was:
            break
        was = now
    return labels


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) of each row of ``docs`` (doc_id, text):
    fingerprint and smallest doc_id reachable over links of ``max_bits``."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    last = F.coalesce("id", F.lit(_LAST_ID))
    classes = stored_small(fps.groupBy("fp").agg(F.min(last).alias("first")), "classes")
    labels = connected_components(near_links(classes, max_bits, block_rows))
    named = (classes.join(labels, classes.fp == labels.node, "left")
             .withColumn("label", F.coalesce("label", "fp")).select("fp", "label", "first"))
    named = stored_small(named, "named")
    names = named.groupBy("label").agg(F.min("first").alias("component"))
    of_class = named.join(names, "label").select("fp", "component")
    return (fps.join(of_class, "fp")
            .select(F.col("id").alias("doc_id"), "fp",
                    F.when(F.col("component") != _LAST_ID, F.col("component")).alias("component_id")))


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id,
    rows without one last.  Rows are told apart by a key of their own, so rows
    that share an id, or have none, are linked by their texts alone."""
    rows = row_keyed(docs, "near-copies")
    found = near_duplicates(rows.select(F.col("_key").alias("doc_id"), F.col("row.text").alias("text")), shingle, max_bits)
    stay = (found.select(F.col("doc_id").alias("_key"), "component_id").join(rows.select("_key", "_order"), "_key")
            .groupBy("component_id").agg(F.min("_order").alias("best")).select(F.col("best.key").alias("_key")))
    return rows.join(stay, "_key", "left_semi").select("row.*")


# --- query ---------------------------------------------------------------------

def op9_simhash_golay(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
