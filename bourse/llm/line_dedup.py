"""Removal of multi-line passages that repeat across documents, by
content-defined line chunks.

Lines.  A text is cut into its lines, and a line of several sentences further
after each sentence end (wide forms and closing quotes too), so that a passage pasted into the middle of a line
still has lines of its own.  Lines keep what separates them: joined again they
are the text.  They are compared byte by byte, each without surrounding white
space: a passage indented or wrapped in blank lines elsewhere is the same passage.

Chunks.  A rolling hash over the hashes of ``WINDOW`` lines opens a chunk
wherever it falls into a fixed share of its range: boundaries depend on nearby
lines alone, so text inserted before a passage shifts none of them.  A chunk
runs until it holds ``MIN_LINES`` lines and ``MIN_CHUNK_WORDS`` words, blank lines
not counted, and one line further if no boundary is there.  Words are runs of
other than white space; in scripts without spaces two characters count as one.
A line of ``LONG_LINE`` words or more is a chunk by itself too.

Repeats.  Chunks are counted by hash over all documents.  The copy in the
document with the smallest id stays.  For all others the first copy's lines
are brought along, in blocks of ``BLOCK_LINES`` lines with at least ``MARGIN``
more on either side; the chunk is removed only if the bytes of all its lines
equal those of the first copy, and the removal extends over neighbouring lines as
long as their bytes are equal too.  Every chunk that repeats goes, whatever its
length; ``min_words`` keeps shorter runs on demand.  A chunk that repeats within
one document is compared with its first place there.

Scale.  What is shuffled for all documents is one row of a few numbers for a
chunk; texts move once, to meet their list of repeats.  Counts are pre-
aggregated; a chunk that a third of all documents share is one row on the
small side of a join, whose large side Spark splits.

Defined results.  Null texts stay null, empty ones empty; a document of which
nothing is left keeps its row with an empty text.  Rows that share an id count
as one document: what they share with one another stays.  A row without id is a
document of its own, before all that have one; rows without id that are equal in
all columns count as one.  Extra columns pass through.  An empty table gives an
empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.llm.common import NULL_ID, mix, stored, table

WINDOW = 2
MIN_LINES = 2
MARGIN = 3
#: Lines of a first copy that travel together.
BLOCK_LINES = 16
#: Share of the rolling hash's range that opens a chunk.
OPENS = 0.9
MIN_CHUNK_WORDS = 8
LONG_LINE = 16
#: Of a run that is removed; no more than a chunk has in any case.
MIN_WORDS = MIN_CHUNK_WORDS

_CLOSERS = "\"')\\]”’»"
_WIDE = "。！？｡．"
_CUT = re.compile(rf"[\n.?!{_WIDE}](?:(?<=\n)|(?<=[.?!])[{_CLOSERS}]*[^\S\n]+(?=\S)|(?<=[{_WIDE}])[{_WIDE}」』）】》”’]*[^\S\n]*(?=\S))")
#: Scripts that put no spaces between words: Thai to Lao, Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d"
                       "\U00020000-\U0003ffff]")
_ROLL = np.uint64(0x9E3779B97F4A7C15)
_UNROLL = np.uint64(pow(int(_ROLL), -1, 1 << 64))
_LIMIT = np.uint64(int(OPENS * (1 << 64)))


def lines_of(text: str) -> list[str]:
    """The lines of a text, each with what separates it from the next."""
    ends = [m.end() for m in _CUT.finditer(text)]
    out = [text[a:b] for a, b in zip([0, *ends], ends)]
    last = text[ends[-1]:] if ends else text
    return [*out, last] if last else out


def chunks_of(hashes: np.ndarray, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line, number of lines and hash (a signed long) of each chunk;
    lines of one text after another, ``ends`` where each line's text ends."""
    whole = np.flatnonzero(words)                 # blank lines neither open nor close a chunk
    n = len(whole)
    line = np.arange(n)
    last = np.searchsorted(whole, ends[whole])
    padded = np.concatenate([hashes[whole], np.zeros(WINDOW, dtype=np.uint64)])
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        rolled = rolled * _ROLL + padded[k:k + n]
    opens = np.zeros(n + 1, dtype=bool)
    opens[:n] = (((rolled ^ rolled >> np.uint64(32)) * _ROLL) < _LIMIT) & (line + WINDOW <= last)
    at = np.flatnonzero(opens[:n])
    total = np.concatenate([[0], np.cumsum(words[whole])])
    stop = np.maximum(at + MIN_LINES, np.searchsorted(total, total[at] + MIN_CHUNK_WORDS))
    fits = stop <= last[at]
    at, stop = at[fits], stop[fits]
    stop += (stop < last[at]) & ~opens[stop]
    at, stop = whole[at], whole[stop - 1] + 1
    long = np.flatnonzero(words >= LONG_LINE)
    at, stop = np.concatenate([at, long]), np.concatenate([stop, long + 1])
    order = np.argsort(at, kind="stable")
    at, size = at[order], (stop - at)[order]
    # sums of hashes times powers, moved to the chunk's first line
    power, back = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(hashes), x)])) for x in (_ROLL, _UNROLL))
    summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:-1], dtype=np.uint64)])
    h = mix((summed[at + size] - summed[at]) * back[at] + size.astype(np.uint64))
    return at, size, h.view(np.int64)


def _keys(lines: list[str]) -> list[str]:
    return [x.strip() for x in lines]


def _words(key: str) -> int:
    """Number of words of a line."""
    if key.isascii():
        if key.isprintable() and "  " not in key:
            return key.count(" ") + (key != "")
        return len(key.split())
    rest, unspaced = _UNSPACED.subn(" ", key)
    return len(rest.split()) + (unspaced + 1) // 2


def _measured(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of words of each line."""
    n = len(keys)
    return (np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=n),
            np.fromiter(map(_words, keys), dtype=np.int64, count=n))


def _chunks(keys: list[str]) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Words of each line, and (first line, lines, hash) of each chunk of a text."""
    hashes, words = _measured(keys)
    found = chunks_of(hashes, words, np.full(len(keys), len(keys)))
    return words, list(zip(*(x.tolist() for x in found)))


def chunk_rows(docs: DataFrame) -> DataFrame:
    """(h, id): each chunk's hash once for a row (_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                keys: list[str] = []
                ends = []
                for text in part.column("text").to_pylist():
                    keys.extend(_keys(lines_of(text)))
                    ends.append(len(keys))
                lines = np.diff(ends, prepend=0)
                hashes, words = _measured(keys)
                at, _, h = chunks_of(hashes, words, np.repeat(ends, lines))
                owner = np.repeat(np.arange(len(ends)), lines)[at]
                order = np.lexsort((h, owner))
                owner, h = owner[order], h[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
                ids = part.column("_id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(h[new]), pa.array(ids[owner[new]])], names=["h", "id"])

    return docs.mapInArrow(run, "h long, id long")


def _span(keys: list[str], at: int, size: int, other: list[str], there: int) -> tuple[int, int] | None:
    """The equal run of lines around a chunk at ``at`` here and ``there`` in
    the other text; None if the chunk's own text differs."""
    if keys[at:at + size] != other[there:there + size]:
        return None
    a, b = at, there
    while a and b and keys[a - 1] == other[b - 1]:
        a, b = a - 1, b - 1
    e, f = at + size, there + size
    while e < len(keys) and f < len(other) and keys[e] == other[f]:
        e, f = e + 1, f + 1
    return a, e


def clean_text(text: str, originals: dict[int, list[tuple[list[str], int]]], min_words: int) -> tuple[str, int, int]:
    """The text without repeats of ``originals`` (by chunk hash: lines around
    the first copy, place of the chunk there) and of itself; removed lines and
    words."""
    lines = lines_of(text)
    keys = _keys(lines)
    if not originals and len(set(keys)) == len(keys):
        return text, 0, 0
    words, chunks = _chunks(keys)
    gone = bytearray(len(lines))
    first = {}
    for at, size, h in chunks:
        span = None
        for around, there in originals.get(h, ()):
            span = span or _span(keys, at, size, around, there)
        if span is None and h in first and first[h] + size <= at:
            # within the document only the chunk itself, which must not touch its original
            start = first[h]
            if keys[at:at + size] == keys[start:start + size]:
                span = (at, at + size)
        first.setdefault(h, at)
        if span is not None:
            gone[span[0]:span[1]] = b"\1" * (span[1] - span[0])
    kept, out_lines, out_words, i = [], 0, 0, 0
    while i < len(lines):
        j = i
        while j < len(lines) and gone[j] == gone[i]:
            j += 1
        n = int(words[i:j].sum())
        if gone[i] and n >= min_words:
            out_lines, out_words = out_lines + j - i, out_words + n
        else:
            kept.extend(lines[i:j])
        i = j
    return "".join(kept), out_lines, out_words


def document_key(docs: DataFrame) -> Column:
    """doc_id, or for a row without one a number below all ids, by its content."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    own = F.lit(NULL_ID) + F.xxhash64(*plain).bitwiseAND(F.lit(2 ** 62 - 1))
    return F.coalesce(F.col("doc_id").cast("long"), own)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeats removed from text, and the
    columns n_lines_removed and n_words_removed (in place of any so called)."""
    added = ("n_lines_removed", "n_words_removed")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    rows = docs.select(document_key(docs).alias("_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    chunks = stored(chunk_rows(rows.select("_id", F.coalesce("row.text", F.lit("")).alias("text"))), "line-chunks")
    repeated = stored(chunks.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
                      .where(F.col("n") > 1).select("h", "first"), "repeated-chunks")

    # the first copies' lines, in blocks, with the repeated chunks they hold
    wanted = repeated.groupBy(F.col("first").alias("_id")).agg(F.collect_list("h").alias("_wanted"))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                cols: list[list] = [[] for _ in range(5)]
                for i, text, wants in zip(part.column("_id").to_pylist(), part.column("row").field("text").to_pylist(),
                                          part.column("_wanted").to_pylist()):
                    if not wants:
                        continue
                    keys = _keys(lines_of(text or ""))
                    todo, own = set(wants), {}
                    stops: dict[int, int] = {}
                    for at, size, x in _chunks(keys)[1]:
                        if x in todo:
                            todo.discard(x)
                            block = at // BLOCK_LINES
                            own.setdefault(block, []).append((x, at))
                            stops[block] = max(at + size, stops.get(block, (block + 1) * BLOCK_LINES + MARGIN))
                    doc = xxhash.xxh64_intdigest(text or "") - (1 << 63)
                    for block, found_here in own.items():
                        lo = max(0, block * BLOCK_LINES - MARGIN)
                        near = keys[lo:stops[block] + MARGIN]
                        for col, x in zip(cols, (i, doc, block, "\n".join(near),
                                                 [{"h": h, "at": at - lo} for h, at in found_here])):
                            col.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.string(),
                                                           pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())]))))],
                    names=["id", "doc", "block", "near", "own"])

    place = ["id", "doc", "block"]
    blocks = stored(rows.join(wanted, "_id", "left").mapInArrow(
        around, "id long, doc long, block int, near string, own array<struct<h: long, at: int>>").dropDuplicates(place), "first-copies")
    # repeated rows bring their chunks and blocks once each
    copies = (chunks.withColumnRenamed("id", "copy").join(repeated, "h").where(F.col("copy") != F.col("first"))
              .select("h", "copy").distinct())
    hits = (copies.join(blocks.select(*place, F.inline("own")), "h")
            .groupBy("copy", *place).agg(F.collect_list(F.struct("h", "at")).alias("own")))
    found = (hits.join(blocks.select(*place, "near"), place).groupBy(F.col("copy").alias("_id"))
             .agg(F.collect_list(F.struct("near", "own")).alias("_found")))

    names = [*docs.columns, *added]
    text_at = names.index("text")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                fields = part.column("row").flatten()
                texts, counts = [], ([], [])
                for text, hits in zip(fields[text_at].to_pylist(), part.column("_found").to_pylist()):
                    near: dict[int, list] = {}
                    for x in hits or ():
                        around_it = x["near"].split("\n")
                        for c in x["own"]:
                            near.setdefault(c["h"], []).append((around_it, c["at"]))
                    new, *n = clean_text(text, near, min_words) if text else (text, 0, 0)
                    texts.append(new)
                    for to, x in zip(counts, n):
                        to.append(x)
                fields[text_at] = pa.array(texts, fields[text_at].type)
                yield pa.RecordBatch.from_arrays([*fields, *(pa.array(x, pa.int64()) for x in counts)],
                                                 names=names)

    schema = T.StructType([*docs.schema, *(T.StructField(c, T.LongType()) for c in added)])
    return rows.join(found, "_id", "left").mapInArrow(remove, schema)


# --- query ---------------------------------------------------------------------

def op6_line_chunks(spark, sf_dir: str) -> DataFrame:
    """Each document with what was removed from it and what is left."""
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines_removed", "n_words_removed", "text")
