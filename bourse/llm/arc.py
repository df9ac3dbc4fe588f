"""Legacy web archives (ARC, versions 1 and 2) turned into WARC 1.1.

An ARC volume opens with a ``filedesc://`` record whose block names the version
and the fields of a record's header line: five in version 1, ten in version 2.
Each record is its header line, as many bytes as the line's last field declares,
and a line break; nothing else tells where a record ends.

1. ``write_arc`` lays pages down as ARC volumes of a bounded size, versions by
   turns: what an old crawler would have left.
2. ``records`` reads volumes: header lines by their version, blocks by their
   declared length, the payload after the HTTP header, its SHA-256.
3. ``convert`` writes WARC volumes.  A record's identifier is a UUID of the ARC
   volume's name and the record's number there, so a second conversion gives the
   same; its date is the ARC date in ISO 8601; its type is ``response`` for an
   HTTP reply, ``resource`` for anything else, ``warcinfo`` for a ``filedesc``,
   and ``revisit`` for a payload of at least 100 bytes that another record has
   as well: the one with the smallest page_id stays, others refer to it and keep
   the HTTP header alone.
4. ``read_warc`` reads WARC volumes back and recomputes all digests; one that
   does not match fails the job.

Only digests meet to find repeats (an aggregation); payloads are shuffled once,
compressed, to learn whether they are repeats.  A payload that a third of all
pages share is one row of at most 1,000 that are broadcast, and its pages stay
dealt out.  A task holds one volume and the batch of records in hand.  Volumes
are written through Spark's text writer (one row a volume, one volume a file),
so a lost executor leaves no half-written file; they are gzipped as a whole.

Defined results.  Null html is an empty payload; a null or empty url is written
as ``-`` and read as null; white space and controls in a url are percent-encoded.
A null page_id is written without one and comes after all others; rows that share
a page_id, or are repeated, are a record each, the first of equal page_ids (by
volume and place) being the response.  A record that ends before its declared
length is marked ``WARC-Truncated``; a header line that does not fit its version
fails the job, as nothing after it could be framed.  Extra columns are not
carried along.  An empty table gives no records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.llm.common import hot_join, stored, table
from bourse.session import scratch_path

VOLUME_BYTES = 16 << 20
MIN_REVISIT = 100
CRAWL_DATE = "20000101000000"      # of pages, which have none

# Fields of the header line by version, as the formats name them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    pass


# --- ARC volumes -------------------------------------------------------------------

def _arc_line(version: int, uri: bytes, mime: bytes, length: int, date: str, offset: int, name: str) -> bytes:
    head = [uri, b"0.0.0.0", date.encode(), mime]
    if version == 2:
        head += [b"200", b"-", b"-", b"%d" % offset, name.encode()]
    return b" ".join([*head, b"%d" % length]) + b"\n"


def _arc_uri(url: str | None) -> bytes:
    raw = (url or "-").encode("utf-8", "surrogatepass")
    return re.sub(rb"[\x00-\x20\x7F]", lambda m: b"%%%02X" % m[0][0], raw)


def _arc_start(version: int, name: str, date: str) -> bytes:
    block = f"{version} 0 bourse\n{ARC_FIELDS[version]}\n\n".encode()
    return _arc_line(version, f"filedesc://{name}".encode(), b"text/plain", len(block), date, 0, name) + block


def http_reply(page_id: int | None, payload: bytes) -> bytes:
    name = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
    return (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + name
            + b"Content-Length: %d\r\n\r\n" % len(payload) + payload)


def write_arc(pages: DataFrame, path: str, versions: tuple[int, ...] = (1, 2), date: str = CRAWL_DATE,
              volume_bytes: int = VOLUME_BYTES) -> str:
    """``pages`` (page_id, url, html) as ARC volumes under ``path``; each input
    partition writes its volumes in one of ``versions``."""
    crawl = uuid.uuid4().hex[:12]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version = versions[part % len(versions)]
        out, size, number, name = [], 0, 0, ""
        for b in batches:
            for page_id, url, html in zip(*(b.column(c) for c in ("page_id", "url", "html"))):
                if not out:
                    name = f"crawl-{crawl}-{part:06d}-{number:06d}.arc"
                    out = [_arc_start(version, name, date)]
                    size = len(out[0])
                block = http_reply(page_id.as_py(), html.as_py() or b"")
                line = _arc_line(version, _arc_uri(url.as_py()), b"text/html", len(block), date, size, name)
                out += [line, block, b"\n"]
                size += len(line) + len(block) + 1
                if size >= volume_bytes:
                    yield _volume(out[:-1])
                    out, number = [], number + 1
        if out:
            yield _volume(out[:-1])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").cast("binary").alias("html"))
    _write_volumes(rows.mapInArrow(run, "value binary"), path, "\n")
    return path


def _volume(parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["value"])


def _write_volumes(volumes: DataFrame, path: str, end: str) -> None:
    """A file for each row; ``end`` closes it."""
    (volumes.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", end)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def _opened(raw: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)


def _arc_header(line: bytes, version: int, where: str) -> tuple[bytes, bytes, str, str, int]:
    """(uri, ip, ISO date, mime type, length) of a header line.  The url comes
    first and may hold blanks, so fields are counted from the end."""
    parts = line.rstrip(b"\r\n").rsplit(b" ", ARC_FIELDS[version].count(" "))
    try:
        uri, ip, date, mime = parts[:4]
        when = datetime.strptime(date.decode(), "%Y%m%d%H%M%S")
        if len(parts) != ARC_FIELDS[version].count(" ") + 1 or not parts[-1].isdigit():
            raise ValueError
        return uri, ip, when.isoformat() + "Z", mime.decode(), int(parts[-1])
    except ValueError:
        raise ArchiveError(f"no version {version} header line at {where}: {line[:200]!r}") from None


def parse_arc(raw: bytes) -> Iterator[dict]:
    """The records of one ARC volume, its ``filedesc`` first."""
    f = _opened(raw)
    version, name, number = 0, "", 0
    while line := f.readline():
        if not line.strip():      # the break between records
            continue
        where = f"{name or 'the start'}, record {number}"
        if not version:
            if not line.startswith(b"filedesc://"):
                raise ArchiveError(f"not an ARC volume: {line[:200]!r}")
            version = 1 if len(line.split()) == 5 else 2
        uri, ip, date, mime, length = _arc_header(line, version, where)
        block = f.read(length)
        rec = {"number": number, "uri": uri, "ip": ip, "date": date, "mime": mime, "head": b"", "payload": block,
               "truncated": len(block) < length, "kind": "resource"}
        if not number:
            name = uri.removeprefix(b"filedesc://").decode("utf-8", "replace")
            told = block.split(b" ", 1)[0]
            if told != b"%d" % version:
                raise ArchiveError(f"{name}: header line of version {version}, block of version {told!r}")
            rec |= {"kind": "warcinfo", "payload": f"software: bourse\r\nformat: WARC File Format 1.1\r\n"
                                                   f"arc-name: {name}\r\narc-version: {version}\r\n".encode()}
        elif block.startswith(b"HTTP/") and (end := re.search(rb"\r?\n\r?\n", block)):
            rec |= {"kind": "response", "head": block[:end.end()], "payload": block[end.end():]}
        yield rec | {"volume": name}
        number += 1


_PAGE_ID = re.compile(rb"^X-Page-Id: (-?\d+)\r?$", re.M)


def _page_id(head: bytes) -> int | None:
    found = _PAGE_ID.search(head)
    return int(found[1]) if found else None


_META = {"volume": pa.string(), "number": pa.int64(), "kind": pa.string(), "uri": pa.binary(), "date": pa.string(),
         "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string()}
_BLOCK = {"ip": pa.binary(), "mime": pa.string(), "truncated": pa.bool_(), "head": pa.binary(), "payload": pa.binary()}
_DDL = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary", pa.bool_(): "boolean"}
_STEP = 4 << 20


def _ddl(fields: dict) -> str:
    return ", ".join(f"`{k}` {_DDL[t]}" for k, t in fields.items())


def _batch(rows: list[dict], fields: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in fields.items()], names=list(fields))


def _steps(rows: Iterator[dict], fields: dict) -> Iterator[pa.RecordBatch]:
    """``rows`` in batches of about ``_STEP`` bytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 500 + len(r.get("payload") or b"")
        if size >= _STEP:
            yield _batch(held, fields)
            held, size = [], 0
    if held:
        yield _batch(held, fields)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def records(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The records of the ARC volumes under ``path``: where they stand, their
    header line's values, payload size and digest; with ``blocks`` also the HTTP
    header and the payload, compressed by zstandard."""
    fields = _META | (_BLOCK if blocks else {})

    def parsed(raw: bytes, pack) -> Iterator[dict]:
        for r in parse_arc(raw):
            r |= {"page_id": _page_id(r["head"]), "payload_bytes": len(r["payload"]),
                  "payload_digest": hashlib.sha256(r["payload"]).hexdigest()}
            yield r | {"payload": pack(r["payload"]) if blocks else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for raw in b.column("content"):
                yield from _steps(parsed(raw.as_py(), pack), fields)

    return _files(spark, path).mapInArrow(run, _ddl(fields))


# --- WARC volumes -------------------------------------------------------------------

def record_id(volume: str, number: int) -> str:
    """The same for the same record of the same ARC volume."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{volume}#{number}'.encode()).digest()[:16], version=5)}>"


def _warc(fields: list[tuple[str, object]], block: bytes) -> bytes:
    fields = [*fields, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + b"".join(
        k.encode() + b": " + (v if isinstance(v, bytes) else str(v).encode()) + b"\r\n" for k, v in fields) + b"\r\n" + block


def warc_record(r: dict) -> bytes:
    """A WARC record of an ARC record; ``first`` (volume, number, uri, date,
    page_id) is the one it repeats, if any."""
    kind, first = r["kind"], r["first"]
    fields = [("WARC-Type", "revisit" if first else kind), ("WARC-Record-ID", record_id(r["volume"], r["number"])),
              ("WARC-Date", r["date"])]
    if kind == "warcinfo":
        return _warc([*fields, ("WARC-Filename", r["volume"]), ("Content-Type", "application/warc-fields")], r["payload"])
    if r["uri"] != b"-":
        fields.append(("WARC-Target-URI", r["uri"]))
    fields += [("WARC-IP-Address", r["ip"]), ("WARC-Warcinfo-ID", record_id(r["volume"], 0)),
               ("WARC-Payload-Digest", "sha256:" + r["payload_digest"]),
               ("Content-Type", "application/http; msgtype=response" if kind == "response" else r["mime"])]
    if r["truncated"]:
        fields.append(("WARC-Truncated", "unspecified"))
    if not first:
        return _warc(fields, r["head"] + r["payload"])
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(first["volume"], first["number"])),
               ("WARC-Refers-To-Date", first["date"]), ("X-Payload-Length", r["payload_bytes"])]
    if first["uri"] != b"-":
        fields.append(("WARC-Refers-To-Target-URI", first["uri"]))
    if first["page_id"] is not None:
        fields.append(("X-Refers-To-Page-Id", first["page_id"]))
    return _warc(fields, r["head"])


def repeats(meta: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(payload_digest, n, first) of payloads of ``min_bytes`` or more that
    several records hold."""
    order = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "volume", "number", "uri", "date")
    return (meta.where((F.col("kind") == "response") & (F.col("payload_bytes") >= min_bytes))
            .groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1"))


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = MIN_REVISIT,
            volume_bytes: int = VOLUME_BYTES) -> str:
    """The ARC volumes under ``arc_path`` as WARC volumes under ``warc_path``."""
    again = stored(repeats(records(spark, arc_path, blocks=False), min_bytes), "arc-repeats")
    rows = records(spark, arc_path)
    rows = rows.withColumn("_digest", F.when((F.col("kind") == "response") & (F.col("payload_bytes") >= min_bytes),
                                             F.col("payload_digest")))
    rows = hot_join(rows, again.withColumnRenamed("payload_digest", "_digest"), ["_digest"], "n",
                    F.xxhash64("volume", "number"))
    own = (F.col("first.volume") == F.col("volume")) & (F.col("first.number") == F.col("number"))
    rows = rows.withColumn("first", F.when(~own, F.col("first"))).select(*_META, *_BLOCK, "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        out, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, 64):
                for r in b.slice(at, 64).to_pylist():
                    made = warc_record(r | {"payload": unpack(r["payload"])})
                    out += [made, b"\r\n\r\n"]
                    size += len(made) + 4
                    if size >= volume_bytes:
                        yield _volume(out[:-1])
                        out, size = [], 0
        if out:
            yield _volume(out[:-1])

    _write_volumes(rows.mapInArrow(run, "value binary"), warc_path, "\r\n\r\n")
    return warc_path


def parse_warc(raw: bytes) -> Iterator[dict]:
    """(headers, block) of the records of one WARC volume, digests checked."""
    f = _opened(raw)
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"not a WARC record: {line[:200]!r}")
        headers: dict[str, bytes] = {}
        while (line := f.readline()) not in (b"\r\n", b""):
            k, _, v = line.partition(b":")
            headers[k.decode().lower()] = v.strip()
        block = f.read(int(headers["content-length"]))
        digest = hashlib.sha256(block).hexdigest().encode()
        if headers.get("warc-block-digest") != b"sha256:" + digest:
            raise ArchiveError(f"damaged record {headers.get('warc-record-id')!r}")
        head, payload = b"", block
        if headers["content-type"].startswith(b"application/http") and (end := re.search(rb"\r?\n\r?\n", block)):
            head, payload = block[:end.end()], block[end.end():]
        if headers["warc-type"] in (b"response", b"resource"):
            told = hashlib.sha256(payload).hexdigest().encode()
            if headers.get("warc-payload-digest") != b"sha256:" + told:
                raise ArchiveError(f"damaged payload in {headers.get('warc-record-id')!r}")
        yield {"headers": headers, "head": head, "payload": payload}


_WARC = {"record_type": pa.string(), "record_id": pa.string(), "date": pa.string(), "uri": pa.string(),
         "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
         "refers_to_record": pa.string(), "refers_to": pa.int64(), "truncated": pa.bool_()}


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the WARC volumes under ``path``; a revisit's size and digest
    are those of the payload it repeats.  With ``payloads``, what a response or
    resource holds."""
    fields = _WARC | ({"payload": pa.binary()} if payloads else {})

    def parsed(raw: bytes) -> Iterator[dict]:
        for r in parse_warc(raw):
            h = r["headers"]
            text = {k: v.decode("utf-8", "surrogateescape").encode("utf-8", "replace").decode() for k, v in h.items()}
            revisit = text["warc-type"] == "revisit"
            refers = h.get("x-refers-to-page-id")
            yield {"record_type": text["warc-type"], "record_id": text["warc-record-id"], "date": text["warc-date"],
                   "uri": text.get("warc-target-uri"), "page_id": _page_id(r["head"]),
                   "payload_bytes": int(h["x-payload-length"]) if revisit else len(r["payload"]),
                   "payload_digest": text.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                   "refers_to_record": text.get("warc-refers-to"), "refers_to": int(refers) if refers else None,
                   "truncated": "warc-truncated" in h,
                   "payload": r["payload"] if payloads and not revisit else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("content"):
                yield from _steps(parsed(raw.as_py()), fields)

    return _files(spark, path).mapInArrow(run, _ddl(fields))


def op11_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through ARC volumes of both versions into WARC volumes, and
    the records read back."""
    arcs = write_arc(table(spark, sf_dir, "pages"), scratch_path(spark, "arc"))
    warcs = convert(spark, arcs, scratch_path(spark, "warc"))
    return (read_warc(spark, warcs).where(F.col("record_type").isin("response", "revisit"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "date", "uri"))
