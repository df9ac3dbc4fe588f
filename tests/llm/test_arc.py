import gzip
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.llm import arc as A
from bourse.llm import common

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType())])
LONG = "<p>" + "same words " * 20 + "</p>"


@pytest.fixture()
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, PAGES)


def rows_of(n=120):
    out = [(5, "http://a.example/x y\tz", LONG), (3, "http://b.example/ü", LONG), (9, None, LONG), (4, "", None),
           (6, "http://c.example/", ""), (7, "http://c.example/", "short"), (8, "http://d.example/", "short"),
           (None, "http://e.example/", LONG), (5, "http://a.example/again", LONG), (11, "x", "a" * 99), (12, "x", "a" * 99),
           (13, "x", "b" * 100), (14, "x", "b" * 100), (15, "dns:x", "line\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" * 9),
           (16, "http://g/", " é\x00" * 60)]
    return out + [(100 + i, f"http://h/{i}", f"<p>{i % 7}</p>" * 30) for i in range(n)]


def expected(rows):
    """Per row: size, digest, type, page_id of the response (smallest, null last)."""
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        ids = sorted(groups[html or ""], key=lambda x: (x is None, x))
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), ids[0] if len(raw) >= 100 and len(ids) > 1 else None))
    return out


def check(got, rows):
    """Types up to which of several rows with one page_id is the response."""
    want = expected(rows)
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got if r["page_id"] is not None) \
        == sorted(w[:3] for w in want if w[0] is not None)
    assert len(got) == len(rows)
    for digest in {w[2] for w in want}:
        same = [r for r in got if r["payload_digest"] == digest]
        first = [w[3] for w in want if w[2] == digest][0]
        if first is None:
            assert all(r["record_type"] == "response" and r["refers_to"] is None for r in same)
        else:
            response, = [r for r in same if r["record_type"] == "response"]
            assert response["page_id"] == first and response["refers_to"] is None
            assert all(r["record_type"] == "revisit" and r["refers_to"] == first for r in same if r is not response)


@pytest.mark.parametrize("share", [1000, 1, 0.01])
def test_query(spark, pages, tmp_path, monkeypatch, share):
    monkeypatch.setattr(common, "SHARE", share)
    rows = rows_of()
    pages(rows).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = A.op11_arc_to_warc(spark, str(tmp_path)).collect()
    check(got, rows)
    assert len({r["record_id"] for r in got}) == len(rows) and {r["date"] for r in got} == {"2000-01-01T00:00:00Z"}


@pytest.mark.parametrize("version", [1, 2])
def test_volumes_and_references(spark, pages, tmp_path, version):
    rows = rows_of()
    made = pages(rows).withColumn("first", F.lit("clash")).withColumn("kind", F.lit(1)).coalesce(1)
    arcs = A.write_arc(made, f"{tmp_path}/arc", versions=(version,), volume_bytes=4000)
    files = sorted(f for f in (tmp_path / "arc").iterdir() if f.name.startswith("part-"))
    volumes = [gzip.decompress(f.read_bytes()) for f in files]
    assert len(volumes) > 5 and all(v.startswith(b"filedesc://crawl-") for v in volumes)
    assert all(v.split(b"\n")[2].decode() == A.ARC_FIELDS[version] for v in volumes)
    parsed = [r for v in volumes for r in A.parse_arc(v)]
    assert sum(r["kind"] == "response" for r in parsed) == len(rows)
    assert sorted(r["payload"] for r in parsed if r["number"]) == sorted((h or "").encode() for _, _, h in rows)
    warcs = A.convert(spark, arcs, f"{tmp_path}/warc", volume_bytes=4000)
    again = A.convert(spark, arcs, f"{tmp_path}/warc2")
    got = A.read_warc(spark, warcs, payloads=True).collect()
    other = A.read_warc(spark, again).collect()
    assert {r["record_id"] for r in got} == {r["record_id"] for r in other}
    check([r for r in got if r["record_type"] in ("response", "revisit")], rows)
    assert sum(r["record_type"] == "warcinfo" for r in got) == len(volumes)
    by_id = {r["record_id"]: r for r in got}
    for r in got:
        if r["record_type"] == "revisit":
            target = by_id[r["refers_to_record"]]
            assert target["record_type"] == "response" and target["page_id"] == r["refers_to"]
            assert hashlib.sha256(target["payload"]).hexdigest() == r["payload_digest"] and r["payload"] is None
    uris = {r["page_id"]: r["uri"] for r in got}
    assert uris[9] is None and uris[4] is None and uris[3] == "http://b.example/ü"


def arc(version, *records, told=None):
    block = f"{told or version} 0 x\n{A.ARC_FIELDS[version]}\n\n".encode()
    more = " 200 - - 0 f" if version == 2 else ""
    out = f"filedesc://old.arc 1.2.3.4 19970102030405 text/plain{more} {len(block)}\n".encode() + block
    for uri, mime, declared, body in records:
        out += f"\n{uri} 1.2.3.4 19970102030405 {mime}{more} {declared}\n".encode() + body
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_foreign_volumes(version):
    body = b"HTTP/1.0 200 OK\nServer: x\n\nhello\n\n"
    raw = arc(version, ("http://a/with blank", "text/html", len(body), body), ("dns:a.b", "text/dns", 3, b"1\n2"),
              ("http://c/", "text/plain", 50, b"cut"))
    for data in (raw, gzip.compress(raw[:60]) + gzip.compress(raw[60:])):
        desc, a, b, c = A.parse_arc(data)
        assert desc["kind"] == "warcinfo" and desc["volume"] == "old.arc"
        assert (a["uri"], a["kind"], a["payload"], a["date"]) == (b"http://a/with blank", "response", b"hello\n\n", "1997-01-02T03:04:05Z")
        assert (b["kind"], b["payload"], b["mime"], b["truncated"]) == ("resource", b"1\n2", "text/dns", False)
        assert c["truncated"] and c["payload"] == b"cut"
    assert list(A.parse_arc(b"")) == []


@pytest.mark.parametrize("raw", [
    b"http://a/ 1.2.3.4 19970102030405 text/html 3\nabc", arc(1, ("http://a/", "text/html", "x", b"abc")),
    arc(2, ("http://a/", "text/html", 3, b"abc"), told=1), arc(1).replace(b"19970102030405", b"19971302030405")])
def test_bad_volumes_fail(raw):
    with pytest.raises(A.ArchiveError):
        list(A.parse_arc(raw))


def test_damage_does_not_go_unseen():
    rec = {"kind": "response", "first": None, "volume": "v", "number": 1, "date": "d", "uri": b"u", "ip": b"i", "mime": "m",
           "payload_digest": hashlib.sha256(b"abc").hexdigest(), "truncated": True, "head": b"HTTP/1.1 200 OK\r\n\r\n", "payload": b"abc"}
    raw = A.warc_record(rec)
    assert [r["payload"] for r in A.parse_warc(raw + b"\r\n\r\n" + raw)] == [b"abc", b"abc"]
    assert b"WARC-Truncated: unspecified" in raw
    with pytest.raises(A.ArchiveError):
        list(A.parse_warc(raw.replace(b"abc", b"abd")))


def test_no_pages(spark, pages, tmp_path):
    pages([]).write.parquet(f"{tmp_path}/pages.parquet")
    assert A.op11_arc_to_warc(spark, str(tmp_path)).collect() == []
