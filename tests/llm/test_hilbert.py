import zlib

import pytest
from pyspark.sql import functions as F

from bourse.llm import hilbert as hb


@pytest.mark.parametrize("bits,dims", [(1, 2), (2, 3), (4, 2), (2, 4)])
def test_curve_visits_neighbours(spark, bits, dims):
    axes = [f"a{i}" for i in range(dims)]
    n, mask = 1 << bits * dims, (1 << bits) - 1
    cells = spark.range(n).select("id", *[F.shiftright("id", bits * i).bitwiseAND(F.lit(mask)).cast("int").alias(a)
                                          for i, a in enumerate(axes)])
    rows = sorted((r["h"], r["id"]) for r in hb.curve_place(cells, axes, bits, "h").collect())
    assert [h for h, _ in rows] == list(range(n))
    at = [[i >> bits * d & mask for d in range(dims)] for _, i in rows]
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(at, at[1:]))


def test_query_keeps_its_law(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = hb.op8_hilbert_shards(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots.setdefault(r["shard"], []).append(r)
    assert set(slots) == set(range(24))
    counts = [len(v) for v in slots.values()]
    assert max(counts) - min(counts) <= 1
    last = (-1,)
    for shard in range(24):
        own = sorted(slots[shard], key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        for r in own:               # one ascending run over all shards
            key = (r["hilbert"], r["text_crc32"], r["doc_id"])
            assert key > last
            last = key


def test_shards_prune(spark, tmp_base):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    done = hb.hilbert_shards(df)
    assert done.groupBy("source").agg(F.countDistinct("shard").alias("n")).where("source <> 'src0'").agg(F.avg("n")).first()[0] < 16
    assert done.groupBy("lang").agg(F.countDistinct("shard").alias("n")).where("lang <> 'en'").agg(F.avg("n")).first()[0] < 16
    hb.write_shards(df, tmp_base)
    back = spark.read.parquet(tmp_base)
    assert back.count() == df.count() and back.select("shard").distinct().count() == 24


@pytest.mark.parametrize("rows", [0, 1, 5, 24, 25])
def test_few_rows(spark, docs, rows):
    got = hb.hilbert_shards(docs([f"t{i}" for i in range(rows)])).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(i, 0) for i in range(min(rows, 24))] or rows == 25
    assert len(got) == rows


def test_odd_tables(spark, docs):
    df = docs([(1, "a"), (1, "a"), (None, None), (2, "")], extra=("shard", "_tie", "hilbert", "_axis0", "_row"))
    df = df.withColumn("source", F.lit(None).cast("string"))
    got = hb.hilbert_shards(df, shards=3).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0)]


def test_long_names_are_told_apart(spark):
    names = [f"https://archive.example.org/common/prefix/{i:04d}" for i in range(400)]
    df = spark.createDataFrame([(i, n, "t") for i, n in enumerate(names)], "doc_id long, source string, text string").repartition(5)
    bin_, = hb.bins(df, ("source",), bits=5)
    got = {r["source"]: r["b"] for r in df.select("source", bin_.alias("b")).collect()}
    ordered = [got[n] for n in names]
    assert ordered == sorted(ordered) and set(ordered) == set(range(32))
    sizes = [ordered.count(b) for b in range(32)]
    assert max(sizes) - min(sizes) <= 1
    done = hb.hilbert_shards(df, shards=20, dimensions=("source",))
    spans = sorted((r["a"], r["z"]) for r in done.groupBy("shard").agg(F.min("source").alias("a"), F.max("source").alias("z")).collect())
    assert all(z < a for (_, z), (a, _) in zip(spans[::2], spans[2::2]))


def test_text_edges_are_exact_quantiles(spark):
    rows = [(w,) for w in ["x"] * 50 + ["b", "a", "é", "\U0001F600", None, "", "common_crawl_2020", "common_wiki"] * 3]
    df = spark.createDataFrame(rows, "v string").repartition(4)
    values = sorted((w for w, in rows if w is not None), key=lambda w: w.encode())
    shares = [i / 8 for i in range(1, 8)]
    want = [next(v for k, v in enumerate(values, 1) if k >= s * len(values)) for s in shares]
    assert hb.text_edges(df, "v", shares) == want
    assert hb.text_edges(df.where("v = 'none'"), "v", shares) == []
