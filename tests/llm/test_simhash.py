import random

import numpy as np
import pytest
import xxhash

from bourse.llm import simhash as sh


def brute_fingerprint(text, n=4):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, max_bits=4):
    ids = sorted(fps)
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if bin(fps[ids[a]] ^ fps[ids[b]]).count("1") <= max_bits:
                x, y = sorted((root(ids[a]), root(ids[b])))
                label[y] = x
    return {i: root(i) for i in ids}


def test_fingerprints():
    for t in [None, "", "  \t", "One", "a b c d", "a b c d e", "É A\x0bB\x1cC d é f " * 3, "x " * 70_000]:
        if t is None or len(t) < 1000:
            assert sh.fingerprint(t) == brute_fingerprint(t)
    assert sh.fingerprint("x " * 70_000) == sh.fingerprint("x " * 5)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F
    got = spark.createDataFrame([("héllo wörld foo bar" * 5,)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(("héllo wörld foo bar" * 5).encode(), seed=42)


def test_code_is_perfect():
    words = np.arange(1 << 23)
    index = sh.decode(words)
    assert (np.bincount(index, minlength=4096) == 2048).all()


def test_fingerprints_that_link_share_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000, dtype=np.uint64)
    for bits in range(5):
        flips = np.array([sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in a], dtype=np.uint64)
        at, keys = sh.keys_of(a)
        bt, other = sh.keys_of(a ^ flips)
        mine = set(zip(at.tolist(), keys.tolist()))
        shared = {i for i, k in zip(bt.tolist(), other.tolist()) if (i, k) in mine}
        assert len(shared) == len(a)
        assert len(keys) / len(a) < 34


def near_fps(rng, n=400):
    fps = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):          # chains, stars and dense clusters
        x = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(0, 5)):
            x ^= 1 << b
        fps.append(x)
    return fps


@pytest.mark.parametrize("block_rows", [2048, 4])
def test_components_against_brute_force(spark, block_rows):
    fps = {i: x for i, x in enumerate(near_fps(random.Random(2)))}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in set(fps.values())], "fp long")
    labels = {r["node"]: r["label"] for r in sh.connected_components(sh.near_links(df, 4, block_rows)).collect()}
    want = brute_components(fps)
    groups, found = {}, {}
    for i, x in fps.items():
        s = x - (1 << 64) if x >> 63 else x
        groups.setdefault(want[i], set()).add(s)
        found.setdefault(labels.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_large_keys_are_split(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)} | {rng.getrandbits(64) for _ in range(100)}
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    links = sh.near_links(df, 4, block_rows=64)
    labels = [r["label"] for r in sh.connected_components(links).collect()]
    assert len(set(labels)) == 1 and len(labels) == 64 * 63 // 2
    assert links.count() < 200 * len(labels)          # forests, not all pairs


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_components(fps)
    rows = sh.op9_simhash_golay(spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        i: (f"{fps[i]:016x}", want[i]) for i in texts}


def test_one_of_each_group_stays(spark, docs, prose):
    rng = random.Random(4)
    text, other = (" ".join(prose(rng, 400)) for _ in range(2))
    near = text.replace(".", "!", 1)
    df = docs([(9, text), (3, text), (5, near), (3, text), (7, other), (None, None), (8, ""), (None, other)], extra=("_id", "row", "fp"))
    comp = {(r["doc_id"], r["component_id"]) for r in sh.near_duplicates(df).collect()}
    assert {(9, 3), (3, 3), (7, 7), (8, 8), (None, 8), (None, 7)} <= comp
    kept = sh.drop_near_duplicates(df).collect()
    left = sorted(r["doc_id"] for r in kept)
    assert left == sorted({c for _, c in comp}) and kept[0]["_id"] == "own"
    nameless = docs([(None, "a b"), (None, "a b")])
    assert [r["component_id"] for r in sh.near_duplicates(nameless).collect()] == [None, None]
    assert sh.drop_near_duplicates(nameless).count() == 1
    assert sh.near_duplicates(df.limit(0)).count() == 0 and sh.drop_near_duplicates(df.limit(0)).count() == 0


def test_rows_without_an_id_or_that_repeat_one_are_rows_of_their_own(spark, docs, prose):
    rng = random.Random(21)
    texts = [" ".join(prose(rng, 80)) for _ in range(6)]
    df = docs([(None, t) for t in texts] + [(5, texts[0]), (5, " ".join(prose(rng, 80))), (3, texts[1]), (None, texts[2])])
    kept = sh.drop_near_duplicates(df.repartition(4)).collect()
    assert len(kept) == 7 and {r["text"] for r in kept} == {r["text"] for r in df.collect()}
    assert {(r["doc_id"], r["text"]) for r in kept} >= {(5, texts[0]), (3, texts[1]), (None, texts[2])}


def test_small_tables_are_written_by_a_few_tasks_a_core(spark, docs, monkeypatch):
    files, written = [], sh.stored_small

    def counted(df, name):
        out = written(df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(sh, "stored_small", counted)
    texts = [f"{i} one two three four five {i * 7} six" for i in range(400)] + ["copies of one text all the way down"] * 40
    # a count of partitions that is asked for is not merged by AQE
    monkeypatch.setattr(sh, "fingerprints", lambda d, n, f=sh.fingerprints: f(d, n).repartition(97, "fp"))
    got = sh.near_duplicates(docs(texts)).collect()
    assert len(got) == 440 and {r["component_id"] for r in got if r["doc_id"] >= 400} == {400}
    assert len(files) >= 4 and max(files) <= 4 * spark.sparkContext.defaultParallelism
    wide = written(spark.range(1000).repartition(97), "wide")
    assert wide.count() == 1000 and len(wide.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism
