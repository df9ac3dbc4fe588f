import pathlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bourse.llm import packing as pk

OWN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(t):
    return np.array([*OWN.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")


def check(rows, texts):
    """Every id in exactly one piece, sequences gapless and of allowed sizes."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        want, at = ids_of(texts[i]), 0
        for r in sorted(own, key=lambda r: r["start"]):
            part = want[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(want)) and r["length"] > 0
            if "ids_crc32" in r.asDict():
                assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            else:
                assert bytes(r["ids"]) == part.tobytes()
            at += r["length"]
        assert at == len(want)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_fast_encoder_gives_the_same_ids():
    enc = pk.encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(1)
    texts = ["", " ", "a", "it's we'll I'VE", " x　y\r\n\r\n  z", "é𝄞漢字٣", "<|endoftext|> b", "  \t\n ", "\x00\x1c\x85", "123 4 56é7"]
    texts += ["".join(rng.choice(" aé1.'\n\t漢😀s<|>") for _ in range(30)) for _ in range(300)]
    for t in texts:
        assert enc.ids(t).tolist() == ids_of(t).tolist(), repr(t)
    slow = pk.Encoder(public_tokenizers.path("byte_bpe_50k.json"), None)
    assert slow.ids("some words").tolist() == ids_of("some words").tolist()


def test_fast_encoder_looks_for_one_special_token_and_reads_the_tokenizer_file_late():
    """Without a special token tiktoken's search for one stops at each character."""
    enc = pk.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert enc._fast.special_tokens_set == {pk.SPECIAL}
    text = "some words é漢 <|endoftext"
    assert enc.ids(text).tolist() == ids_of(text).tolist() and enc._own is None
    marked = f"a {pk.SPECIAL} b"
    assert enc.ids(marked).tolist() == ids_of(marked).tolist() and enc._own is not None


def test_index_against_plain_bm25():
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(1, 30, rng.integers(1, 40)), 0) for _ in range(25)]
    index = pk.Index(docs)
    n, mean = len(docs), np.mean([len(d) - 1 for d in docs])
    df = {t: sum(t in d[:-1] for d in docs) for d in docs for t in d[:-1].tolist()}
    for q in range(n):
        terms = [int(index.terms[t]) for t in index.queries[q]]
        own = sorted((df[t], t) for t in set(docs[q][:-1].tolist()) if df[t] > 1)
        assert sorted(df[t] for t in terms) == [f for f, _ in own[:pk.QUERY_TERMS]]
        want = []
        for d in docs:
            s = 0.0
            for t in terms:
                f = int((d[:-1] == t).sum())
                if f:
                    s += np.log1p((n - df[t] + .5) / (df[t] + .5)) * f * (pk.K1 + 1) / (f + pk.K1 * (1 - pk.B + pk.B * (len(d) - 1) / mean))
            want.append(s)
        assert np.allclose(index.scores(q, n), want)


def test_windows_gather_neighbours():
    rng = np.random.default_rng(2)
    topics = [rng.integers(1000 * t, 1000 * t + 40, size=100) for t in range(1, 6) for _ in range(20)]
    docs = [np.append(topics[i], 0) for i in rng.permutation(len(topics))]
    mixed = [len({int(docs[d][0]) // 1000 for d, _, _ in w}) for w in pk.fill(docs)]
    assert np.mean(mixed) < 2.2


def test_query_round_trip(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = pk.op10_bm25_packing(spark, sf).collect()
    check(rows, texts)
    sizes = {}
    for r in rows:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert sum(v < 1024 for v in sizes.values()) <= 10        # the one shard's last window


@pytest.mark.parametrize("shard_bytes", [1 << 22, 2000])
def test_odd_tables(spark, docs, shard_bytes):
    texts = {1: None, 2: "", 3: "word " * 20_000, 4: "a", None: "no id", 6: "tie tie", 7: "tie tie"}
    df = docs(texts, extra=("shard", "ids", "offset"))
    check(pk.pack(df, shard_bytes=shard_bytes).collect(), texts)
    assert pk.pack(df.limit(0)).count() == 0
    twice = pk.pack(docs([(1, "same text"), (1, "same text")])).collect()
    assert sum(r["length"] for r in twice) == 2 * len(ids_of("same text"))


def siblings(rng, topics=60, each=12):
    """Texts of topics, each with words of its own, in random order."""
    def word(k):
        return "".join("bcdfghjklmnpqrstvwz"[k // 19 ** j % 19] + "aeiou"[k // 7 ** j % 5] for j in range(3))
    out = []
    for t in range(topics):
        own = [word(7919 * (30 * t + j) % 6859) for j in range(30)]
        for _ in range(each):
            words = [rng.choice(own) if rng.random() < .5 else rng.choice(("the", "of", "and", "to", "in", "is")) for _ in range(120)]
            out.append((t, " ".join(words)))
    rng.shuffle(out)
    return out


def test_siblings_meet_in_a_shard_and_counts_are_the_corpus(spark, docs):
    made = siblings(random.Random(4))
    df = docs(dict(enumerate(t for _, t in made))).repartition(5)
    total = sum(len(t) for _, t in made)
    rows = pk.pack(df, shard_bytes=total // 20).collect()
    check(rows, dict(enumerate(t for _, t in made)))
    shard = {r["doc_id"]: r["sequence_id"] >> 32 for r in rows}
    assert len(set(shard.values())) >= 15
    pairs = [(a, b) for a in shard for b in shard if a < b and made[a][0] == made[b][0]]
    assert np.mean([shard[a] == shard[b] for a, b in pairs]) > 0.4        # 0.05 by hash
    ids = [ids_of(t) for _, t in made]
    want = pk.corpus_of(ids)
    got = pk.corpus_counts(spark.createDataFrame([(bytearray(x.tobytes()),) for x in ids], "ids binary").repartition(4))
    assert got.n == want.n and np.isclose(got.mean, want.mean)
    assert got.terms.tolist() == want.terms.tolist() and got.frequency.tolist() == want.frequency.tolist()
    # a shard's scores carry the corpus's weights
    few = ids[:5]
    assert not np.allclose(pk.Index(few, want).weight, pk.Index(few).weight)


def test_copies_are_split_over_shards(spark, docs):
    texts = {i: "one and the same text over and over" for i in range(400)}
    rows = pk.pack(docs(texts), shard_bytes=2000).collect()
    check(rows, texts)
    sizes = {}
    for r in rows:
        sizes[r["sequence_id"] >> 32] = sizes.get(r["sequence_id"] >> 32, 0) + r["length"]
    assert len(sizes) >= 10 and max(sizes.values()) < 8 * np.mean(list(sizes.values()))


def test_neighbours_by_the_full_query():
    """A seed with many rare ids that one other document holds each, and a
    neighbour that shares its whole other vocabulary."""
    rare, topic = np.arange(1000, 1040), np.arange(1, 201)
    docs = [np.concatenate([topic, rare, [0]])] + [np.append(np.append(np.arange(3000 + 300 * k, 3200 + 300 * k), r), 0) for k, r in enumerate(rare)]
    docs += [np.append(topic, 0), np.append(topic[:150], 0)]
    index, corpus = pk.Index(docs), pk.corpus_of(docs)
    want = []
    for d in docs:
        s = 0.0
        for t in docs[0][:-1].tolist():
            if t in d[:-1]:
                idf, _ = corpus.idf(np.array([t]))
                s += float(idf[0] * pk.saturated(np.array(1), np.array(len(d) - 1), corpus.mean))
        want.append(s)
    got = index.scores(0, len(docs))
    assert np.allclose(got[1:], want[1:], rtol=1e-4) and int(got[1:].argmax()) + 1 == len(docs) - 2
    first = pk.fill(docs, 600)[0]
    assert [d for d, _, _ in first][:3] == [0, len(docs) - 2, len(docs) - 1]


def test_index_sorts_a_shard_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    docs = [np.append(rng.integers(1, 300, rng.integers(0, 40)), 0).astype(kind) for kind in ("<u2", "<u4") for _ in range(100)]
    for part in (docs[:100], docs[100:]):
        for d, *got in zip(part, *own_terms(pk.distinct(part), len(part))):
            assert [x.tolist() for x in got] == [x.tolist() for x in np.unique(d[:-1], return_counts=True)]
    corpus, calls, unique = pk.corpus_of(docs[:100]), [], np.unique
    monkeypatch.setattr(pk.np, "unique", lambda *a, **k: calls.append(1) or unique(*a, **k))
    pk.Index(docs[:100], corpus)
    assert len(calls) <= 2        # none for each document


def own_terms(found, n):
    owner, term, count = found
    return [term[owner == k] for k in range(n)], [count[owner == k] for k in range(n)]


def test_token_table_goes_once_the_topics_are_known(spark, docs, tmp_base):
    folder = pathlib.Path(tmp_base.removeprefix("file:")).parent
    folder.mkdir(parents=True, exist_ok=True)
    before = set(folder.iterdir())
    texts = {i: f"some words {i % 7}" for i in range(50)}
    check(pk.pack(docs(texts)).collect(), texts)
    made = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert made == {"packing-topics"}
