import random

import numpy as np
import pytest

from bourse.llm import decontaminate as dc
from bourse.llm.common import word_hashes


def brute_align(item, passage):
    h = [[0.0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0.0
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if item[i - 1] == passage[j - 1] else -0.5), h[i - 1][j] - 0.5, h[i][j - 1] - 0.5)
            best = max(best, h[i][j])
    return best / len(item)


def test_alignment_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(1, 14))
        assert dc.align(a, b)[0] == pytest.approx(brute_align(a.tolist(), b.tolist()))


def setup(spark, docs, prose, share=0.0):
    rng = random.Random(7)
    items = {i: " ".join(prose(rng, rng.randint(20, 50))) for i in range(30)}
    texts, want = {}, set()
    for d in range(150):
        own = " ".join(prose(rng, 120)).split()
        if d % 3 == 0:
            i = rng.randrange(30)
            copy = [w if rng.random() >= share else "zzz" for w in items[i].split()]
            at = rng.randrange(len(own))
            own[at:at] = copy
            want.add((d, i))
        texts[d] = " ".join(own)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    return docs(texts), bench, texts, items, want


@pytest.mark.parametrize("share", [0.0, 0.15])
def test_copies_are_found_edited_or_not(spark, docs, prose, share):
    df, bench, texts, items, want = setup(spark, docs, prose, share)
    rows = dc.leaks(df, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert got <= want and len(got) >= 0.95 * len(want)
    if not share:
        assert got == want and {r["score"] for r in rows} == {1.0}
        for r in rows:
            a, _ = word_hashes([texts[r["doc_id"]]])
            b, _ = word_hashes([items[r["item_id"]]])
            assert (a[r["first_word"]:r["end_word"]] == b).all()


def test_all_pairs_by_brute_force(spark, docs, prose):
    df, bench, texts, items, _ = setup(spark, docs, prose, 0.3)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.leaks(df, bench).collect()}
    w = {i: word_hashes([t])[0] for i, t in items.items()}
    want = {}
    for d, t in list(texts.items())[::3]:
        x = word_hashes([t])[0]
        for i in items:
            score = dc.align(w[i], x)[0]
            if score >= dc.MIN_SCORE:
                want[d, i] = score
    own = {k: v for k, v in got.items() if k[0] % 3 == 0}
    assert set(own) <= set(want) and len(own) >= 0.9 * len(want)
    assert all(v == pytest.approx(want[k]) for k, v in own.items())


def test_blocks_change_nothing(spark, docs, prose, monkeypatch):
    df, bench, *_ = setup(spark, docs, prose)
    whole = sorted(map(tuple, dc.leaks(df, bench).collect()))
    monkeypatch.setattr(dc, "BLOCK_WORDS", 60)
    blocks = dc._blocks(bench)
    assert blocks.select("block").distinct().count() > 3 and blocks.count() == bench.count()
    assert sorted(map(tuple, dc.leaks(df, bench.limit(6)).collect())) == [
        r for r in whole if r[1] in {x["item_id"] for x in bench.limit(6).collect()}]


def test_a_passage_in_a_third_of_all_documents(spark, docs, prose):
    rng = random.Random(9)
    item = " ".join(prose(rng, 30))
    texts = [" ".join(prose(rng, 60)) + (" " + item if i % 3 == 0 else "") for i in range(90)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r["doc_id"] for r in dc.leaks(docs(texts), bench).collect()} == set(range(0, 90, 3))


def test_odd_tables(spark, docs):
    bench = spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (4, "solo"), (None, "a b c d e f"), (5, "...")],
                                  "item_id long, text string")
    df = docs([(1, "x one two y"), (1, "x one two y"), (None, None), (2, ""), (3, "q " * 50_000 + "solo"), (4, "A, b; c d e f")],
              extra=("_id", "row", "item_id"))
    got = sorted((r["doc_id"], r["item_id"] or 0, r["score"]) for r in dc.leaks(df, bench).collect())
    assert got == [(1, 1, 1.0), (1, 1, 1.0), (3, 4, 1.0), (4, 0, 1.0)]
    kept = dc.drop_leaks(df, bench).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["2", "None"] and kept[0]["_id"] == "own"
    assert dc.leaks(df.limit(0), bench).count() == 0 and dc.leaks(df, bench.limit(0)).count() == 0


def test_a_leak_drops_its_own_row_alone(spark, docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    df = docs([(None, "so alpha beta gamma delta epsilon zeta eta theta it is"), (None, "clean one"), (None, "clean two"),
               (4, "x alpha beta gamma delta epsilon zeta eta theta y"), (4, "clean four")])
    assert sorted(r["text"] for r in dc.drop_leaks(df, bench).collect()) == ["clean four", "clean one", "clean two"]


def test_as_many_blocks_as_the_benchmark_asks_for(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(100)]
    bench = spark.createDataFrame(rows, "item_id long, text string").repartition(3)
    for bound, least, most in ((4000, 1, 1), (3999, 2, 3), (1300, 4, 6), (100, 40, 100)):
        monkeypatch.setattr(dc, "BLOCK_WORDS", bound)
        got = dc._blocks(bench).collect()
        sizes = {}
        for r in got:
            sizes[r["block"]] = sizes.get(r["block"], 0) + 40
        assert len(got) == 100 and least <= len(sizes) <= most and max(sizes.values()) <= max(2 * bound, 40), (bound, sizes)
