import random

from hypothesis import given, settings
from hypothesis import strategies as st

from bourse.llm import line_dedup as ld


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.? \n\t", max_size=60))
def test_lines_join_to_the_text(text):
    assert "".join(ld.lines_of(text)) == text


def test_boundaries_do_not_shift(prose):
    rng = random.Random(1)
    passage = prose(rng, 300)
    hashes = []
    for before in (0, 3, 50):
        text = " ".join(prose(rng, before) + passage)
        hashes.append({c[2] for c in ld._chunks(ld._keys(ld.lines_of(text)))[1]})
    assert len(hashes[0] & hashes[1] & hashes[2]) > 0.8 * len(hashes[0])


def test_texts_of_a_batch_do_not_mix(prose):
    rng = random.Random(8)
    texts = [ld._keys(prose(rng, n)) for n in (40, 0, 9, 200, 3)]
    alone = [[c[2] for c in ld._chunks(k)[1]] for k in texts]
    hashes, words = ld._measured([x for k in texts for x in k])
    ends = [sum(map(len, texts[:i + 1])) for i in range(len(texts))]
    at, size, h = ld.chunks_of(hashes, words, ld.np.repeat(ends, [len(k) for k in texts]))
    assert h.tolist() == [x for own in alone for x in own]
    assert all(any(a < e and a + s <= e for e in ends) for a, s in zip(at.tolist(), size.tolist()))


def test_repeated_passages_go_and_clean_texts_stay(spark, docs, prose):
    rng = random.Random(2)
    texts, passages = {}, [" ".join(prose(rng, 70)) for _ in range(12)]
    for i in range(120):
        own = prose(rng, 150)
        if i % 3:
            at = rng.randrange(len(own))
            own.insert(at, passages[i % 12])
        texts[i] = ("Header of them all.\n" if i % 2 else "") + (" ".join(own) if i % 5 else "\n".join(own))
    out = {r["doc_id"]: r for r in ld.dedup_lines(docs(texts)).collect()}
    assert len(out) == 120
    for k, p in enumerate(passages):
        holders = [i for i in texts if p in texts[i]]
        assert all(p in out[i]["text"] for i in holders[:1])
        inner = ". ".join(p.split(". ")[1:-1])          # its ends may run into other sentences
        left = [i for i in holders[1:] if inner in out[i]["text"]]
        assert len(left) <= len(holders) // 10, (k, left, holders)
    for i in texts:
        if not i % 3:
            assert out[i]["text"] == texts[i] and out[i]["n_lines_removed"] == 0


def test_copies_keep_the_smallest_id(spark, docs, prose):
    rng = random.Random(3)
    text = "\n".join(prose(rng, 200))
    near = text.replace("\n", "\nNew words put in here.\n", 1)
    out = {r["doc_id"]: r for r in ld.dedup_lines(docs([(5, text), (9, text), (7, near), (9, text), (None, None), (4, "")])).collect()}
    assert out[5]["text"] == text and out[9]["text"] == "" and out[None]["text"] is None and out[4]["text"] == ""
    assert "New words" in out[7]["text"] and out[7]["n_words_removed"] > 150


def test_bytes_decide(prose):
    rng = random.Random(4)
    lines = prose(rng, 100)
    text = "\n".join(lines)
    keys = ld._keys(ld.lines_of(text))
    chunks = ld._chunks(keys)[1]
    same = {h: [(keys, at)] for at, _, h in chunks}
    other = {h: [([k[::-1] for k in keys], at)] for at, _, h in chunks}       # as after a collision of hashes
    assert ld.clean_text(text, same, 25)[0] == ""
    assert ld.clean_text(text, other, 25) == (text, 0, 0)


def test_repeats_within_a_document(spark, docs, prose):
    rng = random.Random(5)
    part = prose(rng, 60)
    text = "\n".join(part + prose(rng, 40) + part)
    out = ld.dedup_lines(docs([text])).collect()[0]
    assert out["n_words_removed"] >= 40 and out["text"].startswith("\n".join(part))


def test_short_repeats_stay(spark, docs, prose):
    rng = random.Random(6)
    texts = [f"All rights reserved.\nSee the notice.\n{' '.join(prose(rng, 60))}" for _ in range(20)]
    out = ld.dedup_lines(docs(texts)).collect()
    assert sorted(r["text"] for r in out) == sorted(texts)


def test_odd_tables(spark, docs, prose):
    rng = random.Random(7)
    long = " ".join(prose(rng, 30_000))
    df = docs([(1, long), (2, long), (None, long), (3, "no end of line " * 2000)], extra=("_id", "row", "h", "n_lines_removed"))
    out = {r["doc_id"]: r for r in ld.dedup_lines(df).collect()}
    assert out[None]["text"] == long and out[1]["text"] == out[2]["text"] == "" and out[1]["_id"] == "own"
    assert ld.dedup_lines(df.limit(0)).count() == 0


def cleaned(spark, docs, prose, passages, apart="\n", seed=11):
    """How many of ``passages`` (lists of lines) go from their second holder."""
    rng = random.Random(seed)
    texts = {}
    for k, p in enumerate(passages):
        for i in (2 * k, 2 * k + 1):
            texts[i] = "\n".join(prose(rng, 60)) + "\n" + apart.join(p) + "\n" + "\n".join(prose(rng, 60))
    out = {r["doc_id"]: r["text"] for r in ld.dedup_lines(docs(texts)).collect()}
    assert all(out[2 * k] == texts[2 * k] for k in range(len(passages)))
    return sum("\n".join(p[3:-3]) not in out[2 * k + 1].replace("\n\n", "\n") for k, p in enumerate(passages)) / len(passages)


def test_passages_of_short_lines_go(spark, docs, prose):
    rng = random.Random(12)
    def lines(n, words):
        own = " ".join(prose(rng, n * words)).replace(".", "").lower().split()
        return [" ".join(own[i * words:(i + 1) * words]) for i in range(n)]
    for n, words, apart in ((30, 2, "\n"), (55, 1, "\n"), (18, 3, "\n"), (11, 5, "\n\n"), (9, 6, "\n\n"), (8, 7, "\n\n"), (18, 3, "\n\n")):
        share = cleaned(spark, docs, prose, [lines(n, words) for _ in range(20)], apart)
        assert share >= 0.9, (n, words, apart, share)


def test_passages_without_spaces_go(spark, docs, prose):
    rng = random.Random(13)
    han = lambda k: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(k))
    assert cleaned(spark, docs, prose, [[han(14) + "。" for _ in range(10)] for _ in range(10)]) >= 0.9
    tabs = lambda: "\t".join(" ".join(prose(rng, 6)).split())
    assert cleaned(spark, docs, prose, [[tabs() for _ in range(10)] for _ in range(10)]) >= 0.9
    assert [ld._words(x) for x in ("", "a b", "a\tb  c", "漢字漢字 x", "é è")] == [0, 2, 3, 3, 2]


def test_sentence_ends():
    assert ld.lines_of('He said "no!" Then he left! Why?! "Yes." 漢字。「漢字！」漢字？ end') == [
        'He said "no!" ', "Then he left! ", "Why?! ", '"Yes." ', "漢字。", "「漢字！」", "漢字？ ", "end"]


def brute(texts):
    """Text left of each document: every chunk that another document with a
    smaller key holds goes, with the equal lines around it in the first copy."""
    keys = {i: ld._keys(ld.lines_of(t)) for i, t in texts.items()}
    chunks = {i: ld._chunks(k)[1] for i, k in keys.items()}
    content = lambda i, c: tuple(keys[i][c[0]:c[0] + c[1]])
    holders = {}
    for i in sorted(texts):
        for c in chunks[i]:
            holders.setdefault(content(i, c), []).append((i, c[0]))
    left = {}
    for i in texts:
        lines, gone = ld.lines_of(texts[i]), set()
        for c in chunks[i]:
            held = holders[content(i, c)]
            first, there = held[0]
            at, size = c[0], c[1]
            if first == i:
                if there + size <= at:
                    gone |= set(range(at, at + size))
                continue
            # lines around the first copy travel with it, to the end of its block and a margin
            lo = max(0, there // ld.BLOCK_LINES * ld.BLOCK_LINES - ld.MARGIN)
            ends = [d[0] + d[1] for d in chunks[first] if d[0] // ld.BLOCK_LINES == there // ld.BLOCK_LINES
                    and holders[content(first, d)][0] == (first, d[0]) and len({h[0] for h in holders[content(first, d)]}) > 1]
            hi = max([(there // ld.BLOCK_LINES + 1) * ld.BLOCK_LINES + ld.MARGIN, *ends]) + ld.MARGIN
            other = keys[first][:hi]
            a, b, e, f = at, there, at + size, there + size
            while a and b > lo and keys[i][a - 1] == other[b - 1]:
                a, b = a - 1, b - 1
            while e < len(keys[i]) and f < len(other) and keys[i][e] == other[f]:
                e, f = e + 1, f + 1
            gone |= set(range(a, e))
        left[i] = "".join(x for k, x in enumerate(lines) if k not in gone)
    return left


def test_query_equals_brute_force(spark, docs, prose):
    rng = random.Random(21)
    shared = [prose(rng, rng.choice([14, 20, 45, 200])) for _ in range(25)]
    texts = {}
    for i in range(90):
        own = []
        for _ in range(rng.randint(0, 5)):
            own += rng.choice([prose(rng, rng.randint(5, 40)), rng.choice(shared), rng.choice(shared)[:3]])
        texts[i] = rng.choice([" ", "\n", "\n\n    "]).join(own)
    got = {r["doc_id"]: r["text"] for r in ld.dedup_lines(docs(texts).repartition(5)).collect()}
    want = brute(texts)
    assert got == want and sum(want[i] != texts[i] for i in texts) > 30


def test_short_chunks_go_too(spark, docs, prose):
    rng = random.Random(22)
    pair = prose(rng, 10) + prose(rng, 10)
    texts = {i: "\n".join(prose(rng, 60) + pair + prose(rng, 60)) for i in range(5)}
    out = {r["doc_id"]: r["text"] for r in ld.dedup_lines(docs(texts)).collect()}
    assert out[0] == texts[0] and all(pair[0] not in out[i] and len(out[i]) > 400 for i in range(1, 5))
    kept = {r["doc_id"]: r["text"] for r in ld.dedup_lines(docs(texts), min_words=25).collect()}
    assert kept == texts


def test_rows_without_id_are_documents_each(spark, docs, prose):
    rng = random.Random(23)
    passage = "\n".join(prose(rng, 80))
    made = ["\n".join(prose(rng, 40)) + "\n" + passage + "\n" + "\n".join(prose(rng, 40)) for _ in range(8)]
    rows = [(None, t) for t in made[:5]] + [(i, t) for i, t in enumerate(made[5:])]
    out = ld.dedup_lines(docs(rows).repartition(4)).collect()
    assert len(out) == 8
    whole = [r for r in out if passage in r["text"]]
    assert len(whole) == 1 and whole[0]["doc_id"] is None      # the first copy alone
    # equal in all columns: one document, brought along once
    many = ld.dedup_lines(docs([(None, made[0])] * 300 + [(7, made[1]), (7, made[1])])).collect()
    assert len(many) == 302 and sum(passage in r["text"] for r in many) == 300
    assert all(passage not in r["text"] for r in many if r["doc_id"] == 7)
