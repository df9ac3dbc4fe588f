import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from bourse.llm import periodic as P


def brute_runs(words):
    """Every maximal stretch of smallest period q and length >= max(6, 4 q)."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smallest = not any(all(words[x] == words[x + p] for x in range(i, j + q - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and smallest:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {x for s, m, q in runs for x in range(s + q, s + m)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def searched(texts):
    found = P.Factors([t.encode().split() for t in texts]).runs()
    starts = np.concatenate([[0], np.cumsum([len(t.split()) for t in texts])])
    return [[(int(s - a), int(m), int(q)) for s, m, q in found if a <= s < b] for a, b in zip(starts, starts[1:])]


def nested(rng, depth):
    """Words made of repetitions of repetitions."""
    if not depth:
        return [rng.choice("ab") for _ in range(rng.randint(1, 3))]
    out = []
    for _ in range(rng.randint(1, 3)):
        out += nested(rng, depth - 1) * rng.choice([1, 1, 2, 3, 4, 5])
    return out


def test_runs_equal_brute_force():
    rng = random.Random(5)
    texts = ["", "a", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "a b " * 4 + "a", "x " + "a a b " * 4,
             "a a a a a a b a a a a a a", "a b a b a b a b c a b a b a b a b"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += [" ".join(nested(rng, 3)[:150]) for _ in range(200)]
    texts += [" ".join([rng.choice("abc") for _ in range(7)] * 9 + ["z"] * 20 + ["a", "b", "c"] * 11) for _ in range(20)]
    assert searched(texts) == [brute_runs(t.split()) for t in texts]


def test_runs_do_not_cross_texts():
    assert searched(["a a a", "a a a", "a a a a a a"]) == [[], [], [(0, 6, 1)]]
    assert searched(["b a a a a a a", "a a a a a a a"]) == [[(1, 6, 1)], [(0, 7, 1)]]


def test_long_periods_and_long_texts():
    words = [f"w{i}" for i in range(3000)]
    text = " ".join(["q"] + words * 4 + ["z"])
    assert searched([text])[0] == [(1, 12000, 3000)]
    assert searched(["x " * 300_000])[0] == [(0, 300_000, 1)]
    assert searched([" ".join(words * 3)])[0] == []


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(9)
    texts = [None, "", " \t\n", "one", "a " * 40, "a\x0bb a\x0cb\ta b\ra b", "a\x85b " * 9, "é ü " * 12, "x " * 70_000]
    texts += [" ".join(rng.choice(["ja", "nein", "vielleicht"]) for _ in range(rng.randint(1, 90))) for _ in range(150)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "a b " * 9), (4, "a " * 40)]


def test_query_rows_equal_brute_force(spark, docs, cases, tmp_path):
    small = [(i, t) for i, t in cases if t is None or len(t) < 1000]
    docs(small).write.parquet(f"{tmp_path}/documents.parquet")
    got = P.op13_basic_factors(spark, str(tmp_path)).collect()
    want = sorted(((i, *brute_row(i, t)) for i, t in small), key=repr)
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got), key=repr) == want
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in small if t)


def test_operator_with_clashing_names_and_no_rows(spark, docs, cases):
    frame = docs(cases, extra=["runs", "collapsed", "start"])
    rows = P.find_runs(frame).collect()
    assert len(rows) == len(cases)
    long = next(r for r in rows if r["doc_id"] == 8)
    assert [tuple(x) for x in long["runs"]] == [(0, 70_000, 1)] and long["collapsed"] == "x"
    assert P.find_runs(frame.limit(0)).collect() == []


def test_blocks_do_not_change_results(spark, docs, cases, monkeypatch):
    whole = P.find_runs(docs(cases)).collect()
    monkeypatch.setattr(P, "BLOCK_WORDS", 50)
    assert sorted(P.find_runs(docs(cases)).collect(), key=repr) == sorted(whole, key=repr)
