import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.llm import burst_trie as B
from bourse.llm import common

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COLUMNS = [*B._NODE, "ends_sha256"]


def brute(rows):
    """Nodes by walking every prefix of every rebuilt conversation."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        own_saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own_saved
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def nodes(spark, rows, tmp_path, name, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("clash")).withColumn("c", F.lit(0.5))
    df.repartition(parts).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    got = B.op12_burst_trie(spark, f"{tmp_path}/{name}").collect()
    return sorted(tuple(r[c] for c in COLUMNS) for r in got)


def cases():
    rng = random.Random(3)
    word = lambda: rng.choice(["hi", "yes", "no", "é", "ok then", ""])
    rows = []
    for c in range(-5, 330):
        if c in (100, 7):      # no such conversation, an absent base
            continue
        common_start = [("system", "be nice")] if c % 3 else []
        seq = common_start + [(rng.choice(["user", "bot"]), word()) for _ in range(rng.randint(1, 9))]
        if 210 <= c < 260:     # copies
            seq = [("system", "be nice"), ("user", "same"), ("bot", "same"), ("user", "x"), ("bot", "y"), ("user", "z"), ("bot", "end")]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(seq)]
    rows += [(400, None, "user", "first"), (400, 0, None, None), (400, 5, "user", ""), (400, 3, "", "user"),
             (None, 1, "user", "nobody's"), (500, 1, "user", "once"), (601, 2, "user", "few"), (7_000_000_123, 1, "u", "far")]
    # one long conversation, and another that shares most of it
    rows += [(900, t, "user", f"turn {t % 50}") for t in range(700)]
    rows += [(800 + 100 * 12, t, "user", f"turn {t % 50}" if t < 600 else "other") for t in range(650)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("container, chunk, share, ids", [(256, 1024, 1000, 4096), (20, 64, 3, 7), (1, 1000, 1000, 4096)])
def test_nodes_equal_brute_force(spark, tmp_path, monkeypatch, container, chunk, share, ids):
    monkeypatch.setattr(B, "CONTAINER", container)
    monkeypatch.setattr(B, "CHUNK", chunk)
    monkeypatch.setattr(B, "BLOCK_IDS", ids)
    monkeypatch.setattr(common, "SHARE", share)
    rows = cases()
    if container == 1:      # every shared prefix bursts
        rows = [r for r in rows if r[0] not in (900, 2000)]
    got = nodes(spark, rows, tmp_path, "a")
    assert got == brute(rows)
    assert max(r[3] for r in got if r[1] == 3) > 20 and any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)


def test_repeated_rows_are_turns_each(spark, tmp_path):
    rows = [(1, 1, "u", "a"), (1, 1, "u", "a"), (1, 1, "u", "a"), (2, 1, "u", "a"), (2, 2, "u", "a"), (3, 1, "u", "a" * 50_000)] * 2
    assert nodes(spark, rows, tmp_path, "b") == brute(rows)


def test_no_conversations(spark, tmp_path):
    assert nodes(spark, [], tmp_path, "c") == []
    assert nodes(spark, [(None, 1, "u", "x")], tmp_path, "d") == []


def test_one_turnless_conversation(spark, tmp_path):
    c = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6)
    got = nodes(spark, [(c, 1, "u", "x")], tmp_path, "e")
    assert got == brute([(c, 1, "u", "x")]) and len(got) == 1 and got[0][5] == 1


def test_sweep():
    # two suffixes with a common beginning, one a prefix of the other
    got = B.sweep([(5, 2, [b"a", b"b"], [3, 4]), (4, 1, [b"a"], [3]), (9, 1, [b"a", b"c"], [3, 1])], 1, 1)
    assert sorted(got) == [[4, 2, 1, 4, 2, 2, 4 * 1 + 3 * 3, 4], [5, 3, 4, 2, 0, 1, 4, 5], [9, 3, 4, 1, 0, 1, 0, 9]]
