"""The prefix trie of conversations, built as a burst trie.

1. A turn's id is 16 bytes of a SHA-256 over its role and text; texts play no
   further part.  Turns are numbered by a sort over ranges of (conversation, turn);
   what a conversation holds in earlier ranges is added from a table of one row a
   range.
2. Sequences that are equal throughout are one from here on, with a weight, so a
   conversation that a third of all conversations repeat is one suffix.
3. A prefix of d turns is known by (d, two 64-bit sums without carry of the hashes
   of (place, turn id)); such sums run along a sequence in chunks, so that one
   conversation of any length is spread over tasks.
4. Bursting.  A container holds the suffixes below one prefix; one that holds more
   than ``CONTAINER`` turns, of more than one sequence, becomes a trie node and
   bursts by next turn id.  Level by level that takes a job for each turn of a
   common prefix.  But how much any container would hold is a sum over the turns
   that pass its prefix, and a container bursts only if those above it do: one
   aggregation tells all nodes that burst (the heads).
5. What is left of a sequence below its last head is a suffix in a container.  A
   container of one suffix is a chain, whose nodes follow from sums along it, of
   any length; any other holds at most ``CONTAINER`` turns and is sorted and swept
   in one task.
6. Leaves and savings below a head are added up over heads by doubling distances:
   in round r each head adds what heads 2^r below hold, so as many rounds as the
   depth of the heads has binary digits.

Conversation ids that end at a node are joined in order and hashed: ranges of
(node, id) give strings of up to 4,096 ids each, which one task a node passes
through SHA-256 in order, a batch at a time.

Defined results.  Turns without conv_id belong to no conversation.  Null role and
text are empty.  Turns go by number, null first; equal numbers by turn id, so
rows that are repeated are turns each.  Extra columns play no part.  An empty
table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourse.llm.common import hot_join, stored, table

CONTAINER = 256          # turns in a container that is swept
CHUNK = 1024             # turns of one sequence that one task takes
BLOCK_IDS = 4096
BASE, SHARED = 100, 6    # of the contract: base conversations, modulus of shared turns

_KEY = ["depth", "x1", "x2"]
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


# --- turns -------------------------------------------------------------------------

def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(c, pos, tid, len) of every turn that has a conv_id: its place in its
    conversation, its id and the code points of its text."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    # the role's length parts it from the text
    tid = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"), tid.alias("tid"),
        F.char_length(text).cast("long").alias("len"))
    order = ["c", "turn", "tid"]
    laid = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select(F.spark_partition_id().alias("part"), "c", "tid", "len"))
    laid = stored(laid.mapInArrow(_number, "part int, c long, tid binary, len long, place long"), "trie-turns")
    # conversations at the ends of a range may go on in the next
    ends = laid.groupBy("part").agg(F.min("c").alias("a"), F.max("c").alias("b"))
    ends = ends.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    held = laid.join(F.broadcast(ends), "c").groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select("c", "part", before.alias("before")).where("before > 0")
    return (laid.join(F.broadcast(held), ["c", "part"], "left")
            .select("c", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "tid", "len"))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's place among the rows of its ``c``, which stand together."""
    last, count = None, 0
    for b in batches:
        c = b.column("c").to_numpy()
        if not len(c):
            continue
        new = np.concatenate([[c[0] != last], c[1:] != c[:-1]])
        at = np.arange(len(c))
        first = np.maximum.accumulate(np.where(new, at, 0))
        place = at - first + np.where(np.cumsum(new) == 0, count, 0)
        last, count = c[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place)], names=[*b.schema.names, "place"])


def _chunk(pos: str = "pos") -> Column:
    return F.floor(F.col(pos) / CHUNK).cast("long")


def _chunks(n: str) -> Column:
    """The chunks of a sequence of ``n`` > 0 turns."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / CHUNK).cast("long"))).alias("m")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of the rebuilt conversations: of c, the first h turns of
    c - c % 100, then c's own after its first h, with h = crc32(c) % 6."""
    n = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    n = n.select("c", "n", (F.crc32(F.col("c").cast("string")) % SHARED).cast("long").alias("h"),
                 (F.col("c") - F.col("c") % BASE).alias("base"))
    first = (turns.where((F.col("c") % BASE == 0) & (F.col("pos") < SHARED - 1)).groupBy(F.col("c").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "len"))).alias("first")))
    info = n.join(first, "base", "left").withColumn("taken", F.slice(F.coalesce("first", F.array()), F.lit(1), F.col("h").cast("int")))
    info = stored(info.select("c", "n", "h", "taken", F.size("taken").cast("long").alias("k")), "trie-rebuilt")
    shared = info.select("c", F.explode("taken").alias("t")).select("c", "t.pos", "t.tid", "t.len")
    own = turns.withColumn("m", _chunk()).join(info.select("c", "h", "k", _chunks("n")), ["c", "m"]).where("pos >= h")
    return (shared.unionByName(own.select("c", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "tid", "len")),
            info.select("c"))


# --- sequences and their prefixes ------------------------------------------------------

def _paths(turns: DataFrame) -> DataFrame:
    """Each turn with its prefix (x1, x2), its parent's (p1, p2), the length of
    its sequence and the code points from it on."""
    z = {"z1": F.xxhash64("tid", "pos"), "z2": F.xxhash64(F.lit("second"), "pos", "tid")}
    dealt = turns.withColumns({"m": _chunk(), **z}).repartition("c", "m")
    total = dealt.groupBy("c", "m").agg(F.bit_xor("z1").alias("t1"), F.bit_xor("z2").alias("t2"),
                                        F.sum("len").alias("t3"), F.count(F.lit(1)).alias("t4"))
    by = Window.partitionBy("c").orderBy("m")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    carry = total.select("c", "m", *[F.coalesce(F.bit_xor(t).over(before), zero).alias(t) for t in ("t1", "t2")],
                         F.coalesce(F.sum("t3").over(after), zero).alias("t3"),
                         F.sum("t4").over(Window.partitionBy("c")).alias("n"))
    w = Window.partitionBy("c", "m").orderBy("pos")
    here = dealt.withColumns({
        "r1": F.bit_xor("z1").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "r2": F.bit_xor("z2").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "r3": F.sum("len").over(w.rowsBetween(0, Window.unboundedFollowing))})
    x1, x2 = F.col("r1").bitwiseXOR(F.col("t1")), F.col("r2").bitwiseXOR(F.col("t2"))
    return here.join(carry, ["c", "m"]).select(
        "c", "m", "pos", (F.col("pos") + 1).alias("depth"), "tid", "len", "n", (F.col("r3") + F.col("t3")).alias("rest"),
        x1.alias("x1"), x2.alias("x2"), x1.bitwiseXOR(F.col("z1")).alias("p1"), x2.bitwiseXOR(F.col("z2")).alias("p2"))


def _ends(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(ended, ends_sha256) of each class of equal sequences, ``ended`` being the
    smallest id there."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        rep = None
        for b in batches:
            out = []
            for r, c in zip(b.column("rep").to_pylist(), b.column("c").to_pylist()):
                if held and (r != rep or len(held) == BLOCK_IDS):
                    out.append((rep, held[0], ",".join(map(str, held))))
                    held = []
                rep = r
                held.append(c)
            yield _rows(out)
        if held:
            yield _rows([(rep, held[0], ",".join(map(str, held)))])

    def _rows(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.string())], names=["rep", "a", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, sha = None, None
        for b in batches:
            done = []
            for r, ids in zip(b.column("rep").to_pylist(), b.column("ids")):
                if sha is not None and r == rep:
                    sha.update(b",")
                else:
                    if sha is not None:
                        done.append((rep, sha.hexdigest()))
                    rep, sha = r, hashlib.sha256()
                sha.update(ids.as_py().encode())
            yield _pairs(done)
        if sha is not None:
            yield _pairs([(rep, sha.hexdigest())])

    def _pairs(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                           pa.array([r[1] for r in rows], pa.string())], names=["rep", "ends_sha256"])

    several = members.where("w > 1").select("rep", "c")
    blocks = (several.repartitionByRange("rep", "c").sortWithinPartitions("rep", "c")
              .mapInArrow(join, "rep long, a long, ids string"))
    many = (blocks.repartition("rep").sortWithinPartitions("rep", "a").mapInArrow(digest, "rep long, ends_sha256 string"))
    one = classes.where("w = 1").select("rep", F.sha2(F.col("rep").cast("string"), 256).alias("ends_sha256"))
    return many.unionByName(one).withColumnRenamed("rep", "ended")


# --- containers --------------------------------------------------------------------------

def sweep(suffixes: list[tuple[int, int, list[bytes], list[int]]], depth: int, parent: int) -> list[list]:
    """The nodes of one container below ``depth``: suffixes (id, weight, turn
    ids, code points), all different, are sorted and swept with a stack.  A
    node's last value is the id of the suffix that ends there, if any."""
    done: list[list] = []
    stack: list[dict] = []
    top = {"c": parent, "w": 0, "kids": [], "leaves": 0, "saved": 0}

    def close(to: int) -> None:
        while len(stack) > to:
            node = stack.pop()
            above = stack[-1] if stack else top
            leaves = node["leaves"] or 1
            saved = node["saved"] + (node["w"] - 1) * node["len"]
            row = [node["c"], depth + len(stack) + 1, None, node["w"], len(node["kids"]), leaves, saved, node["end"]]
            for kid in node["kids"]:
                kid[2] = node["c"]
            done.append(row)
            above["kids"].append(row)
            above["c"] = node["c"] if above["c"] is None else min(above["c"], node["c"])
            above["w"] += node["w"]
            above["leaves"] += leaves
            above["saved"] += saved

    last: list[bytes] = []
    for c, w, ids, sizes in sorted(suffixes, key=lambda s: s[2]):
        same = 0
        while same < min(len(ids), len(last)) and ids[same] == last[same]:
            same += 1
        close(same)
        for at in range(same, len(ids)):
            stack.append({"c": None, "w": 0, "kids": [], "leaves": 0, "saved": 0, "len": sizes[at], "end": None})
        last_node = stack[-1]
        last_node["c"] = c if last_node["c"] is None else min(last_node["c"], c)
        last_node["w"] += w
        last_node["end"] = c
        last = ids
    close(0)
    for row in top["kids"]:
        row[2] = parent
    return done


_SWEPT = ", ".join(f"{c} long" for c in [*_NODE, "ended", "u1", "u2", "k"])


def _sweep_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by container, sequence and place."""
    where, rows, held = None, {}, []

    def flush():
        _, k, _, _, u1, u2, parent = where
        for r in sweep([(c, *v) for c, v in rows.items()], k, parent):
            held.append([*r, u1, u2, k])

    def made():
        return pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in (zip(*held) if held else [[]] * 11)],
                                          names=[*_NODE, "ended", "u1", "u2", "k"])

    for b in batches:
        cols = [b.column(x).to_pylist() for x in ("c", "w", "tid", "len", "k", "c1", "c2", "u1", "u2", "parent")]
        for c, w, tid, size, k, c1, c2, u1, u2, parent in zip(*cols):
            key = (None, k, c1, c2, u1, u2, parent)
            if key != where:
                if where:
                    flush()
                where, rows = key, {}
            _, ids, sizes = rows.setdefault(c, (w, [], []))
            ids.append(tid)
            sizes.append(size)
        yield made()
        held.clear()
    if where:
        flush()
    yield made()


def _summed(heads: DataFrame) -> DataFrame:
    """``heads`` (key, up: parent's key or null, leaves, saved) with both summed
    over each head's subtree."""
    deepest = heads.agg(F.max("depth")).first()[0] or 0
    far = 1
    while far <= deepest:
        up = [f"u_{k}" for k in _KEY]
        below = heads.where(F.col("u_depth").isNotNull()).groupBy(*up).agg(
            F.count(F.lit(1)).alias("n_up"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        below = below.withColumnsRenamed(dict(zip(up, _KEY)))
        # who is twice as far up, by each head that is far up
        jump = stored(below.join(heads.select(*_KEY, *[F.col(u).alias(f"v_{u}") for u in up]), _KEY), "trie-jump")
        added = heads.join(jump.select(*_KEY, "more_leaves", "more_saved"), _KEY, "left")
        added = added.withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")})
        side = jump.select(*[F.col(k).alias(f"u_{k}") for k in _KEY], "n_up", *[f"v_{u}" for u in up])
        heads = hot_join(added.drop("more_leaves", "more_saved"), side, up, "n_up", F.xxhash64(*_KEY))
        heads = stored(heads.withColumns({u: F.col(f"v_{u}") for u in up}).select(*_KEY, *up, "leaves", "saved"), "trie-heads")
        far *= 2
    return heads.select(*_KEY, "leaves", "saved")


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of sequences ``turns`` (c, pos: from 0 without
    gaps, tid, len); ``ids`` (c) has every sequence once, also those without turns."""
    paths = stored(_paths(turns), "trie-paths")
    ends = paths.where("depth = n").select("c", *_KEY)
    none = ids.join(ends.select("c"), "c", "left_anti").select(
        "c", *[F.lit(0).cast("long").alias(k) for k in _KEY])
    ends = ends.unionByName(none)
    classes = stored(ends.groupBy(*_KEY).agg(F.min("c").alias("rep"), F.count(F.lit(1)).alias("w")), "trie-classes")
    members = hot_join(ends, classes, _KEY, "w", F.xxhash64("c"))
    last = _ends(members, classes)

    reps = classes.where("depth > 0").select(F.col("rep").alias("c"), "w", _chunks("depth"))
    rows = stored(paths.join(reps, ["c", "m"]), "trie-sequences")
    passed = rows.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n_reps"), F.sum(F.col("n") - F.col("pos")).alias("turns"), F.min("c").alias("conv_id"),
        F.sum("w").alias("n_convs"), F.min("len").alias("size"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    heads = stored(passed.where((F.col("turns") > CONTAINER) & (F.col("n_reps") > 1)).drop("turns"), "trie-bursts")
    whole = ids.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")

    tagged = stored(hot_join(rows, heads.select(*_KEY, "n_reps", "conv_id"), _KEY, "n_reps", F.xxhash64("c", "pos")), "trie-tagged")
    burst = F.col("n_reps").isNotNull()

    def at(c: str, first: bool) -> Column:     # of a sequence's last head, or of its container
        return F.min_by(F.when(~burst, F.col(c)), F.when(~burst, F.col("pos"))) if first \
            else F.max_by(F.when(burst, F.col(c)), F.when(burst, F.col("pos")))

    zero = F.lit(0).cast("long")
    own = tagged.groupBy("c").agg(
        F.count_if(burst).alias("k"), at("x1", True).alias("c1"), at("x2", True).alias("c2"), F.max("n").alias("n"),
        F.coalesce(at("x1", False), zero).alias("u1"), F.coalesce(at("x2", False), zero).alias("u2"),
        at("conv_id", False).alias("up"))
    own = own.where("k < n").crossJoin(F.broadcast(whole.select(F.col("conv_id").alias("root"))))     # one row
    own = stored(own.withColumn("parent", F.coalesce("up", "root")).drop("up", "root"), "trie-containers")
    size = own.groupBy("k", "c1", "c2").agg(F.count(F.lit(1)).alias("in_container"))
    spread = own.join(size, ["k", "c1", "c2"]).select("c", "k", "c1", "c2", "u1", "u2", "parent", "in_container", _chunks("n"))
    body = tagged.where(~burst).drop("n_reps", "conv_id").join(spread, ["c", "m"])

    chains = body.where("in_container = 1").select(
        F.col("c").alias("conv_id"), "depth", F.when(F.col("pos") == F.col("k"), F.col("parent")).otherwise(F.col("c")).alias("parent_conv_id"),
        F.col("w").alias("n_convs"), F.when(F.col("depth") < F.col("n"), 1).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), ((F.col("w") - 1) * F.col("rest")).alias("saved_tokens"),
        F.when(F.col("depth") == F.col("n"), F.col("c")).alias("ended"), "u1", "u2", "k")
    place = ["k", "c1", "c2"]
    swept = (body.where("in_container > 1").select("c", "pos", "w", "tid", "len", *place, "u1", "u2", "parent")
             .repartition(*place).sortWithinPartitions(*place, "c", "pos").mapInArrow(_sweep_all, _SWEPT))
    below = stored(chains.unionByName(swept), "trie-nodes")

    # heads: what their containers hold, then what the heads below them hold
    root = whole.select("conv_id", "n_convs", zero.alias("size"), *[zero.alias(k) for k in _KEY],
                        *[F.lit(None).cast("long").alias(f"u_{k}") for k in _KEY])
    inner = heads.select("conv_id", "n_convs", "size", *_KEY, (F.col("depth") - 1).alias("u_depth"), F.col("p1").alias("u_x1"),
                         F.col("p2").alias("u_x2")).unionByName(root)
    tops = below.where("depth = k + 1").groupBy(F.col("k").alias("depth"), F.col("u1").alias("x1"), F.col("u2").alias("x2")).agg(
        F.count(F.lit(1)).alias("tops"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    kids = inner.where("u_depth is not null").groupBy(*[F.col(f"u_{k}").alias(k) for k in _KEY]).agg(F.count(F.lit(1)).alias("kids"))
    inner = inner.join(tops, _KEY, "left").join(kids, _KEY, "left")
    children = F.coalesce("tops", zero) + F.coalesce("kids", zero)
    inner = stored(inner.withColumns({
        "n_children": children, "leaves": F.when(children == 0, 1).otherwise(F.coalesce("leaves", zero)).cast("long"),
        "saved": F.coalesce("saved", zero) + (F.col("n_convs") - 1) * F.col("size")}), "trie-inner")
    total = _summed(inner.select(*_KEY, *[f"u_{k}" for k in _KEY], "leaves", "saved"))
    names = stored(inner.where("kids > 0").select(*[F.col(k).alias(f"u_{k}") for k in _KEY], F.col("kids").alias("n_up"),
                                                  F.col("conv_id").alias("parent_conv_id")), "trie-parents")
    named = hot_join(inner.drop("leaves", "saved"), names, [f"u_{k}" for k in _KEY], "n_up", F.xxhash64(*_KEY))
    ended = classes.select(*_KEY, F.col("rep").alias("ended"))
    top = named.join(total, _KEY).join(ended, _KEY, "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                                         F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ended")
    nodes = below.select(*_NODE, "ended").unionByName(top)
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return (nodes.where("ended is not null").join(last, "ended").select(*_NODE, "ends_sha256")
            .unionByName(nodes.where("ended is null").select(*_NODE, nobody.alias("ends_sha256"))))


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations, a row a node."""
    return trie(*rebuilt(ordered_turns(table(spark, sf_dir, "conversations"))))
