"""Approximate nearest neighbours by vantage-point trees, one for each shard.

Equal vectors are one class with its smallest ids, as many as a query can need,
so a vector that a third of all rows share is searched once.  Classes are dealt
into shards of about ``SHARD_ROWS`` by a hash, queries into blocks of about
``BLOCK_ROWS``; each shard meets each block in one task, which builds the shard's
tree and takes all the block's queries through it together.

A node splits its rows at the median distance from a vantage point.  The triangle
inequality bounds the distance from a query to either half; a half is skipped if
the bound times ``factor`` exceeds the query's k-th distance so far.  Factor 1
skips only what cannot matter and finds exactly the k nearest; larger factors
skip more.  How much a factor loses depends on the vectors: little where they are
spread over all dimensions, much where they lie in a few.  So the factor is the
largest of ``FACTORS`` that finds ``RECALL`` of the true neighbours when sample
vectors are sought among the sample, in a tree of their own.  Every query starts with its k-th distance within a bounded sample of
``SAMPLE_ROWS`` vectors, a true upper limit, so that pruning works from the root.

Defined results.  Vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id; an id that comes with several
vectors keeps the smallest.  Vectors of different lengths are never compared.
Ties go to the smaller id.  With fewer than k candidates all are returned; extra
columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import stored, table

K = 10
FACTORS = (8.0, 6.0, 5.0, 4.0, 3.0, 2.5, 2.0, 1.5, 1.0)
RECALL = 0.98
TRIALS = 200
SHARD_ROWS = 16_384
BLOCK_ROWS = 16_384
SAMPLE_ROWS = 4_096
LEAF_ROWS = 128
#: Rounding of squared distances that go through a matrix product.
SLACK = 1e-9


class Tree:
    """Rows of ``x`` in vantage-point order: each node is a range of rows whose
    first row is the vantage point."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.x = np.ascontiguousarray(x, dtype=np.float64)
        self.order = np.arange(len(x))
        self.nodes: list[tuple] = []       # (lo, hi, None) or (lo, hi, (left, right, bounds))
        self._rng = np.random.default_rng(seed)
        self.root = self._build(0, len(x))
        self.x = self.x[self.order]
        self.square = (self.x ** 2).sum(axis=1)

    def _build(self, lo: int, hi: int) -> int:
        at = len(self.nodes)
        self.nodes.append((lo, hi, None))
        if hi - lo > LEAF_ROWS:
            rows = self.order[lo:hi]
            # of a few random rows, the one whose distances spread most
            picks = self._rng.choice(len(rows), 5, replace=False)
            some = rows[self._rng.choice(len(rows), min(64, len(rows)), replace=False)]
            spread = [np.std(np.linalg.norm(self.x[some] - self.x[rows[p]], axis=1)) for p in picks]
            pick = picks[int(np.argmax(spread))]
            rows[0], rows[pick] = rows[pick], rows[0]
            far = np.linalg.norm(self.x[rows[1:]] - self.x[rows[0]], axis=1)
            middle = len(far) // 2
            # halves by rank, so that equal distances cannot unbalance the tree
            split = np.argpartition(far, middle)
            rows[1:] = rows[1:][split]
            far = far[split]
            bounds = (far[:middle].min(), far[:middle].max(), far[middle:].min(), far[middle:].max())
            self.order[lo:hi] = rows
            self.nodes[at] = (lo, hi, (self._build(lo + 1, lo + 1 + middle), self._build(lo + 1 + middle, hi), bounds))
        return at


class Search:
    """The k nearest rows of a tree for many queries at once."""

    def __init__(self, tree: Tree, queries: np.ndarray, tau: np.ndarray, k: int, factor: float, names: np.ndarray):
        self.tree, self.k, self.factor = tree, k, factor
        self.q = np.ascontiguousarray(queries, dtype=np.float64)
        self.q_square = (self.q ** 2).sum(axis=1)
        self.tau = tau.astype(float).copy()
        self.names = names[tree.order]          # decide ties
        self.found: list[list[tuple[float, int, int]]] = [[] for _ in queries]      # (distance, name, row)
        self.looked = 0
        if len(tree.x):
            self._visit(tree.root, np.arange(len(queries)))

    def _offer(self, queries: np.ndarray, rows: np.ndarray) -> None:
        """Pairs that may be among the k nearest, measured exactly."""
        distance = np.sqrt(((self.q[queries] - self.tree.x[rows]) ** 2).sum(axis=1))
        for q, row, d in zip(queries.tolist(), rows.tolist(), distance.tolist()):
            if d <= self.tau[q]:
                own = self.found[q]
                own.append((d, int(self.names[row]), row))
                if len(own) >= 4 * self.k:
                    self._trim(q)
        for q in np.unique(queries).tolist():
            if len(self.found[q]) >= self.k:
                self._trim(q)

    def _trim(self, q: int) -> None:
        own = sorted(self.found[q])[:self.k]
        self.found[q] = own
        if len(own) == self.k:
            self.tau[q] = min(self.tau[q], own[-1][0])

    def _visit(self, node: int, queries: np.ndarray) -> None:
        lo, hi, inner = self.tree.nodes[node]
        if not len(queries):
            return
        if inner is None:
            self.looked += len(queries) * (hi - lo)
            square = self.q_square[queries, None] + self.tree.square[None, lo:hi] - 2 * (self.q[queries] @ self.tree.x[lo:hi].T)
            limit = self.tau[queries] ** 2 + SLACK * (1 + self.q_square[queries])
            a, b = np.nonzero(square <= limit[:, None] * (1 + SLACK))
            self._offer(queries[a], lo + b)
            return
        left, right, (l0, l1, r0, r1) = inner
        self.looked += len(queries)
        d = np.sqrt(((self.q[queries] - self.tree.x[lo]) ** 2).sum(axis=1))
        near = d <= self.tau[queries]
        self._offer(queries[near], np.full(int(near.sum()), lo))
        first = d <= (l1 + r0) / 2
        for half, other in ((first, right), (~first, left)):
            self._visit(left if other == right else right, queries[half])
        for half, other, low, high in ((first, right, r0, r1), (~first, left, l0, l1)):
            bound = np.maximum(np.maximum(low - d[half], d[half] - high), 0)
            self._visit(other, queries[half][bound * self.factor <= self.tau[queries[half]] * (1 + SLACK)])


def usable(vec: Column) -> Column:
    """Whether a vector of doubles takes part."""
    odd = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~odd & F.exists(vec, lambda v: v != 0)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


def measured_factor(sample: np.ndarray, k: int, recall: float = RECALL) -> float:
    """The largest factor with which ``TRIALS`` rows of ``sample`` find that share
    of their k nearest, each with a first limit from a quarter of the rows, as in
    the search itself."""
    names = np.arange(len(sample))
    q = sample[::max(1, len(sample) // TRIALS)]
    if len(sample) <= 4 * (k + 1):
        return 1.0
    tree = Tree(sample)
    _, tau = start(sample[::4], q, k)
    true = start(sample, q, k)[0]
    for factor in FACTORS:
        found = Search(tree, q, tau, k + 1, factor, names).found
        hits = sum(len({name for _, name, _ in own} & set(t.tolist())) for own, t in zip(found, true))
        if hits >= recall * true.size:
            return factor
    return 1.0


def nearest(vectors: DataFrame, is_query: Column, k: int = K, factor: float | None = None,
            shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of ``vectors``
    (vec_id, embedding) of each row for which ``is_query`` (of vec_id) holds.
    ``factor``: see above; None measures it, 1 is exact."""
    spark = vectors.sparkSession
    vec = F.col("embedding").cast("array<double>")
    rows = (vectors.where(F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
            .where(usable(F.col("vec"))).groupBy("vec_id").agg(F.min("vec").alias("vec")))
    rows = stored(rows, "vectors")
    # classes of equal vectors; a query needs at most k of them besides itself
    place = Window.partitionBy("vec").orderBy("vec_id")
    classes = stored(rows.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1)
                     .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vector-classes")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vec")
    shards = max(1, -(-classes.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    # a bounded sample gives each query its first candidates, and so a limit to prune by
    taken = (classes.select("vec", "ids").orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE_ROWS).collect())
    by_size: dict[int, tuple[list, list]] = {}
    for r in taken:
        own = by_size.setdefault(len(r["vec"]), ([], []))
        own[0].append(r["vec"])
        own[1].append(r["ids"])
    known = {n: (np.array(x), ids) for n, (x, ids) in by_size.items()}
    factors = {n: measured_factor(x, k) if factor is None else factor for n, (x, _) in known.items()}
    sample = spark.sparkContext.broadcast(known)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            x, q = _matrix(left.column("vec")), _matrix(right.column("vec"))
            ids = left.column("ids").to_pylist()
            names = np.array([i[0] for i in ids])
            query_ids = right.column("query_id").to_pylist()
            own, first = sample.value.get(x.shape[1], (np.empty((0, x.shape[1])), []))
            rows, tau = start(own, q, k)
            found = Search(Tree(x), q, tau, k + 1, factors.get(x.shape[1], factor or 1.0), names)
            order = found.tree.order
            for i, (query, hits) in enumerate(zip(query_ids, found.found)):
                near = {(d, n) for d, _, row in hits for n in ids[order[row]] if n != query}
                for row in rows[i]:
                    d = float(np.sqrt(((q[i] - own[row]) ** 2).sum()))
                    near.update((d, n) for n in first[row] if n != query)
                out.extend((query, n, d) for d, n in sorted(near)[:k])
        cols = list(zip(*out)) or [()] * 3
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])

    size = F.size("vec").alias("dims")
    data = classes.select(size, F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).alias("shard"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec", "ids")
    asked = queries.select(size, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                           F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), "vec", "query_id")
    key = ["dims", "shard", "block"]
    found = (data.groupBy(*key).cogroup(asked.groupBy(*key))
             .applyInArrow(search, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))     # shards repeat the sample
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def start(sample: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the k + 1 nearest rows of the sample (the query itself may
    be among them), and the largest of their distances: no class beyond it can
    be needed.  A sample with fewer rows sets no limit."""
    n = min(k + 1, len(sample))
    rows, limit = [np.empty((0, n), dtype=np.int64)], [np.empty(0)]
    for at in range(0, len(q), 256):
        part = q[at:at + 256]
        square = (part ** 2).sum(axis=1)[:, None] + (sample ** 2).sum(axis=1)[None] - 2 * part @ sample.T
        rows.append(np.argsort(square, axis=1, kind="stable")[:, :n])
        limit.append(np.take_along_axis(square, rows[-1][:, -1:], axis=1)[:, 0] if n > k else np.full(len(part), np.inf))
    return np.concatenate(rows), np.sqrt(np.maximum(np.concatenate(limit), 0) + 1e-6)


# --- query ---------------------------------------------------------------------

def op2_vptree(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
