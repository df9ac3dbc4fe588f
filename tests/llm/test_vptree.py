import numpy as np
import pytest
from pyspark.sql import functions as F

from bourse.llm import vptree


def brute(x, ids, queries, k):
    out = {}
    for i in queries:
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        out[int(ids[i])] = [int(ids[j]) for j in np.lexsort((ids, d)) if j != i][:k]
    return out


@pytest.mark.parametrize("kind", ["random", "ties", "copies"])
def test_factor_one_is_exact(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 6))
    if kind == "ties":
        x = np.round(x)
    if kind == "copies":
        x[300:] = x[0]
    names = rng.permutation(900)
    q = x[::50]
    tree = vptree.Tree(x)
    found = vptree.Search(tree, q, np.full(len(q), np.inf), 7, 1.0, names).found
    for i, own in enumerate(found):
        d = np.sqrt(((x - q[i]) ** 2).sum(axis=1))
        best = np.lexsort((names, d))[:7]
        assert [n for _, n, _ in own] == names[best].tolist()


def test_larger_factors_look_at_less():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 3))
    q = x[::40]
    tree = vptree.Tree(x)
    looked = [vptree.Search(tree, q, np.full(len(q), np.inf), 5, f, np.arange(4000)).looked for f in (1.0, 2.0, 6.0)]
    assert looked[0] > looked[1] > looked[2]


def test_spark_search_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 4)), 1)
    x[100:230] = x[7]                                  # a third of all rows share a vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    x = x.astype(np.float32).astype(float)
    rows = vptree.nearest(df.withColumn("score", F.lit("own")), F.col("vec_id") % 20 == 0, factor=1.0,
                          shard_rows=60, block_rows=7).collect()
    want = brute(x, np.arange(400), range(0, 400, 20), 10)
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["score"] == pytest.approx(np.sqrt(((x[r["query_id"]] - x[r["vec_id"]]) ** 2).sum()), abs=1e-12)
    assert got == want


def test_production_factor_recall(spark):
    sf = "/root/testdata/sf0.1"
    p = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.stack(p["embedding"]).astype(float), p["vec_id"].to_numpy()
    want = brute(x, ids, np.flatnonzero(ids % 100 == 0), 10)
    rows = vptree.op2_vptree(spark, sf).collect()
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert {q: len(v) for q, v in got.items()} == {q: 10 for q in want}
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (None, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (1, [1.0, 0.5]), (100, [2.0, 0.0]), (100, [9.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in vptree.nearest(df, F.col("vec_id") % 100 == 0).collect()}
    assert got == {(0, 1): 1, (0, 2): 100, (100, 1): 0, (100, 2): 1}     # id 100 keeps its smaller vector
    assert vptree.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert vptree.nearest(df.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("inner", [4, 8, 16, 64])
def test_recall_in_subspaces(spark, inner):
    """Vectors of 64 dimensions that lie in a subspace, or are spread over all."""
    rng = np.random.default_rng(inner)
    x = (rng.normal(size=(12_000, inner)) @ rng.normal(size=(inner, 64))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    rows = vptree.nearest(df, F.col("vec_id") % 100 == 0, shard_rows=3000).collect()
    want = brute(x.astype(float), np.arange(len(x)), range(0, len(x), 100), 10)
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    found = sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values()))
    assert found >= 0.9, (inner, found)


def test_the_factor_goes_by_the_vectors():
    rng = np.random.default_rng(1)
    flat = rng.normal(size=(4000, 4)) @ rng.normal(size=(4, 64))
    spread = rng.normal(size=(4000, 64))
    assert vptree.measured_factor(flat, 10) < vptree.measured_factor(spread, 10)
    assert vptree.measured_factor(flat[:20], 10) == 1.0
    assert vptree.measured_factor(np.repeat(flat[:1], 500, axis=0), 10) >= 1.0
