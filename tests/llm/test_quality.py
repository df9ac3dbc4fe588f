import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourse.llm import zstd_quality as q

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = q.op3_zstd_quality(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    y = np.array([r["quality"] for r in rows])
    p = np.array([r["predicted"] for r in rows])
    s = np.array([r["score"] for r in rows])
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (p == (s >= 0.3)).all() and (0 <= s).all() and (s <= 1).all()
    assert (p == y).mean() > 0.95 and p[y == 1].mean() > 0.97
    assert s[y == 1].mean() > s[y == 0].mean() + 0.5


def test_difference_reads_the_whole_text():
    good, bad = q.Compressor(b"good words and fine prose " * 50), q.Compressor(b"@@@### !!! %%% $$$ " * 50)
    head = "good words and fine prose " * 200
    assert q.difference(head, good, bad) > 0
    assert q.difference(head + "@@@### !!! %%% $$$ " * 4000, good, bad) < q.difference(head, good, bad)
    assert q.difference("", good, bad) == q.difference(None, good, bad) == 0.0


def test_isotonic_is_monotone_and_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x))).astype(float)
    at, share = q.isotonic(x, y, np.ones(4000))
    assert (np.diff(at) > 0).all() and (np.diff(share) >= 0).all()
    model = q.Model(b"", b"", at, share)
    assert np.abs(model.score(np.array([0.0, 1.0])) - [0.5, 0.88]).max() < 0.08


def test_odd_tables(spark, docs, prose):
    rng = random.Random(1)
    texts = [" ".join(prose(rng, 80)) if i % 2 else "!! %% " * 60 for i in range(200)]
    df = docs([*texts, None, "", "x" * 300_000], extra=("score", "label", "predicted"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1, 1), (None, 0), (5, None)], "doc_id long, quality int")
    out = q.score_quality(df, q.fit(df, labels))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == 203 and out.columns[-2:] == ["score", "predicted"] and "label" in out.columns
    assert rows[200]["score"] == rows[201]["score"]
    assert np.mean([rows[i]["predicted"] == i % 2 for i in range(200)]) > 0.95
    none = q.score_quality(df, q.fit(df, labels.limit(0)))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert q.score_quality(df.limit(0), q.fit(df, labels)).count() == 0


def test_fold_and_sample_leave_held_out_rows_alone(spark, docs):
    from bourse.llm.common import fold, label_sample
    df = docs({i: str(i) for i in range(300)})
    labels = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    got = label_sample(df, labels, "quality", 100).collect()
    import zlib
    assert len(got) == 100 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in got)
    assert {r["doc_id"]: r["f"] for r in df.select("doc_id", fold().alias("f")).collect()} == {
        i: zlib.crc32(str(i).encode()) % 5 for i in range(300)}


@pytest.mark.parametrize("texts", [[], ["a"], ["", ""]])
def test_small_dictionaries(texts):
    assert isinstance(q.dictionary(texts), bytes)
