import random

import numpy as np
import pyarrow as pa

from bourse.llm import toxicity as x
from bourse.llm.common import word_hashes

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = x.op4_cnn_toxicity(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    y = np.array([r["toxic"] for r in rows])
    p = np.array([r["predicted"] for r in rows])
    s = np.array([r["score"] for r in rows])
    assert (p == (s >= 0.5)).all() and (0 <= s).all() and (s <= 1).all()
    assert p[y == 1].mean() > 0.8 and p[y == 0].mean() < 0.02


def test_batches_do_not_change_scores():
    rng = np.random.default_rng(2)
    texts = ["bad word here", "", "fine", "a " * 3000 + "bad"] + [" ".join(rng.choice(list("abcdef"), 8)) for _ in range(30)]
    model = x.train([*texts, "bad bad"] * 3, np.array([1, 0, 0, 1] + [0] * 30 + [1] + [1, 0, 0, 1] + [0] * 30 + [1]
                                                      + [1, 0, 0, 1] + [0] * 30 + [1], dtype=float))
    whole = model.score(texts)
    assert np.allclose(whole, [model.score([t])[0] for t in texts], atol=1e-6)


def test_pooling_finds_a_word_anywhere(prose):
    rng = random.Random(3)
    clean = [" ".join(prose(rng, 120)) for _ in range(150)]
    toxic = []
    for t in clean:
        words = t.split()
        words.insert(rng.randrange(len(words)), rng.choice(["idiotish", "scummy"]))
        toxic.append(" ".join(words))
    model = x.train(clean + toxic, np.array([0.0] * 150 + [1.0] * 150))
    long = " ".join(" ".join(prose(rng, 400)) for _ in range(10))
    a, b = model.logits(x.words_of([long, long + " Scummy!"]))
    assert b > a


def test_languages_and_thresholds():
    words = x.words_of(["the house of the king", "der Hund und die Katze", "les amis et les autres", "los perros y el gato", ""])
    assert words.languages().tolist() == [0, 1, 2, 3, 0]
    assert 2 < x.best_threshold(np.array([0.0, 1, 2, 3, 4]), np.array([0, 0, 0, 1, 1.0])) < 3
    assert x.best_threshold(np.array([1.0, 2]), np.array([1.0, 1])) is None


def test_word_hashes_are_of_whole_words():
    a, owner = word_hashes(["Ab ab, AB.c", "", None or "é" * 500 + " x", "x " + "é" * 500])
    assert owner.tolist() == [0, 0, 0, 0, 2, 2, 3, 3]
    assert a[0] == a[1] == a[2] != a[3] and a[4] == a[7] and a[5] == a[6] and a[4] != a[5]
    _, _, p = word_hashes(["abcdef abcdxx ab"], 4)
    assert p[0] == p[1] != p[2]


def test_odd_tables(spark, docs):
    df = docs([(1, None), (1, None), (None, ""), (3, "word " * 50_000)], extra=("score", "logits"))
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    out = x.score_toxicity(df, x.fit(df, labels))
    assert {r["score"] for r in out.collect()} == {0.5} and "logits" in out.columns
    one = spark.createDataFrame([(1, 1), (3, 0), (7, 1), (None, 0)], "doc_id long, toxic int")
    assert x.score_toxicity(df, x.fit(df, one)).count() == 4
    assert x.score_toxicity(df.limit(0), x.fit(df, one)).count() == 0


def test_every_labelled_text_trains_or_calibrates(spark, docs, prose, monkeypatch):
    """More labelled documents of a class than any sample held, in several pieces."""
    rng = random.Random(4)
    texts = [" ".join(prose(rng, 12)) + (" scummy" if i % 2 else "") for i in range(600)]
    df = docs(list(enumerate(texts)) + [(5000, "word " * 30_000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)] + [(5000, 0)], "doc_id long, toxic int")
    own = {r["doc_id"]: r for r in x.labelled_texts(df, labels, "toxic").collect()}
    assert len(own) > 450
    monkeypatch.setattr(x, "PIECE_TEXTS", 100)
    seen = {}
    trained, calibrated = x.train_all, x.output_steps
    monkeypatch.setattr(x, "train_all", lambda t, n, size: seen.update(train=t.count(), n=int(n.sum())) or trained(t, n, size))
    monkeypatch.setattr(x, "output_steps", lambda t, m: seen.update(steps=calibrated(t, m)) or seen["steps"])
    model = x.fit(df, labels)
    held = sum(r["part"] == 3 for r in own.values())
    assert seen["train"] == seen["n"] == len(own) - held and seen["steps"][:, 3].sum() == held
    score = {r["doc_id"]: r["predicted"] for r in x.score_toxicity(df, model).collect()}
    assert np.mean([score[i] == i % 2 for i in range(600)]) > 0.95


def test_an_epoch_is_the_average_of_its_pieces(spark, prose):
    rng = random.Random(5)
    texts = [" ".join(prose(rng, 20)) + (" scummy" if i % 2 else "") for i in range(80)]
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, y int")
    rows = x.in_pieces(df, 2)
    held_by, n = x.held_counts(rows)
    assert n.tolist() == [40, 40] and held_by[1].max() == 40
    state, weights = x.initial(held_by, n), x.class_weights(n)
    got = x.mixed_pass(rows, state, weights, 0, 8)
    made = []
    for piece in (0, 1):
        own = sorted(r["doc_id"] for r in rows.where(f"piece = {piece}").collect())
        y = np.array([float(i % 2) for i in own])
        each = state.copy()
        x.one_pass(each, [x.word_rows(texts[i]) for i in own], y, weights[y.astype(int)], x.RATE, np.random.default_rng([x.SEED, 0, piece]))
        made.append((each, np.unique(np.concatenate([x.word_rows(texts[i]) for i in own]))))
    assert np.allclose(got.flat, (made[0][0].flat + made[1][0].flat) / 2, atol=1e-6)
    only = np.setdiff1d(made[0][1], made[1][1])
    assert np.allclose(got.lookup[only], made[0][0].lookup[only], atol=1e-6)
    both = np.intersect1d(made[0][1], made[1][1])
    assert np.allclose(got.lookup[both], (made[0][0].lookup[both] + made[1][0].lookup[both]) / 2, atol=1e-6)


def test_cut_of_groups():
    rng = np.random.default_rng(6)
    out = rng.normal(size=200)
    y = (out + rng.normal(size=200) > 0).astype(float)
    t = x.best_threshold(out, y)
    f1 = [2 * y[out > c].sum() / ((out > c).sum() + y.sum()) for c in out]
    assert 2 * y[out > t].sum() / ((out > t).sum() + y.sum()) >= max(f1) - 1e-9
    steps = np.column_stack([rng.integers(0, 4, 200), out, out, np.ones(200), y])
    m = x.merged(steps)
    assert m[:, 2].sum() == 200 and abs(x.best_cut(*m.T) - t) < 0.05


def test_models_travel_whole(prose):
    import pickle
    rng = random.Random(7)
    texts = [" ".join(prose(rng, 20)) + (" scummy" if i % 2 else "") for i in range(40)]
    y = np.array([float(i % 2) for i in range(40)])
    model = x.train(texts, y)
    back = pickle.loads(pickle.dumps(model))
    assert (back.table == model.table).all() and (back.score(texts) == model.score(texts)).all()
    held_by = np.zeros((2, x.ROWS))
    held_by[1, 5:50] = 9
    state = x.initial(held_by, np.array([20, 20]))
    state.seen[7] = 3
    back = pickle.loads(pickle.dumps(state))
    assert all((getattr(back, f) == getattr(state, f)).all() for f in ("lookup", "live", "seen", "flat", "m", "v"))


def test_a_piece_is_gathered_from_few_rows_at_a_time(monkeypatch):
    sizes, docs = [], x._docs
    monkeypatch.setattr(x, "_docs", lambda b: sizes.append(b.num_rows) or docs(b))
    words = [np.full((1 + i % 3, 3), i, dtype=np.int32) for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"piece": [i // 1500 for i in range(2000)], "y": [i % 2 for i in range(2000)],
                                        "words": [w.tobytes() for w in words]})
    got = list(x._pieces(iter([batch])))
    assert [(p, len(d)) for p, d, _ in got] == [(0, 1500), (1, 500)]
    assert all((a == b).all() for a, b in zip([d for _, own, _ in got for d in own], words))
    assert [c for _, _, y in got for c in y.tolist()] == [i % 2 for i in range(2000)]
    assert max(sizes) <= 512
