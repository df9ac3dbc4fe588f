import corpus_pipeline as cp
from bourse.llm import catalog, simhash
from bourse.llm.common import table
from test_packing import check          # the round trip of pieces
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.01"


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "near duplicates", "benchmark leaks", "packing"]
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
    assert [int(k[2:].split("_")[0]) for k in catalog.QUERIES if k != "pipeline"] == list(range(1, 14))


def test_each_stage_against_brute_force(spark):
    from bourse.llm.common import stored
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "test-stage")
        after = docs.collect()
        seen[name] = (before, after)
        if name != "packing":
            assert docs.columns == columns and len({r["doc_id"] for r in after}) == len(after)

    before, after = seen["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in after}
    clean = [i for i in before if labels.get(i) == 0]
    toxic = [i for i in before if labels.get(i) == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in toxic) <= 0.2 * len(toxic)
    assert all(r == before[r["doc_id"]] for r in after)

    before, after = seen["line dedup"]
    assert {r["doc_id"] for r in after} == set(before)
    first = {}
    for i in sorted(before):
        first.setdefault(before[i]["text"], i)
    for r in after:
        old = before[r["doc_id"]]
        assert len(r["text"]) <= len(old["text"]) and r["n_chars"] == len(r["text"])
        if old["text"].count("\n") > 6 and first[old["text"]] != r["doc_id"]:
            assert len(r["text"]) < 0.5 * len(old["text"])

    before, after = seen["near duplicates"]
    want = brute_components({i: brute_fingerprint(r["text"]) for i, r in before.items()})
    assert {r["doc_id"] for r in after} == set(want.values())

    before, after = seen["benchmark leaks"]
    norm = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    items = [norm(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    kept = {r["doc_id"] for r in after}
    for i, r in before.items():
        assert (i not in kept) == any(x in norm(r["text"]) for x in items)

    before, after = seen["packing"]
    check(after, {i: r["text"] for i, r in before.items()})


def test_run_writes_each_stage_and_covers_the_last(spark):
    sf = "/root/testdata/sf0.001"
    rows = cp.pipeline(spark, sf).collect()
    whole = {}
    for r in rows:
        whole.setdefault(r["doc_id"], [0, r["doc_tokens"]])[0] += r["length"]
    assert whole and all(a == b for a, b in whole.values())


def test_stages_take_odd_tables(spark, docs):
    df = docs([(1, None), (1, None), (None, "x"), (2, "")], extra=("row", "_id"))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns and out.count() <= 4, name
        assert stage(spark, df.limit(0), SF).count() == 0
    assert simhash.near_duplicates(df).count() == 4
