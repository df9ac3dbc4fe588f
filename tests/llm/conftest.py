import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs(spark):
    """docs([text, ...]) or docs({id: text}) or docs([(id, text), ...])."""
    def make(texts, extra=()):
        if isinstance(texts, dict):
            rows = list(texts.items())
        else:
            rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        full = [(i, t, None if t is None else "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("own"))
        return df
    return make


@pytest.fixture()
def prose():
    """Seeded invented sentences: prose(rng, words)."""
    def make(rng, n):
        syllables = "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to".split()
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 5))) for _ in range(n)]
        out = []
        while words:
            k = rng.randint(6, 12)
            out.append(" ".join(words[:k]).capitalize() + ".")
            words = words[k:]
        return out
    return make
