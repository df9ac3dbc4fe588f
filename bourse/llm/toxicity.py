"""Toxicity by a convolutional text classifier over hashed word embeddings.

Words are hashed, never listed: a word's vector is the sum of three rows of one
table, chosen by two hashes of the word and one of its beginning, so two words
are confused only if all rows collide, and inflected forms share a row.  Filters
of one, two and three words slide over the text; each filter's largest response
anywhere in the text goes into a logistic output.  Everything is trained in
numpy, by Adam on the gradients of the positions that won the pooling.

Thresholds are calibrated by language on labelled documents that took no part in
training; the language is read off the text's function words, and the scores are
shifted so that each language's threshold is 0.5.

Fitting takes every labelled document outside fold 0, whole: three in four train,
the fourth calibrates.  Training documents lie in pieces of about ``PIECE_TEXTS``
by a hash of their id.  In each epoch every piece goes on from the same model, in
a task of its own, and the models that come out are averaged: a row of the word
table over the pieces that hold it, all else over all pieces.  Sums are whole
multiples of 1 / ``FIXED``, so their order changes nothing.  Counts by word row,
and outputs by ``STEPS`` a unit for the thresholds, are Spark's sums too; what
comes to the driver is bounded by the model.  Scoring takes every text whole.

Defined results.  Null and empty texts have no words and the score of that; a
table without labels of both classes gives the share of label 1 (one half
without any).  Repeated rows are scored alike; extra columns pass through, and
score and predicted replace columns of these names.  An empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.llm.common import fold, labelled_texts, mix, slices, stored, table, word_hashes

#: Texts, and bytes of text, that a piece holds about.
PIECE_TEXTS, PIECE_BYTES = 4096, 32 << 20
#: Sums of models are whole multiples of 1 / FIXED.
FIXED = float(1 << 32)
#: Outputs are counted by this many steps of 1; the ends of each step are kept.
STEPS = 1024
ROWS = 1 << 18
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIX_BYTES = 4
#: Passes over the sample, and the texts to show in all; few texts take more passes.
EPOCHS, SHOWN = (8, 40), 24_000
BATCH = 32
RATE = 0.01
DECAY = 1e-5
DROPOUT = 0.5
#: A table row is trained if so many distinct texts hold it.
MIN_TEXTS = 5
#: Squared gradients that a row begins with.
UNSEEN = 1e-6
#: Weight of the log odds that a row's first component begins with.
START = 0.2
SEED = 11
THRESHOLD = 0.5

#: Function words by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and to in that is was with for it on be this are from",
    "de": "der die und das von mit für ist nicht den dem ein zu auf sich auch",
    "fr": "le les des et est pour dans qui une sur pas avec au par il elle",
    "es": "el los y del las por con para su no al lo como más pero se",
}


def _function_words() -> tuple[np.ndarray, np.ndarray]:
    hashes, language = [], []
    for i, words in enumerate(FUNCTION_WORDS.values()):
        h, _ = word_hashes(words.split())
        hashes.append(h)
        language.append(np.full(len(h), i))
    hashes, language = np.concatenate(hashes), np.concatenate(language)
    order = np.argsort(hashes)
    return hashes[order], language[order]


def rows_of(whole: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Three table rows of each word; row 0 belongs to none."""
    a = whole % np.uint64(ROWS - 1)
    b = mix(whole + np.uint64(1)) % np.uint64(ROWS - 1)
    c = mix(start + np.uint64(2)) % np.uint64(ROWS - 1)
    return np.stack([a, b, c], axis=1).astype(np.int64) + 1


@dataclass
class Words:
    """Words of many texts: hashes of words and of their beginnings, the text
    each belongs to, and the texts' languages."""
    whole: np.ndarray
    start: np.ndarray
    owner: np.ndarray
    texts: int

    def languages(self) -> np.ndarray:
        """Index of the language with most function words; ties and texts
        without any go to the first."""
        known, language = _function_words()
        at = np.minimum(np.searchsorted(known, self.whole), len(known) - 1)
        hit = known[at] == self.whole
        votes = np.zeros((self.texts, len(FUNCTION_WORDS)))
        np.add.at(votes, (self.owner[hit], language[at[hit]]), 1)
        return votes.argmax(axis=1)


def words_of(texts: list[str]) -> Words:
    whole, owner, start = word_hashes(texts, PREFIX_BYTES)
    return Words(whole, start, owner, len(texts))


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of a few MB of texts at a time."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < 1 << 21):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]          # by width: (width, SIZE, FILTERS)
    shift: list[np.ndarray]
    out: np.ndarray
    bias: float
    slope: float = 1.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS)))

    def __getstate__(self) -> dict:
        """Tasks are sent the table's rows that are not zero."""
        row = np.flatnonzero(self.table.any(axis=1)).astype(np.int32)
        return self.__dict__ | {"table": (len(self.table), row, self.table[row])}

    def __setstate__(self, state: dict) -> None:
        n, row, values = state["table"]
        self.__dict__.update(state, table=np.zeros((n, SIZE), np.float32))
        self.table[row] = values

    def logits(self, words: Words) -> np.ndarray:
        """Output before calibration, for each text.  Words are projected once
        for all their places.  Padding follows each text; responses that would
        reach over it into the next text do not count."""
        distinct, inverse = np.unique(words.whole, return_inverse=True)
        first = np.zeros(len(distinct), dtype=np.uint64)
        first[inverse] = words.start
        vectors = self.table[rows_of(distinct, first)].sum(axis=1)
        vectors = np.concatenate([np.zeros((1, SIZE), np.float32), vectors])
        pad = max(WIDTHS)
        place = np.arange(len(words.owner)) + pad * words.owner
        ids = np.zeros(len(words.owner) + pad * (words.texts + 1), dtype=np.int64)
        ids[place] = inverse + 1
        lengths = np.bincount(words.owner, minlength=words.texts) + pad
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        n = int(lengths.sum())
        beyond = (begins + lengths)[:, None] - np.arange(1, pad)
        pooled = []
        for width, kernel, shift in zip(WIDTHS, self.filters, self.shift):
            total = None
            for k in range(width):
                part = (vectors @ kernel[k])[ids[k:k + n]]
                total = part if total is None else total + part
            total[beyond] = -np.inf
            pooled.append(np.maximum(np.maximum.reduceat(total, begins, axis=0) + shift, 0))
        return np.concatenate(pooled, axis=1) @ self.out + self.bias

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        out = []
        for at, end in _parts(texts):
            words = words_of(texts[at:end])
            x = self.slope * (self.logits(words) - self.thresholds[words.languages()])
            out.append(1 / (1 + np.exp(-np.clip(x, -30, 30))))
        return np.concatenate(out).astype(float)


# --- training ------------------------------------------------------------------

#: The parameters beside the word table, one after another.
SHAPES = [*((w, SIZE, FILTERS) for w in WIDTHS), *((FILTERS,) for _ in WIDTHS), (FILTERS * len(WIDTHS),), (1,)]
PARAMETERS = sum(int(np.prod(shape)) for shape in SHAPES)


def shaped(flat: np.ndarray) -> list[np.ndarray]:
    """Views of the parameters in ``flat``."""
    ends = np.cumsum([int(np.prod(shape)) for shape in SHAPES])
    return [part.reshape(shape) for part, shape in zip(np.split(flat, ends[:-1]), SHAPES)]


@dataclass
class State:
    """A model in training: word table, its rows that are trained, squared
    gradients by row (AdaGrad: the table is large and its gradients are few
    rows), the other parameters and Adam's means of them."""
    lookup: np.ndarray
    live: np.ndarray
    seen: np.ndarray
    flat: np.ndarray
    m: np.ndarray
    v: np.ndarray
    t: int = 0

    def adam(self, grad: np.ndarray, rate: float) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        self.flat -= rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)
        self.flat -= rate * DECAY * self.flat

    def __getstate__(self) -> dict:
        """Tasks are sent the rows that are trained; the others stay as they began."""
        row = np.flatnonzero(self.live).astype(np.int32)
        return self.__dict__ | {"live": row, "lookup": self.lookup[row], "seen": self.seen[row]}

    def __setstate__(self, state: dict) -> None:
        row = state["live"]
        self.__dict__.update(state, live=np.zeros(ROWS, dtype=bool), lookup=np.zeros((ROWS, SIZE), np.float32),
                             seen=np.full(ROWS, UNSEEN, np.float32))
        self.live[row], self.lookup[row], self.seen[row] = True, state["lookup"], state["seen"]

    def copy(self) -> State:
        return State(self.lookup.copy(), self.live, self.seen.copy(), self.flat.copy(), self.m.copy(), self.v.copy(), self.t)

    def model(self) -> Model:
        values = shaped(self.flat)
        n = len(WIDTHS)
        return Model(self.lookup, values[:n], values[n:2 * n], values[-2], float(values[-1][0]))


def word_rows(text: str) -> np.ndarray:
    """Table rows of a text's words, three a word."""
    w = words_of([text])
    return rows_of(w.whole, w.start).astype(np.int32)


def initial(held_by: np.ndarray, n: np.ndarray) -> State:
    """The model that training begins with: ``held_by`` distinct texts of each
    class hold a table row, of ``n`` in all."""
    rng = np.random.default_rng(SEED)
    lookup = rng.normal(0, 0.02, (ROWS, SIZE)).astype(np.float32)
    lookup[0] = 0
    flat = np.zeros(PARAMETERS, np.float32)
    values = shaped(flat)
    for w, kernel in zip(WIDTHS, values):
        kernel[:] = rng.normal(0, 0.5 / np.sqrt(w), (w, SIZE, FILTERS))
        kernel[:, 0] = np.abs(kernel[:, 0])
    values[-2][:] = rng.normal(0, 0.3, FILTERS * len(WIDTHS))
    # rows that few distinct texts share can only be learnt by heart
    live = held_by.sum(axis=0) >= MIN_TEXTS
    live[0] = False
    # the first component begins as the log odds of the class among the texts that hold the row
    n = n[:, None] + 1
    lookup[:, 0] += START * (np.log((held_by[1] + 0.5) / n[1]) - np.log((held_by[0] + 0.5) / n[0]))
    lookup[~live] = 0
    return State(lookup, live, np.full(ROWS, UNSEEN, np.float32), flat, np.zeros_like(flat), np.zeros_like(flat))


def class_weights(n: np.ndarray) -> np.ndarray:
    """Weight of a text of either class, of which there are ``n``."""
    return 0.5 / np.maximum(1, n) * n.sum()


def epochs_of(texts: int) -> int:
    return int(np.clip(SHOWN // max(1, texts), *EPOCHS))


def one_pass(state: State, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float,
             rng: np.random.Generator) -> None:
    """Train ``state`` on each text (its word rows) once."""
    pad = max(WIDTHS)
    docs = [np.concatenate([np.where(state.live[d], d, 0), np.zeros((pad, 3), d.dtype)]) for d in docs]
    lookup, seen = state.lookup, state.seen
    order = rng.permutation(len(docs))
    for lo in range(0, len(order), BATCH):
        own = order[lo:lo + BATCH]
        *values, out, bias = shaped(state.flat)
        kernels, shifts = values[:len(WIDTHS)], values[len(WIDTHS):]
        seen_words = [docs[d] * (rng.random((len(docs[d]), 1)) >= DROPOUT) for d in own]
        vectors = [lookup[d].sum(axis=1) for d in seen_words]
        best, pooled = [], []
        for width, kernel, shift in zip(WIDTHS, kernels, shifts):
            at = np.empty((len(own), FILTERS), dtype=np.int64)
            top = np.empty((len(own), FILTERS), dtype=np.float32)
            for i, x in enumerate(vectors):
                n = max(len(x) - pad + 1, 1)
                z = sum(x[k:k + n] @ kernel[k] for k in range(width))
                at[i] = z.argmax(axis=0)
                top[i] = z[at[i], np.arange(FILTERS)]
            best.append(at)
            pooled.append(np.maximum(top + shift, 0))
        p = np.concatenate(pooled, axis=1)
        x = p @ out + bias
        error = ((1 / (1 + np.exp(-np.clip(x, -30, 30))) - y[own]) * weight[own] / len(own)).astype(np.float32)
        back = error[:, None] * out * (p > 0)
        grads_k, grads_s = [], []
        rows, changes = [], []
        for j, (width, kernel) in enumerate(zip(WIDTHS, kernels)):
            g = back[:, j * FILTERS:(j + 1) * FILTERS]
            gk = np.zeros_like(kernel)
            for k in range(width):
                where = np.stack([d[best[j][i] + k] for i, d in enumerate(seen_words)])     # (docs, FILTERS, 3)
                x_there = lookup[where].sum(axis=2)
                gk[k] = np.einsum("dfs,df->sf", x_there, g)
                rows.append(where.reshape(-1))
                change = g[:, :, None] * kernel[k].T[None]
                changes.append(np.repeat(change.reshape(-1, SIZE), 3, axis=0))
            grads_k.append(gk)
            grads_s.append(g.sum(axis=0))
        # the table's changes are those at the parameters before this step
        rows, changes = np.concatenate(rows), np.concatenate(changes)
        state.adam(np.concatenate([x.reshape(-1) for x in (*grads_k, *grads_s, p.T @ error, error.sum(keepdims=True))]), rate)
        touched, inverse = np.unique(rows, return_inverse=True)
        total = np.zeros((len(touched), SIZE), np.float32)
        np.add.at(total, inverse, changes)
        seen[touched] += (total ** 2).mean(axis=1)
        lookup[touched] -= 10 * rate * total / np.sqrt(seen[touched])[:, None]
        lookup[0] = 0


def train(texts: list[str], y: np.ndarray) -> Model:
    """A model of the given texts (whole) and labels 0 or 1, as one piece."""
    docs = [word_rows(t) for t in texts]
    held_by = np.zeros((2, ROWS))
    classes = {t: int(c) for t, c in zip(texts, y)}
    for text, rows in dict(zip(texts, docs)).items():
        held_by[classes[text], np.unique(rows)] += 1
    state = initial(held_by, np.bincount(list(classes.values()), minlength=2))
    weight = class_weights(np.bincount(y.astype(int), minlength=2))[y.astype(int)]
    rng = np.random.default_rng(SEED)
    epochs = epochs_of(len(docs))
    for epoch in range(epochs):
        one_pass(state, docs, y, weight, RATE * (1 - epoch / epochs), rng)
    return state.model()


# --- training on all rows ------------------------------------------------------

def _docs(b: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.int32).reshape(-1, 3) for x in b.column("words").to_pylist()]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(piece, word rows, labels) from rows sorted by piece."""
    held, docs, y = None, [], []
    for b in slices(batches):
        for piece, d, c in zip(b.column("piece").to_pylist(), _docs(b), b.column("y").to_pylist()):
            if docs and piece != held:
                yield held, docs, np.array(y, dtype=float)
                docs, y = [], []
            held = piece
            docs.append(d)
            y.append(c)
    if docs:
        yield held, docs, np.array(y, dtype=float)


def _column_sums(df: DataFrame, key: str) -> pa.Table:
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in df.columns if c != key]).toArrow()


def in_pieces(texts: DataFrame, pieces: int) -> DataFrame:
    """``texts`` (doc_id, text, y) as a table of word rows sorted by piece;
    ``lead`` is true for one of each distinct text, that of the greatest id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words = pa.array([word_rows(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), words], names=[*names, "words"])

    names = ["doc_id", "y", "piece", "lead"]
    lead = texts.groupBy(F.xxhash64("text"), F.length("text")).agg(F.max("doc_id").alias("doc_id")).select("doc_id", F.lit(True).alias("lead"))
    rows = (texts.join(lead, "doc_id", "left")
            .select(F.col("doc_id").cast("long").alias("doc_id"), "y",
                    F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.lit(pieces)).cast("int").alias("piece"),
                    F.coalesce("lead", F.lit(False)).alias("lead"), "text"))
    return stored(rows.mapInArrow(run, "doc_id long, y int, piece int, lead boolean, words binary")
                  .repartition(pieces, "piece").sortWithinPartitions("piece", "doc_id"), "toxicity-words", 1)


def held_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct texts of each class hold each table row, and how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_by, n = np.zeros((2, ROWS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for b in slices(batches):
            for d, c in zip(_docs(b), b.column("y").to_pylist()):
                held_by[c, np.unique(d)] += 1
                n[c] += 1
        at = np.flatnonzero(held_by.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), *(pa.array(np.append(held_by[c, at], n[c])) for c in (0, 1))],
                                         names=["row", "n0", "n1"])

    got = _column_sums(rows.where("lead").select("words", "y").mapInArrow(run, "row long, n0 long, n1 long"), "row")
    row, both = got["row"].to_numpy(), np.stack([got["n0"].to_numpy(), got["n1"].to_numpy()])
    held_by = np.zeros((2, ROWS))
    held_by[:, row[row >= 0]] = both[:, row >= 0]
    return held_by, both[:, row < 0].sum(axis=1)


def mixed_pass(rows: DataFrame, state: State, weights: np.ndarray, epoch: int, epochs: int) -> State:
    """One epoch: the average of the models that the pieces make of ``state``."""
    changed = [f"d{k}" for k in range(SIZE)] + ["seen"]
    sent = rows.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the table's rows, then a line for each other parameter (value, m, v), then the steps
        state = sent.value
        n = np.zeros(ROWS + PARAMETERS + 1, dtype=np.int64)
        sums = np.zeros((len(n), SIZE + 1), dtype=np.int64)
        for piece, docs, y in _pieces(batches):
            own = state.copy()
            one_pass(own, docs, y, weights[y.astype(int)], RATE * (1 - epoch / epochs), np.random.default_rng([SEED, epoch, piece]))
            held = np.zeros(ROWS, dtype=bool)
            for d in docs:
                held[d.reshape(-1)] = True
            at = np.flatnonzero(held & state.live)
            n[at] += 1
            n[ROWS:] += 1
            change = np.column_stack([own.lookup[at] - state.lookup[at], own.seen[at] - state.seen[at]])
            sums[at] += np.rint(change.astype(float) * FIXED).astype(np.int64)
            for k, (new, old) in enumerate(((own.flat, state.flat), (own.m, state.m), (own.v, state.v))):
                sums[ROWS:-1, k] += np.rint((new - old).astype(float) * FIXED).astype(np.int64)
            sums[-1, 0] += own.t - state.t
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), *(pa.array(sums[at, k]) for k in range(SIZE + 1))],
                                         names=["row", "n", *changed])

    schema = "row long, n long, " + ", ".join(f"{c} long" for c in changed)
    got = _column_sums(rows.select("piece", "words", "y").mapInArrow(run, schema), "row")
    sent.destroy()
    row, n = got["row"].to_numpy(), got["n"].to_numpy()
    mean = np.column_stack([got[c].to_numpy() for c in changed]) / n[:, None]
    out = state.copy()
    words, other = row < ROWS, (row >= ROWS) & (row < ROWS + PARAMETERS)
    out.lookup[row[words]] += (mean[words, :SIZE] / FIXED).astype(np.float32)
    out.seen[row[words]] += (mean[words, SIZE] / FIXED).astype(np.float32)
    for k, values in enumerate((out.flat, out.m, out.v)):
        values[row[other] - ROWS] += (mean[other, k] / FIXED).astype(np.float32)
    out.v = np.maximum(out.v, 0)
    out.t += int(round(float(mean[row == ROWS + PARAMETERS, 0].sum())))
    return out


def train_all(texts: DataFrame, n: np.ndarray, size: int) -> Model:
    """A model of all of ``texts`` (doc_id, text, y): ``n`` of either class, with
    ``size`` bytes of text."""
    pieces = int(max(-(-int(n.sum()) // PIECE_TEXTS), -(-size // PIECE_BYTES), 1))
    rows = in_pieces(texts, pieces)
    state = initial(*held_counts(rows))
    epochs = epochs_of(int(n.sum()))
    for epoch in range(epochs):
        state = mixed_pass(rows, state, class_weights(n), epoch, epochs)
    return state.model()


def output_steps(texts: DataFrame, model: Model) -> np.ndarray:
    """Outputs for ``texts`` (text, y) in steps, as rows (language, lowest,
    highest output, texts, texts of label 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, y = b.column("text").to_pylist(), b.column("y").to_numpy()
            for at, end in _parts(own):
                words = words_of(own[at:end])
                x = model.logits(words).astype(float)
                yield pa.RecordBatch.from_arrays([pa.array(words.languages().astype(np.int64)), pa.array(x), pa.array(y[at:end].astype(np.int64))],
                                                 names=["language", "x", "y"])

    step = F.floor(F.greatest(F.least(F.col("x"), F.lit(64.0)), F.lit(-64.0)) * STEPS)
    got = (texts.select("text", "y").mapInArrow(run, "language long, x double, y long")
           .groupBy("language", step.alias("step")).agg(F.min("x"), F.max("x"), F.count(F.lit(1)), F.sum("y")).collect())
    return np.array([(r[0], *tuple(r)[2:]) for r in got], dtype=float).reshape(len(got), 5)


def best_cut(low: np.ndarray, high: np.ndarray, n: np.ndarray, hits: np.ndarray) -> float | None:
    """The cut, halfway between two outputs, with the best F1 (the widest gap
    among equals), of groups of ``n`` texts with outputs from ``low`` to ``high``;
    None without texts of both classes."""
    if not 0 < hits.sum() < n.sum():
        return None
    order = np.lexsort((-low, -high))
    low, high, n, hits = low[order], high[order], n[order], hits[order]
    found = np.cumsum(hits)
    f1 = 2 * found / (np.cumsum(n) + hits.sum())
    after = np.append(high[1:], low[-1] - 1)
    f1 = np.where(low > after, f1, -1)
    k = max(np.flatnonzero(f1 >= f1.max() - 1e-12), key=lambda i: low[i] - after[i])
    return float(low[k] + after[k]) / 2


def best_threshold(x: np.ndarray, y: np.ndarray) -> float | None:
    """``best_cut`` of single outputs."""
    return best_cut(x, x, np.ones(len(x)), y)


def merged(steps: np.ndarray) -> np.ndarray:
    """(low, high, n, hits) of the steps of all languages."""
    out: dict[int, list[float]] = {}
    for _, low, high, n, hits in steps.tolist():
        own = out.setdefault(int(np.floor(np.clip(low, -64, 64) * STEPS)), [low, high, 0, 0])
        own[:] = [min(own[0], low), max(own[1], high), own[2] + n, own[3] + hits]
    return np.array(list(out.values())).reshape(-1, 4)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    texts = stored(labelled_texts(docs, labels, "toxic"), "toxicity-labelled", 1)
    count = texts.groupBy((F.col("part") == 3).alias("held"), "y").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"))
    by = {(r["held"], r["y"]): (r["n"], r["size"]) for r in count.collect()}

    def total(held: bool | None) -> np.ndarray:
        return np.array([sum(v[0] for (h, c), v in by.items() if c == y and held in (None, h)) for y in (0, 1)])

    if not total(None).all():
        p = (total(None)[1] + 1) / (total(None).sum() + 2)
        zero = [np.zeros((w, SIZE, FILTERS), np.float32) for w in WIDTHS]
        return Model(np.zeros((ROWS, SIZE), np.float32), zero, [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                     np.zeros(FILTERS * len(WIDTHS), np.float32), float(np.log(p / (1 - p))))
    # three parts train and the fourth calibrates; all, where a class has none in them
    own = total(False).all()
    model = train_all(texts.where("part <> 3") if own else texts, total(False if own else None),
                      sum(size for (h, _), (_, size) in by.items() if not (own and h)))
    steps = output_steps(texts.where("part = 3") if own and total(True).all() else texts, model)
    common = best_cut(*merged(steps).T)
    for i in range(len(FUNCTION_WORDS)):
        _, low, high, n, hits = steps[steps[:, 0] == i].T
        enough = min(hits.sum(), (n - hits).sum()) >= 10
        model.thresholds[i] = best_cut(low, high, n, hits) if enough else common
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, ...) with score and predicted."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)


# --- query ---------------------------------------------------------------------

def op4_cnn_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return (score_toxicity(docs, model)
            .select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted"))
