"""Personal data by candidate gradient boosting, in DataFrame operations only.

Base spans are fixed patterns with fixed checks (emails, IPv4 addresses, payment
cards by Luhn, telephone numbers); they always stay.  Beside them, high-recall
generators propose overlapping spans: obfuscated emails, addresses, cards and
telephone numbers wherever digits allow one, long tokens that may be keys.  Each
candidate gets features of its format (digits, letters, separators, distinct
characters, checksum, octets) and its context (the words before it, the characters
around it); gradient-boosted trees score it, and a threshold for each kind,
calibrated on candidates that the trees were not fitted on, selects it.  Selected
candidates are added from the best on, each unless it overlaps a base span or one
already added.

Labels come from the strict rules of ``strict`` on a bounded sample of different
candidates: ``SAMPLE_ROWS``, shared out among the kinds, by hash, so that a rare
kind is calibrated on candidates of its own.  The trees generalise the rules from
format and context.  Scoring covers every candidate of every whole text, inside the row that holds the
text: there is no shuffle.  Patterns use possessive loops and look-behinds, so a
long run of letters or digits takes linear time and no stack; positions are sums
over blocks of ``BLOCK`` matches, and overlaps are sought within groups of spans
that touch, so a server log of many thousand addresses takes no more time each.

Defined results.  Null texts are empty ones and have no spans.  Offsets count code
points.  Ties between overlapping candidates go to the earlier, then longer one.
Repeated rows are treated alike; extra columns pass through (those named like a
result are replaced).  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import free_name, stored, table

#: Candidates that a kind weighs as much as at most, when trees are grown.
KIND_WEIGHT = 4_000
TREES = 24
DEPTH = 3
RATE = 0.3
PRECISION = 0.95
CONTEXT = 24
#: Values that are added up together.
BLOCK = 256
#: Scores are counted by this many steps of 1; the ends of each step are kept.
STEPS = 512
#: Gradients are added up as whole multiples of 1 / FIXED, so their order changes nothing.
FIXED = float(1 << 40)

KINDS = ("email", "ip", "card", "phone", "secret")

_LOCAL = "A-Za-z0-9._%+-"
#: Base patterns.  A possessive loop or a look-behind changes no match: what
#: follows a loop is outside its class, and a start inside a run fails as its
#: beginning does.  Cards of under 14 digits, which fail anyway, are not matched.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_AT, _DOT = r"(?:@|\s?[\[(]at[\])]\s?)", r"(?:\.|\s?[\[(]dot[\])]\s?)"
GENERATORS = {
    "email": rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}+[ .-]?)?+(?:\([0-9]{2,4}\)|[0-9]{3})[ .-]?[0-9]{3,4}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
}
#: What every match of a base pattern that passes its check holds.
BASE_NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){13}", "phone": r"\+[0-9]"}
#: What a text must hold for a generator to be worth trying.
NEEDS = {"email": r"(?i)@|[\[(]at[\])]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]{4}", "phone": r"[0-9]{3}",
         "secret": r"[A-Za-z0-9+/_-]{20}"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_WORDS = (r"token|key|secret|passw|pwd|api|bearer", r"tel|phone|call|mobil|fax", r"mail", r"card|visa|konto|credit|iban",
          r"\bip\b|host|server|addr")

FEATURES = ("kind", "length", "digits", "letters", "upper", "separators", "distinct", "plus", "parens", "luhn", "octets",
            "before", "after", "words")


# --- spans in a row --------------------------------------------------------------

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def scan(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Of each int in an array, ``op`` (a sum or maximum) over 0 and those before
    it.  An array grows by copies, so sums run in blocks and then over blocks."""
    none = F.array().cast("array<int>")

    def within(x: Column) -> Column:
        return F.aggregate(x, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda state, v: F.struct(
            op(state["at"], v).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out")))

    def joined_up(blocks: Column) -> Column:
        return let(within(F.transform(blocks, lambda b: b["at"]))["out"], lambda before: F.flatten(
            F.transform(blocks, lambda b, k: F.transform(b["out"], lambda v: op(before[k], v)))))

    def whole(x: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int"))
        return let(F.transform(starts, lambda k: within(F.slice(x, k * BLOCK + 1, F.lit(BLOCK)))), joined_up)

    return let(values, lambda x: F.when(F.size(x) > 0, whole(x)).otherwise(none))


def matches(text: Column, pattern: str, needs: str) -> Column:
    """Leftmost non-overlapping matches: structs of m, s and e (code points),
    and the characters before and after.  Gaps and matches come from the same
    scan rule, so their lengths add up to positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<m:string,s:int,e:int,left:string,right:string>>")

    def places(both: Column) -> Column:
        sizes = F.transform(both["m"], lambda m, i: F.length(both["g"][i]) + F.length(m))

        def span(before: Column) -> Callable[[Column, Column], Column]:
            def at(m: Column, i: Column) -> Column:
                start = before[i] + F.length(both["g"][i])
                return F.struct(m.alias("m"), start.alias("s"), (start + F.length(m)).alias("e"),
                                F.right(both["g"][i], F.lit(CONTEXT)).alias("left"), F.left(both["g"][i + 1], F.lit(1)).alias("right"))
            return at

        return let(scan(sizes, add), lambda before: F.transform(both["m"], span(before)))

    pair = F.struct(found.alias("m"), gaps.alias("g"))
    return F.when(text.rlike(needs), let(pair, lambda b: F.when(F.size(b["m"]) > 0, places(b)).otherwise(empty))).otherwise(empty)


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Checksum of up to 20 digits: zeros in front change nothing."""
    padded = F.lpad(number, 20, "0")
    terms = []
    for i in range(1, 21):
        d = F.substring(padded, i, 1).cast("int")
        terms.append(F.when(d > 4, d * 2 - 9).otherwise(d * 2) if i % 2 else d)
    return reduce(lambda a, b: a + b, terms) % 10 == 0


def octets(s: Column) -> Column:
    return s.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")


def base_spans(text: Column) -> Column:
    """Array of (s, k, e), k the kind's place in KINDS, in order."""
    out = []
    for k, kind in enumerate(("email", "ip", "card", "phone")):
        found = matches(text, BASE[kind], BASE_NEEDS[kind])
        if kind == "ip":
            found = F.filter(found, lambda x: octets(x["m"]))
        elif kind == "card":
            found = F.filter(found, lambda x: let(digits(x["m"]), lambda d: F.length(d).between(14, 19) & luhn(d)))
        elif kind == "phone":
            found = F.filter(found, lambda x: F.length(digits(x["m"])).between(10, 15))
        out.append(F.transform(found, as_span(k)))
    return F.array_sort(F.concat(*out))


def as_span(k: int) -> Callable[[Column], Column]:
    return lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"))


def _count(s: Column, pattern: str, most: int) -> Column:
    return F.least(F.length(s) - F.length(F.regexp_replace(s, pattern, "")), F.lit(most))


def _edge(c: Column) -> Column:
    return (F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike("[A-Za-z0-9]"), 2).when(c.rlike("[\"'=:]"), 3).otherwise(4))


def candidates(text: Column) -> Column:
    """Array of candidate structs: place, text, context and features."""
    return F.concat(*[F.transform(matches(text, GENERATORS[kind], NEEDS[kind]), described(k)) for k, kind in enumerate(KINDS)])


def described(k: int) -> Callable[[Column], Column]:
    """A match of kind ``k`` with its features."""
    def features(x: Column) -> Column:
        m, left = x["m"], x["left"]
        number = digits(m)
        words = F.lit(0)
        for i, w in enumerate(_WORDS):
            words = F.when(F.lower(left).rlike(w), i + 1).otherwise(words)
        values = {
            "kind": F.lit(k), "length": F.least(F.length(m), F.lit(64)), "digits": _count(m, "[0-9]", 40),
            "letters": _count(m, "[A-Za-z]", 40), "upper": _count(m, "[A-Z]", 20), "separators": _count(m, "[ ().-]", 10),
            "distinct": F.size(F.array_distinct(F.split(m, ""))), "plus": m.startswith("+").cast("int"),
            "parens": m.contains("(").cast("int"),
            "luhn": F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False).cast("int"),
            "octets": octets(m).cast("int"), "before": _edge(F.right(left, F.lit(1))), "after": _edge(x["right"]),
            "words": words,
        }
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), m.alias("m"), left.alias("left"),
                        *[values[f].cast("int").alias(f) for f in FEATURES])

    return features


def strict(c: Column) -> Column:
    """The rule that labels a candidate for fitting."""
    n = F.length(digits(c["m"]))
    version = F.lower(c["left"]).rlike(r"(version|release|\bv)\s*$")
    rules = [
        c["m"].rlike(r"(?i)^[a-z0-9._%+-]+(@|\s?[\[(]at[\])]\s?)[a-z0-9-]+((\.|\s?[\[(]dot[\])]\s?)[a-z0-9-]+)*(\.|\s?[\[(]dot[\])]\s?)[a-z]{2,}$"),
        (c["octets"] == 1) & ~version & (c["distinct"] > 2),
        (c["luhn"] == 1) & (c["distinct"] > 2),
        ((c["plus"] == 1) | (c["parens"] == 1)) & n.between(10, 15),
        (c["distinct"] >= 8) & (c["letters"] > 0) & (c["digits"] * 6 >= c["length"]),
    ]
    out = F.lit(False)
    for k, rule in enumerate(rules):
        out = F.when(c["kind"] == k, rule).otherwise(out)
    return out.cast("int")


# --- boosted trees ---------------------------------------------------------------

@dataclass
class Model:
    #: Nested (feature, limit, at most, above) or a leaf's value.
    trees: list = field(default_factory=list)
    start: float = 0.0
    thresholds: tuple = (float("inf"),) * len(KINDS)

    def raw(self, x: np.ndarray) -> np.ndarray:
        def walk(tree, rows):
            if not isinstance(tree, tuple):
                out[rows] += tree
                return
            f, limit, low, high = tree
            below = x[rows, f] <= limit
            walk(low, rows[below])
            walk(high, rows[~below])

        out = np.full(len(x), self.start)
        for tree in self.trees:
            walk(tree, np.arange(len(x)))
        return out

    def column(self, c: Column) -> Column:
        """The same score of a candidate struct."""
        def walk(tree):
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            f, limit, low, high = tree
            return F.when(c[FEATURES[f]] <= limit, walk(low)).otherwise(walk(high))

        return reduce(lambda a, b: a + b, map(walk, self.trees), F.lit(float(self.start)))


def _open_node(tree) -> Column:
    """The open node (an int in place of a leaf's value) of a row, else -1."""
    if isinstance(tree, tuple):
        f, limit, low, high = tree
        return F.when(F.col(FEATURES[f]) <= limit, _open_node(low)).otherwise(_open_node(high))
    return F.lit(tree if isinstance(tree, int) else -1)


def histograms(cells: DataFrame, model: Model, tree, weight: list[float]) -> dict:
    """Sums of gradients by (open node of ``tree``, feature): arrays of values in
    order, g and h."""
    w = F.lit(0.0)
    for k, x in enumerate(weight):
        w = F.when(F.col("kind") == k, F.lit(x * FIXED)).otherwise(w)
    p = 1 / (1 + F.exp(-model.column(F.struct(*FEATURES))))
    rows = cells.where("not held").select(*FEATURES, "n", "y", w.alias("w"), p.alias("p"), _open_node(tree).alias("node"))
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(c).alias("value")) for f, c in enumerate(FEATURES)]))
    got = (rows.where("node >= 0")
           .select("node", (F.round(F.col("w") * (F.col("p") - F.col("y"))).cast("long") * F.col("n")).alias("g"),
                   (F.round(F.col("w") * F.col("p") * (1 - F.col("p"))).cast("long") * F.col("n")).alias("h"), values.alias("x"))
           .groupBy("node", "x.f", "x.value").agg(F.sum("g"), F.sum("h")).collect())
    out: dict = {}
    for node, f, value, g, h in sorted(map(tuple, got)):
        out.setdefault((node, f), []).append((value, g / FIXED, h / FIXED))
    return {k: np.array(v).T for k, v in out.items()}


def _split(sums: dict, node: int):
    """Best split of a node by gain, as (feature, limit, (g, h) at most, (g, h)
    above), or its own (g, h)."""
    best, split, whole = 1e-6, None, (0.0, 0.0)
    for f in range(len(FEATURES)):
        if (node, f) not in sums:
            continue
        values, g, h = sums[node, f]
        gs, hs = np.cumsum(g), np.cumsum(h)
        whole = gs[-1], hs[-1]
        gs, hs = gs[:-1], hs[:-1]
        if not len(gs):
            continue
        gain = gs ** 2 / (hs + 1) + (whole[0] - gs) ** 2 / (whole[1] - hs + 1) - whole[0] ** 2 / (whole[1] + 1)
        k = int(gain.argmax())
        if gain[k] > best:
            best, split = gain[k], (f, int(values[k]), (gs[k], hs[k]), (whole[0] - gs[k], whole[1] - hs[k]))
    return split or whole


def _leaf(sums: tuple) -> float:
    return float(-RATE * sums[0] / (sums[1] + 1))


def grow(cells: DataFrame, model: Model, weight: list[float]):
    """One more tree for ``model``, a pass over ``cells`` for each level."""
    tree, nodes = 0, 1
    for level in range(DEPTH):
        sums, made = histograms(cells, model, tree, weight), 0

        def cut(part):
            nonlocal made
            if isinstance(part, tuple):
                f, limit, low, high = part
                return (f, limit, cut(low), cut(high))
            if not isinstance(part, int):
                return part
            found = _split(sums, part)
            if len(found) == 2:
                return _leaf(found)
            f, limit, low, high = found
            if level == DEPTH - 1:
                return (f, limit, _leaf(low), _leaf(high))
            made += 2
            return (f, limit, made - 2, made - 1)

        tree, nodes = cut(tree), made
        if not nodes:
            break
    return tree


def score_steps(cells: DataFrame, model: Model) -> list:
    """(kind, held, step of the score, candidates, hits, lowest, highest score)."""
    return (cells.select("kind", "held", "n", (F.col("n") * F.col("y")).alias("hits"), model.column(F.struct(*FEATURES)).alias("score"))
            .groupBy("kind", "held", F.floor(F.col("score") * STEPS).alias("step"))
            .agg(F.sum("n"), F.sum("hits"), F.min("score"), F.max("score")).collect())


def cut_at(steps: list) -> float:
    """The lowest cut of the wanted precision, halfway to the next score, from
    (candidates, hits, lowest, highest score) of groups; infinity if none is."""
    if not steps:
        return float("inf")
    n, hits, low, high = np.array(sorted(steps, key=lambda r: -r[3]), dtype=float).T
    good = np.flatnonzero(np.cumsum(hits) >= PRECISION * np.cumsum(n))
    if not len(good):
        return float("inf")
    k = good[-1]
    return float((low[k] + (high[k + 1] if k + 1 < len(n) else min(low[k], 0.0))) / 2)


def boost(cells: DataFrame, kind_weight: float) -> Model:
    """Trees from the candidates that are not held, thresholds from those that
    are (all of a kind without any).  ``cells`` are features, y, held and n, the
    number of candidates alike in them."""
    model = Model()
    count = F.sum(F.when(~F.col("held"), F.col("n")))
    kinds = cells.groupBy("kind").agg(count.alias("n"), F.sum(F.when(~F.col("held"), F.col("n") * F.col("y"))).alias("hits")).collect()
    fitted = [r for r in kinds if r["n"]]
    if not fitted:
        return model
    weight = [0.0] * len(KINDS)
    for r in fitted:
        weight[r["kind"]] = min(1.0, kind_weight / r["n"])
    share = ((sum(weight[r["kind"]] * r["hits"] for r in fitted) + 1)
             / (sum(weight[r["kind"]] * r["n"] for r in fitted) + 2))
    model.start = float(np.log(share / (1 - share)))
    for _ in range(TREES):
        model.trees.append(grow(cells, model, weight))
    steps = score_steps(cells, model)
    thresholds = []
    for k in range(len(KINDS)):
        own = [r for r in steps if r["kind"] == k]
        own = [r for r in own if r["held"]] or own
        thresholds.append(cut_at([tuple(r)[3:] for r in own]))
    model.thresholds = tuple(thresholds)
    return model


def fit(docs: DataFrame, sample_rows: int = KIND_WEIGHT * len(KINDS)) -> Model:
    """Trees and thresholds from all candidates of ``docs``; copies count once.
    The kinds weigh together as much as ``sample_rows`` candidates at most, each
    the same share; none is left out."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(F.explode(candidates(text)).alias("c"))
    found = (found.select(F.xxhash64("c.m", "c.left").alias("o"), strict(F.col("c")).cast("long").alias("y"),
                          *[F.col(f"c.{f}").cast("long").alias(f) for f in FEATURES]).distinct())
    held = (F.pmod("o", F.lit(4)) == 0).alias("held")
    cells = stored(found.groupBy(*FEATURES, "y", held).agg(F.count(F.lit(1)).alias("n")), "pii-candidates")
    return boost(cells, -(-sample_rows // len(KINDS)))


# --- selection -------------------------------------------------------------------

def _added(base: Column, found: Column, model: Model) -> Column:
    """Candidates over their kind's threshold, taken from the best on, that
    overlap neither a base span nor one taken before, as (s, k, e)."""
    def limit(c: Column) -> Column:
        out = F.lit(float("inf"))
        for k, t in enumerate(model.thresholds):
            out = F.when(c["kind"] == k, F.lit(t)).otherwise(out)
        return out

    def item(s: Column, e: Column, k: Column, score: Column, own: bool) -> Column:
        return F.struct(s.alias("s"), e.alias("e"), k.alias("k"), score.alias("score"), F.lit(own).alias("own"))

    scored = F.transform(found, lambda c: F.struct(c.alias("c"), model.column(c).alias("score")))
    over = F.transform(F.filter(scored, lambda x: x["score"] >= limit(x["c"])),
                       lambda x: item(x["c"]["s"], x["c"]["e"], x["c"]["kind"], x["score"], False))
    kept = F.transform(base, lambda b: item(b["s"], b["e"], b["k"], F.lit(float("inf")), True))
    none = F.array().cast("array<struct<s:int,e:int,k:int,score:double,own:boolean>>")

    def taken(group: Column) -> Column:
        """Of spans that touch one another; base spans are the best."""
        def step(out: Column, x: Column) -> Column:
            clash = F.exists(out, lambda o: (o["s"] < x["e"]) & (x["s"] < o["e"]))
            return F.when(x["own"] | ~clash, F.concat(out, F.array(x))).otherwise(out)

        best_first = F.transform(F.array_sort(F.transform(group, lambda x: F.struct(
            (-x["score"]).alias("score"), x["s"].alias("s"), (-x["e"]).alias("e"), x["k"].alias("k"), x["own"].alias("own")))),
            lambda x: item_of(x))
        return F.aggregate(best_first, none, step)

    def item_of(x: Column) -> Column:
        return F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["k"].alias("k"), (-x["score"]).alias("score"), x["own"].alias("own"))

    def groups(spans: Column) -> Column:
        reach = scan(F.transform(spans, lambda x: x["e"]), lambda a, b: F.greatest(a, b))

        def cut(far: Column) -> Column:
            starts = F.filter(F.transform(spans, lambda x, i: F.when(x["s"] >= far[i], i)), lambda i: i.isNotNull())
            return let(starts, lambda at: F.flatten(F.transform(at, lambda a, j: taken(
                F.slice(spans, a + 1, F.coalesce(F.get(at, j + 1), F.size(spans)) - a)))))

        return let(reach, cut)

    both = let(F.array_sort(F.concat(kept, over)), groups)
    chosen = F.filter(F.when(F.size(over) > 0, both).otherwise(none), lambda x: ~x["own"])
    return F.transform(chosen, lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e")))


def find_spans(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, ...) with base and all: arrays of (s, k, e) by start,
    then kind; k indexes KINDS, s and e count code points, e exclusive."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("base_spans", "all_spans")]
    both = let(F.struct(base_spans(text).alias("base"), candidates(text).alias("found")),
               lambda b: F.struct(b["base"].alias("base"),
                                  F.array_sort(F.concat(b["base"], _added(b["base"], b["found"], model))).alias("all")))
    # one generated row for each row: the spans are computed here and nowhere again
    own = free_name(docs, "spans")
    return (docs.select(*kept, F.explode(F.array(both)).alias(own))
            .select(*kept, F.col(own)["base"].alias("base_spans"), F.col(own)["all"].alias("all_spans")))


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with each span in text replaced by its kind in brackets."""
    found = find_spans(docs, model)
    text = F.col("text")

    def step(state: Column, x: Column) -> Column:
        piece = F.when(x["s"] >= state["at"], F.concat(F.substr(text, state["at"] + 1, x["s"] - state["at"]),
                                                        F.lit("["), F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1), F.lit("]"))
                       ).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], x["e"]).alias("at"), F.concat(state["out"], piece).alias("out"))

    whole = F.aggregate("all_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1)))
    new = F.when(F.size("all_spans") > 0, whole).otherwise(text)
    return found.select(*[new.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


# --- query ---------------------------------------------------------------------

def joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")


def op1_pii_boosting(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, fit(docs))
    def count(k: int) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"),
                        joined("all_spans").alias("spans"))
