"""Next-day-close forecast (FCT-*, AGG-6, UDF-2).

The reference fits a small network per symbol, one symbol after another.
Here every symbol is fitted at once: a linear or ridge model whose
sufficient statistics (sums of products) are hash aggregates per symbol, so
a symbol's rows never have to sit together in one task.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.functions.scalar import direction, pct_diff
from bourse.operators.projection import with_row_index
from bourse.operators.series import DEFAULT_SEGMENT, KEY, SEGMENT, SeriesPass, nan_missing, ordering_of

# The model's inputs, in order.
FEATURES = ["open", "close", "high", "low", "volume_z", "daily_return"]


_VALUES = ["open", "close", "high", "low", "volume"]


def _present(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def _return(close: Column, before: Column) -> Column:
    return F.try_divide(close - before, before)


def _placed(bars: DataFrame, key: str, order: str, segment) -> DataFrame:
    """The bars dealt out by (key, segment), with what a row knows of itself
    inside its segment: ``_first`` and ``_final`` of it, the close before, whether
    it is complete (``_ok``), whether it stays (``_kept``; not known of the first
    row, whose close before lies in another segment) and the next close that
    stays after it (``_next``; never the first row's)."""
    base = bars.select(key, order, *[F.col(c).cast("double").alias(c) for c in _VALUES])
    rows = SeriesPass(keys=[key], order=[order], segment=F.lit(0) if segment is None else segment).dealt(nan_missing(base, _VALUES))
    # only now: summary and rows then need the same columns, and both use one exchange
    filled = [F.col(KEY).getField(key), *[F.col(c) for c in [order, *_VALUES]]]
    rows = rows.withColumn("_ok", reduce(lambda x, y: x & y, [c.isNotNull() for c in filled]))
    w = Window.partitionBy(KEY, SEGMENT).orderBy(order)
    rows = rows.withColumns({"_first": F.lag(F.lit(1)).over(w).isNull(), "_final": F.lead(F.lit(1)).over(w).isNull(),
                             "_before": F.lag("close").over(w)})
    rows = rows.withColumn("_kept", ~F.col("_first") & F.col("_ok") & F.coalesce(
        _present(_return(F.col("close"), F.col("_before"))), F.lit(False)))
    later = w.rowsBetween(1, Window.unboundedFollowing)
    return rows.withColumn("_next", F.first(F.when(F.col("_kept"), F.col("close")), ignorenulls=True).over(later))


def _carried(rows: DataFrame, order: str, fit: bool = False) -> DataFrame:
    """One row a segment of ``_placed`` rows: what crosses its borders, composed
    over both steps (return and drop, then label and standard score) without
    another look at the rows.

    A summary holds the last close as it is (the next segment's first return goes
    by it), the first row apart, and of the rows after it, whose fate is known,
    the first close that stays and the count, mean and M2 of volume.  Along a
    key's segments the close before decides whether the first row stays; then its
    close, or the first that stays after it, is the label of whoever came before,
    and its volume joins the moments.  With ``fit``, also the count, means and
    centred products of (close, label) where both lie in one segment, and the
    pairs across a border: those of the first row and of the last row that stays."""
    kept, close, volume = F.col("_kept"), F.col("close"), F.col("volume")
    place = F.when(kept, ordering_of(rows, [order], ["close"]))
    aggs = [F.max(F.when(F.col("_final"), close)).alias("tail"),
            F.max(F.when(F.col("_first"), close)).alias("f_close"), F.max(F.when(F.col("_first"), volume)).alias("f_volume"),
            F.bool_or(F.col("_first") & F.col("_ok")).alias("f_ok"),
            F.min_by(close, place).alias("r_close"), F.count_if(kept).alias("r_n"),
            F.coalesce(F.avg(F.when(kept, volume)), F.lit(0.0)).alias("r_mean"),
            F.coalesce(F.var_pop(F.when(kept, volume)), F.lit(0.0)).alias("r_var")]
    if fit:
        y, x = F.when(kept, F.col("_next")), close
        aggs += [F.max_by(close, place).alias("l_close"), F.regr_count(y, x).alias("p_n"),
                 *[F.coalesce(f(y, x), F.lit(0.0)).alias(n) for f, n in (
                     (F.regr_avgx, "p_x"), (F.regr_avgy, "p_y"), (F.regr_sxx, "p_xx"), (F.regr_sxy, "p_xy"), (F.regr_syy, "p_yy"))]]
    summary = rows.groupBy(KEY, SEGMENT).agg(*aggs)

    along = Window.partitionBy(KEY).orderBy(SEGMENT)
    whole = Window.partitionBy(KEY)
    c = summary.withColumn("before", F.lag("tail").over(along))
    c = c.withColumn("f_kept", F.col("f_ok") & F.coalesce(_present(_return(F.col("f_close"), F.col("before"))), F.lit(False)))
    c = c.withColumn("head", F.when(F.col("f_kept"), F.col("f_close")).otherwise(F.col("r_close")))
    c = c.withColumn("next_head", F.first("head", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)))
    c = c.withColumn("f_n", F.col("f_kept").cast("int"))
    c = c.withColumn("n", F.sum(F.col("r_n") + F.col("f_n")).over(whole))
    mean = F.sum(F.col("r_n") * F.col("r_mean") + F.when(F.col("f_kept"), F.col("f_volume")).otherwise(0.0)).over(whole)
    c = c.withColumn("mean", F.try_divide(mean, F.col("n")))
    spread = F.col("r_n") * (F.col("r_var") + F.pow(F.col("r_mean") - F.col("mean"), 2)) + F.when(
        F.col("f_kept"), F.pow(F.col("f_volume") - F.col("mean"), 2)).otherwise(0.0)
    return c.withColumn("sd", F.sqrt(F.try_divide(F.sum(spread).over(whole), F.col("n"))))


def feature_frame(bars: DataFrame, key: str = "symbol", order: str = "date",
                  segment=DEFAULT_SEGMENT) -> DataFrame:
    """FCT-1: daily return, drop incomplete rows, standardise volume (after the
    drop), label = next close.  Output: key, date, open, close, high, low,
    volume_z, daily_return, label (NULL on each key's last row).

    One pass: the bars are read and exchanged once, by (key, month); besides
    that, one row a key and month moves to its key and back (``_carried``).
    """
    rows = _placed(bars, key, order, segment)
    carry = _carried(rows, order).select(KEY, SEGMENT, "before", "next_head", "mean", "sd")
    j = rows.join(carry, [KEY, SEGMENT])
    change = _return(F.col("close"), F.when(F.col("_first"), F.col("before")).otherwise(F.col("_before")))
    j = j.withColumn("daily_return", change).filter(F.col("_ok") & _present(F.col("daily_return")))
    volume_z = F.when(F.col("sd") == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("volume") - F.col("mean"), F.col("sd")))
    return j.select(F.col(KEY).getField(key).alias(key), order, "open", "close", "high", "low", volume_z.alias("volume_z"),
                    "daily_return", F.coalesce("_next", "next_head").alias("label"))


def fit_linear(bars: DataFrame, key: str = "symbol", order: str = "date", segment=DEFAULT_SEGMENT) -> DataFrame:
    """FCT-1 -> FCT-2 (linear) -> AGG-6 from segment summaries alone:
    ``forecast_linear(feature_frame(bars))`` and its mean squared error, without
    rows for the features.  Centred products merge as moments do (Chan), so the
    error, (Syy - 2 b Sxy + b^2 Sxx) / n, loses no digits to large prices."""
    c = _carried(_placed(bars, key, order, segment), order, fit=True)
    whole = Window.partitionBy(KEY)
    # pairs across a border: the first row with what follows it, the last row that stays with the next segment's head
    ends = F.array(
        F.struct(F.when(F.col("f_kept"), F.col("f_close")).alias("x"), F.coalesce("r_close", "next_head").alias("y")),
        F.struct(F.col("l_close").alias("x"), F.col("next_head").alias("y")))
    c = c.withColumn("ends", F.filter(ends, lambda e: e["x"].isNotNull() & e["y"].isNotNull()))

    def total(inner: Column, at_end) -> Column:
        return F.sum(inner + F.aggregate("ends", F.lit(0.0), lambda s, e: s + at_end(e))).over(whole)

    n = F.col("p_n")
    c = c.withColumn("n_train", F.sum(n + F.size("ends")).over(whole))
    c = c.withColumns({"mx": F.try_divide(total(n * F.col("p_x"), lambda e: e["x"]), F.col("n_train")),
                       "my": F.try_divide(total(n * F.col("p_y"), lambda e: e["y"]), F.col("n_train"))})

    def product(s: str, a: str, b: str) -> Column:
        return total(F.col(s) + n * (F.col(f"p_{a}") - F.col(f"m{a}")) * (F.col(f"p_{b}") - F.col(f"m{b}")),
                     lambda e: (e[a] - F.col(f"m{a}")) * (e[b] - F.col(f"m{b}")))

    c = c.withColumns({"sxx": product("p_xx", "x", "x"), "sxy": product("p_xy", "x", "y"), "syy": product("p_yy", "y", "y")})
    last = F.coalesce("l_close", F.when(F.col("f_kept"), F.col("f_close")))
    fit = c.filter("n > 0").groupBy(KEY).agg(
        *[F.max(x).alias(x) for x in ("n_train", "mx", "my", "sxx", "sxy", "syy")],
        F.max_by(last, F.when(last.isNotNull(), F.col(SEGMENT))).alias("today_close"))
    slope = F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx"))
    fit = fit.withColumn("slope", slope).withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx"))
    error = F.col("syy") - 2 * F.col("slope") * F.col("sxy") + F.pow("slope", F.lit(2)) * F.col("sxx")
    return fit.select(
        F.col(KEY).getField(key).alias(key), "slope", "intercept", F.col("n_train").cast("bigint").alias("n_train"), "today_close",
        (F.col("intercept") + F.col("slope") * F.col("today_close")).alias("tomorrow_close"),
        F.try_divide(F.when(error < 0, 0.0).otherwise(error), F.col("n_train")).alias("mse"))


def mse(df: DataFrame, key, y: str, yhat: str, out: str = "mse") -> DataFrame:
    """AGG-6: mean squared error per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.avg(F.pow(F.col(y) - F.col(yhat), 2)).alias(out))


def forecast_linear(features: DataFrame, key: str = "symbol", order: str = "date",
                    x: str = "close", label: str = "label") -> DataFrame:
    """FCT-2 (linear): label ~ a + b * close per key; tomorrow = a + b * today's
    close.  Rows without a label (each key's last) drop out of ``regr_*`` by
    themselves, and ``max_by`` picks today's close in the same aggregate."""
    fit = features.groupBy(key).agg(
        F.regr_slope(label, x).alias("slope"),
        F.regr_intercept(label, x).alias("intercept"),
        F.regr_count(label, x).alias("n_train"),
        F.max_by(x, order).alias("today_close"))
    return fit.withColumn("tomorrow_close",
                          F.col("intercept") + F.col("slope") * F.col("today_close"))


def _gram_aggregates(cols, label):
    """Sums of x_i * x_j (i <= j) and x_i * y over labelled rows, x_0 = 1."""
    terms = [F.lit(1.0)] + [F.col(c) for c in cols]
    has = F.col(label).isNotNull()
    aggs = []
    for i, j in combinations_with_replacement(range(len(terms)), 2):
        aggs.append(F.sum(F.when(has, terms[i] * terms[j])).alias(f"_g{i}_{j}"))
    for i in range(len(terms)):
        aggs.append(F.sum(F.when(has, terms[i] * F.col(label))).alias(f"_b{i}"))
    return aggs


def ridge_steps(k: int, lam: float) -> list[dict[str, str]]:
    """The solve of (G + lam * I') beta = b for one row per key, as stages of
    named arithmetic expressions (the same text is Spark SQL and ANSI SQL).
    G = L D L' by Cholesky without roots; the intercept is not penalised."""
    def g(i, j):
        i, j = min(i, j), max(i, j)
        return f"(_g{i}_{j} + {lam!r})" if i == j and i else f"_g{i}_{j}"

    def minus(first, terms):
        return " - ".join([first, *terms])

    stages = []
    for j in range(k):
        stages.append({f"_d{j}": minus(g(j, j), [f"_l{j}_{m} * _l{j}_{m} * _d{m}" for m in range(j)])})
        if j + 1 < k:
            stages.append({f"_l{i}_{j}": f"({minus(g(i, j), [f'_l{i}_{m} * _l{j}_{m} * _d{m}' for m in range(j)])}) / NULLIF(_d{j}, 0)"
                           for i in range(j + 1, k)})
    for i in range(k):
        stages.append({f"_y{i}": minus(f"_b{i}", [f"_l{i}_{m} * _y{m}" for m in range(i)])})
    for i in reversed(range(k)):
        stages.append({f"_beta{i}": minus(f"_y{i} / NULLIF(_d{i}, 0)", [f"_l{m}_{i} * _beta{m}" for m in range(i + 1, k)])})
    return stages


def per_key_apply(stats: DataFrame, fn, schema: str) -> DataFrame:
    """UDF-2: run a pandas function over per-key rows (one row per key, built
    by aggregates), a batch of keys at a time via Arrow.  The function never
    sees a key's raw rows, so no group has to fit in one task."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return stats.mapInPandas(run, schema)


def forecast_ridge(features: DataFrame, key: str = "symbol", order: str = "date",
                   cols=FEATURES, label: str = "label", lam: float = 1.0) -> DataFrame:
    """FCT-2 (ridge): label ~ all six features per key, L2 penalty ``lam``;
    tomorrow = fitted model applied to the key's latest feature row.  Sums of
    products per key, then the solve in column arithmetic: no Python."""
    cols = list(cols)
    k = len(cols) + 1
    fit = features.groupBy(key).agg(
        *_gram_aggregates(cols, label),
        F.count(label).alias("n_train"),
        *[F.max_by(c, order).alias(f"_x{i + 1}") for i, c in enumerate(cols)],
        F.max_by("close", order).alias("today_close"))
    for stage in ridge_steps(k, lam):
        fit = fit.select("*", *[F.expr(e).alias(name) for name, e in stage.items()])
    tomorrow = " + ".join(["_beta0", *[f"_beta{i} * _x{i}" for i in range(1, k)]])
    return fit.select(key, "n_train", "today_close", F.expr(tomorrow).alias("tomorrow_close"))


def forecast_report(fc: DataFrame, key: str = "symbol", labels: DataFrame | None = None) -> DataFrame:
    """FCT-3: key, tomorrow_close, up/down, diff in percent, 1-based index.
    Keys whose fit failed (no forecast) are left out, as the reference skips
    a symbol whose training raised.  ``labels`` (key, name) names each key in
    the report: fitting is by key, so keys that share a name stay apart."""
    ok = fc.filter(F.col("tomorrow_close").isNotNull())
    rep = ok.select(key, "tomorrow_close",
                    direction("tomorrow_close", "today_close").alias("direction"),
                    pct_diff("tomorrow_close", "today_close", None).alias("diff"))
    if labels is None:
        return with_row_index(rep, [key], "index")
    name = next(c for c in labels.columns if c != key)
    named = rep.join(labels.withColumnRenamed(name, "_label"), key)
    named = with_row_index(named, ["_label", key], "index")
    return named.select(F.col("_label").alias(key), "tomorrow_close", "direction", "diff", "index")
