"""Per-symbol time-series operators (NUL-1, WIN-1..4, AGG-5, SRT-*).

A plain ``Window.partitionBy(symbol).orderBy(date)`` sends a symbol's whole
history to one task, so a symbol holding a third of the rows would hold a
third of the data in one task.  Here the window runs per (symbol, segment),
where the segment is a coarse slice of the order column (a month of daily
bars by default).  What crosses a segment border -- the last non-null value
for a forward fill, the previous row for a lag, the next row for a lead --
comes from a per-(symbol, segment) summary, carried along the segments of
each symbol with a small window (one row per segment) and joined back.

The rows are read once and dealt out once, by (symbol, segment): the summary,
the join and the main window all use that one exchange.  A missing symbol or
order value is a value like any other there (the symbol goes in a struct, the
slice gets a number), so both sides of the join keep the same exchange and
such rows get what the plain window would give them.  NaN counts as missing.

``segment="range"`` is for rows that no slice bounds (several rows a day and
symbol, intraday data): segments are then ranges of (symbol, order) of about
equal size, found by sampling and written down, so any symbol is split.

A pass can also carry whole-key statistics (count, mean and M2 per segment,
merged across segments), and with ``keep_segment`` its output keeps the
segment columns so the next pass reuses the same partitioning: the forecast
features (change, lead, standard score) cost one exchange of the rows.

``segment=None`` gives the textbook unsegmented window (used by tests to
cross-check the segmented plan).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.session import ensure_checkpoint_dir

DEFAULT_SEGMENT = "auto"
# Width of a segment for a numeric order column under "auto".
NUMERIC_SEGMENT_WIDTH = 1024


# The columns that hold a row's place in a pass: its key and its segment.
KEY, SEGMENT = "_key", "_seg"
NO_SEGMENT = -(2 ** 62)

# Types whose values fit a hash aggregate's buffer, and the smallest value of
# those that an order column may have.
_LOWEST = {"tinyint": -2 ** 7, "smallint": -2 ** 15, "int": -2 ** 31, "bigint": -2 ** 63,
           "float": float("-inf"), "double": float("-inf"), "date": "0001-01-01",
           "timestamp": "0001-01-01 00:00:00", "timestamp_ntz": "0001-01-01 00:00:00"}
_FIXED_WIDTH = {*_LOWEST, "boolean"}


def _list(x):
    return [x] if isinstance(x, str) else list(x)


# Bits that the values of an order column take, and its whole number.
_BITS = {"boolean": 1, "tinyint": 8, "smallint": 16, "int": 32, "bigint": 64, "date": 32, "timestamp": 64}
_PACKED_BITS = 126         # of a 38-digit number


def _whole(df: DataFrame, col: str) -> Column:
    c, kind = F.col(f"`{col}`"), dict(df.dtypes)[col]
    return F.unix_date(c) if kind == "date" else F.unix_micros(c) if kind == "timestamp" else c.cast("bigint")


def packed_order(df: DataFrame, order) -> Column | None:
    """Several fixed-width order columns as one number that sorts as they do, a
    missing value first; None where they are no whole numbers or take too many
    bits.  Such a number fits a hash aggregate's buffer, which a struct does not."""
    types, order = dict(df.dtypes), _list(order)
    if not all(types.get(o) in _BITS for o in order) or sum(_BITS[types[o]] + 1 for o in order) > _PACKED_BITS:
        return None
    def whole(x: int | Column) -> Column:
        return (F.lit(Decimal(x)) if isinstance(x, int) else x).cast("decimal(38,0)")

    number = whole(0)
    for o in order:
        bits = _BITS[types[o]]
        own = F.coalesce(whole(whole(_whole(df, o)) + whole(2 ** (bits - 1) + 1)), whole(0))
        number = whole(whole(number * whole(2 ** (bits + 1))) + own)
    return number


def plain_order(df: DataFrame, order, cols) -> bool:
    """Whether ``min_by`` / ``max_by`` of ``cols`` can be a hash aggregate: one
    order column or several that pack into a number, fixed-width values."""
    types = dict(df.dtypes)
    order = _list(order)
    one = len(order) == 1 and types.get(order[0]) in _LOWEST
    return (one or packed_order(df, order) is not None) and all(types[c] in _FIXED_WIDTH for c in cols)


def ordering_of(df: DataFrame, order, cols) -> Column:
    """What ``min_by`` / ``max_by`` of ``cols`` should go by: the order column
    itself, or the packed columns, where that gives a hash aggregate (a missing
    one is the smallest), else a struct."""
    order = _list(order)
    if not plain_order(df, order, cols):
        return F.struct(*[F.col(f"`{o}`") for o in order])
    if len(order) == 1 and dict(df.dtypes)[order[0]] in _LOWEST:
        kind = dict(df.dtypes)[order[0]]
        return F.coalesce(F.col(f"`{order[0]}`"), F.lit(_LOWEST[kind]).cast(kind))
    return packed_order(df, order)


def nan_missing(df: DataFrame, cols) -> DataFrame:
    """NaN in the floating ones of ``cols`` as NULL (pandas treats both as missing)."""
    types = dict(df.dtypes)
    odd = [c for c in cols if types.get(c) in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in odd}) if odd else df


def segment_of(c: Column, segment, dtype: str | None = None) -> Column:
    """A monotone slice number of the order column: ``"year"``, ``"month"``,
    ``"week"``, ``"day"``, ``"hour"``, an int width for numbers, or a Column.
    ``"auto"`` is a month for dates and timestamps (daily bars: about 21 rows
    per symbol and segment) and ``NUMERIC_SEGMENT_WIDTH`` for numbers."""
    if isinstance(segment, Column):
        return segment
    if segment == "auto":
        is_time = dtype is None or dtype.startswith(("date", "timestamp"))
        segment = "month" if is_time else NUMERIC_SEGMENT_WIDTH
    if isinstance(segment, int):
        return F.floor(c / F.lit(segment))
    d = F.to_date(c)
    if segment == "hour":   # time-zone free: day number * 24 + hour of day
        return F.datediff(d, F.lit("1970-01-01").cast("date")) * 24 + F.hour(c)
    if segment == "year":
        return F.year(d)
    if segment == "month":
        return F.year(d) * 12 + F.month(d) - 1
    if segment == "week":
        return F.floor(F.datediff(d, F.lit("1970-01-05").cast("date")) / 7)
    if segment == "day":
        return F.datediff(d, F.lit("1970-01-01").cast("date"))
    raise ValueError(f"unknown segment {segment!r}")


@dataclass
class SeriesPass:
    """One window pass over each key in order, with border carry.

    ``ffill``: columns to forward fill (replaced in place).
    ``lag`` / ``lead``: columns whose previous / next value is exposed as
    ``_prev_<c>`` / ``_next_<c>``.
    ``prev_filled``: also expose ``_prevff_<c>``, the previous row's filled
    value, for every ffill column (ffill and lag fused into one pass).
    ``stats``: columns whose whole-key mean and population stddev are exposed
    as ``_mean_<c>`` / ``_sd_<c>`` (per-segment count, mean and M2 merged
    across segments, so no extra join on the key alone).
    Also exposed: ``_first`` (first row of the key) and ``_last``.

    If the input already has the columns ``_key`` and ``_seg`` (the output of
    an earlier pass run with ``keep_segment=True``), they are reused: the data
    is then already hash-partitioned on them and the pass adds no exchange of
    the rows.
    """

    keys: list
    order: list
    ffill: list = field(default_factory=list)
    lag: list = field(default_factory=list)
    lead: list = field(default_factory=list)
    segment: object = DEFAULT_SEGMENT
    prev_filled: bool = False
    stats: list = field(default_factory=list)
    keep_segment: bool = False

    def apply(self, df: DataFrame) -> DataFrame:
        keys, order = _list(self.keys), _list(self.order)
        df = nan_missing(df, {*self.ffill, *self.lag, *self.lead, *self.stats})
        ocols = [F.col(o) for o in order]
        if self.segment is None:
            return self._unsegmented(df, keys, ocols)
        d = df if SEGMENT in df.columns else self.dealt(df)
        place = [KEY, SEGMENT]

        aggs = [F.lit(1).alias("_one")]
        for c in self.ffill:
            aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering_of(d, order, [c])))
                        .alias(f"_tailnn_{c}"))
        for c in self.lag:
            aggs.append(F.max_by(F.col(c), ordering_of(d, order, [c])).alias(f"_tail_{c}"))
        for c in self.lead:
            aggs.append(F.min_by(F.col(c), ordering_of(d, order, [c])).alias(f"_head_{c}"))
        for c in self.stats:
            aggs += [F.count(c).alias(f"_n_{c}"), F.avg(c).alias(f"_mu_{c}"),
                     (F.var_pop(c) * F.count(c)).alias(f"_m2_{c}")]
        summary = d.groupBy(*place).agg(*aggs)
        if self.stats:
            summary = self._key_stats(summary, [KEY])

        ws = Window.partitionBy(KEY).orderBy(SEGMENT)
        before = ws.rowsBetween(Window.unboundedPreceding, -1)
        carry_cols = [F.col(c) for c in place]
        for c in self.ffill:
            carry_cols.append(F.last(f"_tailnn_{c}", ignorenulls=True).over(before)
                              .alias(f"_inff_{c}"))
        for c in self.lag:
            carry_cols.append(F.lag(f"_tail_{c}").over(ws).alias(f"_inlag_{c}"))
        for c in self.lead:
            carry_cols.append(F.lead(f"_head_{c}").over(ws).alias(f"_inlead_{c}"))
        for c in self.stats:
            carry_cols += [F.col(f"_mean_{c}"), F.col(f"_sd_{c}")]
        carry_cols.append(F.lag("_one").over(ws).isNull().alias("_segfirst"))
        carry_cols.append(F.lead("_one").over(ws).isNull().alias("_seglast"))
        carry = summary.select(*carry_cols)

        j = d.join(carry, place, "left")

        w = Window.partitionBy(*place).orderBy(*ocols)
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        first_in_seg = F.lag(F.lit(1)).over(w).isNull()
        last_in_seg = F.lead(F.lit(1)).over(w).isNull()
        out = {}
        for c in self.ffill:
            out[c] = F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"_inff_{c}"))
            if self.prev_filled:
                # the filled value of the previous row = last non-null before it
                out[f"_prevff_{c}"] = F.coalesce(F.last(c, ignorenulls=True).over(before),
                                                 F.col(f"_inff_{c}"))
        for c in self.lag:
            out[f"_prev_{c}"] = F.when(first_in_seg, F.col(f"_inlag_{c}")) \
                                 .otherwise(F.lag(c).over(w))
        for c in self.lead:
            out[f"_next_{c}"] = F.when(last_in_seg, F.col(f"_inlead_{c}")) \
                                 .otherwise(F.lead(c).over(w))
        for c in self.stats:
            out[f"_mean_{c}"] = F.col(f"_mean_{c}")
            out[f"_sd_{c}"] = F.col(f"_sd_{c}")
        out["_first"] = first_in_seg & F.coalesce(F.col("_segfirst"), F.lit(True))
        out["_last"] = last_in_seg & F.coalesce(F.col("_seglast"), F.lit(True))
        base = [c for c in df.columns if c not in place] + (place if self.keep_segment else [])
        out.update({k: F.col(KEY).getField(k) for k in keys if k not in out})
        return self._project(j, base, out)

    def dealt(self, df: DataFrame) -> DataFrame:
        """The rows dealt out by (key, segment), with both as never-null columns."""
        keys, order = _list(self.keys), _list(self.order)
        # the key lives in the struct alone: the summary then needs the same
        # columns as the rows, and both use one exchange
        keyed = df.withColumn(KEY, F.struct(*[F.col(k) for k in keys])).drop(*keys)
        if isinstance(self.segment, str) and self.segment == "range":
            ensure_checkpoint_dir(df.sparkSession)
            # written down: bounds come from a sample, and a lost task must not draw another
            return (keyed.repartitionByRange(KEY, *order)
                    .withColumn(SEGMENT, F.spark_partition_id().cast("long")).checkpoint()
                    .repartition(KEY, SEGMENT))
        number = segment_of(F.col(order[0]), self.segment, dict(df.dtypes).get(order[0]))
        return (keyed.withColumn(SEGMENT, F.coalesce(number.cast("long"), F.lit(NO_SEGMENT)))
                .repartition(KEY, SEGMENT))

    @staticmethod
    def _key_stats(summary: DataFrame, keys) -> DataFrame:
        """Whole-key mean and population stddev from per-segment (n, mean, M2),
        merged with the parallel-variance formula over the key's segments."""
        wk = Window.partitionBy(*keys)
        cols = [c[len("_n_"):] for c in summary.columns if c.startswith("_n_")]
        step = summary
        for c in cols:
            n, mu = F.col(f"_n_{c}"), F.col(f"_mu_{c}")
            total = F.sum(n).over(wk)
            step = step.withColumn(f"_mean_{c}", F.try_divide(
                F.sum(F.coalesce(n * mu, F.lit(0.0))).over(wk), total))
        for c in cols:
            n, mu, m2 = F.col(f"_n_{c}"), F.col(f"_mu_{c}"), F.col(f"_m2_{c}")
            spread = F.coalesce(m2, F.lit(0.0)) + F.coalesce(
                n * F.pow(mu - F.col(f"_mean_{c}"), 2), F.lit(0.0))
            step = step.withColumn(f"_sd_{c}", F.sqrt(F.try_divide(
                F.sum(spread).over(wk), F.sum(n).over(wk))))
        return step

    def _unsegmented(self, df, keys, ocols):
        w = Window.partitionBy(*keys).orderBy(*ocols)
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        out = {}
        for c in self.ffill:
            out[c] = F.last(c, ignorenulls=True).over(upto)
            if self.prev_filled:
                out[f"_prevff_{c}"] = F.last(c, ignorenulls=True).over(
                    w.rowsBetween(Window.unboundedPreceding, -1))
        for c in self.lag:
            out[f"_prev_{c}"] = F.lag(c).over(w)
        for c in self.lead:
            out[f"_next_{c}"] = F.lead(c).over(w)
        whole = Window.partitionBy(*keys)
        for c in self.stats:
            out[f"_mean_{c}"] = F.avg(c).over(whole)
            out[f"_sd_{c}"] = F.stddev_pop(c).over(whole)
        out["_first"] = F.lag(F.lit(1)).over(w).isNull()
        out["_last"] = F.lead(F.lit(1)).over(w).isNull()
        return self._project(df, df.columns, out)

    @staticmethod
    def _project(j, base_cols, out):
        cols = [out[c].alias(c) if c in out else F.col(f"`{c}`") for c in base_cols]
        cols += [v.alias(k) for k, v in out.items() if k not in base_cols]
        return j.select(*cols)


def ffill(df: DataFrame, key, order, cols, segment=DEFAULT_SEGMENT) -> DataFrame:
    """NUL-1: forward fill ``cols`` per key in order; never crosses a key, so a
    key's leading gap stays NULL (the stacked-file fill of the reference would
    take the previous symbol's value)."""
    cols = _list(cols)
    p = SeriesPass(keys=_list(key), order=_list(order), ffill=cols, segment=segment)
    return p.apply(df).drop("_first", "_last")


def pct_change(df: DataFrame, key, order, col: str, out: str, fill=None,
               segment=DEFAULT_SEGMENT) -> DataFrame:
    """WIN-1: x / previous x - 1 per key.  A zero or missing base gives NULL;
    ``fill`` (e.g. 0) is used for the first row of each key only."""
    p = SeriesPass(keys=_list(key), order=_list(order), lag=[col], segment=segment)
    r = p.apply(df)
    prev = F.col(f"_prev_{col}")
    change = F.try_divide(F.col(col) - prev, prev)
    if fill is not None:
        change = F.when(F.col("_first"), F.lit(fill)).otherwise(change)
    return r.withColumn(out, change).drop(f"_prev_{col}", "_first", "_last")


def ffill_pct_change(df: DataFrame, key, order, col: str, out: str, fill=None,
                     segment=DEFAULT_SEGMENT) -> DataFrame:
    """NUL-1 -> FLT-1 -> WIN-1 fused into one pass: forward fill ``col`` per key,
    drop rows still missing (a key's leading gap), then the change to the
    previous remaining row (``fill`` on each key's first remaining row).

    After a per-key forward fill only a leading run can be NULL, so the
    previous remaining row's value is the last non-null value before the
    current row: no second shuffle is needed.
    """
    p = SeriesPass(keys=_list(key), order=_list(order), ffill=[col],
                   prev_filled=True, segment=segment).apply(df)
    p = p.filter(F.col(col).isNotNull())
    prev = F.col(f"_prevff_{col}")
    change = F.try_divide(F.col(col) - prev, prev)
    if fill is not None:
        change = F.when(prev.isNull(), F.lit(fill)).otherwise(change)
    return p.withColumn(out, change).drop(f"_prevff_{col}", "_first", "_last")


def next_value(df: DataFrame, key, order, col: str, out: str,
               segment=DEFAULT_SEGMENT) -> DataFrame:
    """WIN-2: the next row's value per key (tomorrow's close as today's label)."""
    p = SeriesPass(keys=_list(key), order=_list(order), lead=[col], segment=segment)
    return p.apply(df).withColumnRenamed(f"_next_{col}", out).drop("_first", "_last")


def latest(df: DataFrame, key, order, cols=None) -> DataFrame:
    """WIN-3: the latest row per key, as a map-side-combined ``max_by``: a hash
    aggregate where order and columns are of fixed width."""
    keys, order = _list(key), _list(order)
    cols = [c for c in (cols or df.columns) if c not in keys]
    ordering = ordering_of(df, order, cols)
    if plain_order(df, order, cols):
        return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*[F.max_by(F.col(f"`{c}`"), ordering).alias(c) for c in cols])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), ordering).alias("_l"))
    return agg.select(*keys, *[F.col("_l").getField(c).alias(c) for c in cols])


def drop_last(df: DataFrame, label: str) -> DataFrame:
    """WIN-4: drop the rows that have no label yet (the last row of each key)."""
    return df.filter(F.col(label).isNotNull())


def zscore(df: DataFrame, key, col: str, out: str) -> DataFrame:
    """AGG-5: (x - mean) / population stddev per key; a constant series gives 0.

    Mean and stddev come from a partial aggregate per key, joined back; AQE
    broadcasts the per-key table when small and splits a skewed key otherwise.
    """
    keys = _list(key)
    df = nan_missing(df, [col])
    stats = df.groupBy(*keys).agg(F.avg(col).alias("_mu"),
                                  F.stddev_pop(col).alias("_sd"))
    stats = stats.select(*[F.col(k).alias(f"_zk{i}") for i, k in enumerate(keys)],
                         "_mu", "_sd")
    cond = [df[k].eqNullSafe(stats[f"_zk{i}"]) for i, k in enumerate(keys)]
    j = df.join(stats, cond, "inner")
    z = F.when(F.col(col).isNull(), F.lit(None).cast("double")) \
         .when(F.col("_sd") == 0, F.lit(0.0)) \
         .otherwise(F.try_divide(F.col(col) - F.col("_mu"), F.col("_sd")))
    return j.select(*[F.col(f"`{c}`") for c in df.columns if c != out], z.alias(out))


def sort_desc(df: DataFrame, col: str, tiebreak=None) -> DataFrame:
    """SRT-1: descending, missing (NULL and NaN) last; a total order when a
    tiebreak column is given.  Spark would sort NaN first on descending."""
    return df.orderBy(missing_last(df, col), *[F.col(t) for t in _list(tiebreak or [])])


def missing_last(df: DataFrame, col: str) -> Column:
    """The order of ``sort_desc``, for a sort by range."""
    c = F.col(col)
    return (F.when(~F.isnan(c), c) if dict(df.dtypes)[col] in ("double", "float") else c).desc_nulls_last()
