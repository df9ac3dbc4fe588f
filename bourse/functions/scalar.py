"""Scalar column functions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the number syntax a coercing numeric parse accepts
# (optional sign, digits with an optional point or a leading point, optional
# exponent, surrounding blanks).  Spark's own cast also takes '12d' and '5f'.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Fixed value: the infinity spellings pandas' numeric parse accepts.
INF_PATTERN = r"^[+-]?(?i)(inf|infinity)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(c, n: int) -> Column:
    """SCL-1: left zero-fill text to ``n`` characters; longer text unchanged.

    ``lpad`` alone would cut ``1234567`` to ``123456``.  NULL stays NULL.
    """
    s = _col(c).cast("string")
    return F.when(F.length(s) < n, F.lpad(s, n, "0")).otherwise(s)


def to_numeric(c) -> Column:
    """SCL-2: coercing parse to double, as pandas' ``to_numeric(errors='coerce')``:
    anything unparsable becomes NULL, a number too large for a double too,
    and ``inf`` / ``infinity`` (any case, signed, no blanks) is infinite."""
    s = _col(c).cast("string")
    num = F.trim(s).try_cast("double")
    inf = F.lit(float("inf"))
    finite = F.when(s.rlike(NUMBER_PATTERN) & (F.abs(num) != inf), num)
    infinite = F.when(s.rlike(INF_PATTERN),
                      F.when(s.startswith("-"), -inf).otherwise(inf))
    return F.coalesce(finite, infinite)


def nan_to_null(c) -> Column:
    """pandas treats NaN as missing; Spark keeps NaN apart from NULL."""
    col = _col(c)
    return F.when(~F.isnan(col), col)


def cast_columns(df: DataFrame, types: dict) -> DataFrame:
    """SCL-3: strict type map; under ANSI a bad value fails the whole job."""
    return df.select(*[
        F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
        for c in df.columns
    ])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SCL-4: narrow columns to a table schema (long->int raises on overflow,
    timestamp->date truncates), in the table's column order."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def limit_text(c, n: int, on_overflow: str = "truncate") -> Column:
    """SCL-5: text limited to ``n`` characters.  ``"truncate"`` is what an
    explicit ``::VARCHAR(n)`` does; ``"fail"`` is what loading an over-long
    value into a ``VARCHAR(n)`` column does: the job fails, raised from inside
    the projection (no separate check pass)."""
    col = _col(c)
    if on_overflow == "truncate":
        return F.substring(col, 1, n)
    if on_overflow == "fail":
        return F.when(F.length(col) > n, F.raise_error(
            F.concat(F.lit(f"value too long for {n} characters: "), col))).otherwise(col)
    raise ValueError(f"on_overflow must be 'truncate' or 'fail', not {on_overflow!r}")


def text_too_long(c, n: int) -> Column:
    """SCL-5 (fail): predicate for an audit of over-long values."""
    return F.coalesce(F.length(_col(c)) > n, F.lit(False))


def parse_date(c, fmt: str | None = None) -> Column:
    """SCL-6: text -> date (ISO by default)."""
    return F.to_date(_col(c), fmt) if fmt else F.to_date(_col(c))


def parse_timestamp(c) -> Column:
    """SCL-6: text -> timestamp without zone."""
    return _col(c).cast("timestamp_ntz")


def format_date(c) -> Column:
    """SCL-7: date -> ``YYYY-MM-DD`` text."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def add_years(c, years: int) -> Column:
    """SCL-8: shift a date by whole years (``-20`` = twenty years back)."""
    return F.add_months(_col(c), 12 * years)


def pct_diff(a, b, digits: int | None = 4) -> Column:
    """SCL-9 / SCL-11: (a - b) / b * 100; NULL on a zero or missing base.

    ``digits=None`` leaves the value unrounded.
    """
    v = F.try_divide(_col(a) - _col(b), _col(b)) * F.lit(100.0)
    return F.round(v, digits) if digits is not None else v


def direction(pred, today) -> Column:
    """SCL-10: 'up' when the forecast is above today, else 'down'."""
    return F.when(_col(pred) > _col(today), F.lit("up")).otherwise(F.lit("down"))


def json_field(c, name: str) -> Column:
    """SCL-12: one top-level field of a JSON object as text."""
    return F.get_json_object(_col(c), f"$['{name}']")


def has_json_key(c, name: str) -> Column:
    """SCL-12: whether a JSON object carries ``name`` (e.g. 'Error Message')."""
    return json_field(c, name).isNotNull()
