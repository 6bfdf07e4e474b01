"""Column-level helpers: projections P1-P13, strings G1-G6, dates D1-D6,
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- projections -----------------------------------------------------------

def snake_names(name: str) -> str:
    """P1 rule: '-' and ' ' become '_'."""
    return name.replace("-", "_").replace(" ", "_")


def rename_by_rule(df: DataFrame, rule: Callable[[str], str] = snake_names) -> DataFrame:
    """Rename every column by a rule."""
    return df.toDF(*[rule(c) for c in df.columns])


def rename_map(df: DataFrame, mapping: Mapping[str, str], suffix: tuple[str, str] | None = None,
               prefix: tuple[str, str] | None = None) -> DataFrame:
    """Rename by dictionary, plus an optional suffix rule (e.g. '_ATTRIBUTES' -> '_attr')
    and prefix rule applied to the new names."""
    full = dict(mapping)
    for c in df.columns:
        new = full.get(c, c)
        if suffix and new.endswith(suffix[0]):
            new = new[: -len(suffix[0])] + suffix[1]
        if prefix and new.startswith(prefix[0]):
            new = prefix[1] + new[len(prefix[0]):]
        if new != c:
            full[c] = new
    return df.withColumnsRenamed({k: v for k, v in full.items() if k in df.columns})


def drop_columns(df: DataFrame, names: Sequence[str] = (), pattern: str | None = None) -> DataFrame:
    """Drop by name (unknown names ignored) and/or by regex on the name."""
    gone = [c for c in df.columns if c in set(names) or (pattern and re.search(pattern, c))]
    return df.drop(*gone)


def slice_columns(df: DataFrame, first: str, last: str) -> DataFrame:
    """Columns from ``first`` to ``last`` inclusive, in frame order."""
    cols = df.columns
    return df.select(*cols[cols.index(first): cols.index(last) + 1])


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """P5: names of columns of a kind: 'numeric', 'string', or a simpleString like 'bigint'."""
    out = []
    for f in df.schema.fields:
        t: DataType = f.dataType
        if (kind == "numeric" and isinstance(t, NumericType)) or (kind == "string" and isinstance(t, StringType)) \
                or t.simpleString() == kind:
            out.append(f.name)
    return out


def indicator(cond: Column) -> Column:
    """Threshold / equality indicator as 0/1 int; a comparison with NULL is 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def update_where(col: str, mask: Column, value) -> Column:
    """Value where mask holds, else unchanged."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.when(mask, v).otherwise(F.col(col)).alias(col)


def swap_where(df: DataFrame, a: str, b: str, pred: Column) -> DataFrame:
    """Swap two columns where ``pred`` holds; both read the *old* values in one select."""
    others = [c for c in df.columns if c not in (a, b)]
    return df.select(
        *[F.col(c) for c in others],
        F.when(pred, F.col(b)).otherwise(F.col(a)).alias(a),
        F.when(pred, F.col(a)).otherwise(F.col(b)).alias(b),
    ).select(*df.columns)


def flip_sign_for_keys(df: DataFrame, key: str, keys: Sequence, col: str) -> DataFrame:
    """P10: point correction (sign flip) of the rows with the given keys."""
    return df.withColumn(col, F.when(F.col(key).isin(list(keys)), -F.col(col)).otherwise(F.col(col)))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """P11."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def label_by_position(code: Column | str, labels: Sequence[str]) -> Column:
    """Code -> label by position in a list (0-based code); NULL for a code without a label."""
    return F.get(F.array(*[F.lit(s) for s in labels]), _c(code).cast("int"))


# ---- strings -----------------------------------------------------------------

def replace_chars(c: Column | str, old: str, new: str) -> Column:
    """G1: literal replace."""
    return F.replace(_c(c), F.lit(old), F.lit(new))


def split_part(c: Column | str, delim: str, n: int) -> Column:
    """N-th (1-based) part after splitting on a literal delimiter; NULL past the end."""
    return F.get(F.split(_c(c), "\\Q" + delim + "\\E", -1), n - 1)


def squash_whitespace(c: Column | str) -> Column:
    """Strip and remove all inner whitespace."""
    return F.regexp_replace(F.trim(_c(c)), r"\s+", "")


def join_text(*cols: Column | str, sep: str = "_") -> Column:
    """Concatenate with a separator; NULL if any part is NULL (like ``a + '_' + b``)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c))
    return F.concat(*parts)


def matches(c: Column | str, pattern: str) -> Column:
    """Regular-expression search (not anchored unless the pattern is)."""
    return _c(c).rlike(pattern)


def ends_with(c: Column | str, suffix: str) -> Column:
    """G6."""
    return _c(c).endswith(suffix)


# ---- dates -------------------------------------------------------------------

def parse_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """Text -> timestamp (NULL when it does not parse)."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(c))


def date_plus_hours(d: Column | str, hours: Column | str) -> Column:
    """Date + n hours as a timestamp without time zone."""
    return _c(d).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), _c(hours).cast("int"))


def seconds_of_day(ts: Column | str) -> Column:
    """Time of day as seconds since midnight (INT), comparable with ``<``."""
    t = _c(ts)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def calendar_parts(ts: Column | str, prefix: str = "") -> dict[str, Column]:
    """Hour, day of year, weekday (Monday=0) and weekday name."""
    t = _c(ts)
    return {
        f"{prefix}hour": F.hour(t),
        f"{prefix}dayofyear": F.dayofyear(t),
        f"{prefix}weekday": F.weekday(t),
        f"{prefix}weekday_name": F.date_format(t, "EEEE"),
    }


def drop_zone(ts: Column | str) -> Column:
    """Wall-clock time without zone."""
    return _c(ts).cast("timestamp_ntz")


# ---- maths -------------------------------------------------------------------

def log_or_neg_inf(c: Column | str) -> Column:
    """M1: natural log; ln(0) is -inf as in NumPy (Spark's ``ln`` gives NULL)."""
    x = _c(c)
    return F.when(x == 0, F.lit(float("-inf"))).otherwise(F.ln(x))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """M3."""
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def logistic(c: Column | str) -> Column:
    """M3."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def round_half_even(c: Column | str, digits: int) -> Column:
    """M2: NumPy-style rounding (half to even)."""
    return F.bround(_c(c), digits)
