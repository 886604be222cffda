"""Column-expression building blocks.

Everything here returns a Catalyst ``Column`` so that a chain of steps stays
one plan inside whole-stage codegen.  No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """G1: names of numeric columns (booleans excluded), in schema order."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def placeholder_to_null(c: Column | str, placeholders: Iterable[str]) -> Column:
    """Exact, case-sensitive match against the placeholder list -> NULL."""
    col = as_col(c)
    return F.when(~col.isin(list(placeholders)), col)


def try_double(c: Column | str) -> Column:
    """Numeric coercion; text that does not parse, or says NaN, becomes NULL."""
    return nan_to_null(as_col(c).try_cast("double"))


def map_values(c: Column | str, mapping: Mapping, out_type: str | None = None) -> Column:
    """Dictionary lookup, unmapped (and NULL) -> NULL."""
    col = as_col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    if out is None:
        out = F.lit(None)
    return out.cast(out_type) if out_type else out


def clip(c: Column | str, lo, hi) -> Column:
    """O2: clip to [lo, hi]; NULL and NaN give NULL (bare least/greatest would
    fill NULL, and NaN counts as the largest value)."""
    col = nan_to_null(c)
    inner = col
    if lo is not None:
        inner = F.greatest(inner, F.lit(float(lo)))
    if hi is not None:
        inner = F.least(inner, F.lit(float(hi)))
    return F.when(col.isNotNull(), inner)


def log1p_floor0(c: Column | str) -> Column:
    """O3: log1p after flooring at 0 (NULL and NaN give NULL)."""
    col = number(c)
    return F.when(col.isNotNull(), F.log1p(F.greatest(col, F.lit(0.0))))


def nan_to_null(c: Column | str) -> Column:
    """NaN counts as missing, as everywhere in this library."""
    col = as_col(c)
    return F.when(~F.isnan(col), col)


def number(c: Column | str) -> Column:
    """A numeric column as double, NaN as NULL."""
    return nan_to_null(as_col(c).cast("double"))


def missing(df: DataFrame, c: str) -> Column:
    """True where a cell is NULL or NaN."""
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def filled(df: DataFrame, c: str, value) -> Column:
    """Missing cells replaced by ``value``."""
    col = nan_to_null(c) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c)
    kind = df.schema[c].dataType
    if isinstance(value, str) and not isinstance(kind, T.StringType):
        return F.coalesce(col, F.lit(value).cast(kind))   # a date or time saved as text
    return F.coalesce(col, F.lit(value))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """coalesce(num, 0) / (den with 0 -> 1); NULL den -> NULL."""
    n = F.coalesce(as_col(num).cast("double"), F.lit(0.0))
    d = as_col(den).cast("double")
    return n / F.when(d == 0, F.lit(1.0)).otherwise(d)


def flag(cond: Column) -> Column:
    """Boolean -> int 0/1 with NULL -> 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def bin_label(c: Column | str, edges: list[float], labels: list[str],
              unknown: str = "Unknown") -> Column:
    """Right-closed bins ``(e[i], e[i+1]]`` with the lowest edge included.

    Values outside ``[e[0], e[-1]]`` get ``unknown``.  ``Bucketizer`` is
    left-closed, so the bins are written as one CASE instead.
    """
    col = as_col(c)
    n_bins = len(edges) - 1
    if n_bins < 1:
        return F.lit(unknown)
    expr = F.when(col.isNull(), F.lit(unknown)).when(col < F.lit(edges[0]), F.lit(unknown))
    for i in range(n_bins):
        expr = expr.when(col <= F.lit(edges[i + 1]), F.lit(labels[i]))
    return expr.otherwise(F.lit(unknown))
