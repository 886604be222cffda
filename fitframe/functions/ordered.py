"""Running totals and lags in key order without an unpartitioned window.

AUC, KS and Wasserstein distances need cumulative sums over a table sorted by
value; MASE needs the previous value of a series.  A window ordered over a
whole table or over one huge series would put it in one task.  Instead, any
group (or the whole table) larger than ``rows_per_bucket`` rows is cut into
key ranges of about that many rows using ``percentile_approx`` cut points;
each range is its own window partition, and what the ranges before it
contribute (their totals, or the last value before the range) comes from a
table with one row per range, computed with a window partitioned by group and
joined back.  Nothing per group is collected to the driver.  The result is
exact: approximate cuts only affect how balanced the ranges are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ROWS_PER_BUCKET = 1_000_000


def range_key(df: DataFrame, key: str):
    """A double that never falls as ``key`` rises, whatever its type: ranges
    are cut on it, while rows within a range are ordered by the key itself."""
    kind, c = df.schema[key].dataType, F.col(key)
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', `{key}`)").cast("double")
    # text and binary are ordered by their bytes: the first six as a number
    head = F.hex(F.substring(c.cast("binary"), 1, 6))
    return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")


def assign_buckets(df: DataFrame, key: str, by: Sequence[str] = (),
                   rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                   n_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Add ``_bucket`` (key range id within ``by``); returns (frame, split?).
    ``n_rows`` (an exact row count already known, e.g. of a materialised
    state) skips the sizing job when the whole table fits one range."""
    by = list(by)
    if n_rows is not None and n_rows <= rows_per_bucket:
        return df.withColumn("_bucket", F.lit(0)), False
    if by:
        counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        top = counts.agg(F.max("_n").alias("m")).first()["m"] or 0
    else:
        counts = None
        top = df.count()
    if top <= rows_per_bucket:
        return df.withColumn("_bucket", F.lit(0)), False
    nb = math.ceil(top / rows_per_bucket)
    fracs = [i / nb for i in range(1, nb)]
    kd = range_key(df, key)
    if not by:
        cuts = sorted(set(df.agg(F.percentile_approx(kd, fracs, 10000)).first()[0] or []))
        b = None
        for c in cuts:
            t = (kd > F.lit(float(c))).cast("int")
            b = t if b is None else b + t
        return df.withColumn("_bucket", b if b is not None else F.lit(0)), True
    big = counts.where(F.col("_n") > rows_per_bucket).select(*by)
    cut_tab = (df.join(big, by, "left_semi").groupBy(*by)
               .agg(F.array_sort(F.array_distinct(F.percentile_approx(kd, fracs, 10000))).alias("_cuts")))
    out = df.join(cut_tab, by, "left")
    bucket = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.col("_cuts"), lambda c: c < kd)))
    return out.withColumn("_bucket", bucket).drop("_cuts"), True


def running_totals(df: DataFrame, key: str, sums: Sequence[str], by: Sequence[str] = (),
                   rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
                   with_next_key: bool = False, n_rows: int | None = None) -> DataFrame:
    """Add ``cum_<s>`` (sum of ``s`` over rows with key <= this key, within
    ``by``) for every ``s`` in ``sums``; optionally ``next_key`` (the next
    larger key within ``by``, NULL for the last).

    ``df`` must hold one row per ``(by..., key)``.
    """
    by = list(by)
    sums = list(sums)
    bucketed, split = assign_buckets(df, key, by, rows_per_bucket, n_rows)
    w = Window.partitionBy(*by, "_bucket").orderBy(key)
    wc = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not split:
        sel = [F.col(c) for c in df.columns] + [F.sum(s).over(wc).alias(f"cum_{s}") for s in sums]
        if with_next_key:
            sel.append(F.lead(key).over(w).alias("next_key"))
        return bucketed.select(*sel)
    tot = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums],
                                               F.min(key).alias("_min"))
    wb = Window.partitionBy(*by).orderBy("_bucket")
    off = tot.select(*by, "_bucket",
                     *[F.coalesce(F.sum(f"_t_{s}").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias(f"_off_{s}") for s in sums],
                     F.lead("_min").over(wb).alias("_next_min"))
    out = bucketed.join(off, [*by, "_bucket"], "left")
    sel = [F.col(c) for c in df.columns]
    sel += [(F.sum(s).over(wc) + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums]
    if with_next_key:
        sel.append(F.coalesce(F.lead(key).over(w), F.col("_next_min")).alias("next_key"))
    return out.select(*sel)


def lag_within(df: DataFrame, key: str, value: str, by: Sequence[str] = (),
               rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Add ``prev_<value>``: ``value`` of the row with the next smaller key
    within ``by`` (keys unique within ``by``)."""
    by = list(by)
    bucketed, split = assign_buckets(df, key, by, rows_per_bucket)
    w = Window.partitionBy(*by, "_bucket").orderBy(key)
    if not split:
        return bucketed.select(*[F.col(c) for c in df.columns], F.lag(value).over(w).alias(f"prev_{value}"))
    last = bucketed.groupBy(*by, "_bucket").agg(F.max_by(F.col(value), F.col(key)).alias("_last"))
    carry = last.select(*by, "_bucket", F.lag("_last").over(Window.partitionBy(*by).orderBy("_bucket"))
                        .alias("_carry"))
    out = bucketed.join(carry, [*by, "_bucket"], "left")
    prev = F.when(F.row_number().over(w) == 1, F.col("_carry")).otherwise(F.lag(value).over(w))
    return out.select(*[F.col(c) for c in df.columns], prev.alias(f"prev_{value}"))
