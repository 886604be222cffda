"""Profiling (P1-P10) as tidy DataFrames.

Every statistic of every column comes from one wide aggregation (or one
``groupBy(column, value)`` over a stacked view for categorical columns); no
job per column and no window over raw rows.  Pictures are not drawn: the
histogram is a bin-count table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs
from ..functions.quantiles import column_stats, exact_quantiles
from ..functions.sizing import materialize_state


def _stack(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long view ``(c, v)`` of string-cast values, one row per cell."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s")
    ).select("s.c", "s.v")


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.select(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def missing_report(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Missing count and percent per column, only > 0, most missing first."""
    cols = list(cols) if cols is not None else df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.sum(exprs.missing(df, c).cast("long")).alias(f"m{i}") for i, c in enumerate(cols)])
    long = agg.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count"))
        for i, c in enumerate(cols)])).alias("s"))
    return (long.select("s.column", "s.missing_count",
                        F.round(F.col("s.missing_count") * 100.0 / F.col("_n"), 6).alias("missing_pct"))
            .where(F.col("missing_count") > 0)
            .orderBy(F.desc("missing_pct"), "column"))


def dtype_frequency(df: DataFrame) -> DataFrame:
    """How many columns of each type."""
    spark = df.sparkSession
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    return spark.createDataFrame(sorted(counts.items()), "dtype string, n_columns int")


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Share of each target value, NULLs excluded."""
    counts = materialize_state(df.where(~exprs.missing(df, target)).groupBy(target).agg(F.count(F.lit(1)).alias("n"))).df
    total = counts.agg(F.sum("n")).first()[0] or 1      # of the counts, not of the rows
    return counts.select(F.col(target).alias("value"), "n", F.round(F.col("n") / F.lit(float(total)), 6).alias("share"))


def describe_numeric(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """P5: count, mean, std (sample), min, quartiles (interpolated), max."""
    spark = df.sparkSession
    cols = exprs.numeric_columns(df) if cols is None else cols
    if not cols:
        return spark.createDataFrame([], _DESC_SCHEMA)
    extra = {}
    for i, c in enumerate(cols):
        x = exprs.number(c)
        extra.update({f"n{i}": F.count(x), f"a{i}": F.avg(x), f"s{i}": F.stddev_samp(x),
                      f"lo{i}": F.min(x), f"hi{i}": F.max(x)})
    row: dict = {}
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], extra_aggs=extra, extra_out=row)

    def r(v):
        return None if v is None else round(float(v), digits)
    rows = [(c, int(row[f"n{i}"]), r(row[f"a{i}"]), r(row[f"s{i}"]), r(row[f"lo{i}"]),
             r(q[c][0]), r(q[c][1]), r(q[c][2]), r(row[f"hi{i}"])) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, _DESC_SCHEMA)


_DESC_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("column", T.StringType()), ("count", T.LongType()), ("mean", T.DoubleType()),
    ("std", T.DoubleType()), ("min", T.DoubleType()), ("p25", T.DoubleType()),
    ("p50", T.DoubleType()), ("p75", T.DoubleType()), ("max", T.DoubleType())]])


def value_counts(df: DataFrame, cols: list[str], dropna: bool = True) -> DataFrame:
    """``(column, value, n)`` for every value of every listed column."""
    st = _stack(df, cols)
    if dropna:
        st = st.where(F.col("v").isNotNull())
    return st.groupBy(F.col("c").alias("column"), F.col("v").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count (non-NULL), unique, top (ties -> smallest value), freq."""
    cols = exprs.string_columns(df) if cols is None else cols
    vc = value_counts(df, cols)
    return vc.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("b")
    ).select("column", "count", "unique", F.col("b.v").alias("top"), (-F.col("b.k")).alias("freq"))


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bin counts ``(column, bin, lo, hi, n)``; the last bin
    is closed on the right.  Only non-empty bins are listed."""
    cols = exprs.numeric_columns(df) if cols is None else cols
    st = column_stats(df, cols)
    parts = []
    for c in cols:
        n, lo, hi = st[c]
        if n == 0:
            continue
        x = F.col(c).cast("double")
        width = (hi - lo) / bins if hi > lo else 1.0
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int") if hi > lo else F.lit(0)
        parts.append(F.when(x.isNotNull() & ~F.isnan(x), F.struct(F.lit(c).alias("column"), b.alias("bin"),
                                                                  F.lit(lo).alias("_lo"), F.lit(width).alias("_w"))))
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo double, hi double, n long")
    st_df = df.select(F.explode(F.array(*parts)).alias("s")).where(F.col("s").isNotNull())
    return (st_df.groupBy("s.column", "s.bin", "s._lo", "s._w").agg(F.count(F.lit(1)).alias("n"))
            .select("column", "bin", F.round(F.col("_lo") + F.col("bin") * F.col("_w"), 6).alias("lo"),
                    F.round(F.col("_lo") + (F.col("bin") + 1) * F.col("_w"), 6).alias("hi"), "n"))


def category_counts(df: DataFrame, cols: list[str] | None = None, max_unique: int = 50) -> DataFrame:
    """Value counts of categorical columns with fewer than ``max_unique``
    distinct values, most frequent first."""
    cols = exprs.string_columns(df) if cols is None else cols
    vc = value_counts(df, cols)
    small = vc.groupBy("column").agg(F.count(F.lit(1)).alias("_u")).where(F.col("_u") < max_unique)
    return (vc.join(F.broadcast(small.select("column")), "column")
            .orderBy("column", F.desc("n"), "value"))


def target_profile(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """Per feature: missing, distinct, correlation with the target
    (numeric) or NULL (categorical)."""
    cols = [c for c in (df.columns if cols is None else cols) if c != target]
    numeric = set(exprs.numeric_columns(df))
    y = exprs.number(target)
    # one stacked groupBy counts distinct values; several count_distinct in one
    # aggregation would copy every row once per column
    distinct = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.when(
        ~exprs.missing(df, c), F.col(c).cast("string")).alias("v")) for c in cols])).alias("s"))
        .groupBy("s.c", "s.v").agg(F.lit(1).alias("one")).groupBy("c").agg(F.count("v").alias("distinct")))
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.sum(exprs.missing(df, c).cast("long")).alias(f"m{i}"))
        aggs.append(F.corr(exprs.number(c), y).alias(f"r{i}") if c in numeric else F.lit(None).cast("double").alias(f"r{i}"))
    rest = df.agg(*aggs).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"),
                 F.round(exprs.nan_to_null(f"r{i}"), 6).alias("target_corr")) for i, c in enumerate(cols)])).alias("s")).select("s.*")
    return (rest.join(F.broadcast(distinct), F.col("column") == F.col("c"), "left")
            .select("column", "missing", F.coalesce("distinct", F.lit(0)).alias("distinct"), "target_corr"))


def target_rate(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Target mean per category of each listed column."""
    y = F.col(target).cast("double")
    st = df.select(y.alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s"))
    return st.groupBy(F.col("s.c").alias("column"), F.col("s.v").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("_y"), 6).alias("target_mean"))


def target_rate_by_bin(df: DataFrame, target: str, cols: list[str], bins: int = 10) -> DataFrame:
    """P9 for numeric features: target mean per equal-width bin
    ``(column, bin, n, target_mean)``; the last bin is closed on the right."""
    st = column_stats(df, cols)
    y = F.col(target).cast("double")
    parts = []
    for c in cols:
        n, lo, hi = st[c]
        if n == 0:
            continue
        x = F.col(c).cast("double")
        b = (F.least(F.floor((x - F.lit(lo)) / F.lit((hi - lo) / bins)), F.lit(bins - 1)).cast("int")
             if hi > lo else F.lit(0))
        parts.append(F.when(exprs.nan_to_null(x).isNotNull(), F.struct(F.lit(c).alias("column"), b.alias("bin"))))
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, bin int, n long, target_mean double")
    long = df.select(y.alias("_y"), F.explode(F.array(*parts)).alias("s")).where(F.col("s").isNotNull())
    return long.groupBy("s.column", "s.bin").agg(F.count(F.lit(1)).alias("n"),
                                                 F.round(F.avg("_y"), 6).alias("target_mean"))


def notebook_profile(df: DataFrame) -> dict[str, DataFrame]:
    """P10: null counts and describe of every column (numeric and categorical)."""
    return {"missing": missing_report(df), "numeric": describe_numeric(df),
            "categorical": describe_categorical(df)}


def eda_summary(df: DataFrame, target: str) -> dict[str, DataFrame]:
    """P1-P6 in one call: shape, missing, dtypes, target shares, describes."""
    return {"shape": shape(df), "missing": missing_report(df), "dtypes": dtype_frequency(df),
            "target": target_distribution(df, target),
            "numeric": describe_numeric(df, [c for c in exprs.numeric_columns(df) if c != target]),
            "categorical": describe_categorical(df)}
