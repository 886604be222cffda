"""Drift between a reference and a current table (Q1-Q6).

Numeric columns: PSI on reference-decile bins, exact two-sample KS distance
and Wasserstein-1 distance divided by the reference std.  Categorical
columns: Jensen-Shannon distance (natural log) and PSI on category shares.
Numeric distances come from segment counts refined by branch and bound
(``functions/cdf_gap.py``): values are neither sorted nor shuffled one by one.
Categorical sides are reduced to ``(column, value)`` counts, so a hot value is
one row; that table is materialised once (a local relation when small, a
checkpoint otherwise).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.cdf_gap import cdf_gaps, side_stats
from ..functions.names import sanitize_metric_name
from ..functions.quantiles import exact_quantiles
from ..functions.sizing import materialize_state

EPS = 1e-4


def common_columns(ref: DataFrame, cur: DataFrame) -> list[str]:
    """Q1: columns present on both sides, sorted."""
    return sorted(set(ref.columns) & set(cur.columns))


def _tagged_counts(ref: DataFrame, cur: DataFrame, cols: list[str], cast: str) -> DataFrame:
    """``(column, value, n_ref, n_cur)``: per-value counts of both sides from
    one scan per side and one shuffle, NULL and NaN left out."""
    cells = [F.when((exprs.number(c) if cast == "double" else F.col(c)).isNotNull(),
                    F.struct(F.lit(c).alias("c"), F.col(c).cast(cast).alias("v"))) for c in cols]

    def long(df, side):
        return df.select(F.lit(side).alias("side"), F.explode(F.array(*cells)).alias("s")).where(
            F.col("s").isNotNull())
    return long(ref, 0).unionByName(long(cur, 1)).groupBy(F.col("s.c").alias("column"), F.col("s.v").alias("value")).agg(
        F.sum((F.col("side") == 0).cast("long")).alias("n_ref"),
        F.sum((F.col("side") == 1).cast("long")).alias("n_cur"))


def psi_numeric(ref: DataFrame, cur: DataFrame, cols: list[str], bins: int = 10,
                digits: int = 6) -> DataFrame:
    """PSI over bins cut at the reference quantiles (right-closed, open ends)."""
    q = exact_quantiles(ref, cols, [i / bins for i in range(1, bins)])
    parts = []
    for c in cols:
        cuts = sorted(set(v for v in q[c] if v is not None))
        x = exprs.number(c)
        b = F.lit(0)
        for e in cuts:                      # bin = number of cuts below x
            b = b + (x > F.lit(float(e))).cast("int")
        parts.append(F.when(x.isNotNull(), F.struct(F.lit(c).alias("c"), b.alias("b"))))

    def long(df, side):
        return df.select(F.lit(side).alias("side"), F.explode(F.array(*parts)).alias("s")).where(
            F.col("s").isNotNull())
    counts = long(ref, 0).unionByName(long(cur, 1)).groupBy(
        F.col("s.c").alias("column"), F.col("s.b").alias("bin")).agg(
        F.sum((F.col("side") == 0).cast("long")).alias("n_ref"),
        F.sum((F.col("side") == 1).cast("long")).alias("n_cur"))
    return _psi_from_counts(counts, digits)


def _totals(counts: DataFrame) -> DataFrame:
    """Values per column and side, of columns with values on both sides: a
    distance to an empty side is not defined, such columns have no score."""
    tot = counts.groupBy("column").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    return tot.where("t_ref > 0 and t_cur > 0")


def _psi_from_counts(counts: DataFrame, digits: int) -> DataFrame:
    j = counts.join(F.broadcast(_totals(counts)), "column")
    e = F.greatest(F.col("n_ref") / F.col("t_ref"), F.lit(EPS))
    a = F.greatest(F.col("n_cur") / F.col("t_cur"), F.lit(EPS))
    return j.groupBy("column").agg(F.round(F.sum((a - e) * F.log(a / e)), digits).alias("psi"))


def psi_categorical(ref: DataFrame, cur: DataFrame, cols: list[str], digits: int = 6,
                    counts: DataFrame | None = None) -> DataFrame:
    counts = (_tagged_counts(ref, cur, cols, "string") if counts is None else counts).withColumnRenamed("value", "bin")
    return _psi_from_counts(counts, digits)


def js_categorical(ref: DataFrame, cur: DataFrame, cols: list[str], digits: int = 6,
                   counts: DataFrame | None = None) -> DataFrame:
    """Jensen-Shannon distance (sqrt of the divergence, natural log)."""
    counts = _tagged_counts(ref, cur, cols, "string") if counts is None else counts
    j = counts.join(F.broadcast(_totals(counts)), "column")
    p = F.col("n_ref") / F.col("t_ref")
    q = F.col("n_cur") / F.col("t_cur")
    m = (p + q) / 2

    def kl(x):
        return F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))
    return j.groupBy("column").agg(
        F.round(F.sqrt(F.greatest(F.sum(kl(p) + kl(q)) / 2, F.lit(0.0))), digits).alias("js"))


def _gaps(ref: DataFrame, cols: list[str], gaps: dict, what: str, of) -> DataFrame:
    rows = [(c, float(v)) for c in cols if c in gaps and (v := of(c)) is not None]
    return ref.sparkSession.createDataFrame(rows, f"column string, {what} double")


def ks_numeric(ref: DataFrame, cur: DataFrame, cols: list[str], digits: int = 6, stats=None) -> DataFrame:
    """Exact two-sample Kolmogorov-Smirnov distance ``sup |F_ref - F_cur|``,
    of the columns with values on both sides (``functions/cdf_gap.py``)."""
    gaps = cdf_gaps(ref, cur, cols, ["ks"], stats)
    return _gaps(ref, cols, gaps, "ks", lambda c: gaps[c]["ks"]).select("column", F.round("ks", digits).alias("ks"))


def wasserstein_numeric(ref: DataFrame, cur: DataFrame, cols: list[str], normed: bool = True,
                        digits: int = 6, stats=None) -> DataFrame:
    """Wasserstein-1 distance ``integral |F_ref - F_cur| dx``, divided by the
    reference (population) std of the finite values when ``normed``; NULL
    where that is 0 or no reference value is finite."""
    stats = stats or side_stats(ref, cur, cols)
    gaps = cdf_gaps(ref, cur, cols, ["w1"], stats)
    out = _gaps(ref, cols, gaps, "w", lambda c: gaps[c]["w1"])
    if not normed:
        return out.select("column", F.round("w", digits).alias("wasserstein"))
    std = ref.sparkSession.createDataFrame([(c, stats[c].std) for c in cols], "column string, std double")
    return (out.join(F.broadcast(std), "column")
            .select("column", F.round(F.when(F.col("std") > 0, F.col("w") / F.col("std")), digits).alias("wasserstein")))


def drift_scores(ref: DataFrame, cur: DataFrame, numeric_method: str = "wasserstein",
                 categorical_method: str = "js", columns: Iterable[str] | None = None) -> DataFrame:
    """Q2: one row per common column ``(column, kind, method, score, status)``.

    NULL and NaN cells are left out.  ``status`` is ``ok``, or ``empty`` where
    neither side has a value, or ``one_side_empty``; the score of both is NULL.
    No common column gives no row."""
    cols = list(columns) if columns is not None else common_columns(ref, cur)
    num = [c for c in exprs.numeric_columns(ref) if c in cols]
    cat = [c for c in cols if c not in set(num)]
    spark = ref.sparkSession
    # numeric columns: counts of both sides; categorical ones: per-value counts
    stats = side_stats(ref, cur, num) if num else {}
    counts = materialize_state(_tagged_counts(ref, cur, cat, "string")).df if cat else None
    parts = []
    if num:
        if numeric_method == "psi":
            s = psi_numeric(ref, cur, num)
        else:
            s = {"wasserstein": wasserstein_numeric, "ks": ks_numeric}[numeric_method](ref, cur, num, stats=stats)
        parts.append(s.select("column", F.col(s.columns[1]).alias("score")))
    if cat:
        s = {"js": js_categorical, "psi": psi_categorical}[categorical_method](ref, cur, cat, counts=counts)
        parts.append(s.select("column", F.col(s.columns[1]).alias("score")))
    wanted = spark.createDataFrame([(c, "num" if c in set(num) else "cat", numeric_method if c in set(num) else categorical_method)
                                    for c in cols], "column string, kind string, method string")
    if not parts:
        return wanted.select("*", F.lit(None).cast("double").alias("score"), F.lit("empty").alias("status"))
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    filled = spark.createDataFrame([(c, stats[c].n[0] > 0, stats[c].n[1] > 0) for c in num], "column string, r boolean, c boolean")
    if cat:
        filled = filled.unionByName(counts.groupBy("column").agg(F.max(F.col("n_ref") > 0).alias("r"), F.max(F.col("n_cur") > 0).alias("c")))
    status = (F.when(F.col("r") & F.col("c"), F.lit("ok")).when(F.col("r") | F.col("c"), F.lit("one_side_empty"))
              .otherwise(F.lit("empty")))
    return (wanted.join(F.broadcast(filled), "column", "left").join(scores, "column", "left")
            .select(sanitize_metric_name("column").alias("column"), "kind", "method", "score", status.alias("status")))


def drift_summary(scores: DataFrame, column_threshold: float = config.DRIFT_COLUMN_THRESHOLD,
                  share_threshold: float = config.DRIFT_SHARE_THRESHOLD) -> DataFrame:
    """Q3 + Q6: drifted column count, share, and the dataset gate.  A column
    that lost all its values on one side has drifted; one without a score
    otherwise has not.  No column: share NULL, no drift."""
    drifted = F.coalesce(exprs.nan_to_null("score") >= F.lit(column_threshold), F.lit(False))
    if "status" in scores.columns:
        drifted = drifted | (F.col("status") == "one_side_empty")
    agg = scores.agg(F.coalesce(F.sum(drifted.cast("long")), F.lit(0)).alias("n_drifted"), F.count(F.lit(1)).alias("n_columns"))
    share = F.try_divide(F.col("n_drifted"), F.col("n_columns"))
    return agg.select("n_drifted", "n_columns", F.round(share, 6).alias("share"),
                      F.coalesce(share >= F.lit(share_threshold), F.lit(False)).alias("drift_detected"))


def side_summary(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """Q4: rows and columns of both sides."""
    return (ref.select(F.lit("reference").alias("side"), F.count(F.lit(1)).alias("n_rows"),
                       F.lit(len(ref.columns)).alias("n_columns"))
            .unionByName(cur.select(F.lit("current").alias("side"), F.count(F.lit(1)).alias("n_rows"),
                                    F.lit(len(cur.columns)).alias("n_columns"))))


def side_profile(ref: DataFrame, cur: DataFrame) -> dict[str, DataFrame]:
    """Q4: missing report, numeric and categorical describe of both sides,
    each with a ``side`` column."""
    from . import profile
    sides = [("reference", ref), ("current", cur)]

    def stacked(fn):
        parts = [fn(df).withColumn("side", F.lit(name)) for name, df in sides]
        return parts[0].unionByName(parts[1])
    return {"missing": stacked(profile.missing_report), "numeric": stacked(profile.describe_numeric),
            "categorical": stacked(profile.describe_categorical)}


def monitor_drift(ref: DataFrame, cur: DataFrame, **kw) -> bool:
    """Q6: True when the share of drifted columns reaches the threshold."""
    return bool(drift_summary(drift_scores(ref, cur, **kw)).first()["drift_detected"])
