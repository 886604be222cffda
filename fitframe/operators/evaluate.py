"""Evaluation (M4, M6, M7, M8).

Classification counts come from one conditional aggregation.  The exact AUC
is a tie-grouped rank sum: scores are grouped first (so a hot score is one
row), then the cumulative count of negatives below each score is taken with
the range-bucketed running total (no unpartitioned window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs
from ..functions.ordered import lag_within, running_totals
from ..functions.sizing import materialize_state
from ..session import ensure_checkpoint_dir


def confusion_metrics(df: DataFrame, label: str, pred: str, digits: int = 6) -> DataFrame:
    """M4: tn, fp, fn, tp, accuracy, precision, recall, f1 (zero division -> 0)."""
    y = F.col(label).cast("int")
    p = F.col(pred).cast("int")
    agg = df.agg(F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
                 F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
                 F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
                 F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"))

    def div(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    tp, fp, fn, tn = (F.coalesce(F.col(c), F.lit(0)) for c in ("tp", "fp", "fn", "tn"))
    precision = div(tp, tp + fp)
    recall = div(tp, tp + fn)
    f1 = div(2 * tp, 2 * tp + fp + fn)
    return agg.select(tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"),
                      F.round(div(tp + tn, tp + tn + fp + fn), digits).alias("accuracy"),
                      F.round(precision, digits).alias("precision"),
                      F.round(recall, digits).alias("recall"),
                      F.round(f1, digits).alias("f1"))


def class_report(df: DataFrame, label: str, pred: str, digits: int = 6) -> DataFrame:
    """M4 per-class report: precision, recall, f1, support per class value,
    of any type."""
    y = F.col(label)
    p = F.col(pred).cast(df.schema[label].dataType)
    st = df.select(F.explode(F.array(
        F.struct(y.alias("cls"), F.lit(1).alias("is_true"), (p == y).cast("int").alias("hit")),
        F.struct(p.alias("cls"), F.lit(0).alias("is_true"), (p == y).cast("int").alias("hit")))).alias("s"))
    agg = st.groupBy(F.col("s.cls").alias("cls")).agg(
        F.sum("s.is_true").alias("support"),
        F.sum(F.col("s.is_true") * F.col("s.hit")).alias("tp"),
        F.sum(1 - F.col("s.is_true")).alias("predicted"))

    def div(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    prec = div(F.col("tp"), F.col("predicted"))
    rec = div(F.col("tp"), F.col("support"))
    f1 = div(2 * F.col("tp"), F.col("predicted") + F.col("support"))
    return agg.select("cls", F.round(prec, digits).alias("precision"), F.round(rec, digits).alias("recall"),
                      F.round(f1, digits).alias("f1"), F.col("support").cast("long").alias("support"))


def auc_exact(df: DataFrame, label: str, score: str, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """M4: exact ROC AUC with ties counted half, as one-row DataFrame ``auc``;
    NULL when one class is absent."""
    return auc_by(df, [], label, score, rows_per_bucket)


def auc_by(df: DataFrame, by: list[str], label: str, score: str, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """``auc_exact`` for every group of ``by`` in one set of jobs."""
    y = F.col(label).cast("long")
    s = exprs.number(score)
    grouped = df.where(s.isNotNull() & y.isNotNull()).groupBy(*by, s.alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    sized = materialize_state(grouped)
    cum = running_totals(sized.df, "s", ["neg"], by=by, rows_per_bucket=rows_per_bucket, n_rows=sized.rows)
    area = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg")))
    return cum.groupBy(*by).agg(F.try_divide(area, F.sum("pos") * F.sum("neg")).alias("auc"))


def regression_metrics(df: DataFrame, label: str, pred: str, digits: int = 6) -> DataFrame:
    """M6: MAE, MSE, RMSE, R2 in one aggregation."""
    y = F.col(label).cast("double")
    p = F.col(pred).cast("double")
    agg = df.agg(F.avg(F.abs(y - p)).alias("mae"), F.avg((y - p) * (y - p)).alias("mse"),
                 F.sum((y - p) * (y - p)).alias("_sse"), F.var_pop(y).alias("_vy"), F.count(y).alias("_n"))
    r2 = F.when(F.col("_vy") == 0, F.lit(None)).otherwise(1 - F.col("_sse") / (F.col("_vy") * F.col("_n")))
    return agg.select(F.round("mae", digits).alias("mae"), F.round("mse", digits).alias("mse"),
                      F.round(F.sqrt("mse"), digits).alias("rmse"), F.round(r2, digits).alias("r2"))


def mase(df: DataFrame, label: str, pred: str, order: str, series: str | None = None,
         scale: float | None = None, digits: int = 6) -> DataFrame:
    """M7: mean |y - p| divided by the mean |y_t - y_{t-1}| of the naive
    forecast within each series (ordered by the unique key ``order``), or by
    ``scale``.  A zero scale gives NULL.  Long series are split into key
    ranges (``lag_within``), so one series never lands in one task."""
    part = [series] if series else []
    if scale is None:
        # stored once: the lag reads it for the sizes of the series and again
        ensure_checkpoint_dir(df.sparkSession)
        base = df.select(*part, order, exprs.number(label).alias("_y"), exprs.number(pred).alias("_p")).checkpoint(eager=True)
        d = lag_within(base, order, "_y", part)
        agg = d.agg(F.avg(F.abs(F.col("_y") - F.col("_p"))).alias("_mae"),
                    F.avg(F.abs(F.col("_y") - F.col("prev__y"))).alias("_scale"))
    else:
        err = F.abs(F.col(label).cast("double") - F.col(pred).cast("double"))
        agg = df.agg(F.avg(err).alias("_mae"), F.lit(float(scale)).alias("_scale"))
    return agg.select(F.round(F.when(F.col("_scale") == 0, F.lit(None))
                              .otherwise(F.col("_mae") / F.col("_scale")), digits).alias("mase"))


def residual_table(df: DataFrame, label: str, pred: str, bins: int = 20) -> DataFrame:
    """M8: residual ``y - p`` summarised as equal-width bin counts."""
    from .profile import histogram
    r = df.select((F.col(label).cast("double") - F.col(pred).cast("double")).alias("residual"))
    return histogram(r, ["residual"], bins)
