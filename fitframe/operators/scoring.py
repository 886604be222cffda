"""Batch scoring helpers.

Scoring never removes rows (W2): every output row carries the caller's key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_features(df: DataFrame, features: Iterable[str], keep: Iterable[str] = (),
                   default: float = 0.0) -> DataFrame:
    """The model's feature columns in order, missing ones (and NULLs) = 0."""
    have = set(df.columns)
    sel = [F.col(k) for k in keep if k in have]
    for c in features:
        sel.append(F.coalesce(F.col(c).cast("double"), F.lit(default)).alias(c) if c in have
                   else F.lit(default).cast("double").alias(c))
    return df.select(*sel)


def format_scores(df: DataFrame, prob: str = "probability", threshold: float = 0.5) -> DataFrame:
    """Z3: probability as ``xx.xx%`` text and the label ``p > threshold``."""
    p = F.col(prob).cast("double")
    return df.select("*", F.format_string("%.2f%%", p * 100).alias("conversion_probability"),
                     (p > F.lit(threshold)).cast("int").alias("predicted_label"))


def preview(df: DataFrame, n: int = 100, order_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows (a limit is the feature here) and the total.
    With ``order_by`` the head is deterministic (a per-partition top-n merged
    on the driver, no global sort)."""
    head = df.orderBy(*order_by).limit(n) if order_by else df.limit(n)
    return head, df.select(F.count(F.lit(1)).alias("total_rows"))


class Lineage:
    """rows/columns before and after each stage.

    Column lists are schema facts, recorded for free.  Row counts are taken
    where rows can change and the data is materialised anyway (a count of a
    cached frame), or on request for a tracked output frame (one ``count``
    job when the table is built).  ``DataFrame.observe`` is avoided: an
    observation attaches state to the session that Spark ML models then fail
    to serialise.
    """

    def __init__(self):
        self.stages: list[list] = []      # [name, cols_before, cols_after, rows_after | DataFrame | None]
        self.rows_in: int | None = None

    def record(self, name: str, before: DataFrame, after: DataFrame, rows: int | None = None) -> None:
        self.stages.append([name, list(before.columns), list(after.columns), rows])

    def track(self, name: str, before: DataFrame, after: DataFrame) -> DataFrame:
        self.stages.append([name, list(before.columns), list(after.columns), after])
        return after

    def table(self, spark, rows_in: int | None = None) -> DataFrame:
        out = []
        prev_rows = rows_in if rows_in is not None else self.rows_in
        for name, cb, ca, rows in self.stages:
            if isinstance(rows, DataFrame):
                rows = rows.count()
            removed = sorted(set(cb) - set(ca))
            out.append((name, prev_rows, rows, len(cb), len(ca), ",".join(removed)))
            prev_rows = rows if rows is not None else prev_rows
        return spark.createDataFrame(out, "stage string, rows_before long, rows_after long, "
                                          "cols_before int, cols_after int, removed_columns string")
