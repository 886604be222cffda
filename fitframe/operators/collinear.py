"""Collinearity filter (V1-V4).

The variance inflation factor of column i in a no-intercept regression on the
other columns is ``G_ii / SSR_i`` with ``G = X'X`` and
``SSR_i = G_ii - g_i' pinv(G_-i) g_i``.  ``G`` of the median-filled columns
follows from the Gram matrix of the vectors ``[value or 0, missing flags]``,
whose blocks are all the moments that any fill values need.  That matrix is
one tree aggregation (``RowMatrix``) whose plan does not grow with the pairs of
columns; the greedy removal of the largest VIF then works on sub-matrices on
the driver (k x k numbers), so no removal round rescans the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs, names
from ..functions.order_stats import OrderStats, quantiles_of
from ..state import Fitted, register


def _finite(c: str):
    """A number, with NaN and infinities as missing."""
    x = exprs.number(c)
    return F.when(F.abs(x) != float("inf"), x)


def usable_numeric(df: DataFrame, cols: list[str] | None = None, min_unique: int = 2) -> list[str]:
    """V1: numeric columns with more than ``min_unique`` distinct values and
    a positive standard deviation.  Exact: one aggregation gives the least and
    greatest value, each further one the next value above the last known."""
    cols = exprs.numeric_columns(df) if cols is None else cols
    if not cols:
        return []
    clean = df.select(*[_finite(c).alias(f"x{i}") for i, c in enumerate(cols)])
    row = clean.agg(*[f(f"x{i}").alias(f"{n}{i}") for i in range(len(cols)) for n, f in (("lo", F.min), ("hi", F.max), ("s", F.stddev_samp))]).first()
    open_at = {i: row[f"lo{i}"] for i in range(len(cols)) if row[f"s{i}"] is not None and row[f"s{i}"] > 0}
    for _ in range(min_unique - 1):    # known so far: the lowest values, and the greatest
        if not open_at:
            break
        above = clean.agg(*[F.min(F.when(F.col(f"x{i}") > F.lit(v), F.col(f"x{i}"))).alias(f"n{i}") for i, v in open_at.items()]).first()
        open_at = {i: above[f"n{i}"] for i in open_at if above[f"n{i}"] < row[f"hi{i}"]}
    return [c for i, c in enumerate(cols) if i in open_at]


def moment_matrix(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Gram matrix of ``[x_1 or 0, .., x_k or 0, missing_1, .., missing_k]``
    over the rows of ``df`` (numbers, missing as NULL): the top left block
    sums products of present pairs, the bottom right one counts rows where
    both are missing, the others sum a column where another is missing."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils
    values = F.array(*[F.col(c) for c in cols])
    both = F.concat(F.transform(values, lambda x: F.coalesce(x, F.lit(0.0))), F.transform(values, lambda x: F.isnull(x).cast("double")))
    # a row of zeros adds nothing, and keeps an empty table from failing
    nothing = df.sparkSession.range(1).select(array_to_vector(F.array_repeat(F.lit(0.0), 2 * len(cols))).alias("v"))
    rows = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(both).alias("v")).unionByName(nothing), "v")
    return RowMatrix(rows, 0, 2 * len(cols)).computeGramianMatrix().toArray()


def filled_gram(moments: np.ndarray, fills: list[float]) -> np.ndarray:
    """``X'X`` of the columns with these values in place of missing ones."""
    k = len(fills)
    fill = np.diag(fills)
    cross = moments[:k, k:] @ fill
    return moments[:k, :k] + cross + cross.T + fill @ moments[k:, k:] @ fill


def _median_and_gram(df: DataFrame, cols: list[str], order: OrderStats | None = None) -> np.ndarray:
    """The Gram matrix of the columns filled with their exact medians (NaN
    and +-inf count as missing).  ``order`` may know the medians of the
    columns without infinities, which it counts as values."""
    clean = df.select(*[_finite(c).alias(c) for c in cols])
    known = []
    if order is not None:
        row = df.agg(*[F.max((F.abs(exprs.number(c)) == float("inf")).cast("int")).alias(f"i{i}") for i, c in enumerate(cols)]).first()
        known = [c for i, c in enumerate(cols) if not row[f"i{i}"]]
    med = quantiles_of(order, clean, known, [0.5]) if known else {}
    med.update(quantiles_of(None, clean, [c for c in cols if c not in med], [0.5]))
    return filled_gram(moment_matrix(clean, cols), [float(med[c][0] or 0.0) for c in cols])


def vif_from_gram(g: np.ndarray) -> np.ndarray:
    """``G_ii (G^-1)_ii`` for every column, from one inverse of the scaled Gram
    matrix.  Where columns depend on each other exactly, the inverse is
    unusable; those are found by their share in the null space and are
    infinite, the others take the pseudo-inverse."""
    k = g.shape[0]
    if k == 1:
        return np.ones(1)
    d = np.sqrt(np.maximum(np.diag(g), 1e-300))
    scaled = g / np.outer(d, d)
    values, vectors = np.linalg.eigh((scaled + scaled.T) / 2)
    small = values <= 1e-12 * max(values[-1], 1e-300)
    inverse = (vectors[:, ~small] / values[~small]) @ vectors[:, ~small].T
    out = np.diag(inverse).copy()
    out[(vectors[:, small] ** 2).sum(axis=1) > 1e-10] = np.inf
    return out


@register
@dataclass
class VifState(Fitted):
    selected: list
    dropped: list
    vif: dict = field(default_factory=dict)   # final VIF of the kept columns

    def transform(self, df: DataFrame) -> DataFrame:
        """V3: kept numerics first, then untouched columns; ``prefix__`` stripped."""
        df = df.toDF(*[names.strip_prefix(c) for c in df.columns])
        uniq = names.dedupe_names(df.columns)                       # V4
        if len(uniq) != len(df.columns):
            seen, idx = set(), []
            for i, c in enumerate(df.columns):
                if c not in seen:
                    seen.add(c)
                    idx.append(i)
            df = df.select(*[df[i] for i in idx])
        drop = set(self.dropped)
        keep = [c for c in self.selected if c in df.columns]
        return df.select(*keep, *[c for c in df.columns if c not in set(keep) and c not in drop])

    def order_effect(self, order) -> None:
        """Columns are only left out."""

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, float(v)) for c, v in self.vif.items()], "feature string, vif double")


def vif_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """V2, one round: VIF of every listed column against the others
    (median-filled), as ``(feature, vif)``."""
    v = vif_from_gram(_median_and_gram(df, cols))
    return df.sparkSession.createDataFrame([(c, float(x)) for c, x in zip(cols, v)],
                                           "feature string, vif double")


def fit_vif(df: DataFrame, cols: list[str] | None = None, threshold: float = config.VIF_THRESHOLD,
            min_unique: int = 2, order: OrderStats | None = None) -> VifState:
    """V1+V2: median-fill, Gram matrix, greedy removal of the largest VIF
    while it exceeds ``threshold``."""
    renamed = df.toDF(*[names.strip_prefix(c) for c in df.columns])
    cols = usable_numeric(renamed, cols, min_unique)
    if not cols:
        return VifState([], [], {})
    g = _median_and_gram(renamed, cols, order if renamed.columns == df.columns else None)
    live = list(range(len(cols)))
    dropped = []
    while True:
        sub = g[np.ix_(live, live)]
        v = vif_from_gram(sub)
        if v.max() <= threshold or len(live) == 1:
            break
        worst = int(np.argmax(v))
        dropped.append(cols[live[worst]])
        live.pop(worst)
    return VifState([cols[i] for i in live], dropped, {cols[i]: float(x) for i, x in zip(live, v)})
