"""Scaling (X1-X6).

Every statistic of every scaled column (mean, population std, min, max,
skewness, count) comes from one aggregation; medians and quartiles for the
robust scaler from one run of the exact quantile search.  The transform is one
``select``: scaled columns first, then the rest, as the original orders them.
ML's ``StandardScaler`` divides by the *sample* std and ``RobustScaler`` takes
non-interpolated quantiles, so the arithmetic is written out here.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.order_stats import OrderStats, quantiles_of
from ..state import Fitted, register


def adjusted_skew(g1: float | None, n: int) -> float | None:
    """Sample-adjusted skewness ``G1 = g1 * sqrt(n(n-1)) / (n-2)`` (pandas
    ``skew``); Spark's ``skewness`` is the population ``g1``."""
    if g1 is None or n < 3 or (isinstance(g1, float) and math.isnan(g1)):
        return None
    return g1 * math.sqrt(n * (n - 1)) / (n - 2)


def skewness_table(df: DataFrame, cols: list[str] | None = None) -> dict[str, float | None]:
    cols = exprs.numeric_columns(df) if cols is None else cols
    if not cols:
        return {}
    row = df.agg(*[F.skewness(exprs.number(c)).alias(f"s{i}") for i, c in enumerate(cols)],
                 *[F.count(exprs.number(c)).alias(f"n{i}") for i, c in enumerate(cols)]).collect()[0]
    return {c: adjusted_skew(row[f"s{i}"], row[f"n{i}"]) for i, c in enumerate(cols)}


def detect_skewed(df: DataFrame, threshold: float = config.SKEW_THRESHOLD,
                  exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns with |adjusted skew| > threshold."""
    sk = skewness_table(df, exprs.numeric_columns(df, exclude))
    return [c for c, v in sk.items() if v is not None and abs(v) > threshold]


@register
@dataclass
class ScaleState(Fitted):
    params: dict     # column -> {"kind": standard|robust|minmax, "center": c, "scale": s}
    order: list      # scaled columns, in output order

    def transform(self, df: DataFrame) -> DataFrame:
        sel = []
        for c in self.order:
            if c in df.columns:
                p = self.params[c]
                sel.append(((exprs.number(c) - F.lit(p["center"])) / F.lit(p["scale"])).alias(c))
        done = set(self.order)
        return df.select(*sel, *[F.col(c) for c in df.columns if c not in done])

    def order_effect(self, order: OrderStats) -> None:
        for c in self.order:
            p = self.params[c]
            order.mapped(c, lambda x, p=p: (x - p["center"]) / p["scale"])

    def inverse(self, df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
        """Undo the scaling of the given (or all) scaled columns."""
        cols = set(self.order if cols is None else cols)
        out = []
        for c in df.columns:
            if c in cols and c in self.params:
                p = self.params[c]
                out.append((F.col(c) * F.lit(p["scale"]) + F.lit(p["center"])).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


def fit_scaler(df: DataFrame, standard: Iterable[str] = (), robust: Iterable[str] = (),
               minmax: Iterable[str] = (), skewed_to_robust: bool = False,
               target: str | None = None, skew_threshold: float = config.SKEW_THRESHOLD,
               order: OrderStats | None = None) -> ScaleState:
    """X2 standard ``(x - mean) / std_pop``, X3 robust ``(x - median) / IQR``
    (interpolated quartiles), X4 min-max ``(x - min) / (max - min)``; a zero
    scale becomes 1.  X5: ``skewed_to_robust`` adds every other numeric
    column with |skew| > threshold to the robust list (the router)."""
    have = set(df.columns)
    standard = [c for c in standard if c in have and c != target]
    robust = [c for c in robust if c in have and c != target]
    minmax = [c for c in minmax if c in have and c != target]
    if skewed_to_robust:
        assigned = set(standard) | set(robust) | set(minmax)
        robust += [c for c in detect_skewed(df, skew_threshold, exclude=[target] if target else [])
                   if c not in assigned]
    params: dict = {}
    if standard or minmax:
        aggs = []
        for i, c in enumerate(standard):
            x = exprs.number(c)
            aggs += [F.avg(x).alias(f"a{i}"), F.stddev_pop(x).alias(f"s{i}")]
        for i, c in enumerate(minmax):
            x = exprs.number(c)
            aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        row = df.agg(*aggs).collect()[0]
        for i, c in enumerate(standard):
            s = row[f"s{i}"]
            params[c] = {"kind": "standard", "center": row[f"a{i}"] or 0.0,
                         "scale": s if s not in (None, 0.0) else 1.0}
        for i, c in enumerate(minmax):
            lo, hi = row[f"lo{i}"], row[f"hi{i}"]
            rng = (hi - lo) if lo is not None else None
            params[c] = {"kind": "minmax", "center": lo or 0.0, "scale": rng if rng not in (None, 0.0) else 1.0}
    if robust:
        q = quantiles_of(order, df, robust, [0.25, 0.5, 0.75])
        for c in robust:
            q1, med, q3 = q[c]
            iqr = (q3 - q1) if q1 is not None else None
            params[c] = {"kind": "robust", "center": med or 0.0,
                         "scale": iqr if iqr not in (None, 0.0) else 1.0}
    return ScaleState(params, standard + robust + minmax)


def apply_feature_scaling(df: DataFrame, target: str = config.TARGET) -> tuple[DataFrame, ScaleState]:
    """X5 with the default lists: named standard/robust/minmax columns, then
    the skewed leftovers to robust."""
    st = fit_scaler(df, config.STANDARD_SCALE_COLS, config.ROBUST_SCALE_COLS, config.MINMAX_SCALE_COLS,
                    skewed_to_robust=True, target=target)
    return st.transform(df), st
