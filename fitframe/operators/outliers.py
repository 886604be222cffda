"""Outliers (O1-O5): IQR bounds, clip, log1p and its inverse.

Bounds for every column come from one run of the exact distributed quantile
search (all columns and both quartiles resolved together).  Bounds are
learned on the scale the clip is applied to: after the optional log (W7).
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.order_stats import OrderStats, quantiles_of
from ..state import Fitted, register


@register
@dataclass
class ClipState(Fitted):
    bounds: dict  # column -> [lo, hi]
    log_columns: list = field(default_factory=list)

    def transform(self, df: DataFrame, apply_log: bool = True, apply_clip: bool = True) -> DataFrame:
        logs = set(self.log_columns) if apply_log else set()
        sel = []
        for c in df.columns:
            e = exprs.log1p_floor0(c) if c in logs else F.col(c)
            b = self.bounds.get(c) if apply_clip else None
            if b is not None and b != [None, None]:
                e = exprs.clip(e, b[0], b[1])
            sel.append(e.alias(c))
        return df.select(*sel)

    def order_effect(self, order: OrderStats) -> None:
        order.changed(*self.log_columns)
        for c, (lo, hi) in self.bounds.items():
            order.mapped(c, lambda x, lo=lo, hi=hi: min(max(x, x if lo is None else lo), math.inf if hi is None else hi))

    def inverse_log(self, df: DataFrame) -> DataFrame:
        return inverse_log(df, self.log_columns)


def iqr_bounds(df: DataFrame, cols: list[str], k: float = config.IQR_K, order: OrderStats | None = None, **kw) -> dict[str, list]:
    """O1: ``(Q1 - k*IQR, Q3 + k*IQR)`` with interpolated quartiles."""
    q = quantiles_of(order, df, cols, [0.25, 0.75], **kw)
    out = {}
    for c in cols:
        q1, q3 = q[c]
        if q1 is None:
            out[c] = [None, None]
        else:
            iqr = q3 - q1
            bounds = [q1 - k * iqr, q3 + k * iqr]
            # quartiles at infinity leave no bound on that side
            out[c] = [None if math.isnan(b) or math.isinf(b) else b for b in bounds]
    return out


def fit_clip(df: DataFrame, columns: Iterable[str] | None = None, k: float = config.IQR_K,
             log_columns: Iterable[str] = (), exclude: Iterable[str] = (),
             include_binary: bool = False, order: OrderStats | None = None) -> ClipState:
    """Learn clip bounds for ``columns`` (default: every numeric column).

    Columns with at most two distinct values are skipped unless
    ``include_binary`` (W6: clipping 0/1 flags would flatten them).
    """
    log_columns = [c for c in log_columns if c in df.columns]
    cols = list(columns) if columns is not None else exprs.numeric_columns(df, exclude)
    scaled = df.select(*[(exprs.log1p_floor0(c) if c in log_columns else F.col(c)).alias(c) for c in cols])
    distinct: dict = {}
    extra = {} if include_binary else {f"d{i}": F.approx_count_distinct(c) for i, c in enumerate(cols)}
    if order is not None:
        order.changed(*log_columns)    # bounds are learned on the logged scale
    bounds = iqr_bounds(scaled, cols, k, order, extra_aggs=extra, extra_out=distinct)
    if not include_binary:
        bounds = {c: b for i, c in enumerate(cols) if distinct[f"d{i}"] > 2 for b in [bounds[c]]}
    return ClipState(bounds, list(log_columns))


def inverse_log(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``expm1`` on the given columns."""
    cols = set(cols)
    return df.select(*[(F.expm1(F.col(c)).alias(c) if c in cols else F.col(c)) for c in df.columns])


def clip_outliers(df: DataFrame, k: float = config.IQR_K, **kw) -> DataFrame:
    """Stateless IQR clip of every numeric column."""
    return fit_clip(df, k=k, **kw).transform(df)


def handle_outliers(df: DataFrame, skewed_columns: Iterable[str] = (), k: float = config.IQR_K,
                    **kw) -> DataFrame:
    """Log the skewed columns, then clip every numeric column."""
    return fit_clip(df, k=k, log_columns=skewed_columns, **kw).transform(df)
