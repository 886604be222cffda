"""Imputation.

Fit: medians by exact distributed quantiles, means by one ``avg``, modes by a
frequent-items summary whose candidates are counted exactly
(``functions/modes.py``; ties to the smallest value).  Transform: one ``select`` of ``coalesce``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import exprs
from ..functions.modes import exact_modes
from ..functions.order_stats import OrderStats, quantiles_of
from ..state import Fitted, register


@register
@dataclass
class ImputeState(Fitted):
    fills: dict  # column -> {"strategy": ..., "value": ...}

    def transform(self, df: DataFrame) -> DataFrame:
        """Apply the learned fills; columns absent from ``df`` are ignored."""
        sel = []
        for c in df.columns:
            info = self.fills.get(c)
            if info is None or info["value"] is None:
                sel.append(F.col(c))
            else:
                sel.append(exprs.filled(df, c, info["value"]).alias(c))
        return df.select(*sel)

    def order_effect(self, order: OrderStats) -> None:
        for c, info in self.fills.items():
            order.filled(c, info["value"])


def fit_impute(df: DataFrame, numeric_config: Mapping | None = None,
               categorical_config: Mapping | None = None, order: OrderStats | None = None) -> ImputeState:
    """Learn fill values for the configured columns present in ``df``,
    whose order statistics may be known to ``order``."""
    numeric_config = dict(config.NUMERIC_IMPUTE if numeric_config is None else numeric_config)
    categorical_config = dict(config.CATEGORICAL_IMPUTE if categorical_config is None
                              else categorical_config)
    fills: dict = {}
    num = {c: s for c, s in numeric_config.items() if c in df.columns}
    for c, s in num.items():
        if s not in ("median", "mean", "constant"):
            raise ValueError(f"Unknown strategy: {s} for column: {c}")
    medians = [c for c, s in num.items() if s == "median"]
    means = [c for c, s in num.items() if s == "mean"]
    med = quantiles_of(order, df, medians, [0.5]) if medians else {}
    mean_row = df.agg(*[F.avg(exprs.number(c)).alias(c) for c in means]).collect()[0] if means else {}
    for c, s in num.items():
        v = med[c][0] if s == "median" else (mean_row[c] if s == "mean" else 0)
        fills[c] = {"strategy": s, "value": v}

    cat = {c: cfg for c, cfg in categorical_config.items() if c in df.columns}
    mode_cols = [c for c, cfg in cat.items() if cfg.get("strategy") == "mode"]
    modes = column_modes(df, mode_cols)
    for c, cfg in cat.items():
        strat = cfg.get("strategy")
        if strat == "mode":
            v = modes.get(c)
            v = config.DEFAULT_CATEGORICAL_FILL if v is None else v
        else:
            v = cfg.get("fill_value", config.DEFAULT_CATEGORICAL_FILL)
        fills[c] = {"strategy": strat, "value": v}
    return ImputeState(fills)


def column_modes(df: DataFrame, cols: list[str]) -> dict:
    """Most frequent non-missing value per column; ties -> smallest value (as
    text), given back in the column's own type."""
    got = exact_modes(df, {c: F.when(~exprs.missing(df, c), F.col(c).cast("string")) for c in cols})
    return {c: _typed_value(df.schema[c].dataType, got[c][0] if c in got else None) for c in cols}


def _typed_value(kind: T.DataType, text: str | None):
    """A fill value that keeps the column's type and saves as JSON; dates and
    times stay text, which the column's type reads back."""
    if text is None:
        return None
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float(text)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(text)
    if isinstance(kind, T.BooleanType):
        return text == "true"
    return text


def impute_missing(df: DataFrame, **kw) -> DataFrame:
    """I4: fit and apply in one call."""
    return fit_impute(df, **kw).transform(df)


def fit_median_fill(df: DataFrame, cols: list[str] | None = None, order: OrderStats | None = None) -> ImputeState:
    """Median fill of every numeric column."""
    cols = exprs.numeric_columns(df) if cols is None else cols
    return fit_impute(df, numeric_config={c: "median" for c in cols}, categorical_config={}, order=order)
