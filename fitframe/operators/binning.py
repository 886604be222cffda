"""Binning (B1-B4).

Quantile edges come from the exact distributed quantile search over
``coalesce(c, 0)`` (NULL counts as zero engagement); equal-width edges from
one ``min/max`` aggregation.  The transform is one CASE per column: bins are
right-closed with the lowest edge included, anything else is ``Unknown``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.order_stats import OrderStats
from ..functions.quantiles import exact_quantiles
from ..state import Fitted, register


@register
@dataclass
class BinState(Fitted):
    edges: dict   # column -> sorted unique edges
    labels: dict  # column -> labels actually used (len(edges) - 1)
    suffix: str = "_binned"
    unknown: str = config.UNKNOWN_BIN

    def transform(self, df: DataFrame) -> DataFrame:
        extra = []
        for c, e in self.edges.items():
            if c in df.columns:
                val = F.coalesce(exprs.number(c), F.lit(0.0))
                extra.append(exprs.bin_label(val, e, self.labels[c], self.unknown).alias(c + self.suffix))
        names = {c + self.suffix for c in self.edges}
        return df.select(*[c for c in df.columns if c not in names], *extra)

    def order_effect(self, order: OrderStats) -> None:
        order.changed(*[c + self.suffix for c in self.edges])


def uniform_edges(lo: float, hi: float, bins: int) -> list[float]:
    """B2: equal-width edges; the lowest edge widened by 0.1 % of the range
    (a constant column gets +-0.1 % around its value)."""
    if lo == hi:
        d = 0.001 * abs(lo) if lo != 0 else 0.001
        lo, hi = lo - d, hi + d
        step = (hi - lo) / bins
        return [i * step + lo for i in range(bins)] + [hi]
    step = (hi - lo) / bins
    edges = [i * step + lo for i in range(bins)] + [hi]
    edges[0] -= (hi - lo) * 0.001
    return edges


def fit_bins(df: DataFrame, cfg: Mapping | None = None, order: OrderStats | None = None) -> BinState:
    """B1/B2: learn edges for the configured numeric columns present.  As bins
    count missing values as 0, ``order`` serves columns without any."""
    cfg = dict(config.BINNING if cfg is None else cfg)
    cols = [c for c in cfg if c in df.columns]
    filled = df.select(*[F.coalesce(exprs.number(c), F.lit(0.0)).alias(c) for c in cols])
    qcols = [c for c in cols if cfg[c]["strategy"] == "quantile"]
    ucols = [c for c in cols if cfg[c]["strategy"] == "uniform"]
    bad = [c for c in cols if cfg[c]["strategy"] not in ("quantile", "uniform")]
    if bad:
        raise ValueError(f"Invalid binning strategy for {bad}")
    edges, labels = {}, {}
    if qcols:
        probs = {c: [i / cfg[c]["bins"] for i in range(cfg[c]["bins"] + 1)] for c in qcols}
        q = order.complete_quantiles(filled, qcols, probs) if order is not None else exact_quantiles(filled, qcols, probs)
        for c in qcols:
            if q[c][0] is None:
                continue
            edges[c] = sorted(set(q[c]))
    if ucols:
        row = filled.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(ucols)],
                         *[F.max(c).alias(f"hi{i}") for i, c in enumerate(ucols)]).collect()[0]
        for i, c in enumerate(ucols):
            if row[f"lo{i}"] is None:
                continue
            edges[c] = uniform_edges(row[f"lo{i}"], row[f"hi{i}"], cfg[c]["bins"])
    for c, e in edges.items():
        labels[c] = list(cfg[c]["labels"])[: max(len(e) - 1, 0)]  # W11
    return BinState(edges, labels)


def apply_binning(df: DataFrame, cfg: Mapping | None = None) -> DataFrame:
    """Fit and apply in one call."""
    return fit_bins(df, cfg).transform(df)
