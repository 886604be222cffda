"""Order statistics that survive monotone steps.

Imputing a median, clipping at quartiles, cutting bins at quantiles and robust
scaling each ask for quantiles of a column that the step before has changed.
But the changes keep the order of the values:

* a fill puts ``missing`` copies of one value among the ``n`` present ones, so
  the value at place ``i`` of the filled column is the present one at ``i``, if
  that is below the fill, the present one at ``i - missing``, if that is above
  it, and the fill otherwise;
* clipping, and scaling by a positive factor, map the value at each place.

So the quantiles after any such steps follow from present values at places that
depend on the counts alone.  ``OrderStats`` finds the values at all these places
for the usual probabilities in one search (``exact_quantiles`` with extra
ranks), and answers every later question from them.  Only DOUBLE columns are
tracked, and only steps whose arithmetic is the same here and in Spark; for
anything else the quantiles are searched as before.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .quantiles import exact_quantiles, interpolate

USUAL = (0.0, 0.25, 0.5, 0.75, 1.0)


def _places(p: float, n: int) -> tuple[int, int, float]:
    at = float(p) * (n - 1)
    low = int(math.floor(at))
    return low, min(low + 1, n - 1), at - low


class _Tracked:
    """A column: its present values by rank, a fill, and maps after it."""

    def __init__(self, present: int, rows: int, ranked: dict[int, float]):
        self.present, self.rows, self.ranked = present, rows, ranked
        self.fill: float | None = None
        self.maps: list[Callable[[float], float]] = []

    @property
    def count(self) -> int:
        return self.present if self.fill is None else self.rows

    def at(self, i: int) -> float | None:
        """The value at place ``i`` of the column as it is now; None where a
        rank was not searched for."""
        if self.fill is None:
            value = self.ranked.get(i)
        else:
            before, behind = i, i - (self.rows - self.present)
            value = self.fill
            if before < self.present:
                if before not in self.ranked:
                    return None
                if self.ranked[before] < self.fill:
                    value = self.ranked[before]
            if value == self.fill and behind >= 0:
                if behind not in self.ranked:
                    return None
                value = max(self.fill, self.ranked[behind])
        if value is None:
            return None
        for f in self.maps:
            value = f(value)
        return value

    def quantile(self, p: float) -> tuple[bool, float | None]:
        """(known, value)"""
        if self.count == 0:
            return True, None
        low, high, part = _places(p, self.count)
        a, b = self.at(low), self.at(high)
        return (False, None) if a is None or b is None else (True, interpolate(a, b, part))


def wanted_ranks(present: int, rows: int, probs: Iterable[float] = USUAL) -> set[int]:
    """Ranks of present values that decide these quantiles of the column, now
    or once its missing values are filled with whatever value."""
    out: set[int] = set()
    for p in probs:
        if present:
            out |= set(_places(p, present)[:2])
        if rows:
            low, high, _ = _places(p, rows)
            for i in (low, high, low - (rows - present), high - (rows - present)):
                if 0 <= i < present:
                    out.add(i)
    return out


class OrderStats:
    """Quantiles of the DOUBLE columns of a frame through a chain of steps."""

    def __init__(self, df: DataFrame, cols: Sequence[str] | None = None, probs: Sequence[float] = USUAL):
        self.df = df
        self.cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and (cols is None or f.name in cols)]
        self.probs = tuple(probs)
        self.columns: dict[str, _Tracked] | None = None   # None: not searched yet
        self.untracked: set[str] = set()

    def _search(self) -> dict[str, _Tracked]:
        if self.columns is None:
            ranked: dict = {}
            exact_quantiles(self.df, self.cols, {c: [] for c in self.cols}, rank_out=ranked,
                            extra_ranks=lambda present, rows: wanted_ranks(present, rows, self.probs))
            self.columns = {c: _Tracked(*ranked[c]) for c in self.cols if c not in self.untracked}
        return self.columns

    def quantiles(self, df: DataFrame, cols: Sequence[str], probs: Sequence[float] | Mapping[str, Sequence[float]], **kw) -> dict[str, list]:
        """``exact_quantiles`` of ``df``, the frame after the steps told so far."""
        want = {c: list(probs[c]) if isinstance(probs, Mapping) else list(probs) for c in cols}
        out = {}
        if any(c in self.cols and c not in self.untracked for c in cols):
            tracked = self._search()
            for c in cols:
                if c in tracked:
                    got = [tracked[c].quantile(p) for p in want[c]]
                    if all(known for known, _ in got):
                        out[c] = [v for _, v in got]
        rest = [c for c in cols if c not in out]
        if rest:
            out.update(exact_quantiles(df, rest, {c: want[c] for c in rest}, **kw))
        elif kw.get("extra_aggs"):
            row = df.agg(*[e.alias(k) for k, e in kw["extra_aggs"].items()]).first()
            kw["extra_out"].update({k: row[k] for k in kw["extra_aggs"]})
        return {c: out[c] for c in cols}

    def complete_quantiles(self, df: DataFrame, cols: Sequence[str], probs: Mapping[str, Sequence[float]]) -> dict[str, list]:
        """``quantiles`` of a frame whose missing values were replaced anew:
        only columns that had none by then are answered from what is known."""
        whole = set()
        if any(c in self.cols and c not in self.untracked for c in cols):
            whole = {c for c, t in self._search().items() if t.count == t.rows}
        out = self.quantiles(df, [c for c in cols if c in whole], probs)
        out.update(exact_quantiles(df, [c for c in cols if c not in whole], probs))
        return out

    # ---- what steps do to columns ----

    def filled(self, c: str, value) -> None:
        if c in self.cols and c not in self.untracked and value is not None:
            t = self._search()[c]
            if t.fill is None and not t.maps and isinstance(value, (int, float)) and math.isfinite(value):
                t.fill = float(value)
            elif t.fill is None:
                self.changed(c)

    def mapped(self, c: str, f: Callable[[float], float]) -> None:
        """``f`` must not fall, keep missing values, and be exact in doubles."""
        if c in self.cols and c not in self.untracked:
            self._search()[c].maps.append(f)

    def changed(self, *cols: str) -> None:
        """Columns that are something else now."""
        self.untracked |= set(cols)
        for c in cols:
            (self.columns or {}).pop(c, None)

    def after(self, fitted, df: DataFrame, keeps_rows: bool) -> OrderStats:
        """The statistics of ``df``, the output of a step with this state."""
        if not keeps_rows:
            return OrderStats(df, None, self.probs)
        effect = getattr(fitted, "order_effect", None)
        if effect is None:
            self.changed(*self.cols)
        else:
            effect(self)
        if all(c in self.untracked for c in self.cols):
            return OrderStats(df, None, self.probs)
        return self


def quantiles_of(order: OrderStats | None, df: DataFrame, cols: Sequence[str], probs, **kw) -> dict[str, list]:
    """From ``order`` where there is one, else by a search."""
    return exact_quantiles(df, cols, probs, **kw) if order is None else order.quantiles(df, cols, probs, **kw)
