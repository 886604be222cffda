"""Exact distances between two empirical distributions by branch and bound.

The Kolmogorov-Smirnov distance is the greatest ``|F_ref - F_cur|``, the
Wasserstein-1 distance its integral.  Neither needs the sorted values:

* The values of a column fall into segments, each known by its counts, sums,
  least and greatest value of both sides (one aggregation, a row per segment).
  Running totals over the segments give the gap ``D`` at every segment's ends.
* Inside a segment ``D`` moves up by at most the reference's share of rows in
  it, and down by at most the current one's.  A segment whose bound is not
  above the greatest gap seen cannot hold the supremum.  Where ``D`` cannot
  change sign, the integral follows from the sums.  A segment of one value, or
  with the same values in the same proportions on both sides (counts and sums
  of hashes), needs nothing more either.
* The other segments are split again.  Once they hold few rows, or after
  MAX_PASSES, their values are counted and totalled in Spark, segment by
  segment.

So rows shuffled depend on the number of segments, not of distinct values.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = 4096          # into which a column is cut first
DRIVER_ROWS = 400_000    # segments that a pass may make, all columns together
COLLECT_ROWS = 50_000    # rows in open segments whose values are counted without another split
MAX_PASSES = 4
ROUNDING = 1e-13         # of sums of shares
_FIELDS = ("n_ref", "n_cur", "low", "high", "s_ref", "s_cur", "same")


@dataclass
class SideStats:
    """Of a column on both sides: rows, rows at -inf and +inf, range of the
    finite values, and the reference's standard deviation."""

    n: list[int] = field(default_factory=lambda: [0, 0])
    below: list[int] = field(default_factory=lambda: [0, 0])
    above: list[int] = field(default_factory=lambda: [0, 0])
    low: float | None = None
    high: float | None = None
    std: float | None = None

    @property
    def both(self) -> bool:
        return min(self.n) > 0


def _finite(c: str):
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x + F.lit(0.0))


def side_stats(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> dict[str, SideStats]:
    """One aggregation over both sides."""
    aggs = []
    for i, c in enumerate(cols):
        x, raw = _finite(c), F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.stddev_pop(x).alias(f"sd{i}"),
                 F.count(F.when(raw == float("-inf"), 1)).alias(f"u{i}"), F.count(F.when(raw == float("inf"), 1)).alias(f"v{i}")]
    pick = lambda df, side: df.select(F.lit(side).alias("__side"), *[F.col(c).cast("double").alias(c) for c in cols])
    rows = pick(ref, 0).unionByName(pick(cur, 1)).groupBy("__side").agg(*aggs).collect()
    out = {c: SideStats() for c in cols}
    for r in rows:
        side = r["__side"]
        for i, c in enumerate(cols):
            s = out[c]
            s.below[side], s.above[side] = r[f"u{i}"], r[f"v{i}"]
            s.n[side] = r[f"n{i}"] + s.below[side] + s.above[side]
            if r[f"n{i}"]:
                s.low = r[f"lo{i}"] if s.low is None else min(s.low, r[f"lo{i}"])
                s.high = r[f"hi{i}"] if s.high is None else max(s.high, r[f"hi{i}"])
            if side == 0:
                s.std = r[f"sd{i}"]
    return out


class _Column:
    """The segments of a column in order of their values."""

    def __init__(self, stats: SideStats):
        self.stats = stats
        self.id = np.zeros(0, np.int64)
        self.of = {k: np.zeros(0) for k in _FIELDS}

    def replace(self, gone: np.ndarray, ids: np.ndarray, fields: dict[str, np.ndarray]) -> None:
        keep = ~np.isin(self.id, gone)
        self.id = np.concatenate([self.id[keep], ids])
        self.of = {k: np.concatenate([self.of[k][keep], fields[k]]) for k in _FIELDS}
        order = np.argsort(self.of["low"], kind="stable")
        self.id = self.id[order]
        self.of = {k: v[order] for k, v in self.of.items()}

    def bounds(self):
        """Gap before and behind each segment, its reach up and down, and
        whether it may hide something."""
        n, m = self.stats.n
        c_ref = self.stats.below[0] + np.cumsum(self.of["n_ref"])
        c_cur = self.stats.below[1] + np.cumsum(self.of["n_cur"])
        end = c_ref / n - c_cur / m
        start = (c_ref - self.of["n_ref"]) / n - (c_cur - self.of["n_cur"]) / m
        unknown = (self.of["low"] < self.of["high"]) & (self.of["same"] == 0)
        return start, end, self.of["n_ref"] / n, self.of["n_cur"] / m, unknown

    def greatest(self, inside: np.ndarray | float = 0.0) -> float:
        start, end, *_ = self.bounds()
        n, m = self.stats.n
        seen = [abs(self.stats.below[0] / n - self.stats.below[1] / m), float(np.max(inside, initial=0.0))]
        return max(seen + [float(np.abs(end).max(initial=0.0)), float(np.abs(start).max(initial=0.0))])

    def open_for(self, wanted: Sequence[str]) -> np.ndarray:
        start, _, up, down, unknown = self.bounds()
        hidden = np.zeros(len(start), bool)
        if "ks" in wanted:
            hidden |= np.maximum(np.abs(start + up), np.abs(start - down)) > self.greatest() + ROUNDING
        if "w1" in wanted:
            hidden |= (start - down < 0) & (start + up > 0)
        return unknown & hidden

    def integral(self, inside: dict[int, float]) -> float:
        """Integral of the absolute gap; ``inside`` has that of the segments
        whose values were counted."""
        s = self.stats
        if any(a[0] * s.n[1] != a[1] * s.n[0] for a in (s.below, s.above)):
            return float("inf")
        start, end, *_ = self.bounds()
        if not len(start):
            return 0.0
        width = self.of["high"] - self.of["low"]
        whole = np.abs(start * width + (self.of["n_ref"] * width - self.of["s_ref"]) / s.n[0] - (self.of["n_cur"] * width - self.of["s_cur"]) / s.n[1])
        whole = np.where(width > 0, whole, 0.0)
        if inside:
            whole = np.where(np.isin(self.id, list(inside)), np.array([inside.get(int(i), 0.0) for i in self.id]), whole)
        return float(whole.sum() + (np.abs(end[:-1]) * (self.of["low"][1:] - self.of["high"][:-1])).sum())


def _cells(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(id, side, x)``: every finite value, the id being its column's number."""
    cells = F.array(*[F.when(_finite(c).isNotNull(), F.struct(F.lit(i).cast("long").alias("id"), _finite(c).alias("x"))) for i, c in enumerate(cols)])
    long = lambda df, side: df.select(F.lit(side).alias("side"), F.explode(cells).alias("s")).where("s is not null").select("s.id", "side", "s.x")
    return long(ref, 0).unionByName(long(cur, 1))


def _dealt(cells: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The rows that are in open segments all the way down, with the id of
    their segment and the place ``lo`` that sums are taken from."""
    rows = cells
    for level in levels:
        # halves, so that no range of doubles overflows
        part = F.least(F.greatest(F.floor((F.col("x") / 2 - F.col("lo") / 2) * F.col("scale")), F.lit(0)), F.col("parts") - 1)
        rows = (rows.select("id", "side", "x").join(F.broadcast(level), "id")
                .select((F.col("first") + part).alias("id"), "side", "x", "lo"))
    return rows


def cdf_gaps(ref: DataFrame, cur: DataFrame, cols: Sequence[str], wanted: Sequence[str] = ("ks", "w1"), stats: dict[str, SideStats] | None = None,
             segments: int = SEGMENTS, driver_rows: int = DRIVER_ROWS, collect_rows: int = COLLECT_ROWS,
             max_passes: int = MAX_PASSES) -> dict[str, dict[str, float]]:
    """``{column: {"ks": .., "w1": ..}}`` of the columns with values on both
    sides; NULL and NaN are left out.  Infinities are the least and greatest
    values; where the sides' shares at one differ, the integral is infinite.
    """
    spark = ref.sparkSession
    stats = stats or side_stats(ref, cur, cols)
    cols = [c for c in cols if stats[c].both]
    if not cols:
        return {}
    columns = [_Column(stats[c]) for c in cols]
    cells = _cells(ref, cur, cols)

    levels: list[DataFrame] = []
    next_id = len(cols)
    low = {i: stats[c].low for i, c in enumerate(cols)}
    # segments to split: (id, column, least, greatest value)
    todo = [(i, i, stats[c].low, stats[c].high) for i, c in enumerate(cols) if low[i] is not None]
    inside = [dict() for _ in cols]    # segment -> integral of its counted values
    peaks = [0.0 for _ in cols]
    for turn in range(max_passes):
        if not todo:
            break
        parts = max(2, min(segments, driver_rows // len(todo)))
        rows, owner_at, owner = [], [], []
        for sid, c, lo, hi in todo:
            half = hi / 2 - lo / 2
            scale = min(parts / half, sys.float_info.max) if half > 0 else 0.0
            rows.append((sid, lo, scale, parts, next_id))
            owner_at.append(next_id)
            owner.append(c)
            next_id += parts
        levels.append(spark.createDataFrame(rows, "id long, lo double, scale double, parts long, first long"))
        h = F.xxhash64("x")
        is_ref, is_cur = F.col("side") == 0, F.col("side") == 1
        piece = lambda side, k: F.coalesce(F.sum(F.when(side, F.shiftrightunsigned(h, k).bitwiseAND((1 << 26) - 1))), F.lit(0))
        got = (_dealt(cells, levels).groupBy("id").agg(
            F.count(F.when(is_ref, 1)).alias("n_ref"), F.count(F.when(is_cur, 1)).alias("n_cur"),
            F.min("x").alias("low"), F.max("x").alias("high"),
            F.coalesce(F.sum(F.when(is_ref, F.col("x") - F.col("lo"))), F.lit(0.0)).alias("s_ref"),
            F.coalesce(F.sum(F.when(is_cur, F.col("x") - F.col("lo"))), F.lit(0.0)).alias("s_cur"), F.min("lo").alias("lo"),
            *[piece(side, k).alias(f"h{name}{k}") for name, side in (("r", is_ref), ("c", is_cur)) for k in (0, 32)]).toPandas())
        of_column = np.array(owner)[np.searchsorted(owner_at, got["id"].to_numpy(), side="right") - 1] if len(got) else np.zeros(0, int)
        split_ids = np.array([t[0] for t in todo], np.int64)
        for i, col in enumerate(columns):
            mine = got[of_column == i]
            if len(mine):
                n, m = col.stats.n
                same = np.array([hr0 * m == hc0 * n and hr1 * m == hc1 * n and a * m == b * n for hr0, hc0, hr1, hc1, a, b in
                                 zip(*(mine[k].tolist() for k in ("hr0", "hc0", "hr32", "hc32", "n_ref", "n_cur")))], float)
                # sums from the segment's own least value
                shift = mine["low"].to_numpy() - mine["lo"].to_numpy()
                fields = {k: mine[k].to_numpy(np.float64) for k in ("n_ref", "n_cur", "low", "high")}
                fields["s_ref"] = mine["s_ref"].to_numpy() - fields["n_ref"] * shift
                fields["s_cur"] = mine["s_cur"].to_numpy() - fields["n_cur"] * shift
                col.replace(split_ids, mine["id"].to_numpy(np.int64), fields | {"same": same})
        todo, left = [], 0
        for i, col in enumerate(columns):
            at = np.flatnonzero(col.open_for(wanted))
            left += int((col.of["n_ref"][at] + col.of["n_cur"][at]).sum())
            todo += [(int(col.id[j]), i, float(col.of["low"][j]), float(col.of["high"][j])) for j in at]
        if left <= collect_rows or len(todo) > driver_rows // 2:
            break

    if todo:
        before = []
        for i, col in enumerate(columns):
            at = np.flatnonzero(col.open_for(wanted))
            c_ref = col.stats.below[0] + np.cumsum(col.of["n_ref"]) - col.of["n_ref"]
            c_cur = col.stats.below[1] + np.cumsum(col.of["n_cur"]) - col.of["n_cur"]
            before += [(int(col.id[j]), i, float(c_ref[j]), float(c_cur[j]), float(col.stats.n[0]), float(col.stats.n[1])) for j in at]
        start = spark.createDataFrame(before, "id long, col int, c_ref double, c_cur double, n double, m double")
        values = (_dealt(cells, levels).join(F.broadcast(start.select("id")), "id").groupBy("id", "x")
                  .agg(F.sum(1 - F.col("side")).alias("r"), F.sum("side").alias("c")))
        run = Window.partitionBy("id").orderBy("x")
        so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        gap = F.abs((F.col("c_ref") + F.sum("r").over(so_far)) / F.col("n") - (F.col("c_cur") + F.sum("c").over(so_far)) / F.col("m"))
        per = (values.join(F.broadcast(start), "id").select("id", "col", gap.alias("gap"), (F.lead("x").over(run) - F.col("x")).alias("step"))
               .groupBy("id", "col").agg(F.max("gap").alias("peak"), F.coalesce(F.sum(F.col("gap") * F.col("step")), F.lit(0.0)).alias("area")))
        for r in per.collect():   # one row per open segment
            peaks[r["col"]] = max(peaks[r["col"]], r["peak"])
            inside[r["col"]][r["id"]] = r["area"]

    out = {}
    for i, c in enumerate(cols):
        out[c] = {}
        if "ks" in wanted:
            out[c]["ks"] = columns[i].greatest(peaks[i])
        if "w1" in wanted:
            out[c]["w1"] = columns[i].integral(inside[i])
    return out
