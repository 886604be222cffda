"""Exact quantiles without a global sort and without a value map in one task.

Spark's ``percentile`` is exact but merges a value->count map of the whole
column in a single task, which does not survive a high-cardinality column at
cluster scale; ``percentile_approx`` is bounded but not exact.  This module
finds the exact order statistics by *bucket refinement*:

1. one aggregation gives ``count/min/max`` of every requested column (and,
   with ``accuracy > 0``, a ``percentile_approx`` bracket around every wanted
   probability: the sketch's rank error is at most ``n / accuracy``, so the
   exact order statistic lies inside ``[approx(p - 3/acc), approx(p + 3/acc)]``;
   cheaper in scans for very large columns, dearer in CPU);
2. every pass handles all columns at once: each value falls in one segment of
   its column (a gap or an open interval); gaps are left out, as the pass
   before tells how many values they hold (only after ``percentile_approx``
   they are counted), intervals
   holding at most ``collect_rows`` rows are grouped by value (which resolves
   the rank), larger ones are split into ``buckets`` buckets aggregated as
   ``count, min, max`` (one shuffle of at most ``#intervals x buckets`` groups,
   map-side combined, so a hot value costs one row per map task).  An interval
   within a factor of two is cut at equal widths, a wider one by the logarithm
   of the magnitude, so whatever the range, a few passes reach single values;
3. on the driver, the bucket that holds each wanted rank becomes the next
   interval ``[bucket min, bucket max]``; it is resolved when its min equals
   its max, or by grouping by value once it holds at most ``collect_rows``
   rows.  A bracket that misses its rank (not expected) falls back to the
   whole column.

The first pass settles a column of zeros and ones (flags, one-hot columns) by
counting the zeros.  Infinities are counted in the first pass and take the lowest and highest
ranks; the search runs over the finite values.

The driver reads at most ``driver_rows`` rows per pass however many columns
and probabilities are asked for (bucket counts shrink as intervals grow in
number).  Interpolation is linear between the two neighbouring order
statistics, as in pandas ``quantile``, Spark ``percentile`` and DuckDB
``quantile_cont``.
"""

from __future__ import annotations

import math
import os
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 4096
DEFAULT_COLLECT_ROWS = 50_000
MAX_PASSES = 40               # far above the 6 or 7 that any doubles need
DEFAULT_DRIVER_ROWS = 400_000   # rows the driver reads per pass, all columns together
DEFAULT_ACCURACY = 0          # > 0: seed the first pass with percentile_approx brackets
_DEBUG = bool(os.environ.get("FITFRAME_DEBUG"))


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _dlit(v: float) -> str:
    """A double literal in SQL text that parses back to exactly ``v``."""
    v = float(v)
    if math.isinf(v):
        return "CAST('Infinity' AS DOUBLE)" if v > 0 else "CAST('-Infinity' AS DOUBLE)"
    r = repr(v)
    return f"({r}D)" if ("e" in r or "E" in r or "." in r) else f"({r}.0D)"


def _clean(c: str):
    """Finite value of a column, else NULL."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def _infinite(c: str, sign: float):
    return F.sum((F.col(c).cast("double") == F.lit(sign * math.inf)).cast("long"))


def _magnitude(v: float) -> float:
    """A monotone map of all doubles to about [-2200, 2200]: sign times the
    binary logarithm of the magnitude, shifted past the smallest."""
    return 0.0 if v == 0 else math.copysign(math.log2(abs(v)) + 1100.0, v)


def _magnitude_sql(x: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN 0D ELSE sign({x}) * (log2(abs({x})) + 1100D) END)"


def _wide(lo: float, hi: float) -> bool:
    """Whether an interval spans more than a factor of two (or zero)."""
    return lo <= 0 <= hi or max(abs(lo), abs(hi)) > 2 * min(abs(lo), abs(hi))


def column_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    """count / min / max of every column in one aggregation."""
    aggs = []
    for i, c in enumerate(cols):
        x = _clean(c)
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).collect()[0]
    return {c: (int(row[f"n{i}"]), row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}


def exact_quantiles(df: DataFrame, cols: Sequence[str],
                    probs: Sequence[float] | Mapping[str, Sequence[float]],
                    buckets: int = DEFAULT_BUCKETS,
                    collect_rows: int = DEFAULT_COLLECT_ROWS,
                    accuracy: int = DEFAULT_ACCURACY,
                    driver_rows: int = DEFAULT_DRIVER_ROWS,
                    extra_aggs: Mapping | None = None,
                    extra_out: dict | None = None,
                    extra_ranks=None,
                    rank_out: dict | None = None,
                    ) -> dict[str, list[float | None]]:
    """Return ``{col: [quantile(p) for p in probs[col]]}``; NULL/NaN ignored.

    A column without values gets ``None`` for every probability.
    ``extra_aggs`` (name -> aggregate Column) ride along in the first pass;
    their values land in ``extra_out``.  ``extra_ranks`` (a function of the
    numbers and the rows of a column) names ranks from 0 whose values are
    searched along: ``rank_out[col] = (numbers, rows, {rank: value})``.
    """
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    want = {c: list(probs[c]) if isinstance(probs, Mapping) else list(probs) for c in cols}
    margin = 3.0 / accuracy if accuracy else 0.0

    # pass A: count / min / max and approximate brackets around every p
    aggs = []
    bracket_probs: dict[str, list[float]] = {}
    for i, c in enumerate(cols):
        x = _clean(c)
        bp = sorted({min(1.0, max(0.0, p + d)) for p in want[c] for d in (-margin, margin)})
        bracket_probs[c] = bp
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 _infinite(c, -1.0).alias(f"u{i}"), _infinite(c, 1.0).alias(f"v{i}")]
        aggs += [F.count_if(x == 0.0).alias(f"z{i}"), F.count_if(x == 1.0).alias(f"w{i}")]
        if accuracy:
            aggs.append(F.percentile_approx(x, bp, accuracy).alias(f"b{i}"))
    extra_aggs = dict(extra_aggs or {})
    if extra_ranks is not None:
        aggs.append(F.count(F.lit(1)).alias("_rows"))
    aggs += [e.alias(f"_e_{k}") for k, e in extra_aggs.items()]
    _t = time.time()
    row = df.agg(*aggs).collect()[0]
    if extra_out is not None:
        for k in extra_aggs:
            extra_out[k] = row[f"_e_{k}"]
    if _DEBUG:
        print(f"pass A: {time.time() - _t:.2f}s")
    st = {c: (int(row[f"n{i}"]), row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}
    below = {c: int(row[f"u{i}"] or 0) for i, c in enumerate(cols)}    # rows at -Infinity
    total = {c: st[c][0] + below[c] + int(row[f"v{i}"] or 0) for i, c in enumerate(cols)}
    # zeros of the columns that hold zeros and ones only
    zeros = {c: row[f"z{i}"] for i, c in enumerate(cols) if row[f"z{i}"] and row[f"z{i}"] + row[f"w{i}"] == row[f"n{i}"]}

    def settled(c: str, r: int) -> float | None:
        """The value at a rank among the finite ones, if pass A tells it."""
        n, lo, hi = st[c]
        return lo if lo == hi or r < zeros.get(c, 0) else hi if c in zeros else None

    brk = {c: dict(zip(bracket_probs[c], row[f"b{i}"] or [])) if accuracy else {} for i, c in enumerate(cols)}

    plan: dict[str, list[tuple[int, int, float]]] = {}
    ranks: dict[tuple[str, int], float | None] = {}
    # open target (col, rank) -> [lo, hi, expected rows in [lo, hi], finite
    # values below lo (None: not known)]
    open_t: dict[tuple[str, int], list] = {}
    for c in cols:
        n, lo, hi = st[c]
        rows = []
        for p in want[c]:
            if total[c] == 0:
                rows.append((-1, -1, 0.0))
                continue
            pos = float(p) * (total[c] - 1)
            r0 = int(math.floor(pos))
            r1 = min(r0 + 1, total[c] - 1)
            rows.append((r0, r1, pos - r0))
            if n == 0:
                continue
            blo = brk[c].get(min(1.0, max(0.0, p - margin)))
            bhi = brk[c].get(min(1.0, max(0.0, p + margin)))
            blo = lo if blo is None else max(lo, blo)
            bhi = hi if bhi is None else min(hi, bhi)
            expect = min(n, 2 * margin * n + 2 * n / accuracy + 1) if accuracy else n
            for r in (r0 - below[c], r1 - below[c]):   # ranks among the finite values
                if not 0 <= r < n:
                    continue
                if settled(c, r) is not None:
                    ranks[(c, r)] = settled(c, r)
                elif (c, r) not in open_t:
                    ranks[(c, r)] = None
                    open_t[(c, r)] = [blo, bhi, expect, None if accuracy else 0]
        plan[c] = rows
        if extra_ranks is not None:
            asked = sorted(extra_ranks(total[c], row["_rows"]))
            rank_out[c] = (total[c], row["_rows"], dict.fromkeys(asked))
            for r in (r - below[c] for r in asked):
                if 0 <= r < n and (c, r) not in ranks:
                    ranks[(c, r)] = settled(c, r)
                    if ranks[(c, r)] is None:
                        open_t[(c, r)] = [lo, hi, n, 0]

    passes = 0
    while open_t:
        passes += 1
        if passes > MAX_PASSES:
            raise RuntimeError(f"quantile search not settled after {MAX_PASSES} passes")
        # per column: disjoint sorted intervals (overlapping target intervals merged)
        segs: dict[str, list[list]] = {}
        for (c, _r), (lo, hi, size, under) in open_t.items():
            segs.setdefault(c, []).append([lo, hi, size, under])
        for c, ivs in segs.items():
            ivs.sort(key=lambda iv: iv[:3])
            merged = []
            for lo, hi, size, under in ivs:
                if merged and lo <= merged[-1][1]:
                    m = merged[-1]
                    if (lo, hi) != (m[0], m[1]):
                        m[2] = m[2] + size
                    m[1] = max(m[1], hi)
                else:
                    merged.append([lo, hi, size, under])
            segs[c] = merged
        counted = {c for c, ivs in segs.items() if any(iv[3] is None for iv in ivs)}   # gaps are counted
        # The driver reads at most ``driver_rows`` rows per pass: intervals are
        # grouped by value (smallest first) while their sizes fit half of
        # that budget; the others share it as buckets.
        ivs_all = sorted((iv for ivs in segs.values() for iv in ivs), key=lambda iv: iv[2])
        budget = driver_rows // 2
        for iv in ivs_all:
            if iv[0] == iv[1] or (iv[2] <= collect_rows and iv[2] <= budget):
                iv.append("collect")
                budget -= 0 if iv[0] == iv[1] else iv[2]
            else:
                iv.append("bucket")
        n_bucketed = sum(1 for iv in ivs_all if iv[4] == "bucket")
        nb = max(16, min(buckets, (driver_rows // 2) // max(1, n_bucketed)))
        # Per-row code is generated as SQL text (one parse per column instead
        # of thousands of driver->JVM calls).  The segment of x is a sum of
        # comparisons computed once in its own projection; the bucket reads its
        # interval from literal arrays, so no nested CASE grows with the number
        # of intervals and the stage stays inside whole-stage codegen.
        col_ids = {c: i for i, c in enumerate(segs)}
        xs = [f"CASE WHEN isnan(CAST({_q(c)} AS DOUBLE)) OR abs(CAST({_q(c)} AS DOUBLE)) = {_dlit(math.inf)} THEN NULL "
              f"ELSE CAST({_q(c)} AS DOUBLE) END AS _x{i}" for c, i in col_ids.items()]
        gs = []
        structs, read = [], []
        for c, ivs in segs.items():
            i = col_ids[c]
            gs.append(" + ".join(f"CAST(_x{i} >= {_dlit(lo)} AS INT) + CAST(_x{i} > {_dlit(hi)} AS INT)"
                                 for lo, hi, *_ in ivs) + f" AS _g{i}")
            ends = [tuple(map(_magnitude, iv[:2])) if _wide(iv[0], iv[1]) else (iv[0], iv[1]) for iv in ivs]
            los = ", ".join(_dlit(lo) for lo, _ in ends)
            widths = ", ".join(_dlit(float(hi - lo) or 1.0) for lo, hi in ends)
            flags = ", ".join("true" if iv[4] == "collect" else "false" for iv in ivs)
            logs = ", ".join("true" if _wide(iv[0], iv[1]) else "false" for iv in ivs)
            j = f"shiftright(_g{i}, 1)"
            scaled = f"(CASE WHEN get(array({logs}), {j}) THEN {_magnitude_sql(f'_x{i}')} ELSE _x{i} END)"
            bucket = (f"CAST(greatest(least(floor(({scaled} - get(array({los}), {j})) / get(array({widths}), {j}) "
                      f"* {nb}), {nb - 1}), 0) AS DOUBLE)")
            k = f"CASE WHEN _g{i} % 2 = 1 THEN (CASE WHEN get(array({flags}), {j}) THEN _x{i} ELSE {bucket} END) END"
            read.append(f"_x{i} IS NOT NULL" if c in counted else f"_g{i} % 2 = 1")
            structs.append(f"CASE WHEN {read[-1]} THEN named_struct('c', {i}, 'g', _g{i}, 'k', {k}, "
                           f"'x', _x{i}) END")
        base = df.selectExpr(*xs).selectExpr("*", *gs).where(" OR ".join(read))
        # explode, then drop NULL entries: a higher-order ``filter`` would
        # leave whole-stage codegen for the interpreted path
        agg = (base.selectExpr(f"explode(array({', '.join(structs)})) AS s").where("s IS NOT NULL")
               .groupBy(F.col("s.c").alias("c"), F.col("s.g").alias("g"), F.col("s.k").alias("k"))
               .agg(F.count(F.lit(1)).alias("cnt"), F.min("s.x").alias("mn"), F.max("s.x").alias("mx")))
        got: dict[int, list] = {}
        _t = time.time()
        collected = agg.collect()
        if _DEBUG:
            print(f"pass {passes}: {len(collected)} rows in {time.time() - _t:.2f}s "
                  f"modes={[iv[4] for ivs in segs.values() for iv in ivs]}")
        for r in collected:
            got.setdefault(r["c"], []).append((r["g"], r["k"] if r["k"] is not None else -math.inf,
                                               r["cnt"], r["mn"], r["mx"]))
        nxt = {}
        for c, ivs in segs.items():
            rows_c = sorted(got.get(col_ids[c], []), key=lambda t: (t[0], t[1]))
            below_seg: dict[int, int] = {}
            acc = 0
            for g in range(2 * len(ivs) + 1):
                below_seg[g] = acc
                acc += sum(t[2] for t in rows_c if t[0] == g)
            for (cc, r), (lo, hi, *_) in open_t.items():
                if cc != c:
                    continue
                j = next(i for i, iv in enumerate(ivs) if iv[0] <= lo and hi <= iv[1])
                mode = ivs[j][4]
                cum = below_seg[2 * j + 1] if c in counted else ivs[j][3]
                found = None
                for g, _k, cnt, mn, mx in rows_c:
                    if g != 2 * j + 1:
                        continue
                    if r < cum + cnt:
                        found = (cnt, mn, mx)
                        break
                    cum += cnt
                if found is None:
                    # the approximate bracket missed the rank: search the whole column
                    n, clo, chi = st[c]
                    nxt[(c, r)] = [clo, chi, n, 0]
                    continue
                cnt, mn, mx = found
                if mode == "collect" or mn == mx:
                    ranks[(c, r)] = mn
                else:
                    nxt[(c, r)] = [mn, mx, cnt, cum]
        open_t = nxt

    out: dict[str, list[float | None]] = {}
    for c in cols:
        vals = []
        for r0, r1, frac in plan[c]:
            if r0 < 0:
                vals.append(None)
                continue
            v0, v1 = (_ranked(ranks, c, r - below[c], st[c][0]) for r in (r0, r1))
            vals.append(interpolate(v0, v1, frac))
        out[c] = vals
        if extra_ranks is not None:
            for r in rank_out[c][2]:
                rank_out[c][2][r] = _ranked(ranks, c, r - below[c], st[c][0])
    return out


def interpolate(v0: float, v1: float, frac: float) -> float:
    """The value a part of the way between two neighbouring order statistics."""
    if frac == 0 or v0 == v1:
        return v0
    if math.isinf(v0) or math.isinf(v1):   # between a number and an infinity
        return v0 if math.isinf(v0) else v1
    return v0 + (v1 - v0) * frac if math.isfinite(v1 - v0) else v0 * (1 - frac) + v1 * frac


def _ranked(ranks: dict, c: str, r: int, n: int) -> float:
    """Value at a rank counted from the first finite value."""
    return -math.inf if r < 0 else math.inf if r >= n else ranks[(c, r)]


def exact_median(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, cols, [0.5], **kw).items()}
