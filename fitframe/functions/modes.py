"""Exact most frequent values without shuffling every distinct value.

One pass keeps a frequent-items summary per column (``approx_top_k``: a
mergeable counter map of bounded size).  With ``TRACKED`` counters its
estimates are never too low and at most ``ERROR * n`` too high, and a value
that it does not list occurs at most ``2 * ERROR * n`` times, or no more often
than the last one listed if the list is full.  The listed values that may be
the most frequent are then counted exactly, a row per value and task.

If the best exact count is above what an unlisted value can have, it is the
mode, ties included.  Otherwise no value is frequent enough to be certain, and
the values of that column are counted in full.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000
LISTED = 200
ERROR = 3.5 / 16_384    # of a summary with room for TRACKED values (a power of two above TRACKED / 0.75)


def exact_modes(df: DataFrame, texts: Mapping[str, Column], tracked: int = TRACKED, listed: int = LISTED,
                error: float = ERROR) -> dict[str, tuple[str, int]]:
    """``{name: (value, count)}`` of the most frequent value of each text
    expression (NULL is no value), ties to the smallest; a name without values
    is left out."""
    names = list(texts)
    if not names:
        return {}
    wide = df.select(*[e.alias(f"v{i}") for i, e in enumerate(texts.values())])
    row = wide.selectExpr(*[x for i in range(len(names)) for x in (
        f"count(v{i}) AS n{i}", f"approx_top_k(v{i}, {listed}, {tracked}) FILTER (WHERE v{i} IS NOT NULL) AS top{i}")]).first()
    candidates, unlisted = [], {}
    for i in range(len(names)):
        top, n = row[f"top{i}"] or [], row[f"n{i}"]
        if not n:
            continue
        unlisted[i] = max(2 * error * n, top[-1]["count"] if len(top) == listed else 0)
        floor = max((t["count"] for t in top), default=0) - error * n
        candidates += [(i, t["item"]) for t in top if t["count"] >= floor]
    best = _best(wide, list(unlisted), df.sparkSession.createDataFrame(candidates, "c int, v string")) if candidates else {}
    unsure = [i for i in unlisted if i not in best or best[i][1] <= unlisted[i]]
    best.update(_best(wide, unsure, None))
    return {names[i]: best[i] for i in best}


def _best(wide: DataFrame, which: list[int], among: DataFrame | None) -> dict[int, tuple[str, int]]:
    """Exact most frequent values of the columns ``which``; only of the values
    ``among``, when given."""
    if not which:
        return {}
    cells = wide.select(F.explode(F.array(*[F.when(F.col(f"v{i}").isNotNull(), F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("v")))
                                            for i in which])).alias("s")).where("s IS NOT NULL").select("s.c", "s.v")
    if among is not None:
        cells = cells.join(F.broadcast(among), ["c", "v"], "left_semi")   # at most LISTED rows a column
    counts = cells.groupBy("c", "v").count()
    top = counts.groupBy("c").agg(F.min(F.struct((-F.col("count")).alias("k"), F.col("v").alias("v"))).alias("b"))
    return {r["c"]: (r["b"]["v"], -r["b"]["k"]) for r in top.collect()}
