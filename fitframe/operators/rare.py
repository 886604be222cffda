"""Rare labels.

Fit: one ``groupBy(column, value).count`` over all configured columns
(NULL is its own value and counts in the denominator), share = count / rows,
rare when share < threshold.  The rare table is materialised with a counted
size: a small one becomes an ``isin`` hash set inside the projection, a large
one is joined (broadcast only within the checked bound, else a shuffle join
that AQE splits on skewed keys).  Values not seen at fit are left as they are.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.sizing import SizedFrame, materialize_state, measure
from ..state import Fitted, register

ISIN_MAX = 20_000


@register
@dataclass
class RareState(Fitted):
    rules: dict          # column -> {"threshold": t, "new_name": s}
    rare: object         # SizedFrame: (c string, v string) ; v NULL = the NULL value

    @classmethod
    def _from_state(cls, kw):
        return cls(kw["rules"], measure(kw["rare"]))

    def order_effect(self, order) -> None:
        order.changed(*self.rules)

    def rare_lists(self) -> dict[str, list] | None:
        sf: SizedFrame = self.rare
        if sf.rows > ISIN_MAX or not sf.small:
            return None
        out: dict[str, list] = {c: [] for c in self.rules}
        for r in sf.df.collect():
            out.setdefault(r["c"], []).append(r["v"])
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        lists = self.rare_lists()
        if lists is not None:
            sel = []
            for c in df.columns:
                if c in self.rules and lists.get(c):
                    vals = [v for v in lists[c] if v is not None]
                    null_rare = any(v is None for v in lists[c])
                    s = F.col(c).cast("string")
                    cond = s.isin(vals) if vals else F.lit(False)
                    if null_rare:
                        cond = cond | F.col(c).isNull()
                    sel.append(F.when(cond, F.lit(self.rules[c]["new_name"])).otherwise(s).alias(c))
                else:
                    sel.append(F.col(c))
            return df.select(*sel)
        # large rare tables: one left join per column on the value
        out = df
        sf: SizedFrame = self.rare
        for c, rule in self.rules.items():
            if c not in out.columns:
                continue
            side = sf.df.where(F.col("c") == c).select(
                F.col("v").alias(f"_rv_{c}"), F.lit(True).alias(f"_rf_{c}"))
            side = F.broadcast(side) if sf.small else side
            out = out.join(side, F.col(c).cast("string").eqNullSafe(F.col(f"_rv_{c}")), "left")
            out = out.withColumn(
                c, F.when(F.col(f"_rf_{c}"), F.lit(rule["new_name"])).otherwise(F.col(c).cast("string"))
            ).drop(f"_rv_{c}", f"_rf_{c}")
        return out


def label_shares(df: DataFrame, cols: list[str]) -> DataFrame:
    """R1 measure: ``(c, v, cnt, share)`` for every value, NULL included."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s"))
    counts = stacked.groupBy(F.col("s.c").alias("c"), F.col("s.v").alias("v")).agg(
        F.count(F.lit(1)).alias("cnt"))
    return counts


def fit_rare(df: DataFrame, rules: Mapping | None = None) -> RareState:
    rules = {c: dict(r) for c, r in (config.RARE_LABELS if rules is None else rules).items()
             if c in df.columns}
    if not rules:
        spark = df.sparkSession
        empty = spark.createDataFrame([], "c string, v string")
        return RareState(rules, SizedFrame(empty, 0, True, 0))
    counts = label_shares(df, list(rules))
    # every column sees every row, so the per-column total is the row count;
    # the total comes from the same counts (one job, the shuffle is reused)
    totals = counts.groupBy("c").agg(F.sum("cnt").alias("tot"))
    thr = F.create_map(*[x for c, r in rules.items() for x in (F.lit(c), F.lit(float(r["threshold"])))])
    rare = (counts.join(F.broadcast(totals), "c")
            .where((F.col("cnt") / F.col("tot")) < thr[F.col("c")]).select("c", "v"))
    return RareState(rules, materialize_state(rare))


def apply_rare_label_encoding(df: DataFrame, rules: Mapping | None = None) -> DataFrame:
    """Fit and apply in one call."""
    return fit_rare(df, rules).transform(df)
