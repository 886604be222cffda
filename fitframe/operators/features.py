"""Domain features.

F1 learns, per configured column, the values whose text before the first
``.`` parses as an integer; a value not seen at fit gives NULL.  A list that
fits a hash set is one; a longer one is a state table joined on the value,
with the same result.  Every other step is a pure column expression.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.sizing import SizedFrame, materialize_state, measure
from ..state import Fitted, register

ISIN_MAX = 20_000
TABLE = "*"      # stands for a list that is held as a table


def prefix_int(c: Column | str) -> Column:
    """Integer before the first ``.`` (surrounding blanks allowed), else NULL."""
    return F.trim(F.split(exprs.as_col(c).cast("string"), r"\.").getItem(0)).try_cast("int")


def ratio(num: str, den: str) -> Column:
    """``coalesce(num, 0) / (den with 0 -> 1)``; NULL den -> NULL."""
    return exprs.safe_ratio(num, den)


def both_one(a: str, b: str) -> Column:
    """1 when both flags equal 1, else 0 (NULL counts as not 1)."""
    return exprs.flag((F.col(a) == 1) & (F.col(b) == 1))


def collapse_indicators(cols: Iterable[str], default: str = config.OTHER_SOURCE) -> Column:
    """name of the LAST indicator (in list order) equal to 1, else ``default``."""
    out = F.lit(default)
    for c in cols:
        out = F.when(F.col(c) == 1, F.lit(c)).otherwise(out)
    return out


def equals_flag(c: str, value) -> Column:
    """``(c == value)`` as int, NULL -> 0."""
    return exprs.flag(F.col(c) == F.lit(value))


@register
@dataclass
class FeatureState(Fitted):
    ordinal_values: dict                 # column -> values whose prefix parses (F1)
    ratios: list = field(default_factory=lambda: [["time_per_visit", "total_time_spent_on_website",
                                                    "total_visits"]])
    both_flags: list = field(default_factory=lambda: [["no_contact_allowed", "do_not_email", "do_not_call"]])
    collapse: dict = field(default_factory=lambda: {"lead_source_channel": list(config.LEAD_SOURCE_DUMMIES)})
    equals: list = field(default_factory=lambda: [["is_from_india", "country", "India"]])
    ordinal_table: object = None         # SizedFrame (c, v) of the lists marked TABLE

    @classmethod
    def _from_state(cls, kw):
        if isinstance(kw.get("ordinal_table"), DataFrame):
            kw = {**kw, "ordinal_table": measure(kw["ordinal_table"])}
        return cls(**kw)

    def transform(self, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        drop: set[str] = set()
        extra: dict[str, Column] = {}
        marks = []
        for c, vals in self.ordinal_values.items():
            if c in have and vals:
                if vals == TABLE:
                    sized: SizedFrame = self.ordinal_table
                    side = sized.df.where(F.col("c") == c).select(F.col("v").alias(f"_ov_{c}"), F.lit(True).alias(f"_of_{c}"))
                    side = F.broadcast(side) if sized.small else side
                    df = df.join(side, F.col(c).cast("string") == F.col(f"_ov_{c}"), "left")
                    marks += [f"_ov_{c}", f"_of_{c}"]
                    seen = F.col(f"_of_{c}")
                else:
                    seen = F.col(c).cast("string").isin(vals)
                extra[f"{c}_ordinal"] = F.when(seen, prefix_int(c)).cast("double")
                drop.add(c)
        for name, a, b in self.ratios:
            if a in have and b in have:
                extra[name] = ratio(a, b)
        for name, a, b in self.both_flags:
            if a in have and b in have:
                extra[name] = both_one(a, b)
        for name, cols in self.collapse.items():
            present = [c for c in cols if c in have]
            extra[name] = collapse_indicators(present)
            drop |= set(present)
        for name, c, v in self.equals:
            if c in have:
                extra[name] = equals_flag(c, v)
        keep = [c for c in df.columns if c not in drop and c not in extra and c not in marks]
        return df.select(*keep, *[e.alias(n) for n, e in extra.items()])


def fit_features(df: DataFrame, ordinal_cols: Iterable[str] = config.PREFIX_ORDINAL_COLS,
                 isin_max: int = ISIN_MAX, **kw) -> FeatureState:
    """F1 fit: distinct values of each column whose prefix parses (one job)."""
    cols = [c for c in ordinal_cols if c in df.columns]
    values: dict = {c: [] for c in cols}
    table = None
    if cols:
        st = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s")
        ).select("s.c", "s.v").where(F.col("v").isNotNull()).distinct()
        sized = materialize_state(st.where(prefix_int("v").isNotNull()))
        if sized.rows <= isin_max and sized.small:
            for r in sized.df.collect():
                values[r["c"]].append(r["v"])
        else:
            table = sized
            for r in sized.df.select("c").distinct().collect():
                values[r["c"]] = TABLE
    return FeatureState({c: (v if v == TABLE else sorted(v)) for c, v in values.items() if v}, ordinal_table=table, **kw)


def full_feature_engineering(df: DataFrame, target: str, importance: bool = True, n_repeats: int = 10,
                             **kw):
    """Engineer features (F1-F5), then boosted-tree importances (L4) and
    permutation importances (L5) of the numeric features.  Returns the
    engineered frame and the two importance tables (``None`` when skipped)."""
    from .selection import gbt_importance, permutation_importance
    out = fit_features(df, **kw).transform(df)
    if not importance or target not in out.columns:
        return out, None, None
    num = [c for c in exprs.numeric_columns(out) if c != target]
    return (out, gbt_importance(out, target, num),
            permutation_importance(out, target, num, n_repeats=n_repeats))
