"""Cleaning and typing.

``fit_clean`` makes every data-dependent decision (high-missing and
low-variance drops) in one aggregation pass; ``CleanState.transform`` replays
them as one ``select`` (plus the whole-row dedup shuffle when training).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import exprs, names
from ..state import Fitted, register


def missing_fractions(df: DataFrame, cols: Iterable[str] | None = None) -> dict[str, float]:
    """C4 measure: NULL (and NaN) share of every column, one aggregation."""
    cols = list(cols) if cols is not None else df.columns
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.avg(exprs.missing(df, c).cast("double")).alias(f"m{i}"))
    row = df.agg(*aggs).collect()[0]
    return {c: (row[f"m{i}"] if row[f"m{i}"] is not None else 0.0) for i, c in enumerate(cols)}


def leak_columns(cols: Iterable[str], target: str = config.TARGET,
                 pattern: str = config.LEAK_PATTERN) -> list[str]:
    """Names matching ``(convert|target)`` (any case), except the target."""
    rx = re.compile(pattern)
    return [c for c in cols if rx.search(c) and c != target]


@register
@dataclass
class CleanState(Fitted):
    original_columns: list
    renamed_columns: list
    dropped_columns: list
    leak_columns: list
    final_columns: list
    placeholders: list = field(default_factory=lambda: list(config.PLACEHOLDERS))
    ordinal_maps: dict = field(default_factory=dict)
    name_mode: str = "split_capitals"

    def transform(self, df: DataFrame, dedup: bool = False) -> DataFrame:
        """Replay the cleaning decided at fit.

        ``dedup=True`` only when training (W2: scoring never removes rows).
        Columns the fit never saw are kept; expected ones that are absent are
        ignored, as the original does.
        """
        fn = names.standardize_name if self.name_mode == "split_capitals" else names.simple_name
        df = df.toDF(*[fn(c) for c in df.columns])
        gone = set(self.dropped_columns) | set(self.leak_columns)
        keep = [c for c in df.columns if c not in gone]
        df = df.select(*[_clean_col(df, c, self.placeholders) for c in keep])
        if dedup:
            df = df.dropDuplicates()
        if self.ordinal_maps:
            sel = []
            for c in df.columns:
                m = self.ordinal_maps.get(c)
                sel.append(exprs.map_values(c, m, "int").alias(c) if m else F.col(c))
            df = df.select(*sel)
        return df


def _clean_col(df: DataFrame, c: str, placeholders):
    if isinstance(df.schema[c].dataType, T.StringType):
        return exprs.placeholder_to_null(c, placeholders).alias(c)
    return F.col(c)


def fit_clean(df: DataFrame, drop_high_missing: bool = True, dynamic_var_drop: bool = True,
              keep_cols: Iterable[str] | None = None, target: str = config.TARGET,
              static_drop: Iterable[str] | None = None,
              placeholders: Iterable[str] = config.PLACEHOLDERS,
              ordinal_maps: Mapping | None = None,
              missing_threshold: float = config.MISSING_THRESHOLD,
              variance_threshold: float = config.VARIANCE_THRESHOLD,
              name_mode: str = "split_capitals") -> CleanState:
    """Learn which columns to drop, in one aggregation job.

    C1/C1b rename; C3 static drop lists (matched under both naming rules);
    C4 null share > ``missing_threshold`` and C5 sample variance <
    ``variance_threshold`` measured in the same aggregation, before the
    placeholders become NULL; C6 ``keep_cols`` veto; C7 leak names.  The
    transform applies C8 placeholders, C9 whole-row dedup (training only)
    and C10 ordinal maps."""
    original = list(df.columns)
    fn = names.standardize_name if name_mode == "split_capitals" else names.simple_name
    renamed = [fn(c) for c in original]
    sdf = df.toDF(*renamed)

    if static_drop is None:
        raw = config.ID_COLS + config.CONST_COLS + (config.HIGH_MISS_COLS if drop_high_missing else [])
        static = names.drop_list_names(raw)
    else:
        static = set(static_drop)
    to_drop = [c for c in renamed if c in static]

    numeric = exprs.numeric_columns(sdf)
    aggs = []
    if drop_high_missing:
        for i, c in enumerate(renamed):
            aggs.append(F.avg(exprs.missing(sdf, c).cast("double")).alias(f"m{i}"))
    if dynamic_var_drop:
        for i, c in enumerate(numeric):
            aggs.append(F.var_samp(exprs.number(c)).alias(f"v{i}"))
    if aggs:
        row = sdf.agg(*aggs).collect()[0]
        if drop_high_missing:
            to_drop += [c for i, c in enumerate(renamed)
                        if row[f"m{i}"] is not None and row[f"m{i}"] > missing_threshold]
        if dynamic_var_drop:
            to_drop += [c for i, c in enumerate(numeric)
                        if row[f"v{i}"] is not None and row[f"v{i}"] < variance_threshold]
    if keep_cols:
        keep = set(keep_cols)
        to_drop = [c for c in to_drop if c not in keep]
    to_drop = sorted(set(to_drop))
    remaining = [c for c in renamed if c not in set(to_drop)]
    leaks = leak_columns(remaining, target)
    final = [c for c in remaining if c not in set(leaks)]
    maps = dict(ordinal_maps) if ordinal_maps is not None else {}
    return CleanState(original, renamed, to_drop, leaks, final, list(placeholders),
                      {k: v for k, v in maps.items()}, name_mode)


def clean_report(df: DataFrame, state: CleanState) -> DataFrame:
    """C11 as a tidy table ``(item, value)``: row counts and column lists."""
    spark = df.sparkSession
    before = df.select(F.lit("rows_before").alias("item"), F.count(F.lit(1)).cast("string").alias("value"))
    cleaned = state.transform(df, dedup=True)
    after = cleaned.select(F.lit("rows_after").alias("item"), F.count(F.lit(1)).cast("string").alias("value"))
    lists = spark.createDataFrame(
        [("dropped_columns", ",".join(state.dropped_columns)),
         ("leak_columns", ",".join(state.leak_columns)),
         ("original_columns", ",".join(state.original_columns)),
         ("final_columns", ",".join(state.final_columns))], "item string, value string")
    return before.unionByName(after).unionByName(lists)


# ---- typing (T1-T4) ----------------------------------------------------------

def convert_types(df: DataFrame, numeric: Iterable[str] = config.NUMERIC_COLUMNS,
                  binary: Iterable[str] = config.BINARY_COLUMNS,
                  ordinal: Mapping | None = None,
                  yes_no: Mapping = config.YES_NO) -> DataFrame:
    """T1 numeric coercion, T2 Yes/No -> 1/0, T3 ordinal maps, in one select.

    T4 (object -> category) is the identity: strings stay strings and are
    indexed only where a model needs it.
    """
    numeric, binary = set(numeric), set(binary)
    ordinal = dict(config.ORDINAL_MAPPINGS if ordinal is None else ordinal)
    sel = []
    for c in df.columns:
        if c in numeric:
            sel.append(exprs.try_double(F.col(c).cast("string")).alias(c)
                       if isinstance(df.schema[c].dataType, T.StringType)
                       else F.col(c).cast("double").alias(c))
        elif c in binary:
            sel.append(exprs.map_values(c, yes_no, "int").alias(c))
        elif c in ordinal:
            sel.append(exprs.map_values(c, ordinal[c], "int").alias(c))
        else:
            sel.append(F.col(c))
    return df.select(*sel)


def coerce_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Numeric coercion of every column whose name starts with ``prefix``."""
    return df.select(*[(exprs.try_double(F.col(c).cast("string")).alias(c) if c.startswith(prefix)
                        else F.col(c)) for c in df.columns])


def complete_cases(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows where every listed column is neither NULL nor NaN."""
    return df.dropna(how="any", subset=list(cols))


# ---- schema conformance (C2, G5) ---------------------------------------------

def conform(df: DataFrame, expected: Mapping[str, str] = config.EXPECTED_RAW_SCHEMA,
            types: Mapping[str, str] | None = None, output: str = "standard") -> DataFrame:
    """Rename known columns, add missing ones as NULL, drop unknown ones,
    and fix the order, in one ``select``.  Incoming names are matched by the
    simple naming rule (C1b) of the raw names.  ``output="raw"`` names the
    result by the raw names, so a chain fitted on raw input (which applies
    C1 itself) sees exactly the names it was fitted on (W8)."""
    types = types or {}
    raw_to_std = {names.simple_name(k): v for k, v in expected.items()}
    std_to_raw = {v: k for k, v in expected.items()}
    present = {}
    for c in df.columns:
        std = raw_to_std.get(names.simple_name(c)) or (names.simple_name(c) if names.simple_name(c) in std_to_raw
                                                        else None)
        if std is not None and std not in present:
            present[std] = c
    sel = []
    for std in expected.values():
        t = types.get(std, "string")
        out = std_to_raw[std] if output == "raw" else std
        if std in present:
            sel.append(F.col(present[std]).alias(out))
        else:
            sel.append(F.lit(None).cast(t).alias(out))
    return df.select(*sel)


def add_missing(df: DataFrame, cols: Iterable[str], default=None, dtype: str = "double") -> DataFrame:
    """Add columns a fitted step expects, filled with ``default``."""
    have = set(df.columns)
    extra = [F.lit(default).cast(dtype).alias(c) for c in cols if c not in have]
    return df.select("*", *extra) if extra else df
