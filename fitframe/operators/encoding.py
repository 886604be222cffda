"""Encoding (E1-E6).

One-hot: the sorted distinct values of each column are learned in one
``groupBy(column, value)`` job; the first category is dropped, unknown values
get all zeros, and the output is a ``select`` of ``CASE`` expressions, one
column per category.  A column of very many categories has the sparse form
instead: ``fit_one_hot_index`` numbers the sorted categories in a state table,
whatever their number, and the row carries the index of its one, or one sparse
ML vector of all columns.  ML's
``OneHotEncoder`` drops the *last* category, so it is not used for either.

Target encoding: ``groupBy(value).agg(count, avg(y))`` blended with the prior,
``lambda = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing))``; applied with a
left join whose broadcast is decided by the counted state size.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.ordered import running_totals
from ..functions.sizing import SizedFrame, materialize_state, measure
from ..state import Fitted, register


# categories of a column that may become columns of a table
WIDE_CATEGORIES = 10_000


@register
@dataclass
class OneHotState(Fitted):
    categories: dict            # column -> sorted categories (None = the NULL category, last)
    ordinal: dict = field(default_factory=dict)   # column -> declared order
    drop_first: bool = True
    naming: str = "plain"       # "plain": <col>_<val>; "prefixed": onehot__<col>_<val>, remainder__<col>
    unknown_ordinal: str = "error"
    others: list = field(default_factory=list)    # columns that stay, whose names are taken

    def order_effect(self, order) -> None:
        order.changed(*self.categories, *self.ordinal)

    def output_name(self, c: str, v) -> str:
        label = "nan" if v is None else str(v)
        return f"onehot__{c}_{label}" if self.naming == "prefixed" else f"{c}_{label}"

    def output_names(self) -> dict:
        """``(column, category) -> name``: as ``output_name`` has it, with
        ``_2``, ``_3``, .. behind where two would have the same (column ``a``
        with ``b_c`` and column ``a_b`` with ``c``) or another column has it."""
        taken = set(self.others) | set(self.ordinal) if self.naming == "plain" else set()
        out = {}
        for c, cats in self.categories.items():
            for v in cats[1:] if self.drop_first else cats:
                plain = name = self.output_name(c, v)
                k = 1
                while name in taken:
                    k += 1
                    name = f"{plain}_{k}"
                taken.add(name)
                out[c, v] = name
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        sel, tail = [], []
        names = self.output_names()
        for c, cats in self.categories.items():
            if c not in df.columns:
                continue
            s = F.col(c).cast("string")
            kept = cats[1:] if self.drop_first else cats
            for v in kept:
                hit = s.isNull() if v is None else (s == F.lit(v))
                sel.append(F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0)).alias(names[c, v]))
        for c, order in self.ordinal.items():
            if c not in df.columns:
                continue
            pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(c).cast("string"))
            bad = F.col(c).isNotNull() & (pos == 0)
            code = (pos - 1).cast("double")
            if self.unknown_ordinal == "error":
                code = F.when(bad, F.raise_error(F.concat(F.lit(f"unknown category in {c}: "),
                                                          F.col(c).cast("string")))
                              .cast("double")).otherwise(code)
            else:
                code = F.when(bad, F.lit(None).cast("double")).otherwise(code)
            sel.append(F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(code)
                       .alias(f"ordinal__{c}" if self.naming == "prefixed" else c))
        enc = set(self.categories) | set(self.ordinal)
        for c in df.columns:
            if c not in enc:
                tail.append(F.col(c).alias(f"remainder__{c}") if self.naming == "prefixed" else F.col(c))
        return df.select(*sel, *tail)

    def feature_names(self) -> list[str]:
        return list(self.output_names().values())


def _distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s")).select("s.c", "s.v").distinct()


def distinct_values(df: DataFrame, cols: list[str]) -> dict[str, list]:
    """Sorted distinct values per column (NULL last when present).  Each
    becomes an output column, so they are counted before they are read: a
    column of more than WIDE_CATEGORIES raises, and ``fit_one_hot_index`` has
    no such limit."""
    out: dict[str, list] = {c: [] for c in cols}
    if not cols:
        return out
    values = materialize_state(_distinct(df, cols))
    if values.rows > WIDE_CATEGORIES:
        big = {r["c"]: r["count"] for r in values.df.groupBy("c").count().collect() if r["count"] > WIDE_CATEGORIES}
        if big:
            raise ValueError(f"too many categories for a column each: {big}; use fit_one_hot_index")
    for r in values.df.collect():
        out[r["c"]].append(r["v"])
    return {c: sorted(v for v in vals if v is not None) + [None] * (None in vals) for c, vals in out.items()}


@register
@dataclass
class OneHotIndexState(Fitted):
    """E1, sparse: ``<c>_index`` is the place of the row's category among the
    columns that the wide form would have (from 0; NULL where all would be 0),
    ``<c>_size`` their number."""
    columns: list
    sizes: dict                 # column -> number of one-hot columns
    table: object               # SizedFrame (c, v, idx), the first category left out

    @classmethod
    def _from_state(cls, kw):
        return cls(kw["columns"], kw["sizes"], measure(kw["table"]))

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.columns:
            if c in df.columns:
                side = self.table.df.where(F.col("c") == c).select(F.col("v").alias(f"_iv_{c}"), F.col("idx").alias(f"{c}_index"))
                side = F.broadcast(side) if self.table.small else side
                out = (out.join(side, F.col(c).cast("string").eqNullSafe(F.col(f"_iv_{c}")), "left").drop(f"_iv_{c}")
                       .withColumn(f"{c}_size", F.lit(self.sizes.get(c, 0)).cast("long")))
        return out.drop(*self.columns)

    def vectors(self, df: DataFrame, numeric: Iterable[str] = (), output: str = "features") -> DataFrame:
        """``df`` with one ML vector: the ``numeric`` columns, then the ones of
        each encoded column, sparse whatever the number of categories.  Names
        are ML attributes where there are at most WIDE_CATEGORIES in all; the
        state table has them in any case."""
        from pyspark.ml.feature import OneHotEncoder, VectorAssembler
        cols = [c for c in self.columns if c in df.columns and self.sizes.get(c, 0) > 0]
        own = [c for c in self.columns if c in df.columns]    # the transform leaves them out
        row = self.transform(df.withColumn("_keep", F.struct(*[F.col(c) for c in own])) if own else df)
        indexed = {c: f"_one_{c}" for c in cols}
        # an index behind the last one is the category that ML leaves out: no one at all
        row = row.select("*", *[F.coalesce(F.col(f"{c}_index"), F.lit(self.sizes[c])).cast("double").alias(i) for c, i in indexed.items()])
        if cols:
            widest = df.sparkSession.createDataFrame([tuple(float(self.sizes[c]) for c in cols)], list(indexed.values()))
            encoder = OneHotEncoder(inputCols=list(indexed.values()), outputCols=[f"{i}_v" for i in indexed.values()], dropLast=True).fit(widest)
            row = encoder.transform(row)
        parts = [*numeric, *[f"{i}_v" for i in indexed.values()]]
        out = VectorAssembler(inputCols=parts, outputCol=output, handleInvalid="keep").transform(row)
        out = out.select(*[F.col(f"_keep.{c}") if c in own else F.col(c) for c in df.columns], output)
        if sum(self.sizes[c] for c in cols) <= WIDE_CATEGORIES:
            known = {(r["c"], r["idx"]): r["v"] for r in self.table.df.collect()}
            names = [*numeric, *[f"{c}_{'nan' if known.get((c, k)) is None else known[c, k]}" for c in cols for k in range(self.sizes[c])]]
            meta = {"ml_attr": {"attrs": {"numeric": [{"idx": k, "name": n} for k, n in enumerate(names)]}, "num_attrs": len(names)}}
            out = out.withColumn(output, F.col(output).alias(output, metadata=meta))
        return out


def fit_one_hot_index(df: DataFrame, columns: Iterable[str], drop_first: bool = True) -> OneHotIndexState:
    """Number the sorted categories of each column (NULL last) in Spark: a
    running count by (column, value), cut into ranges where there are many."""
    cols = [c for c in columns if c in df.columns]
    values = materialize_state(_distinct(df, cols).withColumn("one", F.lit(1)))
    known = running_totals(values.df.where("v is not null"), "v", ["one"], by=["c"], n_rows=values.rows)
    sizes = {r["c"]: r["n"] for r in values.df.groupBy("c").agg(F.count("*").alias("n")).collect()}
    last = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(int(sizes.get(c, 0))))])
    every = known.select("c", "v", F.col("cum_one").alias("place")).unionByName(
        values.df.where("v is null").select("c", "v", last[F.col("c")].cast("long").alias("place")))
    first = 1 if drop_first else 0
    table = materialize_state(every.where(F.col("place") > first).select("c", "v", (F.col("place") - 1 - first).cast("long").alias("idx")))
    return OneHotIndexState(cols, {c: max(int(sizes.get(c, 0)) - first, 0) for c in cols}, table)


def fit_one_hot(df: DataFrame, columns: Iterable[str] | None = None,
                ordinal: Mapping | None = None, drop_first: bool = True,
                naming: str = "plain", unknown_ordinal: str = "error") -> OneHotState:
    """Learn categories of nominal columns; ordinal columns keep the
    declared order."""
    ordinal = dict(config.ORDINAL_ENCODE if ordinal is None else ordinal)
    cols = list(config.ONEHOT_COLUMNS if columns is None else columns)
    onehot = [c for c in cols if c in df.columns and c not in ordinal]
    # a column the typing step already mapped to numbers is already ordinal
    ords = {c: list(v) for c, v in ordinal.items()
            if c in df.columns and df.schema[c].dataType.simpleString() == "string"}
    others = [c for c in df.columns if c not in set(onehot) | set(ords)]
    return OneHotState(distinct_values(df, onehot), ords, drop_first, naming, unknown_ordinal, others)


def to_numeric(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Coerce outputs to double where they parse; others untouched."""
    cols = set(df.columns if cols is None else cols)
    out = []
    for f in df.schema.fields:
        if f.name in cols and f.dataType.simpleString() == "string":
            out.append(F.col(f.name).try_cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def apply_feature_encoding(df: DataFrame, **kw) -> DataFrame:
    """Fit and apply in one call."""
    return fit_one_hot(df, **kw).transform(df)


# ---- target encoding (E4, E5) ------------------------------------------------

@register
@dataclass
class TargetEncodeState(Fitted):
    columns: list
    prior: float
    tables: object              # dict column -> SizedFrame (value string, enc double)
    smoothing: float = config.TARGET_SMOOTHING
    min_samples_leaf: float = config.TARGET_MIN_SAMPLES_LEAF
    suffix: str = ""

    def _split(self):
        scalars = {"columns": self.columns, "prior": self.prior, "smoothing": self.smoothing,
                   "min_samples_leaf": self.min_samples_leaf, "suffix": self.suffix}
        tables = {}
        for c, sf in self.tables.items():
            tables[f"table_{c}"] = sf.df
        return scalars, tables

    def transform(self, df: DataFrame) -> DataFrame:
        """Categories seen at fit get their blended mean, NULL its own (if seen),
        unseen ones the prior."""
        out = df
        for c in self.columns:
            if c not in out.columns:
                continue
            sf: SizedFrame = self.tables[c]
            side = sf.for_join().select(F.col("value").alias(f"_tv_{c}"), F.col("enc").alias(f"_te_{c}"))
            out = out.join(side, F.col(c).cast("string").eqNullSafe(F.col(f"_tv_{c}")), "left")
            out = out.withColumn(c + self.suffix, F.coalesce(F.col(f"_te_{c}"), F.lit(self.prior))) \
                     .drop(f"_tv_{c}", f"_te_{c}")
        return out



def load_target_encoder(spark, path: str) -> TargetEncodeState:
    """Reload a saved target encoder: scalars from ``_state``, one Parquet
    table per encoded column."""
    import json
    import os
    rows = {r["key"]: json.loads(r["value"]) for r in spark.read.parquet(os.path.join(path, "_state")).collect()}
    tables = {}
    for c in rows["columns"]:
        t = spark.read.parquet(os.path.join(path, f"table_{c}"))
        tables[c] = measure(t)
    return TargetEncodeState(rows["columns"], rows["prior"], tables, rows["smoothing"],
                             rows["min_samples_leaf"], rows["suffix"])


def fit_target_encoder(df: DataFrame, columns: Iterable[str], target: str,
                       smoothing: float = config.TARGET_SMOOTHING,
                       min_samples_leaf: float = config.TARGET_MIN_SAMPLES_LEAF,
                       suffix: str = "") -> TargetEncodeState:
    """Smoothed mean encoding; NULL is a category of its own."""
    cols = [c for c in columns if c in df.columns]
    y = exprs.number(target)
    # one stacked pass for all columns; the prior is the total of any of them
    stacked = df.select(y.alias("y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("value")) for c in cols])).alias("s"))
    stats = materialize_state(stacked.groupBy("s.c", "s.value").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("m"), F.sum("y").alias("sy"), F.count("y").alias("ny")))
    total = stats.df.where(F.col("c") == cols[0]).agg(F.sum("sy"), F.sum("ny")).first() if cols else (None, 0)
    prior = total[0] / total[1] if total[1] else None
    lam = 1.0 / (1.0 + F.exp(-(F.col("n") - F.lit(float(min_samples_leaf))) / F.lit(float(smoothing))))
    enc = stats.df.select("c", "value", (F.lit(prior) * (1 - lam) + F.col("m") * lam).alias("enc"))
    tables = {c: SizedFrame(enc.where(F.col("c") == c).select("value", "enc"), stats.rows, stats.local, stats.size) for c in cols}
    return TargetEncodeState(cols, prior, tables, smoothing, min_samples_leaf, suffix)


def fit_ml_target_encoder(df: DataFrame, columns: list[str], target: str, smoothing: float = 20.0):
    """E4, second mode: Spark ML ``TargetEncoder`` (blend ``n / (n + smoothing)``)
    over ``StringIndexer`` codes."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, TargetEncoder
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in columns]
    te = TargetEncoder(inputCols=[f"{c}__idx" for c in columns], outputCols=[f"{c}__te" for c in columns],
                       labelCol=target, targetType="binary", smoothing=smoothing)
    return Pipeline(stages=[*idx, te]).fit(df)
