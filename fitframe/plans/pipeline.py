"""The step chain (Z6), batch scoring (Z1) and stage lineage.

``Chain.fit`` fits each step on the output of the previous one.  The input is
stored once in ``spark.checkpoint.dir`` (and again after the whole-row dedup,
the only step that shuffles rows), so the many small fit aggregations read
stored columns instead of recomputing the source plan; ``materialize="cache"``
keeps them on the executors until ``release``.  ``FittedChain.transform`` replays the fitted
states as one lazy plan: no step refits at scoring (W3, W4, W17, W18), no row
is dropped at scoring (W2), and a failing step raises (W16).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..operators import (binning, cleaning, clustering, collinear, encoding, features, impute, outliers,
                         rare, scaling, scoring, selection)
from ..functions.order_stats import OrderStats
from ..session import ensure_checkpoint_dir
from ..sources.files import stage_dump
from ..state import Fitted, load, register


def materialize(df: DataFrame, how: str | None) -> DataFrame:
    """Cache (or checkpoint) the input of iterative fits.

    An input with fewer partitions than the cluster's default parallelism
    (one Parquet row group, a small dimension join) is spread round-robin
    first, so each of the many fit passes uses every core; inputs that are
    already wide are left as they are (no extra shuffle at scale)."""
    if how is None:
        return df
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < parallelism:
        df = df.repartition(parallelism)
    if how == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        return stored_columns(df)
    raise ValueError(f"unknown materialize mode {how!r}")


def stored_columns(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder as Parquet, of which each pass of a
    fit reads the columns it needs.  Columns are stored by place, whatever
    their names; a column without a type is not stored."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/chain-{uuid.uuid4().hex}"
    placed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    typed = [f.name for f in placed.schema.fields if not isinstance(f.dataType, T.NullType)]
    if not typed:
        return df.checkpoint(eager=True)
    placed.select(*typed).write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(placed.select(*typed).schema).parquet(path)
    return back.select(*[(F.col(f"c{i}") if f"c{i}" in typed else F.lit(None)).alias(c) for i, c in enumerate(df.columns)])


@dataclass
class Step:
    name: str
    fit: Callable[[DataFrame, dict], object]                 # (df, earlier states and "order") -> fitted
    apply: Callable[[object, DataFrame, bool], DataFrame] | None = None  # (fitted, df, training)
    materialize_after: bool = False
    keeps_rows: bool = True           # a projection: row count unchanged

    def run(self, fitted, df: DataFrame, training: bool) -> DataFrame:
        return self.apply(fitted, df, training) if self.apply else fitted.transform(df)


@dataclass
class FittedChain:
    steps: list                       # [(Step, fitted)]
    lineage: scoring.Lineage = field(default_factory=scoring.Lineage)
    scoring_lineage: scoring.Lineage | None = None
    materialized: list = field(default_factory=list)   # cached frames of the fit

    def release(self) -> None:
        """Drop the fit-time caches once the fitted output is no longer read."""
        for d in self.materialized:
            d.unpersist()
        self.materialized = []

    def transform(self, df: DataFrame, track: bool = False) -> DataFrame:
        """Replay every fitted step (scoring mode).  ``track`` records the
        stage columns and the output frame, whose rows are counted when the
        lineage table is built (in ``scoring_lineage``; the fit lineage stays
        in ``lineage``)."""
        lin = scoring.Lineage() if track else None
        for step, fitted in self.steps:
            before = df
            df = step.run(fitted, df, False)
            if lin is not None:
                lin.record(step.name, before, df)
        if lin is not None:
            df = lin.track("output", df, df)
            self.scoring_lineage = lin
        return df

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        """Every step's state below ``path``, in step order; a step
        without a state is named only."""
        spark = spark or SparkSession.getActiveSession()
        spark.createDataFrame([(i, s.name, f is not None) for i, (s, f) in enumerate(self.steps)],
                              "place int, name string, has_state boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/steps")
        for step, fitted in self.steps:
            if fitted is not None:
                fitted.save(f"{path}/{step.name}", spark)

    @classmethod
    def load(cls, spark: SparkSession, path: str, chain: Chain) -> FittedChain:
        """A saved chain, to be replayed by the steps of ``chain`` (the same
        names in the same order; their fit functions are not called)."""
        saved = spark.read.parquet(f"{path}/steps").orderBy("place").collect()
        if [r["name"] for r in saved] != [s.name for s in chain.steps]:
            raise ValueError(f"the chain at {path} has other steps")
        return cls([(s, load(spark, f"{path}/{s.name}") if r["has_state"] else None) for s, r in zip(chain.steps, saved)])

    def states(self) -> list[tuple[str, object]]:
        """Step names and states, as ``operators.scorer.scoring_model`` takes them."""
        return [(step.name, fitted) for step, fitted in self.steps]

    def state(self, name: str):
        for step, fitted in self.steps:
            if step.name == name:
                return fitted
        raise KeyError(name)


class Chain:
    def __init__(self, steps: list[Step], materialize: str | None = "checkpoint", dump: str | None = None):
        """``dump``: a folder that gets the output of every step as Parquet
        (S5), ``<dump>/<step>``; it must hold none of them yet."""
        self.steps = steps
        self.materialize = materialize
        self.dump = dump

    def fit_transform(self, df: DataFrame) -> tuple[FittedChain, DataFrame]:
        lineage = scoring.Lineage()
        data = materialize(df, self.materialize)
        held = [data] if self.materialize == "cache" else []
        # counting the cached input also fills the cache the first fit reads
        cur_rows = data.count() if self.materialize else None
        lineage.rows_in = cur_rows
        fitted_steps = []
        order = OrderStats(data)      # quantiles that outlive monotone steps
        prior: dict = {}
        for step in self.steps:
            prior["order"] = order
            fitted = step.fit(data, prior)
            prior[step.name] = fitted
            before = data
            data = step.run(fitted, data, True)
            rows = cur_rows if step.keeps_rows else None
            if step.materialize_after:
                data = materialize(data, self.materialize)
                if self.materialize == "cache":
                    held.append(data)
                rows = data.count() if self.materialize else rows
            if self.dump:
                data = stage_dump(data, self.dump, step.name, enabled=True)
            cur_rows = rows
            order = order.after(fitted, data, step.keeps_rows)
            lineage.record(step.name, before, data, rows)
            fitted_steps.append((step, fitted))
        return FittedChain(fitted_steps, lineage, materialized=held), data

    def fit(self, df: DataFrame) -> FittedChain:
        return self.fit_transform(df)[0]


# ---- the default lead-conversion chain ---------------------------------------

@register
@dataclass
class Importance(Fitted):
    """Step 11: importance table learned at fit; transform is the identity."""
    table: DataFrame | None

    def transform(self, df: DataFrame) -> DataFrame:
        return df


@register
@dataclass
class TypeState(Fitted):
    """Step 2: declared types (T1-T3) and the target as a nullable int."""
    target: str
    numeric: list = field(default_factory=lambda: list(config.NUMERIC_COLUMNS))
    binary: list = field(default_factory=lambda: list(config.BINARY_COLUMNS))

    @classmethod
    def load_from(cls, spark: SparkSession, path: str, values: dict) -> TypeState:
        return cls(**values)       # a state saved with the target alone has the default columns

    def transform(self, df: DataFrame) -> DataFrame:
        return _typed(df, self.target, self.numeric, self.binary)


@register
@dataclass
class TopK(Fitted):
    """Step 13: the columns that are kept."""
    keep: list

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[c for c in df.columns if c in set(self.keep)])


def fit_importance(df: DataFrame, target: str, protect: list[str], n_trees: int = 100) -> Importance:
    """Step 11: boosted-tree importances of the numeric columns but ``protect``."""
    num = [c for c in df.columns if c not in protect and
           df.schema[c].dataType.simpleString() in ("double", "int", "bigint", "float")]
    if target not in df.columns or not num:
        return Importance(None)
    return Importance(selection.gbt_importance(df, target, num, n_trees=n_trees))


def fit_top_k(df: DataFrame, importance: Importance | None, protect: list[str], k: int = config.TOP_K_IMPORTANCE) -> TopK:
    """Step 13: the ``k`` most important columns, ``protect`` and the cluster."""
    imp = importance.table if importance is not None else None
    if imp is None:
        return TopK(df.columns)
    keep = [r["feature"] for r in selection.top_k(imp, k).collect()]
    return TopK(keep + [c for c in df.columns if c in protect or c == "engagement_cluster"])


# C1 name of the raw "Prospect ID" column, the key carried through the chain
LEAD_KEY = "prospect_i_d"


def lead_chain(target: str = config.TARGET, key: str | None = LEAD_KEY, top_k: int = config.TOP_K_IMPORTANCE,
               materialize_how: str | None = "checkpoint", importance_trees: int = 100) -> Chain:
    """Clean -> types -> impute -> outliers -> engineer -> bin -> rare ->
    VIF -> encode -> scale -> importance -> cluster -> select."""
    protect = [c for c in (target, key) if c]

    keep_cols = [key] if key else None
    steps = [
        Step("1_clean", lambda d, p: cleaning.fit_clean(d, keep_cols=keep_cols, target=target,
                                                     static_drop=_static_drop(key)),
             lambda f, d, training: f.transform(d, dedup=training), materialize_after=True, keeps_rows=False),
        Step("2_type_convert", lambda d, p: TypeState(target)),
        Step("3_impute", lambda d, p: impute.fit_impute(d, order=p["order"])),
        Step("4_outlier", lambda d, p: outliers.fit_clip(d, exclude=protect, order=p["order"])),
        Step("5_engineer", lambda d, p: features.fit_features(d)),
        Step("6_bin", lambda d, p: binning.fit_bins(d, order=p["order"])),
        Step("7_rare_label", lambda d, p: rare.fit_rare(d)),
        Step("8_vif", lambda d, p: collinear.fit_vif(d.drop(*[c for c in protect if c in d.columns]), order=p["order"])),
        Step("9_encode", lambda d, p: encoding.fit_one_hot(d)),
        Step("10_scale", lambda d, p: scaling.fit_scaler(d, config.STANDARD_SCALE_COLS, config.ROBUST_SCALE_COLS,
                                                      config.MINMAX_SCALE_COLS, skewed_to_robust=True,
                                                      target=target, order=p["order"])),
        Step("11_importance", lambda d, p: fit_importance(d, target, protect, importance_trees)),
        Step("12_cluster", lambda d, p: clustering.fit_clusters(d)),
        Step("13_select", lambda d, p: fit_top_k(d, p.get("11_importance"), protect, top_k)),
    ]

    return Chain(steps, materialize_how)


def _typed(df: DataFrame, target: str, numeric: list[str], binary: list[str]) -> DataFrame:
    """T1-T3 plus the target as a nullable int (D1's cast)."""
    out = cleaning.convert_types(df, numeric, binary)
    if target in out.columns:
        out = out.withColumn(target, F.col(target).cast("string").try_cast("double").cast("int"))
    return out


def _static_drop(key: str | None) -> set[str]:
    from ..functions.names import drop_list_names
    drop = drop_list_names(config.ID_COLS + config.CONST_COLS + config.HIGH_MISS_COLS)
    return {c for c in drop if c != key}


# ---- batch scoring (Z1) --------------------------------------------------------

def score_batch(raw: DataFrame, chain: FittedChain, model, features: list[str], key: str = LEAD_KEY,
                threshold: float = 0.5) -> DataFrame:
    """Conform the raw schema, replay the fitted chain, align to the
    model's features, predict, and format; every input row is kept (keyed)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    conformed = cleaning.conform(raw, output="raw")
    prepared = chain.transform(conformed)
    aligned = scoring.align_features(prepared, features, keep=[key])
    vec = VectorAssembler(inputCols=features, outputCol="features").transform(aligned)
    scored = model.transform(vec).select(key, vector_to_array("probability")[1].alias("probability"))
    return scoring.format_scores(scored, "probability", threshold)


__all__ = ["Chain", "FittedChain", "Step", "lead_chain", "score_batch", "materialize", "F"]
