"""Feature selection and importance.

Importances come from Spark ML models (``featureImportances``) or from exact
aggregations.  The permutation test permutes a column over the whole table:
rows are ranked by a salted hash of their key, and a row takes the value of
the row some seeded number of ranks further on.  That is a join of ranks, the
same for any partitioning; the repeats of a feature are scored as one job with
the exact distributed AUC.
"""

from __future__ import annotations

import random
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.ordered import running_totals
from ..functions.sizing import materialize_state, stored_for_fits
from ..session import ensure_checkpoint_dir
from .evaluate import auc_by, auc_exact
from .split import fold_column

ROWS_PER_NARROW_TASK = 200_000   # of a fit on a few numbers a row, beyond a task a core


def top_k(importance: DataFrame, k: int = config.TOP_K_IMPORTANCE, score: str = "importance") -> DataFrame:
    """L2: the ``k`` most important features (a top-k report: the limit is the feature)."""
    return importance.orderBy(F.desc(score), F.asc("feature")).limit(k)


def select_top_k(df: DataFrame, importance: DataFrame, k: int = config.TOP_K_IMPORTANCE,
                 target: str | None = None) -> DataFrame:
    """L2: keep the top-k features (and the target)."""
    feats = [r["feature"] for r in top_k(importance, k).collect() if r["feature"] in df.columns]
    if target and target in df.columns and target not in feats:
        feats.append(target)
    return df.select(*feats)


def corr_importance(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """|Pearson correlation| with the target, all features in one aggregation."""
    y = F.col(target).cast("double")
    row = df.agg(*[F.corr(exprs.number(c), y).alias(f"r{i}") for i, c in enumerate(features)]).collect()[0]
    spark = df.sparkSession
    return spark.createDataFrame([(c, abs(row[f"r{i}"]) if row[f"r{i}"] is not None else 0.0)
                                  for i, c in enumerate(features)], "feature string, importance double")


def _vec(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Complete rows as vectors, stored once for the many passes of a fit."""
    clean = df.dropna(how="any", subset=[*features, target])
    va = VectorAssembler(inputCols=features, outputCol="features")
    return va.transform(stored_for_fits(clean.select(*features, F.col(target).cast("double").alias("label")))[0])


def rf_importance(df: DataFrame, target: str, features: list[str], k: int = 10,
                  seed: int = config.SEED) -> DataFrame:
    """L3: random-forest (50 trees) regression importances, top k."""
    m = RandomForestRegressor(numTrees=50, seed=seed, labelCol="label").fit(_vec(df, features, target))
    imp = m.featureImportances.toArray()
    spark = df.sparkSession
    t = spark.createDataFrame([(c, float(v)) for c, v in zip(features, imp)], "feature string, importance double")
    return top_k(t, k)


def gbt_importance(df: DataFrame, target: str, features: list[str], n_trees: int = 100,
                   seed: int = config.SEED) -> DataFrame:
    """L4 (re-aimed): boosted-tree importances on complete rows."""
    m = GBTClassifier(maxIter=n_trees, seed=seed, labelCol="label").fit(_vec(df, features, target))
    spark = df.sparkSession
    return spark.createDataFrame([(c, float(v)) for c, v in zip(features, m.featureImportances.toArray())],
                                 "feature string, importance double")


def linear_attribution(df: DataFrame, target: str, features: list[str]) -> DataFrame:
    """L4 (exact, linear models): mean |w_j (x_j - mean_j)| in one aggregation."""
    clean = _vec(df, features, target)
    m = LogisticRegression(maxIter=100, labelCol="label").fit(clean)
    w = m.coefficients.toArray()
    means = clean.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).collect()[0]
    row = clean.agg(*[F.avg(F.abs(F.lit(float(w[i])) * (F.col(c).cast("double") - F.lit(means[c]))))
                      .alias(c) for i, c in enumerate(features)]).collect()[0]
    spark = df.sparkSession
    return spark.createDataFrame([(c, float(row[c] or 0.0)) for c in features], "feature string, importance double")


def hash_ranked(df: DataFrame, keys: Iterable[str], seed: int = config.SEED, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """``df`` with ``_rank``, 1 to n in the order of a salted hash of ``keys``,
    which identify a row.  The hashes are counted in key ranges, never in one
    task; rows that share a key share a rank, and then the next rank is
    missing."""
    order = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys],
                              F.lit("rank"), F.lit(str(seed))).cast("binary"))
    counts = materialize_state(df.groupBy(order.alias("_o")).agg(F.count(F.lit(1)).alias("_n")))
    ranks = running_totals(counts.df, "_o", ["_n"], rows_per_bucket=rows_per_bucket, n_rows=counts.rows)
    return df.withColumn("_o", order).join(ranks.select("_o", F.col("cum__n").alias("_rank")), "_o").drop("_o")


def permuted(ranked: DataFrame, col: str, n: int, shift: int) -> DataFrame:
    """``ranked`` with the values of ``col`` moved by ``shift`` of ``n`` ranks:
    a permutation of the column when ranks are unique."""
    source = ranked.select(F.col(col).alias("_v"), ((F.col("_rank") - 1 + F.lit(n - shift)) % F.lit(n) + 1).alias("_rank"))
    return ranked.drop(col).join(source, "_rank").withColumnRenamed("_v", col)


def permutation_importance(df: DataFrame, target: str, features: list[str], n_repeats: int = 10,
                           seed: int = config.SEED, model=None, keys: Iterable[str] | None = None,
                           n_trees: int = 100) -> DataFrame:
    """AUC drop when one feature is permuted over the whole table, mean
    and population std over ``n_repeats`` seeded permutations.  ``keys``
    identify a row; without them, rows are numbered once into the shared
    folder."""
    spark = df.sparkSession
    if keys is None:
        df, keys = df.withColumn("_row", F.monotonically_increasing_id()), ["_row"]
    keys = list(keys)
    ensure_checkpoint_dir(spark)
    clean = df.dropna(how="any", subset=[*features, target]).select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *features,
        F.col(target).cast("double").alias("label")).checkpoint(eager=True)
    va = VectorAssembler(inputCols=features, outputCol="features")
    if model is None:
        model = GBTClassifier(maxIter=n_trees, seed=seed, labelCol="label").fit(va.transform(clean))
    ranked = hash_ranked(clean, [f"_key{i}" for i in range(len(keys))], seed).checkpoint(eager=True)
    n = ranked.count()

    def scored(frame, rep):
        return model.transform(va.transform(frame)).select(
            F.lit(rep).alias("rep"), "label", vector_to_array("probability")[1].alias("p"))
    base = auc_exact(scored(clean, 0), "label", "p").first()["auc"]
    rows = []
    for j, c in enumerate(features):
        rng = random.Random(f"{seed}-{j}")
        shifts = [rng.randrange(1, n) if n > 1 else 0 for _ in range(n_repeats)]
        stacked = None
        for r, s in enumerate(shifts):
            part = scored(permuted(ranked, c, n, s), r)
            stacked = part if stacked is None else stacked.unionByName(part)
        aucs = [r["auc"] for r in auc_by(stacked, ["rep"], "label", "p").collect()] if base is not None else []
        drops = [base - a for a in aucs if a is not None]
        rows.append((c, float(np.mean(drops)) if drops else None, float(np.std(drops)) if drops else None))
    return spark.createDataFrame(rows, "feature string, importance_mean double, importance_std double")


def rfe_cv(df: DataFrame, target: str, features: list[str], keys: list[str], folds: int = 5,
           seed: int = config.SEED) -> tuple[list[str], DataFrame]:
    """L1: recursive elimination (step 1) with a class-balanced logistic
    regression; each subset scored by the mean fold AUC; the best subset wins.

    The features are derived once, into the shared folder.  Which feature goes
    next is decided by the fit on all rows, so the fits on folds run beside
    those, and every fold of every subset is scored in one set of jobs."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    base = df.dropna(how="any", subset=[*features, target]).select(
        *keys, *features, F.col(target).cast("double").alias("label")).checkpoint(eager=True)
    pos = base.agg(F.avg("label")).first()[0] or 0.5
    w = F.when(F.col("label") == 1, F.lit(0.5 / pos)).otherwise(F.lit(0.5 / (1 - pos)))
    data, n = stored_for_fits(fold_column(base.withColumn("_w", w), keys, folds, "label", seed))
    # rows of a few numbers: a fit needs no more tasks than fill the cores
    data = data.coalesce(min(data.rdd.getNumPartitions(),
                             max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_NARROW_TASK))))
    lr = LogisticRegression(maxIter=100, weightCol="_w", labelCol="label")

    def fold_scores(vd, size, f):
        m = lr.fit(vd.where(F.col("fold") != f))
        return m.transform(vd.where(F.col("fold") == f)).select(
            F.lit(size).alias("size"), F.lit(f).alias("fold"), "label", vector_to_array("probability")[1].alias("p"))

    live = list(features)
    subsets, parts = [], []
    with ThreadPoolExecutor(max_workers=2 * max(folds, 2)) as pool:
        while live:
            vd = VectorAssembler(inputCols=live, outputCol="features").transform(data)
            subsets.append(list(live))
            parts += [pool.submit(fold_scores, vd, len(live), f) for f in range(folds)]
            if len(live) == 1:
                break
            full = lr.fit(vd)
            live.pop(int(np.argmin(np.abs(full.coefficients.toArray()))))
        stacked = None
        for part in parts:
            stacked = part.result() if stacked is None else stacked.unionByName(part.result())
    # a fold with one class has no AUC and does not count
    aucs: dict[int, list] = {}
    for r in (auc_by(stacked, ["size", "fold"], "label", "p").collect() if stacked is not None else []):
        if r["auc"] is not None:
            aucs.setdefault(r["size"], []).append((r["fold"], r["auc"]))
    history = []
    best, best_auc = list(features), float("-inf")
    for subset in subsets:
        got = [a for _, a in sorted(aucs.get(len(subset), []))]
        mean_auc = float(np.mean(got)) if got else float("nan")
        history.append((len(subset), ",".join(subset), mean_auc if got else None))
        if mean_auc > best_auc:
            best_auc, best = mean_auc, subset
    return best, spark.createDataFrame(history, "n_features int, features string, cv_auc double")
