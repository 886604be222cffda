"""Model training, tuning, stacking and comparison (M1-M3, M5) on Spark ML.

The three third-party boosters of the original map to ``GBTClassifier``
settings (they are single-machine libraries).  The adaptive sampler is
replaced by seeded random draws inside the declared ranges, evaluated by
k-fold cross-validation on a stratified fold column cut from a hash salted
apart from the split's; the fits run as concurrent jobs.
"""

from __future__ import annotations

import math
import random
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.sizing import stored_for_fits
from ..session import ensure_checkpoint_dir
from . import boosting
from .evaluate import auc_exact, confusion_metrics
from .scorer import scoring_model
from .split import fold_column

FAMILIES = list(config.TUNING_SPACE)


def make_estimator(name: str, params: dict, n_rows: int, label: str = "label",
                   features: str = "features", seed: int = config.SEED):
    """M1: one of the six classifiers, parameters mapped to Spark ML."""
    if name == "LogisticRegression":
        c = params.get("C", 1.0)
        return LogisticRegression(labelCol=label, featuresCol=features, maxIter=100,
                                  regParam=1.0 / (c * max(n_rows, 1)))
    if name == "RandomForest":
        return RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed,
                                      numTrees=int(params.get("n_estimators", 100)),
                                      maxDepth=min(int(params.get("max_depth", 5)), 30))
    iters = int(params.get("n_estimators", params.get("iterations", 100)))
    depth = params.get("max_depth", params.get("depth"))
    if depth is None and "num_leaves" in params:
        depth = math.ceil(math.log2(max(int(params["num_leaves"]), 2)))
    return GBTClassifier(labelCol=label, featuresCol=features, seed=seed, maxIter=iters,
                         stepSize=float(params.get("learning_rate", 0.1)),
                         maxDepth=min(int(depth or 3), 30))


def draw_params(name: str, n_trials: int, seed: int = config.SEED) -> list[dict]:
    """Seeded random draws within the declared ranges (M2)."""
    rng = random.Random(f"{name}-{seed}")
    out = []
    for _ in range(n_trials):
        p = {}
        for k, (kind, lo, hi) in config.TUNING_SPACE[name].items():
            p[k] = rng.randint(lo, hi) if kind == "int" else rng.uniform(lo, hi)
        out.append(p)
    return out


def assemble(df: DataFrame, features: list[str], label: str) -> DataFrame:
    va = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return va.transform(df.select(*features, F.col(label).cast("double").alias("label"),
                                  *[c for c in df.columns if c not in set(features) | {label}]))


@dataclass
class TrainResult:
    results: DataFrame        # model, accuracy, precision, recall, roc_auc
    trials: DataFrame         # model, trial, params, cv_auc, error
    best_name: str
    best_model: object
    drift: DataFrame | None = None      # train-vs-test drift scores (D3 columns)
    encoder: object = None              # target encoder fitted on train (E4)
    scaler: object = None               # standard scaler fitted on train (X2)
    fills: object = None                # medians of the numeric features, fitted on train (G3)
    features: list | None = None

    def scorer(self, keep: list[str] = ()):
        """Everything between raw features and the best model's probability
        as one ``PipelineModel`` (``operators/scorer.py``)."""
        states = [(n, s) for n, s in (("encode", self.encoder), ("fill", self.fills), ("scale", self.scaler)) if s is not None]
        return scoring_model(states, self.features, self.best_model, keep)


def _cancel_after(sc, tag: str, deadline: float, ended: threading.Event) -> None:
    """Cancel the tagged jobs from the deadline on, until the trial has ended."""
    if ended.wait(max(0.0, deadline - time.monotonic())):
        return
    while not ended.is_set():
        sc.cancelJobsWithTag(tag)
        ended.wait(0.3)


def concurrent_fits(train: DataFrame) -> int:
    """How many fits to run at once: twice what fills the cores with the tasks
    of one job, 2 to 16, so that many fits run at once on small tables only."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    return max(2, min(16, -(-2 * cores // max(1, train.rdd.getNumPartitions()))))


def tune(train: DataFrame, name: str, n_trials: int, folds: int = config.CV_FOLDS,
         seed: int = config.SEED, parallelism: int | None = None, seconds: float | None = config.TUNE_SECONDS):
    """M2: random-draw trials scored by the mean AUC of the folds in column
    ``fold``.  A failed trial scores -inf and keeps the error's text; if all
    fail, that is an error.  The fits of all trials and folds are concurrent
    Spark jobs, ``parallelism`` at once (None: ``concurrent_fits``), and begin
    in the order of the trials.  Boosted trees of a table that fits a task are
    grown in one task a fit (``boosting.fold_score``).

    After ``seconds`` (None: no limit) the running jobs are cancelled by their
    tag; a trial with a fold that was cut or not begun scores -inf and says
    so."""
    sc = train.sparkSession.sparkContext
    deadline = math.inf if seconds is None else time.monotonic() + seconds
    tag = f"tune-{uuid.uuid4().hex}"
    n = train.count()
    draws = draw_params(name, n_trials, seed)
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    estimators = [make_estimator(name, p, n) for p in draws]
    few = boosting.local_table(train, n, folds) if any(isinstance(e, GBTClassifier) for e in estimators) else None
    shared = None if few is None else sc.broadcast(few)

    def local_auc(est, f):
        args = (f, est.getMaxIter(), est.getStepSize(), est.getMaxDepth(), est.getMaxBins())
        return sc.parallelize([args], 1).map(lambda a: boosting.fold_score(shared.value, *a)).first()

    def fold_auc(i, f):
        """(AUC, error, begun)"""
        if time.monotonic() >= deadline:
            return None, f"not begun within {seconds} s", False
        sc.addJobTag(tag)
        try:
            if shared is not None:
                return local_auc(estimators[i], f), None, True
            model = estimators[i].fit(train.where(F.col("fold") != f))
            return float(ev.evaluate(model.transform(train.where(F.col("fold") == f)))), None, True
        except Exception as e:  # noqa: BLE001 - a failed trial scores -inf, as in the original
            late = time.monotonic() >= deadline
            return None, f"cut after {seconds} s" if late else str(e)[:500], True
        finally:
            sc.removeJobTag(tag)

    ended = threading.Event()
    if deadline < math.inf:
        threading.Thread(target=_cancel_after, args=(sc, tag, deadline, ended), daemon=True).start()
    try:
        with ThreadPoolExecutor(max_workers=parallelism or concurrent_fits(train)) as pool:
            futures = [[pool.submit(fold_auc, i, f) for f in range(folds)] for i in range(len(draws))]
            scored = [[x.result() for x in trial] for trial in futures]
    finally:
        ended.set()
        if shared is not None:
            shared.destroy()
    rows, best, best_auc = [], {}, float("-inf")
    for i, (p, parts) in enumerate(zip(draws, scored)):
        failed = [x for x in parts if x[1] is not None]
        begun = [x for x in failed if x[2]] if any(x[2] for x in parts) else failed
        error = (begun[0][1] if begun else f"cut after {seconds} s") if failed else None
        score = float("-inf") if failed else sum(x[0] for x in parts) / folds
        rows.append((name, i, repr(p), score, error))
        if score > best_auc:
            best_auc, best = score, p
    if rows and best_auc == float("-inf"):
        raise RuntimeError(f"all {len(rows)} trials of {name} failed; the last: {rows[-1][4]}")
    return best, rows


def train_all(df: DataFrame, features: list[str], target: str, keys: list[str],
              families: list[str] | None = None, n_trials: int = config.N_TRIALS, folds: int = config.CV_FOLDS,
              test_size: float = config.TEST_SIZE, seed: int = config.SEED,
              stack: bool = True, categorical: list[str] | None = None,
              drift_report: bool = True, seconds: float | None = config.TUNE_SECONDS) -> TrainResult:
    """M1/M2/M3/M5 with the original's preparation: drop NULL targets (D1),
    stratified split (D2), drift of train vs test on columns with spread on
    both sides (D3, Q2), target encoding of the categorical features and a
    standard scaler, both fitted on the train side only (E4, X2); then tune
    every family, fit on train, score on test, stack, and compare by AUC."""
    from .drift import drift_scores
    from .encoding import fit_target_encoder
    from .impute import fit_median_fill
    from .scaling import fit_scaler
    from .split import drop_null_target, stratified_split, variant_columns
    spark = df.sparkSession
    categorical = [c for c in (categorical or []) if c in df.columns]
    numeric = [c for c in features if c not in categorical]
    # stored once: the searches and fits below would each derive the features again
    ensure_checkpoint_dir(spark)
    data = drop_null_target(df, target).withColumn("label", F.col(target).cast("double")).checkpoint(eager=True)
    train, test = stratified_split(data, "label", keys, test_size, seed)
    train = fold_column(train, keys, folds, "label", seed)
    drift = None
    if drift_report:
        safe = variant_columns(train.select(*numeric), test.select(*numeric))
        cols = safe + categorical
        if cols:
            drift = drift_scores(train.select(*cols), test.select(*cols))
    encoder = None
    if categorical:
        encoder = fit_target_encoder(train, categorical, "label")
        train, test = encoder.transform(train), encoder.transform(test)
    fills = fit_median_fill(train, numeric)      # no NULL or NaN reaches a model
    train, test = fills.transform(train), fills.transform(test)
    scaler = fit_scaler(train, standard=features)
    train, test = scaler.transform(train), scaler.transform(test)
    va = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    # the prepared sides are stored once, in the shared folder
    train, n = stored_for_fits(va.transform(train))
    test, _ = stored_for_fits(va.transform(test))
    families = families or FAMILIES

    def run_family(name):
        params, rows = tune(train, name, n_trials, folds, seed, seconds=seconds)
        model = make_estimator(name, params, n).fit(train)
        return name, params, rows, model, _test_metrics(model.transform(test))

    # families are tuned as concurrent Spark jobs (results kept in family order)
    with ThreadPoolExecutor(max_workers=min(len(families), 4)) as pool:
        done = list(pool.map(run_family, families))
    results, trials, models, tuned = [], [], [], {}
    for name, params, rows, model, met in done:
        trials += rows
        tuned[name] = params
        models.append((name, model))
        results.append((name, *met))
    best_i = max(range(len(results)), key=lambda i: results[i][4] if results[i][4] is not None else -1.0)
    best_name, best_model = models[best_i]
    if stack and len(models) > 1:
        st = fit_stack(train, [(nm, make_estimator(nm, tuned[nm], n)) for nm, _ in models], features,
                       keys, k=config.STACK_FOLDS, seed=seed, full=[m for _, m in models])
        met = _test_metrics(st.transform(test))
        results.append(("StackingEnsemble", *met))
        if met[3] is not None and met[3] > max((r[4] for r in results[:-1] if r[4] is not None), default=-1.0):
            best_name, best_model = "StackingEnsemble", st
    res = spark.createDataFrame(results, "model string, accuracy double, precision double, "
                                         "recall double, roc_auc double")
    tri = spark.createDataFrame(trials, "model string, trial int, params string, cv_auc double, error string")
    return TrainResult(res, tri, best_name, best_model, drift, encoder, scaler, fills, list(features))


def _test_metrics(scored: DataFrame) -> tuple:
    s = scored.select("label", F.col("prediction").cast("int").alias("pred"),
                      vector_to_array("probability")[1].alias("p1"))
    m = confusion_metrics(s, "label", "pred").first()
    auc = auc_exact(s, "label", "p1").first()["auc"]
    return (m["accuracy"], m["precision"], m["recall"], float(auc) if auc is not None else None)


class StackModel:
    """M3: base models' out-of-fold probabilities + passthrough -> LR."""

    def __init__(self, bases: list, meta: PipelineModel, names: list[str]):
        self.bases, self.meta, self.names = bases, meta, names

    def save(self, path: str) -> None:
        """One ML model folder per base, the meta model, and their names."""
        SparkSession.getActiveSession().createDataFrame(list(enumerate(self.names)), "place int, name string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/names")
        for i, m in enumerate(self.bases):
            PipelineModel([m]).write().overwrite().save(f"{path}/base_{i}")
        self.meta.write().overwrite().save(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StackModel:
        names = [r["name"] for r in spark.read.parquet(f"{path}/names").orderBy("place").collect()]
        bases = [PipelineModel.load(f"{path}/base_{i}").stages[0] for i in range(len(names))]
        return cls(bases, PipelineModel.load(f"{path}/meta"), names)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for nm, m in zip(self.names, self.bases):
            out = m.transform(out).select(
                *out.columns, vector_to_array("probability")[1].alias(f"p_{nm}")).drop(
                "rawPrediction", "prediction", "probability")
        return self.meta.transform(out)


def fit_stack(train: DataFrame, bases: list, features: list[str], keys: list[str], k: int = 5,
              seed: int = config.SEED, parallelism: int | None = None, full: list | None = None) -> StackModel:
    """Out-of-fold base probabilities (the fits run as concurrent Spark jobs,
    ``parallelism`` at once, None: ``concurrent_fits``) + passthrough features
    -> LR.  The folds are stratified and cut from the hash of ``keys``.
    ``full``: the bases as fitted on all of ``train``, if that is done."""
    names = [n for n, _ in bases]
    ensure_checkpoint_dir(train.sparkSession)
    folded = fold_column(train, keys, k, "label", seed, "_sfold", "stack").checkpoint(eager=True)
    with ThreadPoolExecutor(max_workers=parallelism or concurrent_fits(folded)) as pool:
        fold_fits = [[pool.submit(est.fit, folded.where(F.col("_sfold") != f)) for _, est in bases] for f in range(k)]
        full_fits = [] if full is not None else [pool.submit(est.fit, train) for _, est in bases]
        oof = None
        for f in range(k):
            scored = folded.where(F.col("_sfold") == f)
            for nm, fit in zip(names, fold_fits[f]):
                scored = fit.result().transform(scored).select(*scored.columns,
                                                               vector_to_array("probability")[1].alias(f"p_{nm}"))
            oof = scored if oof is None else oof.unionByName(scored)
        meta_cols = [f"p_{n}" for n in names] + features
        va = VectorAssembler(inputCols=meta_cols, outputCol="_meta", handleInvalid="keep")
        lr = LogisticRegression(featuresCol="_meta", labelCol="label", maxIter=100)
        # stored once: each step of the fit would else send and score all fold models again
        meta = Pipeline(stages=[va, lr]).fit(oof.select("label", *meta_cols).checkpoint(eager=True))
        full = full if full is not None else [x.result() for x in full_fits]
    return StackModel(full, meta, names)
