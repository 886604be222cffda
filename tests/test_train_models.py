"""The query ``train_models`` trains every family with the whole budget."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fitframe import config
from fitframe.operators import boosting, training
from fitframe.plans import catalog


@pytest.fixture
def documents(spark, tmp_path):
    """120 labelled documents; long ones are mostly good."""
    rows = [(i, " ".join(["Word"] * (i % 23 + 1)) + "\n" * (i % 4) + "7" * (i * 5 % 9), ["en", "de"][i % 2], ["web", "book", "code"][i % 3])
            for i in range(120)]
    spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id int, text string, lang string, source string, n_chars int") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 23 + i % 7 > 13), 0) for i in range(120)], "doc_id int, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_train_models_tunes_and_stacks_every_family(spark, documents, monkeypatch):
    tuned = {}

    def tune(train, name, n_trials, folds, seed, parallelism=None, seconds=config.TUNE_SECONDS):
        tuned[name] = (n_trials, folds, seconds)
        return {"n_estimators": 2, "iterations": 2, "max_depth": 2, "depth": 2}, []
    monkeypatch.setattr(training, "tune", tune)
    got = {r.model: r for r in catalog.QUERIES["train_models"](spark, documents).collect()}
    assert tuned == {name: (15, 3, None) for name in config.TUNING_SPACE} and len(tuned) == 6
    assert set(got) == {*config.TUNING_SPACE, "StackingEnsemble"}
    assert all(r.roc_auc is not None and 0.0 <= r.roc_auc <= 1.0 for r in got.values())


def labelled(spark, n=300):
    """Rows of three features, one of them with four values, in three folds."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=(n, 2)), rng.integers(0, 4, n)])
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) > 0).astype(float)
    rows = [(i, Vectors.dense(v), float(t), i % 3) for i, (v, t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, ["id", "features", "label", "fold"]).coalesce(1).checkpoint()


def test_local_trees_are_those_of_spark(spark):
    x, y, df = labelled(spark)
    inside = np.arange(len(x)) % 3 != 1
    model = GBTClassifier(seed=42, maxIter=12, maxDepth=4, stepSize=0.2).fit(df.where("fold <> 1"))
    scored = model.transform(df.where("fold = 1"))
    want = [r.rawPrediction[1] for r in scored.orderBy("id").collect()]
    assert np.allclose(boosting.boosted(x[inside], y[inside], x[~inside], 12, 0.2, 4), want, atol=1e-9)
    table = boosting.local_table(df, len(x), 3)
    area = BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(scored)
    assert abs(boosting.fold_score(table, 1, 12, 0.2, 4) - area) < 1e-9


def test_boosted_search_scores_every_draw(spark, monkeypatch):
    """In one task a fit, and by ``GBTClassifier`` for a larger table."""
    df = labelled(spark, 120)[2]
    monkeypatch.setitem(config.TUNING_SPACE, "XGBoost", {"n_estimators": ("int", 2, 4), "learning_rate": ("float", 0.1, 0.3), "max_depth": ("int", 2, 3)})
    best, trials = training.tune(df, "XGBoost", 3, seconds=None)
    assert len(trials) == 3 and all(t[4] is None for t in trials)
    monkeypatch.setattr(boosting, "MAX_LOCAL_VALUES", 359)
    again, by_spark = training.tune(df, "XGBoost", 3, seconds=None)
    assert best == again and np.allclose([t[3] for t in trials], [t[3] for t in by_spark], atol=1e-9)


def test_odd_tables_are_left_to_spark(spark):
    df = labelled(spark, 12)[2]
    assert boosting.local_table(df, 12, 3).shape == (12, 5)
    assert boosting.local_table(df, 12, 4) is None                                             # a fold without rows
    assert boosting.local_table(df.withColumn("label", F.col("label") + 1), 12, 3) is None     # not 0 or 1
    assert boosting.local_table(df.where("id < 0"), 0, 3) is None
    one = np.ones(4)
    assert (boosting.boosted(np.ones((4, 2)), one, np.zeros((3, 2)), 3, 0.1, 3) > 0).all()     # nothing to split
    ev = BinaryClassificationEvaluator(metricName="areaUnderROC", rawPredictionCol="p")
    for labels in ([1.0, 1.0], [0.0, 0.0], [0.0, 1.0], [1.0, 1.0, 0.0]):
        p = [0.5, 0.5, 0.2][:len(labels)]
        want = ev.evaluate(spark.createDataFrame(list(zip(p, labels)), "p double, label double"))
        assert boosting.area_under_roc(np.array(p), np.array(labels)) == want
