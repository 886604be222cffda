"""Fits that derive their features once and run concurrently."""

import threading
import time

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fitframe.operators import selection, training
from fitframe.operators.evaluate import auc_exact


def counted(spark, n=240):
    """A table of ``n`` rows, and an accumulator of the rows that were made."""
    made = spark.sparkContext.accumulator(0)

    def row(i):
        made.add(1)
        return (i, float(i % 17), float((i * 7) % 5), "ab"[i % 2], int((i % 17) + (i * 7) % 5 + i % 3 > 10))
    rdd = spark.sparkContext.parallelize(range(n), 4).map(row)
    return spark.createDataFrame(rdd, "id int, x double, y double, kind string, label int"), made, n


def test_training_derives_its_features_once(spark):
    df, made, n = counted(spark)
    got = training.train_all(df, ["x", "y", "kind"], "label", ["id"], families=["LogisticRegression"], n_trials=1,
                             categorical=["kind"])
    assert got.results.count() == 1 and made.value == n


def test_elimination_derives_its_features_once(spark):
    df, made, n = counted(spark)
    best, history = selection.rfe_cv(df, "label", ["x", "y"], ["id"], folds=3)
    assert [r.n_features for r in history.collect()] == [2, 1] and made.value == n


def test_elimination_scores_are_those_of_each_fold_alone(spark):
    df = counted(spark)[0].cache()
    best, history = selection.rfe_cv(df, "label", ["x", "y"], ["id"], folds=3)
    pos = df.agg(F.avg("label")).first()[0]
    weight = F.when(F.col("label") == 1, 0.5 / pos).otherwise(0.5 / (1 - pos))
    data = training.fold_column(df.withColumn("label", F.col("label").cast("double")).withColumn("_w", weight), ["id"], 3, "label")
    for r in history.collect():
        vec = VectorAssembler(inputCols=r.features.split(","), outputCol="features").transform(data)
        aucs = []
        for f in range(3):
            m = LogisticRegression(maxIter=100, weightCol="_w").fit(vec.where(F.col("fold") != f))
            scored = m.transform(vec.where(F.col("fold") == f)).select("label", vector_to_array("probability")[1].alias("p"))
            aucs.append(auc_exact(scored, "label", "p").first()["auc"])
        assert abs(r.cv_auc - np.mean(aucs)) < 1e-9
    df.unpersist()


def test_trials_and_folds_are_fitted_at_the_same_time(spark, monkeypatch):
    """Each trial's score is that of its folds alone, for any number of folds."""
    df = counted(spark)[0].select("id", "x", F.col("label").cast("double").alias("label"))
    train = VectorAssembler(inputCols=["x"], outputCol="features").transform(training.fold_column(df, ["id"], 4, "label")).checkpoint()
    running, most, fits, lock = [0], [0], [0], threading.Lock()
    plain = training.make_estimator

    def watched(*args, **kw):
        est = plain(*args, **kw)
        fit = est.fit

        def slow(data):
            with lock:
                running[0] += 1
                fits[0] += 1
                most[0] = max(most[0], running[0])
            time.sleep(0.5)
            try:
                return fit(data)
            finally:
                with lock:
                    running[0] -= 1
        est.fit = slow
        return est
    monkeypatch.setattr(training, "make_estimator", watched)
    _, trials = training.tune(train, "LogisticRegression", 2, folds=4, seconds=None, parallelism=8)
    assert most[0] > 1 and fits[0] == 8
    monkeypatch.undo()
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    for (_, _, _, score, error), p in zip(trials, training.draw_params("LogisticRegression", 2)):
        est = training.make_estimator("LogisticRegression", p, 240)
        want = [ev.evaluate(est.fit(train.where(F.col("fold") != f)).transform(train.where(F.col("fold") == f))) for f in range(4)]
        assert error is None and abs(score - np.mean(want)) < 1e-9


def test_chain_input_is_stored_in_columns(spark):
    from fitframe.plans.pipeline import materialize
    df = spark.createDataFrame([(1, "x", 2.5), (None, None, float("nan"))], "`a b` int, `A.c` string, `d,e` double").withColumn("none", F.lit(None))
    got = materialize(df.repartition(9), "checkpoint")
    assert got.dtypes == df.dtypes and got.inputFiles() and all(f.endswith(".parquet") for f in got.inputFiles())
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))
    read = [x for x in got.select("`a b`")._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in x or "FileScan" in x]
    assert read and all("c1" not in x.split("ReadSchema")[-1] for x in read)
