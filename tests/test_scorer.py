import os
import subprocess
import sys
import time

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fitframe.operators import impute, outliers, scaling, scorer, training
from fitframe.plans.pipeline import Chain, Step

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(spark, n=400):
    return spark.range(n).select("id", F.when(F.col("id") % 9 != 0, (F.col("id") % 17).cast("double")).alias("x"),
                                 F.when(F.col("id") % 5 != 0, ((F.col("id") * 7) % 23).cast("double")).alias("y"),
                                 ((F.col("id") % 17 > 8) != (F.col("id") % 11 == 0)).cast("int").alias("label"),
                                 F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"))


def test_saved_scorer_in_a_new_process(spark, tmp_path):
    df = rows(spark)
    chain = Chain([Step("impute", lambda d, p: impute.fit_median_fill(d, ["x", "y"], p["order"])),
                   Step("clip", lambda d, p: outliers.fit_clip(d, ["x", "y"], order=p["order"])),
                   Step("scale", lambda d, p: scaling.fit_scaler(d, ["x"], ["y"], order=p["order"]))])
    fitted, prepared = chain.fit_transform(df)
    model = LogisticRegression(maxIter=20).fit(VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(prepared))
    one = scorer.scoring_model(fitted.states(), ["x", "y"], model, ["id"])
    want = {r.id: r.probability for r in scorer.score(df, one, ["id"]).collect()}
    assert len(want) == df.count() and 0 < min(want.values()) < 0.5 < max(want.values()) < 1
    one.write().overwrite().save(f"{tmp_path}/scorer")
    one.write().overwrite().save(f"{tmp_path}/scorer")     # a second save replaces the first
    df.write.parquet(f"{tmp_path}/raw")
    code = ("from pyspark.ml import PipelineModel\nfrom fitframe.session import build_session\nfrom fitframe.operators import scorer\n"
            "spark = build_session('local[1]', 2, driver_memory='1g')\n"
            f"out = scorer.score(spark.read.parquet(r'{tmp_path}/raw'), PipelineModel.load(r'{tmp_path}/scorer'), ['id'])\n"
            f"out.write.parquet(r'{tmp_path}/scored')\n")
    subprocess.run([sys.executable, "-c", code], check=True, env=os.environ | {"PYTHONPATH": ROOT}, timeout=300, capture_output=True)
    got = {r.id: r.probability for r in spark.read.parquet(f"{tmp_path}/scored").collect()}
    assert got == want
    # columns that are missing at scoring count as the model's default
    assert scorer.score(df.drop("y").withColumn("y", F.lit(None).cast("double")), PipelineModel.load(f"{tmp_path}/scorer"), ["id"]).count() == 400


def test_steps_without_a_state_cannot_be_saved(spark):
    with pytest.raises(ValueError, match="odd"):
        scorer.scoring_model([("odd", None)], ["x"], None)


def test_trained_result_scores_rows_with_gaps(spark, tmp_path):
    df = rows(spark, 600)
    got = training.train_all(df, ["x", "y", "kind"], "label", ["id"], families=["LogisticRegression", "RandomForest"], n_trials=1,
                             categorical=["kind"], drift_report=False)
    one = got.scorer(["id"])
    want = {r.id: r.probability for r in scorer.score(df, one, ["id"]).collect()}
    assert len(want) == 600 and all(0 <= p <= 1 for p in want.values())
    one.write().overwrite().save(f"{tmp_path}/best")
    assert {r.id: r.probability for r in scorer.score(df, PipelineModel.load(f"{tmp_path}/best"), ["id"]).collect()} == want
    accuracy = sum((want[r.id] > 0.5) == (r.label == 1) for r in df.collect()) / 600
    assert accuracy > 0.7


def test_tuning_ends_at_its_deadline(spark):
    df = rows(spark, 300).select("id", F.coalesce("x", F.lit(0.0)).alias("x"), F.col("label").cast("double").alias("label"))
    train = VectorAssembler(inputCols=["x"], outputCol="features").transform(training.fold_column(df, ["id"], 3, "label"))
    train = train.checkpoint()
    best, trials = training.tune(train, "LogisticRegression", 2, seconds=None)
    assert all(t[3] > 0.5 and t[4] is None for t in trials)
    begun = time.monotonic()
    best, trials = training.tune(train, "LogisticRegression", 200, seconds=10)
    assert time.monotonic() - begun < 40
    finished = [t for t in trials if t[4] is None]
    cut = [t for t in trials if t[4] is not None]
    assert len(trials) == 200 and finished and cut and all(t[3] == float("-inf") and "10 s" in t[4] for t in cut)
    assert repr(best) == max(finished, key=lambda t: t[3])[2]
    with pytest.raises(RuntimeError, match="failed"):
        training.tune(train, "LogisticRegression", 3, seconds=0)
    assert spark.range(10).count() == 10    # later jobs are not cancelled
