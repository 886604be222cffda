import os
import tempfile

import pandas as pd
import pytest

from fitframe.operators import features, profile, training
from fitframe.sources import files, jdbc
from tests.fixtures import random_matrix


def test_model_trainer_runs_on_random_matrix(spark):
    pdf = random_matrix(60)
    pdf["label"] = (pdf["y"] > 0.5).astype(int)
    pdf["id"] = range(len(pdf))
    pdf["grp"] = ["g%d" % (i % 3) for i in range(len(pdf))]
    df = spark.createDataFrame(pdf)
    res = training.train_all(df, ["a", "b", "c", "grp"], "label", ["id"], families=["LogisticRegression"],
                             n_trials=2, stack=False, categorical=["grp"])
    rows = res.results.collect()
    assert len(rows) == 1 and rows[0].model == "LogisticRegression"
    assert res.trials.count() == 2
    assert hasattr(res.best_model, "transform")
    assert {r.column for r in res.drift.collect()} == {"a", "b", "c", "grp"}
    assert res.encoder.columns == ["grp"] and set(res.scaler.order) == {"a", "b", "c", "grp"}


def test_param_mapping_and_draws():
    draws = training.draw_params("XGBoost", 3)
    assert len(draws) == 3 and all(50 <= d["n_estimators"] <= 200 for d in draws)
    assert training.draw_params("XGBoost", 3) == draws                   # seeded
    est = training.make_estimator("LightGBM", {"n_estimators": 60, "learning_rate": 0.1, "num_leaves": 31}, 100)
    assert est.getMaxIter() == 60 and est.getMaxDepth() == 5
    lr = training.make_estimator("LogisticRegression", {"C": 2.0}, 100)
    assert abs(lr.getRegParam() - 1 / 200) < 1e-12


def test_feature_engineering(spark):
    df = spark.createDataFrame(
        [("1.Finance", 10.0, 0.0, 1, 1, 1, 0, "India"),
         ("x.bad", None, 4.0, 0, 1, 1, 1, "Kenya"),
         (None, 5.0, None, None, 1, 0, 0, None)],
        "specialization string, total_time_spent_on_website double, total_visits double, do_not_email int, "
        "do_not_call int, search int, newspaper int, country string")
    st = features.fit_features(df, collapse={"lead_source_channel": ["search", "newspaper"]})
    assert st.ordinal_values == {"specialization": ["1.Finance"]}
    out = st.transform(df).collect()
    assert [r.specialization_ordinal for r in out] == [1.0, None, None]
    assert [r.time_per_visit for r in out] == [10.0, 0.0, None]
    assert [r.no_contact_allowed for r in out] == [1, 0, 0]
    assert [r.lead_source_channel for r in out] == ["search", "newspaper", "Other_Source"]
    assert [r.is_from_india for r in out] == [1, 0, 0]
    assert "search" not in st.transform(df).columns


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("b", 3.0), ("a", 4.0), (None, 5.0)], "c string, x double")
    mr = {r.column: (r.missing_count, r.missing_pct) for r in profile.missing_report(df).collect()}
    assert mr == {"c": (1, 20.0), "x": (1, 20.0)}
    cat = profile.describe_categorical(df, ["c"]).first()
    assert (cat["count"], cat.unique, cat.top, cat.freq) == (4, 2, "a", 2)
    num = profile.describe_numeric(df, ["x"]).first()
    s = pd.Series([1.0, 3.0, 4.0, 5.0])
    assert num["count"] == 4 and abs(num["std"] - round(s.std(), 6)) < 1e-9 and num.p50 == 3.5
    h = {r.bin: r.n for r in profile.histogram(df, ["x"], 4).collect()}
    assert sum(h.values()) == 4 and h[3] == 2                            # max lands in the last bin
    assert {r.dtype: r.n_columns for r in profile.dtype_frequency(df).collect()} == {"string": 1, "double": 1}


def test_csv_roundtrip_and_stage_dump(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    root = tempfile.mkdtemp(prefix="fitframe-io-")
    files.write_scored_csv(df, os.path.join(root, "scored"))
    back = files.read_csv(spark, os.path.join(root, "scored"), "id int, v string")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")]
    dumped = files.stage_dump(df, root, "stage1", enabled=True)
    assert dumped.count() == 2 and os.path.isdir(os.path.join(root, "stage1"))


def test_jdbc_options():
    o = jdbc.reader_options("jdbc:postgresql://db/x", "public", "Leads", partition_column="lead_number",
                            lower=0, upper=1000, num_partitions=8)
    assert o["dbtable"] == '"public"."Leads"' and o["numPartitions"] == "8"
    mode, w = jdbc.writer_options("jdbc:postgresql://db/x", "public", "Leads", if_exists="append", batch_size=1000)
    assert mode == "append" and w["batchsize"] == "1000"
    assert jdbc.writer_options("u", "s", "t", if_exists="fail")[0] == "errorifexists"
    with pytest.raises(ValueError):
        jdbc.writer_options("u", "s", "t", if_exists="merge")
    with pytest.raises(ValueError):
        jdbc.reader_options("u", "s", "t", partition_column="id")


def test_ml_target_encoder_mode_and_clusters(spark):
    from fitframe.operators import clustering, encoding
    rows = [("a", 1.0, 1.0)] * 20 + [("b", 0.0, 5.0)] * 20 + [("c", 1.0, 9.0)] * 5
    df = spark.createDataFrame(rows, "c string, y double, total_visits double")
    model = encoding.fit_ml_target_encoder(df, ["c"], "y", smoothing=1.0)
    out = {r.c: r.c__te for r in model.transform(df).dropDuplicates(["c"]).collect()}
    assert out["a"] > out["c"] - 1 and out["b"] < out["a"]
    km = clustering.fit_clusters(df, ["total_visits"], k=2)
    labels = {r.total_visits: r.engagement_cluster for r in km.transform(df).dropDuplicates(["total_visits"]).collect()}
    assert labels[1.0] != labels[9.0] and km.inertia() >= 0.0
    assert km.centers(spark).count() == 2


def test_csv_to_catalog_policies(spark):
    root = tempfile.mkdtemp(prefix="fitframe-cat-")
    src = os.path.join(root, "in")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.option("header", True).csv(src)
    target = os.path.join(root, "tbl")
    files.load_csv_to_catalog(spark, src, "ff_leads", "replace", "id int, v string", path=target)
    files.load_csv_to_catalog(spark, src, "ff_leads", "append", "id int, v string", path=target)
    assert spark.table("ff_leads").count() == 4
    with pytest.raises(Exception):
        files.load_csv_to_catalog(spark, src, "ff_leads", "fail", "id int, v string", path=target)
    files.load_csv_to_catalog(spark, src, "ff_leads", "replace", "id int, v string", path=target)
    assert spark.table("ff_leads").count() == 2
    spark.sql("DROP TABLE IF EXISTS ff_leads")
