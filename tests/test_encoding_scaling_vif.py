import math

import numpy as np
import pandas as pd
import pytest

from fitframe.operators import collinear, encoding, scaling


def test_one_hot_drop_first_unknown_zero_and_names(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "x string")
    st = encoding.fit_one_hot(df, ["x"], ordinal={})
    assert st.categories["x"] == ["a", "b", "c", None]
    out = st.transform(spark.createDataFrame([("a",), ("c",), ("zz",)], "x string"))
    assert out.columns == ["x_b", "x_c", "x_nan"]
    assert [tuple(r) for r in out.collect()] == [(0.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 0.0)]
    pre = encoding.fit_one_hot(df, ["x"], ordinal={}, naming="prefixed").transform(
        spark.createDataFrame([("a", 1)], "x string, y int"))
    assert pre.columns == ["onehot__x_b", "onehot__x_c", "onehot__x_nan", "remainder__y"]


def test_sparse_one_hot_agrees_with_the_wide_form(spark):
    rows = [(i, f"v{i % 37:02d}" if i % 11 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x string")
    wide = {r.id: r.asDict() for r in encoding.fit_one_hot(df, ["x"], ordinal={}).transform(df).collect()}
    names = encoding.fit_one_hot(df, ["x"], ordinal={}).feature_names()
    st = encoding.fit_one_hot_index(df, ["x"])
    unseen = df.unionByName(spark.createDataFrame([(999, "never")], "id long, x string"))
    for r in st.transform(unseen).collect():
        assert r.x_size == len(names)
        ones = [i for i, n in enumerate(names) if r.id != 999 and wide[r.id][n] == 1.0]
        assert ones == ([] if r.x_index is None else [r.x_index])
    many = spark.range(3000).selectExpr("id", "cast(id as string) as x")
    assert len(encoding.fit_one_hot(many, ["x"], ordinal={}).categories["x"]) == 3000     # no cap
    assert encoding.fit_one_hot_index(many, ["x"]).sizes == {"x": 2999}


def test_ordinal_encoding_declared_order_and_unknown(spark):
    df = spark.createDataFrame([("High",), ("Low",), (None,)], "q string")
    st = encoding.fit_one_hot(df, [], ordinal={"q": ["Low", "Medium", "High"]}, unknown_ordinal="null")
    assert [r.q for r in st.transform(df).collect()] == [2.0, 0.0, None]
    bad = encoding.fit_one_hot(df, [], ordinal={"q": ["Low", "Medium", "High"]})
    with pytest.raises(Exception):
        bad.transform(spark.createDataFrame([("Huge",)], "q string")).collect()


def test_target_encoding_formula(spark):
    rows = [("a", 1)] * 30 + [("a", 0)] * 10 + [("b", 0)] * 5 + [(None, 1)] * 2
    df = spark.createDataFrame(rows, "c string, y int")
    st = encoding.fit_target_encoder(df, ["c"], "y", suffix="_te")
    prior = 32 / 47

    def enc(n, m):
        lam = 1 / (1 + math.exp(-(n - 20) / 20))
        return prior * (1 - lam) + m * lam
    got = {r.c: r.c_te for r in st.transform(df.union(spark.createDataFrame([("new", 0)], "c string, y int")))
           .dropDuplicates(["c"]).collect()}
    assert abs(got["a"] - enc(40, 0.75)) < 1e-12 and abs(got["b"] - enc(5, 0.0)) < 1e-12
    assert abs(got[None] - enc(2, 1.0)) < 1e-12 and abs(got["new"] - prior) < 1e-12


def test_scalers_match_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.exponential(2, 200)
    df = spark.createDataFrame(pd.DataFrame({"s": x, "r": x, "m": x, "keep": 1}))
    st = scaling.fit_scaler(df, standard=["s"], robust=["r"], minmax=["m"])
    out = st.transform(df).toPandas()
    assert list(out.columns) == ["s", "r", "m", "keep"]
    assert np.allclose(out.s, (x - x.mean()) / x.std())
    q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    assert np.allclose(out.r, (x - med) / (q3 - q1))
    assert np.allclose(out.m, (x - x.min()) / (x.max() - x.min()))
    back = st.inverse(st.transform(df)).toPandas()
    assert np.allclose(back.s, x) and np.allclose(back.r, x)


def test_adjusted_skew_matches_pandas(spark):
    x = pd.Series([1.0, 2.0, 4.0, 10.0, 30.0, 2.0])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "c": 1.0}))
    sk = scaling.skewness_table(df)
    assert abs(sk["x"] - x.skew()) < 1e-9
    assert scaling.detect_skewed(df) == ["x"]


def test_vif_matches_regression_and_greedy_drop(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=200)
    b = rng.normal(size=200)
    c = a * 2 + b + rng.normal(scale=0.05, size=200)
    X = np.column_stack([a, b, c])
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": c}))
    t = {r.feature: r.vif for r in collinear.vif_table(df, ["a", "b", "c"]).collect()}
    for i, name in enumerate("abc"):
        y = X[:, i]
        others = np.delete(X, i, axis=1)
        coef, *_ = np.linalg.lstsq(others, y, rcond=None)
        r2 = 1 - ((y - others @ coef) ** 2).sum() / (y ** 2).sum()      # uncentred, no intercept
        assert abs(t[name] - 1 / (1 - r2)) / t[name] < 1e-8
    st = collinear.fit_vif(df)
    assert st.dropped == ["c"] and sorted(st.selected) == ["a", "b"]
    out = st.transform(df.withColumn("onehot__z", df.a))
    assert out.columns[:2] == st.selected and "c" not in out.columns and "z" in out.columns


def test_gram_with_missing_values_matches_filled_matrix(spark):
    rng = np.random.default_rng(9)
    X = rng.normal(size=(120, 3))
    X[rng.random((120, 3)) < 0.2] = np.nan
    X[5, 1] = np.inf
    df = spark.createDataFrame(pd.DataFrame(X, columns=["a", "b", "c"]))   # NaN and inf count as missing
    g = collinear._median_and_gram(df, ["a", "b", "c"])
    F = np.where(np.isfinite(X), X, np.nan)
    med = np.nanmedian(F, axis=0)
    F = np.where(np.isnan(F), med, F)
    assert np.allclose(g, F.T @ F)


def test_names_that_clash_are_told_apart(spark):
    rows = [("b_c", "c", 1.0, "x"), ("b_c", "z", 2.0, "y"), ("a", "a", 3.0, "x"), ("d", "c", 4.0, "y")]
    df = spark.createDataFrame(rows, "a string, a_b string, k_y double, k string")
    st = encoding.fit_one_hot(df, ["a", "a_b", "k"], ordinal={})
    assert st.feature_names() == ["a_b_c", "a_d", "a_b_c_2", "a_b_z", "k_y_2"]
    out = st.transform(df)
    assert out.columns == [*st.feature_names(), "k_y"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 1, 0, 0, 1), (1, 0, 0, 1, 1, 2), (0, 0, 0, 0, 0, 3), (0, 1, 1, 0, 1, 4)]


def test_categories_are_counted_before_they_are_read(spark, monkeypatch):
    monkeypatch.setattr(encoding, "WIDE_CATEGORIES", 5)
    df = spark.range(20).selectExpr("cast(id as string) many", "cast(id % 3 as string) few")
    assert encoding.distinct_values(df, ["few"]) == {"few": ["0", "1", "2"]}
    with pytest.raises(ValueError, match="many"):
        encoding.fit_one_hot(df, ["few", "many"], ordinal={})


def test_sparse_vectors_train_a_model_on_user_ids(spark):
    from pyspark.ml.classification import LogisticRegression
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id", "user_id", "event_type", "value", "cast(event_id % 2 as double) label")
    st = encoding.fit_one_hot_index(e, ["user_id", "event_type"])
    made = st.vectors(e, numeric=["value"])
    n_users, n_types = e.select("user_id").distinct().count(), e.select("event_type").distinct().count()
    assert made.columns == [*e.columns, "features"] and made.count() == e.count()
    r = made.first()
    assert r.features.size == n_users + n_types - 1 and len(r.features.indices) <= 3
    names = [a["name"] for a in made.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]]
    assert names[0] == "value" and len(names) == r.features.size and sum(n.startswith("user_id_") for n in names) == n_users - 1
    users = sorted(str(x.user_id) for x in e.select("user_id").distinct().collect())
    for r in made.limit(50).collect():
        on = {names[i] for i, v in zip(r.features.indices, r.features.values) if v and i}
        want = {f"user_id_{r.user_id}"} if str(r.user_id) != users[0] else set()
        assert {n for n in on if n.startswith("user_id_")} == want
    model = LogisticRegression(maxIter=3).fit(made)
    assert model.coefficients.size == r.features.size
    # a user who was not there at fitting has no one at all
    new = st.vectors(e.limit(1).selectExpr("event_id", "-5L as user_id", "event_type", "value", "label")).first()
    assert all(not names[i + 1].startswith("user_id_") for i in new.features.indices)
