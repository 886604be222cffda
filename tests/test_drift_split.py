import numpy as np
import pandas as pd

from fitframe.operators import drift, split


def _pair(spark, seed=0, shift=0.0):
    rng = np.random.default_rng(seed)
    ref = pd.DataFrame({"x": rng.normal(size=400).round(2), "c": rng.choice(list("abc"), 400)})
    cur = pd.DataFrame({"x": (rng.normal(size=300) + shift).round(2), "c": rng.choice(list("abcd"), 300)})
    return ref, cur, spark.createDataFrame(ref), spark.createDataFrame(cur)


def test_identical_sides_have_zero_drift(spark):
    ref, _, r, _ = _pair(spark)
    assert drift.psi_numeric(r, r, ["x"]).first()["psi"] == 0.0
    assert drift.ks_numeric(r, r, ["x"]).first()["ks"] == 0.0
    assert drift.js_categorical(r, r, ["c"]).first()["js"] == 0.0
    assert drift.wasserstein_numeric(r, r, ["x"]).first()["wasserstein"] == 0.0


def test_ks_and_wasserstein_match_brute_force(spark):
    ref, cur, r, c = _pair(spark, 1, 0.5)
    grid = np.union1d(ref.x, cur.x)
    f1 = np.searchsorted(np.sort(ref.x), grid, side="right") / len(ref)
    f2 = np.searchsorted(np.sort(cur.x), grid, side="right") / len(cur)
    assert abs(drift.ks_numeric(r, c, ["x"]).first()["ks"] - round(np.abs(f1 - f2).max(), 6)) < 1e-9
    w = (np.abs(f1 - f2)[:-1] * np.diff(grid)).sum() / ref.x.std(ddof=0)
    assert abs(drift.wasserstein_numeric(r, c, ["x"]).first()["wasserstein"] - round(w, 6)) < 1e-9


def test_drift_scores_gate_and_common_columns(spark):
    _, _, r, c = _pair(spark, 2, 3.0)
    assert drift.common_columns(r, c.withColumn("extra", c.x)) == ["c", "x"]
    s = drift.drift_scores(r, c)
    summ = drift.drift_summary(s).first()
    assert summ.n_columns == 2 and summ.n_drifted >= 1
    assert drift.monitor_drift(r, c) is True
    assert drift.monitor_drift(r, r) is False


def test_stratified_split_keeps_class_shares(spark):
    rows = [(i, 1 if i % 4 == 0 else 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, y int")
    train, test = split.stratified_split(df, "y", ["id"], test_size=0.2)
    tr = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    te = {r.y: r["count"] for r in test.groupBy("y").count().collect()}
    assert tr[1] + te[1] == 500 and tr[0] + te[0] == 1500
    assert abs(te[1] / 500 - 0.2) < 0.01 and abs(te[0] / 1500 - 0.2) < 0.01
    assert train.join(test, "id").count() == 0
    f = split.fold_column(df, ["id"], 5, "y")
    assert sorted(r.fold for r in f.select("fold").distinct().collect()) == [0, 1, 2, 3, 4]


def test_nan_and_empty_sides(spark):
    base = [(float(i % 7), "a" if i % 2 else "b") for i in range(200)]
    ref = spark.createDataFrame(base, "x double, c string")
    one_nan = spark.createDataFrame([(float("nan"), "a")] + base[1:], "x double, c string")
    assert drift.monitor_drift(one_nan, ref) is False
    gone = spark.createDataFrame([(None, "a") for _ in range(5)], "x double, c string")
    rows = {r.column: (r.score, r.status) for r in drift.drift_scores(ref, gone).collect()}
    assert rows["x"] == (None, "one_side_empty") and rows["c"][1] == "ok"
    nothing = gone.withColumn("c", gone.c.substr(0, 0)).selectExpr("x", "nullif(c, '') c")
    assert {r.status for r in drift.drift_scores(nothing, nothing).collect()} == {"empty"}
    for method in ("psi", "ks", "wasserstein"):
        assert {r.column: r.status for r in drift.drift_scores(ref, gone, numeric_method=method).collect()}["x"] == "one_side_empty"
    assert drift.monitor_drift(ref, ref.selectExpr("x y", "c d")) is False
    prof = drift.side_profile(ref, one_nan)
    assert {(r.side, r.column): r.missing_count for r in prof["missing"].collect()} == {("current", "x"): 1}
    assert {r.side for r in prof["numeric"].collect()} == {"reference", "current"} == {r.side for r in prof["categorical"].collect()}


def test_folds_are_exact_and_independent_of_the_split(spark):
    df = spark.createDataFrame([(i, "p" if i % 5 == 0 else "n") for i in range(1000)], "id long, y string")
    train, _ = split.stratified_split(df, "y", ["id"])
    for k in (3, 5, 10):
        got = split.fold_column(train, ["id"], k, "y").groupBy("y", "fold").count().collect()
        for c in ("p", "n"):
            sizes = [r["count"] for r in got if r.y == c]
            assert len(sizes) == k and max(sizes) - min(sizes) <= 1
    a = {r.id: r.fold for r in split.fold_column(df, ["id"], 5, "y").collect()}
    b = {r.id: r.fold for r in split.fold_column(df.repartition(7), ["id"], 5, "y").collect()}
    c = {r.id: r.fold for r in split.fold_column(df, ["id"], 5, "y", salt="stack").collect()}
    assert a == b and a != c


def test_many_classes_are_ranked_with_the_same_result(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i % 50 == 0 else f"c{(i * i) % 23}") for i in range(900)], "id long, y string")
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    few = [rows(f) for f in (*split.stratified_split(df, "y", ["id"]), split.fold_column(df, ["id"], 4, "y").where("fold is not null"))]
    monkeypatch.setattr(split, "SEARCHED_CLASSES", 3)
    many = [rows(f) for f in (*split.stratified_split(df, "y", ["id"]), split.fold_column(df, ["id"], 4, "y").where("fold is not null"))]
    assert few == many and len(few[0]) + len(few[1]) == 882
    assert split.fold_column(df, ["id"], 4, "y").where("fold is null").count() == 18
    # a class for each row
    one = spark.range(500).selectExpr("id", "cast(id as string) y")
    train, test = split.stratified_split(one, "y", ["id"])
    assert train.count() == 500 and test.count() == 0
