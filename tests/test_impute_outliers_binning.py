import numpy as np
import pandas as pd

from fitframe.operators import binning, impute, outliers, rare
from tests.fixtures import missing_pair


def test_reference_missing_pair_has_no_nulls(spark):
    df = spark.createDataFrame(missing_pair())
    st = impute.fit_median_fill(df)
    out = st.transform(df).toPandas()
    assert out.isnull().sum().sum() == 0
    assert out["a"].tolist() == [1.0, 2.0, 3.0] and out["b"].tolist() == [4.0, 5.0, 4.5]


def test_mode_tie_breaks_to_smallest_and_unknown_strategy(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    st = impute.fit_impute(df, {}, {"c": {"strategy": "mode"}})
    assert st.fills["c"]["value"] == "a"
    try:
        impute.fit_impute(spark.createDataFrame([(1.0,)], "x double"), {"x": "bogus"}, {})
        raise AssertionError
    except ValueError:
        pass


def test_iqr_bounds_and_clip_keep_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,), (-50.0,)], "x double")
    b = outliers.iqr_bounds(df, ["x"])
    q = np.quantile([1, 2, 4, 10, -50], [0.25, 0.75])
    assert np.allclose(b["x"], [q[0] - 1.5 * (q[1] - q[0]), q[1] + 1.5 * (q[1] - q[0])])
    st = outliers.fit_clip(df, ["x"])
    out = [r.x for r in st.transform(df).collect()]
    assert out[4] is None
    assert all(v is None or b["x"][0] <= v <= b["x"][1] for v in out)


def test_binary_columns_are_not_clipped_and_log_inverse(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 5.0), (0, 100.0), (1, 3.0)], "flag int, y double")
    st = outliers.fit_clip(df, log_columns=["y"])
    assert "flag" not in st.bounds
    back = outliers.inverse_log(outliers.ClipState({}, ["y"]).transform(df), ["y"])
    assert np.allclose([r.y for r in back.collect()], [1.0, 5.0, 100.0, 3.0])


def test_quantile_bins_match_pandas_qcut(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.gamma(2, 2, 200), 1)
    df = spark.createDataFrame(pd.DataFrame({"v": x}))
    labels = ["L", "M", "H", "VH"]
    st = binning.fit_bins(df, {"v": {"strategy": "quantile", "bins": 4, "labels": labels}})
    _, edges = pd.qcut(x, 4, retbins=True, duplicates="drop")
    assert np.allclose(st.edges["v"], edges)
    got = [r.v_binned for r in st.transform(df).collect()]
    want = pd.cut(x, bins=edges, labels=labels, include_lowest=True).astype(str).tolist()
    assert got == want


def test_uniform_edges_match_pandas_cut(spark):
    x = np.array([0.0, 1.5, 3.0, 9.0, 12.0])
    _, edges = pd.cut(x, 4, retbins=True)
    assert np.allclose(binning.uniform_edges(0.0, 12.0, 4), edges)
    _, edges = pd.cut(np.array([5.0, 5.0]), 4, retbins=True)
    assert np.allclose(binning.uniform_edges(5.0, 5.0, 4), edges)


def test_bins_right_closed_unknown_and_duplicate_edges(spark):
    st = binning.BinState({"v": [0.0, 2.0, 4.0]}, {"v": ["a", "b"]})
    df = spark.createDataFrame([(0.0,), (2.0,), (2.5,), (4.0,), (9.0,), (None,), (-1.0,)], "v double")
    got = [r.v_binned for r in st.transform(df).collect()]
    assert got == ["a", "a", "b", "b", "Unknown", "a", "Unknown"]
    df2 = spark.createDataFrame([(0.0,)] * 8 + [(1.0,), (2.0,)], "v double")
    st2 = binning.fit_bins(df2, {"v": {"strategy": "quantile", "bins": 4, "labels": ["q1", "q2", "q3", "q4"]}})
    assert st2.labels["v"] == ["q1"][: len(st2.edges["v"]) - 1] or len(st2.labels["v"]) == len(st2.edges["v"]) - 1


def test_rare_labels_null_counts_and_unseen_untouched(spark):
    rows = [("a",)] * 60 + [("b",)] * 38 + [("c",)] + [(None,)]
    df = spark.createDataFrame(rows, "x string")
    st = rare.fit_rare(df, {"x": {"threshold": 0.02, "new_name": "Other"}})
    out = st.transform(df.union(spark.createDataFrame([("zzz",)], "x string")))
    counts = {r.x: r["count"] for r in out.groupBy("x").count().collect()}
    assert counts == {"a": 60, "b": 38, "Other": 2, "zzz": 1}
