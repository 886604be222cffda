import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fitframe.functions import modes, order_stats, quantiles
from fitframe.operators import binning, collinear, impute, outliers, scaling
from fitframe.plans.pipeline import Chain, Step


def column(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


# ---- order statistics through monotone steps ----

@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.none() | st.floats(-50, 50) | st.sampled_from([0.0, -0.0, 7.5]), min_size=1, max_size=30),
       fill=st.sampled_from([0.0, -60.0, 60.0, 7.5]) | st.floats(-50, 50))
def test_places_of_filled_and_clipped_columns(values, fill):
    present = sorted(v for v in values if v is not None)
    ranks = order_stats.wanted_ranks(len(present), len(values))
    t = order_stats._Tracked(len(present), len(values), {r: present[r] for r in ranks})
    for p in order_stats.USUAL:
        assert t.quantile(p) == (True, float(np.quantile(present, p)) if present else None) or t.quantile(p)[1] == pytest.approx(np.quantile(present, p))
    t.fill = fill
    t.maps.append(lambda x: min(max(x, -10.0), 20.0))
    now = np.clip([fill if v is None else v for v in values], -10.0, 20.0)
    for p in order_stats.USUAL:
        known, got = t.quantile(p)
        assert known and got == pytest.approx(np.quantile(now, p), abs=1e-12)


def chain(**kw):
    give = (lambda p: p["order"]) if kw.get("fused", True) else (lambda p: None)
    return Chain([
        Step("impute", lambda d, p: impute.fit_impute(d, {"x": "median", "y": "constant"}, {}, give(p))),
        Step("clip", lambda d, p: outliers.fit_clip(d, ["x", "y"], order=give(p))),
        Step("bin", lambda d, p: binning.fit_bins(d, {"x": {"strategy": "quantile", "bins": 4, "labels": list("abcd")},
                                                      "z": {"strategy": "quantile", "bins": 2, "labels": list("ab")}}, give(p))),
        Step("scale", lambda d, p: scaling.fit_scaler(d, robust=["x", "y"], order=give(p))),
        Step("again", lambda d, p: scaling.fit_scaler(d, robust=["x"], order=give(p)))])


def test_a_chain_searches_once_and_learns_the_same(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(None if i % 7 == 0 else float(v), None if i % 3 == 0 else float(w), None if i % 5 == 0 else float(i % 4))
            for i, (v, w) in enumerate(zip(rng.standard_t(2, 700), rng.exponential(size=700) ** 3))]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    searches = []
    plain = quantiles.exact_quantiles

    def counted(d, cols, *a, **k):
        if cols:
            searches.append(list(cols))
        return plain(d, cols, *a, **k)
    for module in (order_stats, binning):
        monkeypatch.setattr(module, "exact_quantiles", counted)
    one = chain().fit(df)
    assert searches == [["x", "y", "z"], ["z"]]    # z has gaps, which bins count as 0
    many = chain(fused=False).fit(df)
    assert len(searches) > 5
    for (s, a), (_, b) in zip(one.steps, many.steps):
        left, right = vars(a), vars(b)
        assert str(left.keys()) == str(right.keys())
        for k in left:
            assert _close(left[k], right[k]), (s.name, k)


def test_steps_are_dumped_on_request(spark, tmp_path):
    df = column(spark, [1.0, None, 3.0, 100.0])
    steps = [Step("impute", lambda d, p: impute.fit_median_fill(d, ["x"], p["order"])),
             Step("clip", lambda d, p: outliers.fit_clip(d, ["x"], order=p["order"]))]
    _, out = Chain(steps, dump=f"{tmp_path}/stages").fit_transform(df)
    assert sorted(r.x for r in spark.read.parquet(f"{tmp_path}/stages/impute").collect()) == [1.0, 3.0, 3.0, 100.0]
    assert sorted(r.x for r in spark.read.parquet(f"{tmp_path}/stages/clip").collect()) == sorted(r.x for r in out.collect())
    with pytest.raises(Exception, match="(?i)exists"):
        Chain(steps, dump=f"{tmp_path}/stages").fit_transform(df)


def _close(a, b):
    if isinstance(a, dict):
        return a.keys() == b.keys() and all(_close(a[k], b[k]) for k in a)
    if isinstance(a, list):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    return a == pytest.approx(b, rel=1e-12) if isinstance(a, float) else a == b


def test_changed_columns_are_searched_again(spark):
    df = column(spark, [1.0, 2.0, 3.0, 4.0, None])
    order = order_stats.OrderStats(df)
    assert order.quantiles(df, ["x"], [0.5, 0.1]) == {"x": [2.5, pytest.approx(1.3)]}
    order.changed("x")
    other = column(spark, [10.0, 30.0])
    assert order.quantiles(other, ["x"], [0.5]) == {"x": [20.0]}
    assert order_stats.OrderStats(column(spark, [None, None])).quantiles(column(spark, [None]), ["x"], [0.5]) == {"x": [None]}


# ---- modes ----

def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_modes_with_and_without_frequent_values(spark, monkeypatch):
    full = []
    plain = modes._best
    monkeypatch.setattr(modes, "_best", lambda w, which, among: full.append(len(which)) if among is None and which else None or plain(w, which, among))
    rng = random.Random(2)
    skewed = [f"v{int(rng.paretovariate(1.0))}" for _ in range(4000)] + [None] * 9000
    df = texts(spark, skewed)
    from collections import Counter
    n = Counter(v for v in skewed if v)
    want = min(n.items(), key=lambda t: (-t[1], t[0]))
    assert modes.exact_modes(df, {"a": df.v}) == {"a": want} and full == []


def test_modes_fall_back_when_no_value_is_frequent(spark):
    values = [f"id{i}" for i in range(5000)]
    df = texts(spark, values + ["id4321", "id77"])
    assert modes.exact_modes(df, {"a": df.v}, tracked=64, listed=10, error=3.5 / 128) == {"a": ("id4321", 2)}
    ties = texts(spark, ["b", "a", "b", "a", "c", None])
    assert modes.exact_modes(ties, {"a": ties.v, "b": ties.v.substr(5, 1)})["a"] == ("a", 2)
    assert modes.exact_modes(texts(spark, [None, None]), {"a": F.col("v")}) == {}
    assert modes.exact_modes(ties, {}) == {}


# ---- Gram matrix and usable columns ----

def test_gram_of_filled_columns(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    med = np.nanmedian(x, axis=0)
    filled = np.where(np.isnan(x), med, x)
    np.testing.assert_allclose(collinear._median_and_gram(df, list("abcd")), filled.T @ filled, rtol=1e-10)
    assert (collinear.moment_matrix(df.limit(0), list("abcd")) == 0).all()


def test_wide_tables_have_a_small_plan(spark):
    """500 columns: one column of vectors, no expression per pair."""
    k = 500
    df = spark.range(400).select(*[(F.rand(i) + (F.col("id") % (i + 2))).alias(f"c{i}") for i in range(k)])
    got = collinear.vif_from_gram(collinear.moment_matrix(df, df.columns)[:k, :k] + np.eye(k))
    assert got.shape == (k,) and np.isfinite(got).all()


def test_usable_columns_are_counted_exactly(spark):
    rows = [(1.0, 1.0, 0.0, 5.0, None, float(i)) for i in range(3)] + [(2.0, 1.0, 0.0, 5.0, float("nan"), 9.0), (1.5, 2.0, 0.0, 5.0, None, None)]
    df = spark.createDataFrame(rows, "three double, two double, zero double, one double, none double, many double")
    assert collinear.usable_numeric(df) == ["three", "many"]
    assert collinear.usable_numeric(df, min_unique=1) == ["three", "two", "many"]
    assert collinear.usable_numeric(df, min_unique=3) == ["many"]
