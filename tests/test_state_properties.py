import os
import tempfile

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fitframe.functions.quantiles import exact_quantiles
from fitframe.operators import binning, encoding, outliers, rare, scaling
from fitframe.state import load


def _roundtrip(spark, fitted, df):
    path = os.path.join(tempfile.mkdtemp(prefix="fitframe-rt-"), "s")
    fitted.save(path)
    again = load(spark, path)
    a = sorted(map(tuple, fitted.transform(df).collect()), key=repr)
    b = sorted(map(tuple, again.transform(df).collect()), key=repr)
    assert fitted.transform(df).columns == again.transform(df).columns
    assert a == b


def test_states_save_load_replay_the_same_rows(spark):
    df = spark.createDataFrame([(float(i % 17), "abcde"[i % 5] if i % 11 else "z", i % 2) for i in range(200)],
                               "x double, c string, y int")
    _roundtrip(spark, outliers.fit_clip(df, ["x"], log_columns=["x"]), df)
    _roundtrip(spark, binning.fit_bins(df, {"x": {"strategy": "quantile", "bins": 4,
                                                  "labels": ["a", "b", "c", "d"]}}), df)
    _roundtrip(spark, rare.fit_rare(df, {"c": {"threshold": 0.05, "new_name": "Other"}}), df)
    _roundtrip(spark, encoding.fit_one_hot(df, ["c"], ordinal={}), df)
    _roundtrip(spark, scaling.fit_scaler(df, ["x"], [], []), df)
    _roundtrip(spark, encoding.fit_target_encoder(df, ["c"], "y"), df)


def test_clip_within_bounds_and_scaled_moments(spark):
    rng = np.random.default_rng(11)
    x = rng.lognormal(size=300)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    stt = outliers.fit_clip(df, ["x"])
    lo, hi = stt.bounds["x"]
    got = np.array([r.x for r in stt.transform(df).collect()])
    assert got.min() >= lo - 1e-12 and got.max() <= hi + 1e-12
    sc = scaling.fit_scaler(df, ["x"]).transform(df)
    z = np.array([r.x for r in sc.collect()])
    assert abs(z.mean()) < 1e-9 and abs(z.std() - 1) < 1e-9


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                min_size=1, max_size=60),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_property(spark, values, probs):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], probs, collect_rows=5, buckets=4)["x"]
    want = np.quantile(np.array(values), probs)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-6)
