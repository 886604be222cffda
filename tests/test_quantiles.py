import numpy as np
import pytest

from fitframe.functions.quantiles import exact_quantiles

PS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _frame(spark, cols):
    n = len(next(iter(cols.values())))
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*cols.values())]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)), n


@pytest.mark.parametrize("kw", [{}, {"collect_rows": 7, "buckets": 4, "accuracy": 20}])
def test_matches_numpy_with_ties_nulls_and_hot_value(spark, kw):
    rng = np.random.default_rng(1)
    a = rng.normal(size=300).round(2)
    b = np.where(rng.random(300) < 0.34, 5.0, rng.exponential(3, 300))   # a third of rows is one value
    c = [None if i % 7 == 0 else float(i % 13) for i in range(300)]
    df, _ = _frame(spark, {"a": a, "b": b, "c": c})
    q = exact_quantiles(df, ["a", "b", "c"], PS, **kw)
    assert np.allclose(q["a"], np.quantile(a, PS))
    assert np.allclose(q["b"], np.quantile(b, PS))
    cc = np.array([v for v in c if v is not None])
    assert np.allclose(q["c"], np.quantile(cc, PS))


def test_constant_empty_and_nan(spark):
    df = spark.createDataFrame([(1.0, None, float("nan")), (1.0, None, 2.0), (1.0, None, 4.0)],
                               "k double, e double, n double")
    q = exact_quantiles(df, ["k", "e", "n"], [0.25, 0.5])
    assert q["k"] == [1.0, 1.0]
    assert q["e"] == [None, None]
    assert q["n"] == [2.5, 3.0]


def test_interpolation_example(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.25, 0.75])["x"] == [1.75, 5.5]


def test_infinities_wide_ranges_and_nan(spark):
    """+-Infinity take the outer ranks; a range from 5e-324 to 1e308 resolves in a few passes."""
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(size=3000) * 10.0 ** rng.integers(-300, 300, 3000), [5e-324, -5e-324, 1.7e308, -1.7e308, 0.0],
                        [np.inf] * 40, [-np.inf] * 25, [np.nan] * 30])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = exact_quantiles(df, ["x"], [0.0, 0.003, 0.1, 0.25, 0.5, 0.9, 1.0], buckets=64, collect_rows=20, driver_rows=400)["x"]
    s = np.sort(x[~np.isnan(x)])
    for p, g in zip([0.0, 0.003, 0.1, 0.25, 0.5, 0.9, 1.0], got):
        pos = p * (len(s) - 1)
        lo, hi = s[int(np.floor(pos))], s[min(int(np.floor(pos)) + 1, len(s) - 1)]
        assert lo <= g <= hi
    only = spark.createDataFrame([(float("inf"),), (float("nan"),), (None,)], "x double")
    assert exact_quantiles(only, ["x"], [0.5])["x"] == [float("inf")]
