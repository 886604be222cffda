import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fitframe.functions import cdf_gap
from fitframe.operators import drift


def brute(a, b):
    a, b = (np.array([v for v in x if v is not None and not math.isnan(v)]) for x in (a, b))
    grid = np.union1d(a, b)
    gap = np.abs(np.searchsorted(np.sort(a), grid, side="right") / len(a) - np.searchsorted(np.sort(b), grid, side="right") / len(b))
    with np.errstate(invalid="ignore", over="ignore"):
        step = np.diff(grid)
        return gap.max(), float(np.where(gap[:-1] > 0, gap[:-1] * np.where(gap[:-1] > 0, step, 0), 0).sum())


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def gaps(spark, a, b, **kw):
    return cdf_gap.cdf_gaps(frame(spark, a), frame(spark, b), ["x"], **kw)["x"]


def check(got, want):
    assert got["ks"] == pytest.approx(want[0], abs=1e-12)
    assert got["w1"] == pytest.approx(want[1], rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("kw", [{}, {"segments": 4, "collect_rows": 0}, {"segments": 3, "driver_rows": 12, "collect_rows": 10}, {"segments": 16, "collect_rows": 0, "max_passes": 1}])
def test_equal_to_sorted_values(spark, kw):
    rng = np.random.default_rng(4)
    for a, b in ((rng.normal(size=3000), rng.normal(size=2000) + 0.01), (rng.exponential(size=500) ** 8, rng.exponential(size=700) ** 8),
                 (np.repeat([1.0, 2.0, 5.0], [1000, 3, 40]), np.repeat([1.0, 2.0, 9.0], [900, 50, 1])), ([3.0], [3.0]), ([0.0], [1.0]), ([-0.0, 1.0], [0.0, 1.0])):
        check(gaps(spark, [float(v) for v in a], [float(v) for v in b], **kw), brute(a, b))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(st.sampled_from([-1e9, -3.5, -0.0, 0.0, 1e-300, 1.0, 1.0000000000000002, 7.25, 1e15]) | st.floats(-100, 100), min_size=1, max_size=40),
       b=st.lists(st.sampled_from([-1e9, -3.5, 0.0, 1.0, 7.25, 1e15]) | st.floats(-100, 100), min_size=1, max_size=40))
def test_any_values(spark, a, b):
    check(gaps(spark, a, b, segments=5, collect_rows=0), brute(a, b))


def test_same_values_in_the_same_shares_need_one_pass(spark, monkeypatch):
    made = []
    plain = cdf_gap._dealt
    monkeypatch.setattr(cdf_gap, "_dealt", lambda cells, levels: made.append(len(levels)) or plain(cells, levels))
    values = [float(i % 997) for i in range(5000)]
    assert gaps(spark, values, values + values, segments=16, collect_rows=0) == {"ks": 0.0, "w1": 0.0} and made == [1]


def test_infinities_nulls_and_empty_sides(spark):
    inf = float("inf")
    got = gaps(spark, [-inf, 1.0, 2.0, None, float("nan")], [1.0, 2.0, inf])
    assert got["ks"] == pytest.approx(1 / 3) and got["w1"] == inf
    check(gaps(spark, [-inf, 1.0, 2.0, inf], [-inf, 1.0, 3.0, inf]), (0.25, 0.25))
    assert gaps(spark, [inf, inf], [inf])["ks"] == 0.0 and gaps(spark, [inf], [-inf])["ks"] == 1.0
    assert cdf_gap.cdf_gaps(frame(spark, [None]), frame(spark, [1.0]), ["x"]) == {}
    with np.errstate(all="ignore"):  # the integral is beyond the doubles
        assert gaps(spark, [-1.7e308, 1.7e308], [1.7e308], segments=7)["ks"] == 0.5


def test_shuffled_rows_do_not_follow_the_values(spark):
    """Two columns of distinct values: the groups of a pass are its segments."""
    df = spark.range(60_000).selectExpr("cast(id as double) x", "cast(id * id as double) y")
    cur = spark.range(60_000).selectExpr("cast(id + 5 as double) x", "cast(id * id as double) y")
    got = cdf_gap.cdf_gaps(df, cur, ["x", "y"], segments=64, collect_rows=2000)
    assert got["x"]["ks"] == pytest.approx(5 / 60_000) and got["x"]["w1"] == pytest.approx(5.0) and got["y"] == {"ks": 0.0, "w1": 0.0}


def test_scores_of_several_columns(spark):
    rng = np.random.default_rng(9)
    a = spark.createDataFrame([(float(u), float(v), int(w)) for u, v, w in zip(rng.normal(size=900), rng.normal(size=900), rng.integers(0, 5, 900))], "u double, v double, w int")
    b = a.selectExpr("u + 1 as u", "v", "w % 3 as w")
    got = {r["column"]: r["ks"] for r in drift.ks_numeric(a, b, ["u", "v", "w"]).collect()}
    rows_a, rows_b = a.collect(), b.collect()
    assert got == {c: round(brute([float(r[c]) for r in rows_a], [float(r[c]) for r in rows_b])[0], 6) for c in "uvw"}
    assert drift.wasserstein_numeric(a, b, ["v"], normed=False).first()["wasserstein"] == 0.0
