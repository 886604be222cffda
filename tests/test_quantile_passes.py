"""What the passes of the quantile search read and give to a shuffle."""

import numpy as np
import pytest

from fitframe.functions import quantiles
from fitframe.functions.order_stats import OrderStats
from fitframe.operators import collinear


def collected(spark, monkeypatch, run):
    """Results of ``run`` and the number of jobs' plans that explode rows."""
    plans = []

    def watched(self):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return plain(self)
    frame = type(spark.range(1))
    plain = frame.collect
    monkeypatch.setattr(frame, "collect", watched)
    out = run()
    monkeypatch.undo()
    return out, [p for p in plans if "explode" in p]


@pytest.mark.parametrize("kind", ["double", "int", "boolean"])
def test_flags_are_settled_by_the_first_pass(spark, monkeypatch, kind):
    pdf = [(float(i % 10 == 0) if i % 7 else None, float(i % 3 > 0)) for i in range(500)]
    df = spark.createDataFrame(pdf, "a double, b double").selectExpr(f"CAST(a AS {kind}) a", f"CAST(b AS {kind}) b")
    probs = [0.0, 0.25, 1 / 3, 0.5, 0.9, 0.95, 1.0]
    got, exploding = collected(spark, monkeypatch, lambda: quantiles.exact_quantiles(df, ["a", "b"], probs))
    assert not exploding
    for i, c in enumerate("ab"):
        want = np.quantile([r[i] for r in pdf if r[i] is not None], probs)
        assert np.allclose(got[c], want)


@pytest.mark.parametrize("values", [[0.0, 1.0, 0.5], [0.0, 1.0, float("inf")], [0.0, 0.0, 2.0], [1.0, 1.0, 1.0], [-1.0, 0.0, 1.0]])
def test_other_columns_with_zeros_and_ones(spark, values):
    df = spark.createDataFrame([(v,) for v in values * 20], "a double")
    got = quantiles.exact_quantiles(df, ["a"], [0.0, 0.3, 0.5, 0.8, 1.0])["a"]
    s = sorted(values * 20)
    want = [quantiles.interpolate(s[int(p * 59)], s[min(int(p * 59) + 1, 59)], p * 59 - int(p * 59)) for p in (0.0, 0.3, 0.5, 0.8, 1.0)]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("accuracy", [0, 50])
def test_later_passes_read_open_intervals_only(spark, accuracy):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(size=4000), 3), rng.exponential(size=4000) * 1e6
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    probs = [0.01, 0.25, 0.5, 0.51, 0.99]
    got = quantiles.exact_quantiles(df, ["a", "b"], probs, buckets=16, collect_rows=20, accuracy=accuracy)
    assert np.allclose(got["a"], np.quantile(a, probs), rtol=1e-12) and np.allclose(got["b"], np.quantile(b, probs), rtol=1e-12)


def test_collinearity_takes_medians_from_the_order(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 13), float((i * i) % 29), None if i % 5 == 0 else float(i % 7),
                                 float("inf") if i == 3 else float(i % 11)) for i in range(200)], "a double, b double, c double, d double")
    plain = collinear.fit_vif(df)
    order = OrderStats(df)
    order.quantiles(df, ["a"], [0.5])
    known, exploding = collected(spark, monkeypatch, lambda: collinear.fit_vif(df, order=order))
    assert known.selected == plain.selected and known.vif == pytest.approx(plain.vif, rel=1e-12)
    assert all("`d`" in p or "d#" in p for p in exploding)    # only the column with an infinity is searched
