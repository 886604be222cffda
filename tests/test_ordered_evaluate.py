import itertools

import numpy as np
import pandas as pd

from fitframe.functions.ordered import lag_within, running_totals
from fitframe.operators import evaluate


def test_running_totals_split_matches_cumsum(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": np.repeat(["a", "b", "c"], [300, 40, 7]),
                        "k": np.concatenate([rng.permutation(300), rng.permutation(40), rng.permutation(7)]).astype(float),
                        "v": rng.integers(0, 5, 347)})
    df = spark.createDataFrame(pdf)
    for rpb in (10**6, 25):
        out = running_totals(df, "k", ["v"], by=["g"], rows_per_bucket=rpb, with_next_key=True).toPandas()
        exp = pdf.sort_values(["g", "k"]).assign(cum=lambda d: d.groupby("g")["v"].cumsum(),
                                                 nk=lambda d: d.groupby("g")["k"].shift(-1))
        m = out.merge(exp, on=["g", "k"])
        assert (m["cum_v"] == m["cum"]).all()
        assert ((m["next_key"] == m["nk"]) | (m["next_key"].isna() & m["nk"].isna())).all()
    flat = pdf.groupby("k", as_index=False)["v"].sum()            # one row per key, as required
    out = running_totals(spark.createDataFrame(flat), "k", ["v"], rows_per_bucket=30,
                         with_next_key=True).toPandas().sort_values("k")
    assert (out["cum_v"].to_numpy() == flat.sort_values("k")["v"].cumsum().to_numpy()).all()
    nxt = out["next_key"].to_numpy()
    assert np.allclose(nxt[:-1], out["k"].to_numpy()[1:]) and np.isnan(nxt[-1])


def test_lag_within_split_matches_shift(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": np.repeat([1, 2], [200, 30]), "k": np.arange(230), "y": rng.random(230)})
    df = spark.createDataFrame(pdf)
    out = lag_within(df, "k", "y", ["g"], rows_per_bucket=17).toPandas().sort_values("k")
    exp = pdf.groupby("g")["y"].shift(1).to_numpy()
    got = out["prev_y"].to_numpy()
    assert np.allclose(np.nan_to_num(got, nan=-1), np.nan_to_num(exp, nan=-1))


def test_auc_matches_pairwise_brute_force(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 120)
    s = np.round(rng.random(120) + 0.3 * y, 1)      # many ties
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg)])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    auc = evaluate.auc_exact(df, "y", "s", rows_per_bucket=5).first()["auc"]
    assert abs(auc - brute) < 1e-12


def test_confusion_and_regression_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y int, p int")
    m = evaluate.confusion_metrics(df, "y", "p").first()
    assert (m.tp, m.fp, m.fn, m.tn) == (1, 1, 1, 2)
    assert m.precision == 0.5 and m.recall == 0.5 and m.accuracy == 0.6
    z = evaluate.confusion_metrics(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").first()
    assert z.precision == 0.0 and z.f1 == 0.0
    r = evaluate.regression_metrics(spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "y double, p double"),
                                    "y", "p").first()
    assert abs(r.mae - 0.5) < 1e-9 and abs(r.r2 - (1 - 1.25 / 2.0)) < 1e-9


def test_mase_series_and_scale(spark):
    pdf = pd.DataFrame({"s": [1] * 5 + [2] * 4, "t": range(9), "y": [1, 3, 2, 5, 4, 10, 12, 11, 15],
                        "p": [1, 2, 2, 4, 4, 10, 11, 11, 14]})
    df = spark.createDataFrame(pdf)
    got = evaluate.mase(df, "y", "p", order="t", series="s").first()["mase"]
    d = pdf.groupby("s")["y"].diff().abs().dropna().mean()
    assert abs(got - round((pdf.y - pdf.p).abs().mean() / d, 6)) < 1e-9
    assert evaluate.mase(df, "y", "p", order="t", scale=0.0).first()["mase"] is None


def test_lag_is_the_same_on_both_paths_for_every_key_type(spark):
    """Split into key ranges or not, the previous value is the same, whatever the key's type."""
    from pyspark.sql import functions as F
    base = spark.range(300).select((F.col("id") % 2).alias("g"), F.col("id").alias("n"), (F.col("id") * 7 % 31).cast("double").alias("y"))
    keys = {"long": F.col("n"), "double": F.col("n") / 3, "date": F.date_add(F.lit("1960-01-01").cast("date"), F.col("n").cast("int") * 30),
            "timestamp": F.timestamp_seconds(F.col("n") * 86_399 - 10**8), "ntz": F.timestamp_seconds(F.col("n") * 3_601).cast("timestamp_ntz"),
            "string": F.concat(F.lit("k"), F.lpad(F.col("n").cast("string"), 5, "0")), "digits": F.col("n").cast("string")}
    for kind, key in keys.items():
        df = base.withColumn("k", key)
        whole, cut = (sorted((r.n, r.prev_y) for r in lag_within(df, "k", "y", ["g"], rows_per_bucket=b).collect() if r.prev_y is not None)
                      for b in (10**6, 11))
        assert whole == cut and len(whole) == 298, kind
        flat = sorted((r.n, r.prev_y) for r in lag_within(df, "k", "y", rows_per_bucket=17).collect() if r.prev_y is not None)
        assert flat == sorted((r.n, r.prev_y) for r in lag_within(df, "k", "y").collect() if r.prev_y is not None), kind


def test_feature_lists_on_both_sides_of_the_hash_set(spark):
    from fitframe.operators import features
    df = spark.createDataFrame([(i, f"{i}.x" if i % 3 else "bad") for i in range(60)], "id long, p string")
    new = df.unionByName(spark.createDataFrame([(999, "999.zz"), (998, None)], "id long, p string"))
    kw = dict(ratios=[], both_flags=[], collapse={}, equals=[])
    a, b = (features.fit_features(df, ["p"], isin_max=m, **kw).transform(new) for m in (1000, 5))
    assert a.columns == b.columns and sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert {r.id: r.p_ordinal for r in b.collect()}[999] is None
