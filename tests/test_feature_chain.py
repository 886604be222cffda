"""The query ``feature_chain`` runs all steps of Z6."""

import datetime

from fitframe.operators import selection
from fitframe.plans import catalog, pipeline
from fitframe.state import load, write_values

SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def line_items(spark, path, n=200):
    """``n`` line items, 10 of them twice, some with gaps."""
    rows = [(i, i, i, i % 7, None if i % 41 == 5 else float(i % 50 + 1), 100.0 * (i * 37 % 101) + 5, i % 4 / 10, i % 3 / 10, "ANR"[i % 3],
             "OF"[i % 2], None if i % 43 == 7 else datetime.datetime(1996 + i % 6, i % 12 + 1, 3)) for i in range(1, n + 1)]
    spark.createDataFrame(rows + rows[:10], SCHEMA).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_feature_chain_runs_every_step(spark, tmp_path, monkeypatch):
    sf = line_items(spark, tmp_path)
    seen, learned, fits = {}, [], []
    plain, fit = selection.gbt_importance, pipeline.Chain.fit

    def importance(df, target, features, n_trees):
        seen.update(target=target, features=features, n_trees=n_trees, rows=df.count())
        learned.append(plain(df, target, features, n_trees=3))
        return learned[-1]

    def kept(chain, df):
        fits.append(fit(chain, df))
        return fits[-1]
    monkeypatch.setattr(selection, "gbt_importance", importance)
    monkeypatch.setattr(pipeline.Chain, "fit", kept)
    out = catalog.QUERIES["feature_chain"](spark, sf)
    assert [s.name for s, _ in fits[0].steps] == ["clean", "types", "impute", "clip", "engineer", "bin", "rare", "vif", "encode", "scale",
                                                  "importance", "cluster", "select"]
    assert len(pipeline.lead_chain().steps) == len(fits[0].steps)
    assert seen["n_trees"] == 100 and seen["rows"] == 200       # duplicates removed at training, by the clean step
    assert not {"l_orderkey", "l_linenumber", seen["target"]} & set(seen["features"])
    cols = {"price_per_unit", "ship_quarter_ordinal", "free_of_both", "channel_no_tax", "returned"}    # engineered, of typed flags
    assert cols <= set(seen["features"])
    assert set(out.columns) == {r.feature for r in learned[0].collect()} | {"l_orderkey", "l_linenumber", seen["target"], "engagement_cluster"}
    got = out.collect()
    assert len(got) == 210                                      # no row removed at scoring
    assert {r.engagement_cluster for r in got} == {0, 1, 2, 3}
    for r in got:
        i = r.l_orderkey
        assert r.shipped_late == (None if i % 43 == 7 else int(1996 + i % 6 >= 1999))
        assert r.ship_quarter_ordinal == (None if i % 43 == 7 else i % 12 // 3 + 1)
        assert r.free_of_both == float(i % 12 == 0)


def test_typed_columns_outlive_a_save(spark, tmp_path):
    pipeline.TypeState("y", ["a"], ["b"]).save(f"{tmp_path}/new", spark)
    df = spark.createDataFrame([("1.5", "Yes", "1"), ("x", "?", None)], "a string, b string, y string")
    assert [tuple(r) for r in load(spark, f"{tmp_path}/new").transform(df).collect()] == [(1.5, 1, 1), (None, None, None)]
    write_values(spark, f"{tmp_path}/old/_state", "TypeState", {"target": "y"})
    assert load(spark, f"{tmp_path}/old") == pipeline.TypeState("y")
