import os
import tempfile

from fitframe import config
from fitframe.plans.pipeline import lead_chain, score_batch
from fitframe.state import load
from fitframe.operators import impute
from fitframe.streaming.replay import read_stream, score_to_memory
from tests.fixtures import lead_table


def test_lead_chain_fit_and_replay(spark):
    raw = spark.createDataFrame(lead_table())
    chain = lead_chain(key="prospect_i_d", top_k=15, importance_trees=5)
    fitted, out = chain.fit_transform(raw)
    cols = out.columns
    assert config.TARGET in cols and "prospect_i_d" in cols and "engagement_cluster" in cols
    n_train = out.count()
    assert n_train < raw.count()                     # duplicates removed at training
    replay = fitted.transform(raw, track=True)
    assert replay.columns == cols                    # same schema at scoring
    assert replay.count() == raw.count()             # no row removed at scoring
    lin = {r.stage: r for r in fitted.lineage.table(spark).collect()}
    assert lin["1_clean"].rows_after == n_train


def test_state_save_load_roundtrip(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (3.0, "a")], "total_visits double, last_activity string")
    st = impute.fit_impute(df)
    path = tempfile.mkdtemp(prefix="fitframe-state-")
    st.save(os.path.join(path, "imp"))
    again = load(spark, os.path.join(path, "imp"))
    assert again.fills == st.fills
    try:
        load(spark, os.path.join(path, "missing"))
        raise AssertionError
    except FileNotFoundError:
        pass


def test_stream_replay_scores_every_row(spark):
    from fitframe.operators import binning, rare
    from fitframe.plans.pipeline import Chain, Step
    base = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "event_type", "value")
    chain = Chain([Step("bin", lambda d, p: binning.fit_bins(d, {"value": {"strategy": "quantile", "bins": 4,
                                                                           "labels": ["a", "b", "c", "d"]}})),
                   Step("rare", lambda d, p: rare.fit_rare(d, {"event_type": {"threshold": 0.3,
                                                                              "new_name": "Other"}}))],
                  materialize=None)
    fitted = chain.fit(base)
    folder = tempfile.mkdtemp(prefix="fitframe-stream-")
    base.repartition(3).write.mode("overwrite").parquet(folder + "/in")
    stream = read_stream(spark, folder + "/in", base.schema)
    q = score_to_memory(stream, fitted, "scored_events")
    q.awaitTermination(120)
    got = spark.sql("select * from scored_events")
    assert got.count() == base.count()
    assert set(got.columns) == set(fitted.transform(base).columns)


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    q = e.queries()
    o = e.oracle_sql()
    assert set(o) <= set(q)
    assert "prep_chain" in q


def test_score_batch_keeps_every_row_and_formats(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from fitframe.operators.scoring import align_features, preview
    raw = spark.createDataFrame(lead_table(300, seed=3))
    chain = lead_chain(key="prospect_i_d", top_k=12, importance_trees=3)
    fitted, train = chain.fit_transform(raw)
    feats = [f.name for f in train.schema.fields if f.name not in ("converted", "prospect_i_d")
             and f.dataType.simpleString() in ("double", "int", "bigint")]
    labelled = train.where("converted IS NOT NULL").withColumn("label", train["converted"].cast("double"))
    data = VectorAssembler(inputCols=feats, outputCol="features").transform(
        align_features(labelled, feats, keep=["label"]))
    model = LogisticRegression(maxIter=20).fit(data)
    batch = raw.drop("Converted").withColumn("Unknown Extra", raw["City"])
    scored = score_batch(batch, fitted, model, feats, key="prospect_i_d")
    rows = scored.collect()
    assert len(rows) == batch.count()
    assert all(r.conversion_probability.endswith("%") and r.predicted_label in (0, 1) for r in rows)
    head, total = preview(scored, 100)
    assert head.count() == 100 and total.first().total_rows == batch.count()


def test_chain_checkpoint_mode_and_release(spark):
    from fitframe.operators import impute as imp
    from fitframe.plans.pipeline import Chain, Step
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_totalprice")
    for how in ("checkpoint", "cache"):
        chain = Chain([Step("impute", lambda d, p: imp.fit_impute(d, {"o_totalprice": "median"}, {}))],
                      materialize=how)
        fitted, out = chain.fit_transform(df)
        assert out.count() == df.count()
        lin = fitted.lineage.table(spark).first()
        assert lin.rows_before == df.count() and lin.rows_after == df.count()
        fitted.release()
        assert fitted.materialized == []


def test_fitted_chain_survives_a_new_process(spark, tmp_path):
    """Fit and save here, load and score in another Python process."""
    import subprocess
    import sys
    import textwrap

    from fitframe.plans.pipeline import lead_chain
    from tests.fixtures import lead_table
    raw = spark.createDataFrame(lead_table(300))
    chain = lead_chain(importance_trees=3)
    fitted, _ = chain.fit_transform(raw)
    fitted.save(f"{tmp_path}/chain", spark)
    raw.write.parquet(f"{tmp_path}/raw")
    want = fitted.transform(raw)
    code = textwrap.dedent(f"""
        from fitframe.session import build_session
        from fitframe.plans.pipeline import FittedChain, lead_chain
        spark = build_session("local[2]", 4, driver_memory="2g")
        chain = FittedChain.load(spark, "{tmp_path}/chain", lead_chain())
        chain.transform(spark.read.parquet("{tmp_path}/raw")).write.parquet("{tmp_path}/scored")
    """)
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=300)
    got = spark.read.parquet(f"{tmp_path}/scored")
    assert sorted(got.columns) == sorted(want.columns)
    key = "prospect_i_d"
    cols = sorted(want.columns)

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(key, *[c for c in cols if c != key]).collect())
    assert rows(got) == rows(want)
