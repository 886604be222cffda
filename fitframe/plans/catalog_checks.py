"""More registered queries: round trips through files and saved states, steps
that the first catalog leaves out, and missing values given as NaN."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import config
from ..operators import (binning, cleaning, clustering, collinear, drift, encoding, evaluate, features, impute, outliers,
                         profile, scaling, selection, split)
from ..session import ensure_checkpoint_dir
from ..sources import files
from ..sources.tables import table
from ..state import load
from .catalog import _DOC_LABEL_SQL, _GAPS_SQL, VALUE_LABELS, _doc_labels, _drift_sides, _orders_with_gaps, doc_features, query


def _folder(spark, name: str) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- files and saved states (S1, S4, S6, S7, S8, Z1) ---------------------------------

@query("csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_csv_round_trip(spark, sf):
    """S8 then S1: the customers as scored CSV, read back with a schema."""
    c = table(spark, sf, "customer")
    path = _folder(spark, "csv")
    files.write_scored_csv(c, path)
    return files.read_csv(spark, path, c.schema)


@query("table_round_trip", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def q_table_round_trip(spark, sf):
    """A staging copy as Parquet."""
    path = _folder(spark, "stage")
    files.write_table(table(spark, sf, "part"), path)
    return spark.read.parquet(path)


@query("saved_state", f"""
WITH g AS ({_GAPS_SQL}), m AS (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM g),
r AS (SELECT o_orderpriority AS p, count(*) * 1.0 / (SELECT count(*) FROM g) AS share FROM g GROUP BY 1)
SELECT o_orderkey, round(coalesce(o_totalprice, m.m), 6) AS o_totalprice,
       CASE WHEN r.share < 0.2 THEN 'RARE' ELSE o_orderpriority END AS o_orderpriority
FROM g, m, r WHERE r.p IS NOT DISTINCT FROM g.o_orderpriority""")
def q_saved_state(spark, sf):
    """A fitted chain saved, loaded and replayed."""
    from ..operators import rare
    from .pipeline import Chain, FittedChain, Step
    g = _orders_with_gaps(spark, sf).select("o_orderkey", "o_totalprice", "o_orderpriority")
    chain = Chain([Step("impute", lambda d, p: impute.fit_impute(d, {"o_totalprice": "median"}, {})),
                   Step("rare", lambda d, p: rare.fit_rare(d, {"o_orderpriority": {"threshold": 0.2, "new_name": "RARE"}}))])
    path = _folder(spark, "chain")
    chain.fit(g).save(path, spark)
    return FittedChain.load(spark, path, chain).transform(g).withColumn("o_totalprice", F.round("o_totalprice", 6))


@query("score_batch", """
SELECT doc_id, true AS has_label, true AS has_percent, true AS agrees FROM documents""")
def q_score_batch(spark, sf):
    """Features of all documents through a chain and a model fitted on the
    labelled ones, both saved and loaded; every row is scored."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from ..operators import scoring
    from .catalog import DOC_FEATURES, text_features
    from .pipeline import Chain, FittedChain, Step
    chain = Chain([Step("impute", lambda d, p: impute.fit_median_fill(d, DOC_FEATURES)),
                   Step("clip", lambda d, p: outliers.fit_clip(d, DOC_FEATURES)),
                   Step("scale", lambda d, p: scaling.fit_scaler(d, DOC_FEATURES))])
    fitted, prepared = chain.fit_transform(doc_features(spark, sf))
    va = VectorAssembler(inputCols=DOC_FEATURES, outputCol="features")
    model = LogisticRegression(labelCol="quality", maxIter=50).fit(va.transform(prepared))
    path = _folder(spark, "score")
    fitted.save(f"{path}/chain", spark)
    PipelineModel([va, model]).write().overwrite().save(f"{path}/model")
    loaded = PipelineModel.load(f"{path}/model")
    replayed = FittedChain.load(spark, f"{path}/chain", chain).transform(text_features(spark, sf))
    scored = loaded.transform(scoring.align_features(replayed, DOC_FEATURES, keep=["doc_id"]))
    out = scoring.format_scores(scored.select("doc_id", vector_to_array("probability")[1].alias("probability")), "probability")
    p = F.col("probability")
    return out.select("doc_id", F.col("predicted_label").isin(0, 1).alias("has_label"),
                      F.col("conversion_probability").rlike(r"^\d+\.\d\d%$").alias("has_percent"),
                      ((p > 0.5).cast("int") == F.col("predicted_label")).alias("agrees"))


@query("chain_steps", f"""
WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
                  l_linestatus, strftime(l_shipdate, '%b') AS ship_month FROM lineitem),
m AS (SELECT l_returnflag AS v FROM b WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS p1, quantile_cont(l_extendedprice, 0.75) AS p3,
             min(l_quantity) AS e0, quantile_cont(l_quantity, 0.25) AS e1, quantile_cont(l_quantity, 0.5) AS e2, quantile_cont(l_quantity, 0.75) AS e3 FROM b),
r AS (SELECT ship_month AS v, count(*) * 1.0 / (SELECT count(*) FROM b) AS share FROM b GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_quantity, round(least(greatest(l_extendedprice, p1 - 1.5 * (p3 - p1)), p3 + 1.5 * (p3 - p1)), 6) AS l_extendedprice,
       coalesce(l_returnflag, m.v) AS l_returnflag, l_linestatus, CASE WHEN share < 0.08 THEN 'Other' ELSE ship_month END AS ship_month,
       CASE WHEN l_quantity <= e1 THEN '{VALUE_LABELS[0]}' WHEN l_quantity <= e2 THEN '{VALUE_LABELS[1]}' WHEN l_quantity <= e3 THEN '{VALUE_LABELS[2]}'
            ELSE '{VALUE_LABELS[3]}' END AS l_quantity_binned
FROM b, m, q, r WHERE r.v = b.ship_month""")
def q_chain_steps(spark, sf):
    """The deterministic steps of a chain (clean with its low-variance
    drop, mode, clip, bins, rare labels) learned on and replayed over all line
    items."""
    from ..operators import rare
    from .pipeline import Chain, Step
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_orderkey") % 10 == 0, F.lit("Select")).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus", F.date_format("l_shipdate", "MMM").alias("ship_month"))
    chain = Chain([Step("clean", lambda d, p: cleaning.fit_clean(d, static_drop=[], keep_cols=["l_orderkey", "l_linenumber"], name_mode="simple")),
                   Step("impute", lambda d, p: impute.fit_impute(d, {}, {"l_returnflag": {"strategy": "mode"}}, p["order"])),
                   Step("clip", lambda d, p: outliers.fit_clip(d, ["l_extendedprice"], order=p["order"])),
                   Step("bin", lambda d, p: binning.fit_bins(d, {"l_quantity": {"strategy": "quantile", "bins": 4, "labels": VALUE_LABELS}}, p["order"])),
                   Step("rare", lambda d, p: rare.fit_rare(d, {"ship_month": {"threshold": 0.08, "new_name": "Other"}}))])
    return chain.fit(li).transform(li).withColumn("l_extendedprice", F.round("l_extendedprice", 6))


SCORE_WEIGHTS = {"value": 0.8, "user_id": -0.5}
SCORE_BIAS = 0.25


@query("score_probability", f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value, user_id::DOUBLE AS user_id FROM events),
f AS (SELECT event_id, coalesce(value, (SELECT quantile_cont(value, 0.5) FROM e)) AS value, user_id FROM e),
q AS (SELECT quantile_cont(value, 0.25) AS v1, quantile_cont(value, 0.75) AS v3, quantile_cont(user_id, 0.25) AS u1, quantile_cont(user_id, 0.75) AS u3 FROM f),
c AS (SELECT event_id, least(greatest(value, v1 - 1.5 * (v3 - v1)), v3 + 1.5 * (v3 - v1)) AS value,
             least(greatest(user_id, u1 - 1.5 * (u3 - u1)), u3 + 1.5 * (u3 - u1)) AS user_id FROM f, q),
s AS (SELECT avg(value) AS vm, stddev_pop(value) AS vs, avg(user_id) AS um, stddev_pop(user_id) AS us FROM c),
p AS (SELECT event_id, 1 / (1 + exp(-({SCORE_WEIGHTS['value']} * (value - vm) / vs + {SCORE_WEIGHTS['user_id']} * (user_id - um) / us + {SCORE_BIAS}))) AS p FROM c, s)
SELECT event_id, round(p, 6) AS probability, (p > 0.5)::INT AS predicted_label FROM p""")
def q_score_probability(spark, sf):
    """Chain, assembler and a model of given coefficients saved as
    one artefact, loaded, and applied to all raw rows."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.linalg import DenseMatrix, Vectors

    from ..operators import scorer
    from .pipeline import Chain, Step
    names = list(SCORE_WEIGHTS)
    raw = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("value"), F.col("user_id").cast("double").alias("user_id"))
    chain = Chain([Step("impute", lambda d, p: impute.fit_median_fill(d, ["value"], p["order"])),
                   Step("clip", lambda d, p: outliers.fit_clip(d, names, order=p["order"])),
                   Step("scale", lambda d, p: scaling.fit_scaler(d, names))])
    fitted, prepared = chain.fit_transform(raw)
    # equal lower and upper bounds give the model its coefficients
    given = DenseMatrix(1, len(names), list(SCORE_WEIGHTS.values()))
    bias = Vectors.dense([SCORE_BIAS])
    train = VectorAssembler(inputCols=names, outputCol="features").transform(prepared.withColumn("label", (F.col("event_id") % 2).cast("double")))
    model = LogisticRegression(maxIter=1, lowerBoundsOnCoefficients=given, upperBoundsOnCoefficients=given,
                               lowerBoundsOnIntercepts=bias, upperBoundsOnIntercepts=bias).fit(train)
    path = _folder(spark, "scorer")
    scorer.scoring_model(fitted.states(), names, model, ["event_id"]).write().overwrite().save(path)
    out = scorer.score(raw, PipelineModel.load(path), ["event_id"])
    return out.select("event_id", F.round("probability", 6).alias("probability"), "predicted_label")


@query("csv_dialect", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '' WHEN o_orderkey % 7 = 2 THEN 'said "' || o_orderpriority || '", twice'
  WHEN o_orderkey % 7 = 3 THEN o_orderpriority || chr(10) || o_orderstatus WHEN o_orderkey % 7 = 4 THEN '  ' || o_orderstatus || '\\ '
  WHEN o_orderkey % 7 = 5 THEN '"' ELSE o_orderpriority || ',' END AS note, o_totalprice FROM orders""")
def q_csv_dialect(spark, sf):
    """S8 then S1 on texts with quotes, commas, line breaks, blanks, empty
    texts and nulls."""
    k, p, s = F.col("o_orderkey") % 7, F.col("o_orderpriority"), F.col("o_orderstatus")
    note = (F.when(k == 0, F.lit(None)).when(k == 1, F.lit("")).when(k == 2, F.concat(F.lit('said "'), p, F.lit('", twice')))
            .when(k == 3, F.concat(p, F.lit("\n"), s)).when(k == 4, F.concat(F.lit("  "), s, F.lit("\\ "))).when(k == 5, F.lit('"'))
            .otherwise(F.concat(p, F.lit(","))))
    o = table(spark, sf, "orders").select("o_orderkey", note.alias("note"), "o_totalprice")
    path = _folder(spark, "csv")
    files.write_scored_csv(o, path)
    return files.read_csv(spark, path, o.schema)


# ---- cleaning (C1, C3, C6, C10, D1, E3, G3, G5) ---------------------------------------

@query("standard_names", """
SELECT c_custkey AS cust_key, c_name AS customer_full_name, c_acctbal AS a_b_c_balance, c_mktsegment AS segment_2 FROM customer""")
def q_standard_names(spark, sf):
    """Raw names to standard ones, every capital beginning a word."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("CustKey"), F.col("c_name").alias("Customer  full-Name"),
                                            F.col("c_acctbal").alias("ABC_Balance!"), F.col("c_mktsegment").alias("_segment 2_"))
    return cleaning.fit_clean(c, drop_high_missing=False, dynamic_var_drop=False, static_drop=[]).transform(c)


@query("static_drop", "SELECT c_custkey, c_acctbal FROM customer")
def q_static_drop(spark, sf):
    """Columns of the static lists go, whatever they hold."""
    c = table(spark, sf, "customer")
    raw = c.select("c_custkey", F.col("c_name").alias("Prospect ID"), F.col("c_nationkey").alias("Lead Number"), "c_acctbal",
                   F.col("c_mktsegment").alias("Magazine"), F.lit("x").alias("Asymmetrique Activity Index"))
    return cleaning.fit_clean(raw, dynamic_var_drop=False, name_mode="simple").transform(raw)


@query("keep_cols", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus, o_orderdate, 1 AS constant_flag FROM
(""" + _GAPS_SQL + ")")
def q_keep_cols(spark, sf):
    """A mostly missing and a constant column stay when they are kept by name."""
    g = _orders_with_gaps(spark, sf).withColumn("constant_flag", F.lit(1))
    st = cleaning.fit_clean(g, static_drop=[], keep_cols=["o_orderdate", "constant_flag"], name_mode="simple", placeholders=[])
    return st.transform(g)


@query("clean_ordinal", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 ELSE NULL END AS o_orderpriority FROM orders""")
def q_clean_ordinal(spark, sf):
    """An ordinal map applied by the cleaning state."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    st = cleaning.fit_clean(o, False, False, static_drop=[], name_mode="simple",
                            ordinal_maps={"o_orderpriority": {"1-URGENT": 2, "2-HIGH": 1}})
    return st.transform(o)


@query("drop_null_target", f"""
SELECT o_orderkey, o_totalprice::INT AS o_totalprice FROM (SELECT o_orderkey, floor(o_totalprice) AS o_totalprice FROM ({_GAPS_SQL}))
WHERE o_totalprice IS NOT NULL""")
def q_drop_null_target(spark, sf):
    """Rows with a target, as an integer."""
    g = _orders_with_gaps(spark, sf).select("o_orderkey", F.floor("o_totalprice").alias("o_totalprice"))
    return split.drop_null_target(g, "o_totalprice")


@query("numeric_outputs", """
SELECT event_id, try_cast(substr(props, 7, length(props) - 7) AS DOUBLE) AS k, try_cast(event_type AS DOUBLE) AS event_type, value FROM events""")
def q_numeric_outputs(spark, sf):
    """Text outputs as numbers where they parse."""
    e = table(spark, sf, "events").select("event_id", F.expr("substr(props, 7, length(props) - 7)").alias("k"), "event_type", "value")
    return encoding.to_numeric(e)


@query("median_fill", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
                  CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id::DOUBLE END AS user_id FROM events)
SELECT event_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM e)), 6) AS value,
       round(coalesce(user_id, (SELECT quantile_cont(user_id, 0.5) FROM e)), 6) AS user_id FROM e""")
def q_median_fill(spark, sf):
    """Every numeric column filled with its median; gaps given as NaN and NULL."""
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("user_id").cast("double")).alias("user_id"))
    out = impute.fit_median_fill(e, ["value", "user_id"]).transform(e)
    return out.select("event_id", F.round("value", 6).alias("value"), F.round("user_id", 6).alias("user_id"))


@query("add_missing", "SELECT n_nationkey, n_name, n_regionkey, 0.5::DOUBLE AS weight, NULL::DOUBLE AS other FROM nation")
def q_add_missing(spark, sf):
    """Expected columns that are absent."""
    n = table(spark, sf, "nation")
    return cleaning.add_missing(cleaning.add_missing(n, ["n_name", "weight"], 0.5), ["other"])


@query("impute_mean_constant", f"""
WITH g AS ({_GAPS_SQL})
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM g)), 4) AS o_totalprice,
       CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE o_custkey END::DOUBLE AS o_custkey, coalesce(o_orderstatus, 'none') AS o_orderstatus FROM g""")
def q_impute_mean_constant(spark, sf):
    """I1 mean (a gap given as NaN) and constant, I2 constant text."""
    g = _orders_with_gaps(spark, sf).select(
        "o_orderkey", F.coalesce("o_totalprice", F.lit(float("nan"))).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("o_custkey").cast("double")).alias("o_custkey"), "o_orderstatus")
    st = impute.fit_impute(g, {"o_totalprice": "mean", "o_custkey": "constant"}, {"o_orderstatus": {"strategy": "constant", "fill_value": "none"}})
    return st.transform(g).withColumn("o_totalprice", F.round("o_totalprice", 4))


# ---- missing values given as NaN (O1, O2, B2, X2-X4, P2, P5, M4, Q2) -------------------

_NAN_SQL = "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events"


def _nan_events(spark, sf):
    return table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, F.lit(float("nan")))
                                             .otherwise(F.col("value")).alias("value"))


@query("nan_clip", f"""
WITH e AS ({_NAN_SQL}), q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM e)
SELECT event_id, round(CASE WHEN value IS NOT NULL THEN least(greatest(value, a - 1.5 * (b - a)), b + 1.5 * (b - a)) END, 6) AS value FROM e, q""")
def q_nan_clip(spark, sf):
    e = _nan_events(spark, sf)
    return outliers.clip_outliers(e, exclude=["event_id"]).withColumn("value", F.round("value", 6))


@query("nan_scale", f"""
WITH e AS ({_NAN_SQL}), s AS (SELECT avg(value) AS m, stddev_pop(value) AS d, min(value) AS lo, max(value) - min(value) AS r,
  quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM e)
SELECT event_id, round((value - m) / d, 6) AS standard, round((value - med) / iqr, 6) AS robust, round((value - lo) / r, 6) AS minmax FROM e, s""")
def q_nan_scale(spark, sf):
    e = _nan_events(spark, sf).select("event_id", F.col("value").alias("standard"), F.col("value").alias("robust"), F.col("value").alias("minmax"))
    out = scaling.fit_scaler(e, ["standard"], ["robust"], ["minmax"]).transform(e)
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in ("standard", "robust", "minmax")])


@query("nan_bins", f"""
WITH e AS (SELECT event_id, coalesce(value, 0) AS v FROM ({_NAN_SQL})), s AS (SELECT min(v) AS lo, max(v) AS hi FROM e)
SELECT event_id, CASE WHEN v <= (hi - lo) / 2 + lo THEN 'low' ELSE 'high' END AS value_binned FROM e, s""")
def q_nan_bins(spark, sf):
    e = _nan_events(spark, sf)
    cfg = {"value": {"strategy": "uniform", "bins": 2, "labels": ["low", "high"]}}
    return binning.apply_binning(e, cfg).select("event_id", "value_binned")


@query("nan_describe", f"""
WITH e AS ({_NAN_SQL})
SELECT 'value' AS "column", count(value) AS "count", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS "min",
  round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS "max" FROM e""")
def q_nan_describe(spark, sf):
    return profile.describe_numeric(_nan_events(spark, sf), ["value"])


@query("nan_missing", f"""
SELECT 'value' AS "column", sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing_count,
  round(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS missing_pct FROM ({_NAN_SQL})""")
def q_nan_missing(spark, sf):
    return profile.missing_report(_nan_events(spark, sf))


@query("auc_one_class", "SELECT NULL::DOUBLE AS auc")
def q_auc_one_class(spark, sf):
    """M4: without negatives there is no AUC."""
    return evaluate.auc_exact(_doc_labels(spark, sf).where("quality = 1"), "quality", "n_chars")


@query("text_class_report", f"""
WITH j AS (SELECT CASE quality WHEN 1 THEN 'good' ELSE 'bad' END AS y, CASE pred WHEN 1 THEN 'good' ELSE 'bad' END AS p FROM ({_DOC_LABEL_SQL})),
a AS (SELECT cls, sum(t) AS support, sum(t * hit) AS tp, sum(1 - t) AS predicted FROM (
  SELECT y AS cls, 1 AS t, (p = y)::INT AS hit FROM j UNION ALL SELECT p, 0, (p = y)::INT FROM j) GROUP BY cls)
SELECT cls, round(tp * 1.0 / predicted, 6) AS precision, round(tp * 1.0 / support, 6) AS recall,
  round(2.0 * tp / (predicted + support), 6) AS f1, support::BIGINT AS support FROM a""")
def q_text_class_report(spark, sf):
    """M4: classes given as text."""
    j = _doc_labels(spark, sf).select(*[F.when(F.col(c) == 1, "good").otherwise("bad").alias(n) for c, n in (("quality", "y"), ("pred", "p"))])
    return evaluate.class_report(j, "y", "p")


@query("drift_empty_side", """
SELECT 'o_totalprice' AS "column", 'num' AS kind, 'wasserstein' AS method, NULL::DOUBLE AS score, 'one_side_empty' AS status
UNION ALL SELECT 'o_orderpriority', 'cat', 'js', NULL, 'empty' FROM (SELECT count(*) FROM orders)""")
def q_drift_empty_side(spark, sf):
    """Q2: a column without values on one side, one without any on both."""
    ref, cur = _drift_sides(spark, sf)
    none = F.lit(None).cast("string")
    ref = ref.select("o_totalprice", none.alias("o_orderpriority"))
    cur = cur.select(F.lit(float("nan")).alias("o_totalprice"), none.alias("o_orderpriority"))
    return drift.drift_scores(ref, cur)


@query("drift_profile", """
SELECT CASE WHEN year(o_orderdate) < 1999 THEN 'reference' ELSE 'current' END AS side, 'o_totalprice' AS "column",
  count(o_totalprice) AS "count", round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std, round(min(o_totalprice), 6) AS "min",
  round(quantile_cont(o_totalprice, 0.25), 6) AS p25, round(quantile_cont(o_totalprice, 0.5), 6) AS p50,
  round(quantile_cont(o_totalprice, 0.75), 6) AS p75, round(max(o_totalprice), 6) AS "max" FROM orders GROUP BY 1""")
def q_drift_profile(spark, sf):
    """Q4: numeric profile of both sides."""
    return drift.side_profile(*_drift_sides(spark, sf))["numeric"]


# ---- scaling, encoding, collinearity, clusters (X5, X6, E1, V2, V3, K2) ----------------

@query("scale_router", """
WITH s AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS r FROM events)
SELECT round((value - m) / r, 6) AS value, event_id, user_id FROM events, s""")
def q_scale_router(spark, sf):
    """The one skewed column goes to the robust scaler, others stay."""
    e = table(spark, sf, "events").select("event_id", "user_id", "value")
    return scaling.fit_scaler(e, skewed_to_robust=True).transform(e).withColumn("value", F.round("value", 6))


@query("scale_inverse", "SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity, round(l_extendedprice, 4) AS l_extendedprice FROM lineitem")
def q_scale_inverse(spark, sf):
    """Scaling undone from the saved state."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    path = _folder(spark, "scale")
    scaling.fit_scaler(li, ["l_quantity"], ["l_extendedprice"]).save(path, spark)
    st = load(spark, path)
    back = st.inverse(st.transform(li))
    return back.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"), F.round("l_extendedprice", 4).alias("l_extendedprice"))


@query("one_hot_sparse", """
WITH r AS (SELECT user_id, dense_rank() OVER (ORDER BY CAST(user_id AS VARCHAR)) - 2 AS i FROM (SELECT DISTINCT user_id FROM events))
SELECT event_id, CASE WHEN i >= 0 THEN i END AS user_id_index, (SELECT count(*) - 1 FROM r) AS user_id_size FROM events e JOIN r ON e.user_id = r.user_id""")
def q_one_hot_sparse(spark, sf):
    """A column of many categories in the sparse form."""
    e = table(spark, sf, "events").select("event_id", "user_id")
    return encoding.fit_one_hot_index(e, ["user_id"]).transform(e)


@query("vif_greedy", """
WITH x AS (SELECT l_quantity AS a, l_extendedprice AS b, l_quantity * 3 + l_tax AS c FROM lineitem),
g AS (SELECT sum(a*a) AS aa, sum(a*b) AS ab, sum(a*c) AS ac, sum(b*b) AS bb, sum(b*c) AS bc, sum(c*c) AS cc FROM x),
v AS (SELECT aa, ab, bb, ac, bc, cc, aa*(bb*cc - bc*bc) - ab*(ab*cc - ac*bc) + ac*(ab*bc - bb*ac) AS det FROM g),
f AS (SELECT aa * (bb*cc - bc*bc) / det AS va, cc * (aa*bb - ab*ab) / det AS vc, aa*bb / (aa*bb - ab*ab) AS v2a, cc*bb / (cc*bb - bc*bc) AS v2c FROM v)
SELECT 'a' AS feature, vc >= va AS kept FROM f UNION ALL SELECT 'b', true FROM f UNION ALL SELECT 'c', vc < va FROM f""")
def q_vif_greedy(spark, sf):
    """V2 and V3: of two columns that nearly repeat each other the one with the larger factor goes."""
    x = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("a"), F.col("l_extendedprice").alias("b"), (F.col("l_quantity") * 3 + F.col("l_tax")).alias("c"))
    st = collinear.fit_vif(x, threshold=100.0)
    kept = set(st.transform(x).columns)
    return x.sparkSession.createDataFrame([(c, c in kept) for c in x.columns], "feature string, kept boolean")


@query("cluster_inertia", """
SELECT count(*) AS n_docs, true AS inertia_agrees, true AS nearest FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_cluster_inertia(spark, sf):
    """K2: the model's inertia against the one of the assignments, and every
    row in the cluster of its nearest centre."""
    df = doc_features(spark, sf)
    m = clustering.fit_clusters(df, ["n_chars", "n_words", "n_lines"])
    centers = [list(map(float, c)) for c in m.model.clusterCenters()]
    scaled = list(m.scaled().values())

    def far(c):
        total = F.lit(0.0)
        for x, v in zip(scaled, c):
            total = total + (x - F.lit(v)) * (x - F.lit(v))
        return total
    rows = m.transform(df).withColumn("_far", F.array(*[far(c) for c in centers]))
    own = F.get("_far", F.col(m.label))
    agg = rows.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(own).alias("s"), F.min((own <= F.array_min("_far") + 1e-9).cast("int")).alias("near"))
    return agg.select("n_docs", (F.abs(F.col("s") - F.lit(m.inertia())) <= 1e-6 * (F.lit(m.inertia()) + 1)).alias("inertia_agrees"),
                      (F.col("near") == 1).alias("nearest"))


# ---- models by what must hold (L3-L5, D2) ----------------------------------------------

@query("importance_invariants", """
SELECT 6::BIGINT AS n_features, true AS not_negative, true AS sums_to_one FROM (SELECT count(*) FROM labels)""")
def q_importance_invariants(spark, sf):
    """L3 / L4: forest importances are shares."""
    from .catalog import DOC_FEATURES
    imp = selection.rf_importance(doc_features(spark, sf), "quality", DOC_FEATURES, k=len(DOC_FEATURES))
    return imp.agg(F.count(F.lit(1)).alias("n_features"), (F.min("importance") >= 0).alias("not_negative"),
                   (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"))


@query("column_permutation", f"""
WITH h AS (SELECT l.doc_id, d.n_chars, row_number() OVER (ORDER BY md5(l.doc_id || '|rank|{config.SEED}')) AS r, count(*) OVER () AS n
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT a.doc_id, b.n_chars FROM h a JOIN h b ON b.r = (a.r - 1 + a.n - 7) % a.n + 1""")
def q_column_permutation(spark, sf):
    """A column moved by 7 ranks in the order of the hashed keys; every row
    takes the value of another."""
    d = _doc_labels(spark, sf).select("doc_id", "n_chars")
    ranked = selection.hash_ranked(d, ["doc_id"])
    n = d.count()
    return selection.permuted(ranked, "n_chars", n, n - 7).select("doc_id", "n_chars")


@query("fold_sizes", f"""
WITH h AS (SELECT quality, ('0x' || substr(md5(doc_id || '|cv|{config.SEED}'), 1, 13))::BIGINT / {2.0 ** 52} AS u FROM labels),
c AS (SELECT quality, quantile_cont(u, 1.0 / 3) AS a, quantile_cont(u, 2.0 / 3) AS b FROM h GROUP BY quality)
SELECT h.quality, (u > a)::INT + (u > b)::INT AS fold, count(*) AS n FROM h JOIN c ON h.quality = c.quality GROUP BY ALL""")
def q_fold_sizes(spark, sf):
    """Stratified folds."""
    lab = table(spark, sf, "labels")
    return split.fold_column(lab, ["doc_id"], 3, "quality").groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("feature_table", """
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, 0) / CASE WHEN l_discount = 0 THEN 1 ELSE l_discount END AS quantity_per_discount,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned, try_cast(split_part(l_linestatus || '.x', '.', 1) AS INT)::DOUBLE AS st_ordinal
FROM lineitem""")
def q_feature_table(spark, sf):
    """F1-F5 in one state, saved and loaded; no value of ``st`` parses, so F1
    leaves the column out and the query adds it as NULL."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
                                             F.concat("l_linestatus", F.lit(".x")).alias("st"))
    path = _folder(spark, "features")
    features.fit_features(li, ["st"], ratios=[["quantity_per_discount", "l_quantity", "l_discount"]], both_flags=[], collapse={},
                          equals=[["is_returned", "l_returnflag", "R"]]).save(path, spark)
    out = cleaning.add_missing(load(spark, path).transform(li), ["st_ordinal"])
    return out.select("l_orderkey", "l_linenumber", "quantity_per_discount", "is_returned", "st_ordinal")
