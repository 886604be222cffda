"""Registered queries: each runs the library's operators over whole tables of
a scale-factor folder, and most have a DuckDB SQL counterpart computing the
same result (same column names) for the correctness gate.

Derived NULLs and duplicates are made the same way on both sides
(``nullif``, ``CASE WHEN key % 10 = 0 THEN NULL``, ``UNION ALL``) because the
tables hold none.  Computed doubles are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..operators import binning, cleaning, impute, outliers, profile, rare
from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


PRICE_LABELS = ["Low_Value", "Medium_Value", "High_Value", "Very_High_Value"]
ORDER_PLACEHOLDERS = list(config.PLACEHOLDERS) + ["4-NOT SPECIFIED"]


# ---------------------------------------------------------------------------
# flagship: orders x customer x nation -> C8 -> I1/I2 -> O1/O2 -> B1/B3 -> R1/R2
# -> per-bin summary
# ---------------------------------------------------------------------------

def prep_chain_input(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    base = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select("o_orderkey",
                    F.when(F.col("o_orderkey") % 10 == 0, F.lit(None))
                    .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                    "o_orderpriority", "c_acctbal", "c_mktsegment", "n_name"))
    return base.select(*[exprs.placeholder_to_null(c, ORDER_PLACEHOLDERS).alias(c)
                         if c == "o_orderpriority" else F.col(c) for c in base.columns])


@query("prep_chain", f"""
WITH base AS (
  SELECT o.o_orderkey,
         CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE o.o_totalprice END AS o_totalprice,
         CASE WHEN o.o_orderpriority IN ({_sql_list(ORDER_PLACEHOLDERS)}) THEN NULL
              ELSE o.o_orderpriority END AS o_orderpriority,
         c.c_acctbal, c.c_mktsegment, n.n_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
med AS (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM base),
mode_p AS (SELECT o_orderpriority AS m FROM base WHERE o_orderpriority IS NOT NULL
           GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1),
imp AS (SELECT o_orderkey, coalesce(o_totalprice, (SELECT m FROM med)) AS o_totalprice,
               coalesce(o_orderpriority, (SELECT m FROM mode_p)) AS o_orderpriority,
               c_acctbal, c_mktsegment, n_name FROM base),
qb AS (SELECT quantile_cont(o_totalprice, 0.25) AS p1, quantile_cont(o_totalprice, 0.75) AS p3,
              quantile_cont(c_acctbal, 0.25) AS a1, quantile_cont(c_acctbal, 0.75) AS a3 FROM imp),
clipped AS (
  SELECT imp.o_orderkey, imp.o_orderpriority, imp.c_mktsegment, imp.n_name,
    least(greatest(o_totalprice, p1 - 1.5 * (p3 - p1)), p3 + 1.5 * (p3 - p1)) AS o_totalprice,
    least(greatest(c_acctbal, a1 - 1.5 * (a3 - a1)), a3 + 1.5 * (a3 - a1)) AS c_acctbal
  FROM imp, qb),
edges AS (SELECT quantile_cont(coalesce(o_totalprice, 0), 0.0) AS e0,
                 quantile_cont(coalesce(o_totalprice, 0), 0.25) AS e1,
                 quantile_cont(coalesce(o_totalprice, 0), 0.5) AS e2,
                 quantile_cont(coalesce(o_totalprice, 0), 0.75) AS e3,
                 quantile_cont(coalesce(o_totalprice, 0), 1.0) AS e4 FROM clipped),
binned AS (
  SELECT clipped.*, CASE
      WHEN coalesce(o_totalprice, 0) < e0 THEN 'Unknown'
      WHEN coalesce(o_totalprice, 0) <= e1 THEN '{PRICE_LABELS[0]}'
      WHEN coalesce(o_totalprice, 0) <= e2 THEN '{PRICE_LABELS[1]}'
      WHEN coalesce(o_totalprice, 0) <= e3 THEN '{PRICE_LABELS[2]}'
      WHEN coalesce(o_totalprice, 0) <= e4 THEN '{PRICE_LABELS[3]}'
      ELSE 'Unknown' END AS o_totalprice_binned
  FROM clipped, edges),
shares AS (SELECT n_name, count(*) * 1.0 / (SELECT count(*) FROM binned) AS share
           FROM binned GROUP BY n_name),
relabeled AS (
  SELECT b.*, CASE WHEN s.share < 0.035 THEN 'OTHER' ELSE b.n_name END AS nation
  FROM binned b JOIN shares s ON b.n_name = s.n_name)
SELECT o_totalprice_binned, o_orderpriority, nation,
       count(*) AS n_orders,
       round(avg(o_totalprice), 6) AS avg_totalprice,
       round(avg(c_acctbal), 6) AS avg_acctbal,
       round(min(o_totalprice), 6) AS min_totalprice,
       round(max(o_totalprice), 6) AS max_totalprice
FROM relabeled GROUP BY o_totalprice_binned, o_orderpriority, nation
""")
def q_prep_chain(spark: SparkSession, sf: str) -> DataFrame:
    from .pipeline import Chain, Step
    chain = Chain([
        Step("impute", lambda d, p: impute.fit_impute(d, {"o_totalprice": "median"},
                                                      {"o_orderpriority": {"strategy": "mode"}}, p["order"])),
        Step("clip", lambda d, p: outliers.fit_clip(d, ["o_totalprice", "c_acctbal"], order=p["order"])),
        Step("bin", lambda d, p: binning.fit_bins(d, {"o_totalprice": {
            "strategy": "quantile", "bins": 4, "labels": PRICE_LABELS}}, p["order"])),
        Step("rare", lambda d, p: rare.fit_rare(d, {"n_name": {"threshold": 0.035, "new_name": "OTHER"}})),
    ])
    _, relabeled = chain.fit_transform(prep_chain_input(spark, sf))
    return (relabeled.groupBy("o_totalprice_binned", "o_orderpriority", F.col("n_name").alias("nation"))
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.round(F.avg("o_totalprice"), 6).alias("avg_totalprice"),
                 F.round(F.avg("c_acctbal"), 6).alias("avg_acctbal"),
                 F.round(F.min("o_totalprice"), 6).alias("min_totalprice"),
                 F.round(F.max("o_totalprice"), 6).alias("max_totalprice")))


# ---------------------------------------------------------------------------
# Cleaning and typing
# ---------------------------------------------------------------------------

@query("placeholder_null", f"""
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ({_sql_list(ORDER_PLACEHOLDERS)}) THEN NULL ELSE o_orderpriority END
         AS o_orderpriority,
       CASE WHEN o_orderstatus IN ({_sql_list(ORDER_PLACEHOLDERS)}) THEN NULL ELSE o_orderstatus END
         AS o_orderstatus
FROM orders""")
def q_placeholder_null(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    st = cleaning.CleanState(o.columns, o.columns, [], [], o.columns, ORDER_PLACEHOLDERS, {}, "simple")
    return st.transform(o)


def _orders_with_gaps(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 5 < 3, F.lit(None)).otherwise(F.col("o_orderdate")).alias("o_orderdate"))


_GAPS_SQL = """
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 5 < 3 THEN NULL ELSE o_orderdate END AS o_orderdate
  FROM orders"""


@query("high_missing_report", f"""
WITH g AS ({_GAPS_SQL}),
m AS (SELECT count(*) AS n,
        sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS m_o_orderkey,
        sum(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS m_o_custkey,
        sum(CASE WHEN o_totalprice IS NULL THEN 1 ELSE 0 END) AS m_o_totalprice,
        sum(CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 0 END) AS m_o_orderpriority,
        sum(CASE WHEN o_orderstatus IS NULL THEN 1 ELSE 0 END) AS m_o_orderstatus,
        sum(CASE WHEN o_orderdate IS NULL THEN 1 ELSE 0 END) AS m_o_orderdate FROM g),
l AS (
  SELECT 'o_orderkey' AS column_name, m_o_orderkey AS missing_count, n FROM m UNION ALL
  SELECT 'o_custkey', m_o_custkey, n FROM m UNION ALL
  SELECT 'o_totalprice', m_o_totalprice, n FROM m UNION ALL
  SELECT 'o_orderpriority', m_o_orderpriority, n FROM m UNION ALL
  SELECT 'o_orderstatus', m_o_orderstatus, n FROM m UNION ALL
  SELECT 'o_orderdate', m_o_orderdate, n FROM m)
SELECT column_name, missing_count::BIGINT AS missing_count, round(missing_count * 100.0 / n, 6) AS missing_pct,
       missing_count * 1.0 / n > 0.5 AS dropped
FROM l WHERE missing_count > 0""")
def q_high_missing_report(spark, sf):
    g = _orders_with_gaps(spark, sf)
    st = cleaning.fit_clean(g, drop_high_missing=True, dynamic_var_drop=False, static_drop=[],
                            name_mode="simple")
    rep = profile.missing_report(g)
    dropped = F.col("column").isin(st.dropped_columns) if st.dropped_columns else F.lit(False)
    return rep.select(F.col("column").alias("column_name"), "missing_count", "missing_pct",
                      dropped.alias("dropped"))


@query("low_variance_report", """
SELECT column_name, round(v, 6) AS var_samp, v < 0.01 AS dropped FROM (
  SELECT 'l_quantity' AS column_name, var_samp(l_quantity) AS v FROM lineitem UNION ALL
  SELECT 'l_extendedprice', var_samp(l_extendedprice) FROM lineitem UNION ALL
  SELECT 'l_discount', var_samp(l_discount) FROM lineitem UNION ALL
  SELECT 'l_tax', var_samp(l_tax) FROM lineitem UNION ALL
  SELECT 'l_linenumber', var_samp(l_linenumber) FROM lineitem)""")
def q_low_variance_report(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                              "l_linenumber")
    st = cleaning.fit_clean(li, drop_high_missing=False, dynamic_var_drop=True, static_drop=[],
                            name_mode="simple")
    aggs = li.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in li.columns])
    long = aggs.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in li.columns])).alias("s"))
    return long.select("s.column_name", F.round("s.v", 6).alias("var_samp"),
                       F.col("s.column_name").isin(st.dropped_columns or ["\u0000"]).alias("dropped"))


@query("dedup", """
SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 4 = 0)""")
def q_dedup(spark, sf):
    o = table(spark, sf, "orders")
    doubled = o.unionByName(o.where(F.col("o_orderkey") % 4 == 0))
    st = cleaning.CleanState(o.columns, o.columns, [], [], o.columns, [], {}, "simple")
    return st.transform(doubled, dedup=True)


PRIORITY_ORDINAL = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}


@query("ordinal_map", """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2
            WHEN '4-NOT SPECIFIED' THEN 1 ELSE NULL END AS o_orderpriority
FROM orders""")
def q_ordinal_map(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return cleaning.convert_types(o, numeric=[], binary=[], ordinal={"o_orderpriority": PRIORITY_ORDINAL})


@query("numeric_coerce", """
SELECT event_id,
       try_cast(substr(props, 7, length(props) - 7) AS DOUBLE) AS k_value,
       try_cast(event_type AS DOUBLE) AS event_type_num
FROM events""")
def q_numeric_coerce(spark, sf):
    e = table(spark, sf, "events")
    raw = e.select("event_id",
                   F.expr("substr(props, 7, length(props) - 7)").alias("k_value"),
                   F.col("event_type").alias("event_type_num"))
    return cleaning.convert_types(raw, numeric=["k_value", "event_type_num"], binary=[], ordinal={})


@query("yes_no_flags", """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 ELSE NULL END AS l_returnflag,
       CASE l_linestatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE NULL END AS l_linestatus
FROM lineitem""")
def q_yes_no_flags(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    a = cleaning.convert_types(li, numeric=[], binary=["l_returnflag"], ordinal={},
                               yes_no={"R": 1, "N": 0})
    return cleaning.convert_types(a, numeric=[], binary=["l_linestatus"], ordinal={},
                                  yes_no={"F": 1, "O": 0})


@query("leak_and_names", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def q_leak_and_names(spark, sf):
    o = table(spark, sf, "orders")
    renamed = o.select(*[F.col(c).alias(n) for c, n in zip(
        o.columns, ["O OrderKey", "O-CustKey", "o orderstatus", "o_totalprice", "O OrderDate",
                    "o orderpriority"])])
    tagged = renamed.select("*", F.lit(1).alias("Convert Flag"), F.lit(0).alias("target_copy"))
    st = cleaning.fit_clean(tagged, drop_high_missing=False, dynamic_var_drop=False,
                            static_drop=[], name_mode="simple")
    return st.transform(tagged)


# ---------------------------------------------------------------------------
# Imputation and outliers
# ---------------------------------------------------------------------------

@query("impute_median_mode", f"""
WITH g AS ({_GAPS_SQL}),
med AS (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM g),
mode_p AS (SELECT o_orderpriority AS m FROM g WHERE o_orderpriority IS NOT NULL
           GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT m FROM med)), 6) AS o_totalprice,
       coalesce(o_orderpriority, (SELECT m FROM mode_p)) AS o_orderpriority,
       coalesce(o_orderstatus, 'Missing') AS o_orderstatus
FROM g""")
def q_impute_median_mode(spark, sf):
    g = _orders_with_gaps(spark, sf).select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    st = impute.fit_impute(g, {"o_totalprice": "median"},
                           {"o_orderpriority": {"strategy": "mode"}, "o_orderstatus": {"strategy": "constant"}})
    out = st.transform(g)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"),
                      "o_orderpriority", "o_orderstatus")


@query("iqr_clip", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, round(least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6) AS value
FROM events, q""")
def q_iqr_clip(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    out = outliers.fit_clip(e, ["value"]).transform(e)
    return out.select("event_id", F.round("value", 6).alias("value"))


@query("log_clip", """
WITH l AS (SELECT doc_id, ln(1 + greatest(n_chars, 0)) AS x FROM documents),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM l)
SELECT doc_id, round(least(greatest(x, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6) AS n_chars,
       round(exp(least(greatest(x, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))) - 1, 4) AS n_chars_restored
FROM l, q""")
def q_log_clip(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    st = outliers.fit_clip(d, ["n_chars"], log_columns=["n_chars"])
    out = st.transform(d)
    back = outliers.inverse_log(out.select("doc_id", "n_chars", F.col("n_chars").alias("n_chars_restored")),
                                ["n_chars_restored"])
    return back.select("doc_id", F.round("n_chars", 6).alias("n_chars"),
                       F.round("n_chars_restored", 4).alias("n_chars_restored"))


# ---------------------------------------------------------------------------
# Binning and rare labels
# ---------------------------------------------------------------------------

VALUE_LABELS = ["Low", "Medium", "High", "Very_High"]


@query("quantile_bin", f"""
WITH e AS (SELECT quantile_cont(coalesce(value, 0), 0.0) AS e0, quantile_cont(coalesce(value, 0), 0.25) AS e1,
                  quantile_cont(coalesce(value, 0), 0.5) AS e2, quantile_cont(coalesce(value, 0), 0.75) AS e3,
                  quantile_cont(coalesce(value, 0), 1.0) AS e4 FROM events)
SELECT event_id, CASE
    WHEN coalesce(value, 0) < e0 THEN 'Unknown'
    WHEN coalesce(value, 0) <= e1 THEN '{VALUE_LABELS[0]}'
    WHEN coalesce(value, 0) <= e2 THEN '{VALUE_LABELS[1]}'
    WHEN coalesce(value, 0) <= e3 THEN '{VALUE_LABELS[2]}'
    WHEN coalesce(value, 0) <= e4 THEN '{VALUE_LABELS[3]}'
    ELSE 'Unknown' END AS value_binned
FROM events, e""")
def q_quantile_bin(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    st = binning.fit_bins(e, {"value": {"strategy": "quantile", "bins": 4, "labels": VALUE_LABELS}})
    return st.transform(e).select("event_id", "value_binned")


@query("uniform_bin", f"""
WITH s AS (SELECT min(coalesce(value, 0)) AS lo, max(coalesce(value, 0)) AS hi FROM events),
e AS (SELECT lo - (hi - lo) * 0.001 AS e0, 1 * ((hi - lo) / 4) + lo AS e1, 2 * ((hi - lo) / 4) + lo AS e2,
             3 * ((hi - lo) / 4) + lo AS e3, hi AS e4 FROM s)
SELECT event_id, CASE
    WHEN coalesce(value, 0) < e0 THEN 'Unknown'
    WHEN coalesce(value, 0) <= e1 THEN '{VALUE_LABELS[0]}'
    WHEN coalesce(value, 0) <= e2 THEN '{VALUE_LABELS[1]}'
    WHEN coalesce(value, 0) <= e3 THEN '{VALUE_LABELS[2]}'
    WHEN coalesce(value, 0) <= e4 THEN '{VALUE_LABELS[3]}'
    ELSE 'Unknown' END AS value_binned
FROM events, e""")
def q_uniform_bin(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    st = binning.fit_bins(e, {"value": {"strategy": "uniform", "bins": 4, "labels": VALUE_LABELS}})
    return st.transform(e).select("event_id", "value_binned")


@query("rare_labels", """
WITH s AS (SELECT p_brand, count(*) * 1.0 / (SELECT count(*) FROM part) AS share FROM part GROUP BY p_brand)
SELECT p.p_partkey, CASE WHEN s.share < 0.04 THEN 'Other_Brand' ELSE p.p_brand END AS p_brand,
       p.p_type
FROM part p JOIN s ON p.p_brand = s.p_brand""")
def q_rare_labels(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    st = rare.fit_rare(p, {"p_brand": {"threshold": 0.04, "new_name": "Other_Brand"}})
    return st.transform(p)


# ---------------------------------------------------------------------------
# Profiling
# ---------------------------------------------------------------------------

@query("describe_numeric", """
SELECT column_name AS "column", n AS "count", round(a, 6) AS mean, round(s, 6) AS std, round(lo, 6) AS "min",
       round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(hi, 6) AS "max" FROM (
  SELECT 'l_quantity' AS column_name, count(l_quantity) AS n, avg(l_quantity) AS a, stddev_samp(l_quantity) AS s,
         min(l_quantity) AS lo, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50,
         quantile_cont(l_quantity, 0.75) AS p75, max(l_quantity) AS hi FROM lineitem
  UNION ALL
  SELECT 'l_extendedprice', count(l_extendedprice), avg(l_extendedprice), stddev_samp(l_extendedprice),
         min(l_extendedprice), quantile_cont(l_extendedprice, 0.25), quantile_cont(l_extendedprice, 0.5),
         quantile_cont(l_extendedprice, 0.75), max(l_extendedprice) FROM lineitem
  UNION ALL
  SELECT 'l_discount', count(l_discount), avg(l_discount), stddev_samp(l_discount), min(l_discount),
         quantile_cont(l_discount, 0.25), quantile_cont(l_discount, 0.5), quantile_cont(l_discount, 0.75),
         max(l_discount) FROM lineitem
  UNION ALL
  SELECT 'l_tax', count(l_tax), avg(l_tax), stddev_samp(l_tax), min(l_tax), quantile_cont(l_tax, 0.25),
         quantile_cont(l_tax, 0.5), quantile_cont(l_tax, 0.75), max(l_tax) FROM lineitem)""")
def q_describe_numeric(spark, sf):
    li = table(spark, sf, "lineitem")
    return profile.describe_numeric(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("describe_categorical", """
WITH v AS (
  SELECT 'c_mktsegment' AS column_name, c_mktsegment AS value FROM customer UNION ALL
  SELECT 'c_name', c_name FROM customer),
c AS (SELECT column_name, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY column_name, value),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rn FROM c)
SELECT column_name AS "column", sum(n)::BIGINT AS "count", count(*) AS "unique",
       max(CASE WHEN rn = 1 THEN value END) AS top, max(CASE WHEN rn = 1 THEN n END) AS freq
FROM r GROUP BY column_name""")
def q_describe_categorical(spark, sf):
    c = table(spark, sf, "customer")
    return profile.describe_categorical(c, ["c_mktsegment", "c_name"])


@query("missing_report", f"""
WITH g AS ({_GAPS_SQL}),
m AS (SELECT count(*) AS n,
        sum(CASE WHEN o_totalprice IS NULL THEN 1 ELSE 0 END)::BIGINT AS a,
        sum(CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 0 END)::BIGINT AS b,
        sum(CASE WHEN o_orderstatus IS NULL THEN 1 ELSE 0 END)::BIGINT AS c,
        sum(CASE WHEN o_orderdate IS NULL THEN 1 ELSE 0 END)::BIGINT AS d,
        sum(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END)::BIGINT AS e FROM g)
SELECT * FROM (
  SELECT 'o_totalprice' AS "column", a AS missing_count, round(a * 100.0 / n, 6) AS missing_pct FROM m UNION ALL
  SELECT 'o_orderpriority', b, round(b * 100.0 / n, 6) FROM m UNION ALL
  SELECT 'o_orderstatus', c, round(c * 100.0 / n, 6) FROM m UNION ALL
  SELECT 'o_orderdate', d, round(d * 100.0 / n, 6) FROM m UNION ALL
  SELECT 'o_custkey', e, round(e * 100.0 / n, 6) FROM m) WHERE missing_count > 0""")
def q_missing_report(spark, sf):
    g = _orders_with_gaps(spark, sf).select("o_totalprice", "o_orderpriority", "o_orderstatus",
                                            "o_orderdate", "o_custkey")
    return profile.missing_report(g)


@query("shape", """
SELECT count(*) AS n_rows, (SELECT count(*) FROM (DESCRIBE lineitem))::INT AS n_columns FROM lineitem""")
def q_shape(spark, sf):
    return profile.shape(table(spark, sf, "lineitem"))


@query("dtype_frequency", """
SELECT CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
            WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(column_type) END AS dtype,
       count(*)::INT AS n_columns
FROM (DESCRIBE lineitem) GROUP BY 1""")
def q_dtype_frequency(spark, sf):
    return profile.dtype_frequency(table(spark, sf, "lineitem"))


@query("target_distribution", """
SELECT quality AS value, count(*) AS n, round(count(*) * 1.0 / (SELECT count(*) FROM labels), 6) AS share
FROM labels GROUP BY quality""")
def q_target_distribution(spark, sf):
    return profile.target_distribution(table(spark, sf, "labels"), "quality")


@query("histogram30", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(floor((value - lo) / ((hi - lo) / 30)), 29)::INT AS bin, lo, (hi - lo) / 30 AS w
      FROM events, s WHERE value IS NOT NULL)
SELECT 'value' AS "column", bin, round(lo + bin * w, 6) AS lo, round(lo + (bin + 1) * w, 6) AS hi,
       count(*) AS n
FROM b GROUP BY bin, lo, w""")
def q_histogram30(spark, sf):
    return profile.histogram(table(spark, sf, "events"), ["value"], 30)


@query("category_counts", """
WITH v AS (
  SELECT 'event_type' AS "column", event_type AS value FROM events UNION ALL
  SELECT 'props', props FROM events),
c AS (SELECT "column", value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY "column", value),
u AS (SELECT "column" FROM c GROUP BY "column" HAVING count(*) < 50)
SELECT c.* FROM c JOIN u USING ("column")""")
def q_category_counts(spark, sf):
    return profile.category_counts(table(spark, sf, "events"), ["event_type", "props"])


@query("target_profile", """
WITH j AS (SELECT d.n_chars, d.lang, d.source, l.quality
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'n_chars' AS "column", sum(CASE WHEN n_chars IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing,
       count(DISTINCT n_chars) AS "distinct", round(corr(n_chars, quality), 6) AS target_corr FROM j
UNION ALL
SELECT 'lang', sum(CASE WHEN lang IS NULL THEN 1 ELSE 0 END)::BIGINT, count(DISTINCT lang), NULL FROM j
UNION ALL
SELECT 'source', sum(CASE WHEN source IS NULL THEN 1 ELSE 0 END)::BIGINT, count(DISTINCT source), NULL FROM j""")
def q_target_profile(spark, sf):
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id").select("n_chars", "lang", "source", "quality")
    return profile.target_profile(j, "quality", ["n_chars", "lang", "source"])


@query("target_rate_bins", """
WITH j AS (SELECT d.n_chars::DOUBLE AS x, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT min(x) AS lo, max(x) AS hi FROM j),
b AS (SELECT least(floor((x - lo) / ((hi - lo) / 10)), 9)::INT AS bin, quality FROM j, s WHERE x IS NOT NULL)
SELECT 'n_chars' AS "column", bin, count(*) AS n, round(avg(quality), 6) AS target_mean FROM b GROUP BY bin""")
def q_target_rate_bins(spark, sf):
    """P9 (numeric): conversion-style target mean per equal-width bin."""
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id").select("n_chars", "quality")
    return profile.target_rate_by_bin(j, "quality", ["n_chars"], 10)


@query("target_rate", """
WITH j AS (SELECT d.lang, d.source, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'lang' AS "column", lang AS value, count(*) AS n, round(avg(quality), 6) AS target_mean
FROM j GROUP BY lang
UNION ALL
SELECT 'source', source, count(*), round(avg(quality), 6) FROM j GROUP BY source""")
def q_target_rate(spark, sf):
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id").select("lang", "source", "quality")
    return profile.target_rate(j, "quality", ["lang", "source"])


# ---------------------------------------------------------------------------
# Encoding and scaling
# ---------------------------------------------------------------------------

from ..operators import collinear, drift, encoding, evaluate, scaling, scoring, selection, split  # noqa: E402


@query("one_hot", """
SELECT c_custkey,
       (CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)::DOUBLE AS c_mktsegment_BUILDING,
       (CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END)::DOUBLE AS c_mktsegment_FURNITURE,
       (CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END)::DOUBLE AS c_mktsegment_HOUSEHOLD,
       (CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END)::DOUBLE AS c_mktsegment_MACHINERY,
       c_acctbal
FROM customer""")
def q_one_hot(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    st = encoding.fit_one_hot(c, ["c_mktsegment"], ordinal={})
    return st.transform(c)


PRIORITY_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query("ordinal_encode", """
SELECT o_orderkey,
       (CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2
            WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 END)::DOUBLE AS o_orderpriority
FROM orders""")
def q_ordinal_encode(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    st = encoding.fit_one_hot(o, [], ordinal={"o_orderpriority": PRIORITY_ORDER})
    return st.transform(o).select("o_orderkey", "o_orderpriority")


@query("target_encode", """
WITH t AS (SELECT l_orderkey, l_linenumber, CAST(month(l_shipdate) AS VARCHAR) AS ship_month,
                  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
p AS (SELECT avg(y) AS prior FROM t),
s AS (SELECT ship_month, count(*) AS n, avg(y) AS m FROM t GROUP BY ship_month),
e AS (SELECT ship_month, prior * (1 - 1 / (1 + exp(-(n - 20.0) / 20.0))) + m * (1 / (1 + exp(-(n - 20.0) / 20.0)))
             AS enc FROM s, p)
SELECT t.l_orderkey, t.l_linenumber, t.ship_month, round(e.enc, 6) AS ship_month_te
FROM t JOIN e ON t.ship_month = e.ship_month""")
def q_target_encode(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.month("l_shipdate").cast("string").alias("ship_month"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"))
    st = encoding.fit_target_encoder(li, ["ship_month"], "y", suffix="_te")
    out = st.transform(li)
    return out.select("l_orderkey", "l_linenumber", "ship_month", F.round("ship_month_te", 6).alias("ship_month_te"))


def _scale_query(kind):
    def run(spark, sf):
        li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
        kw = {kind: ["l_quantity", "l_extendedprice"]}
        st = scaling.fit_scaler(li, **kw)
        out = st.transform(li)
        return out.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"),
                          F.round("l_extendedprice", 6).alias("l_extendedprice"))
    return run


query("standard_scale", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
                  avg(l_extendedprice) AS me, stddev_pop(l_extendedprice) AS se FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity,
       round((l_extendedprice - me) / se, 6) AS l_extendedprice FROM lineitem, s""")(_scale_query("standard"))
query("robust_scale", """
WITH s AS (SELECT quantile_cont(l_quantity, 0.5) AS mq,
                  quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS iq,
                  quantile_cont(l_extendedprice, 0.5) AS me,
                  quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS ie FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / iq, 6) AS l_quantity,
       round((l_extendedprice - me) / ie, 6) AS l_extendedprice FROM lineitem, s""")(_scale_query("robust"))
query("minmax_scale", """
WITH s AS (SELECT min(l_quantity) AS lq, max(l_quantity) - min(l_quantity) AS rq,
                  min(l_extendedprice) AS le, max(l_extendedprice) - min(l_extendedprice) AS re FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - lq) / rq, 6) AS l_quantity,
       round((l_extendedprice - le) / re, 6) AS l_extendedprice FROM lineitem, s""")(_scale_query("minmax"))


@query("skew_report", """
SELECT column_name, round(s, 6) AS skew, abs(s) > 1.0 AS skewed FROM (
  SELECT 'value' AS column_name, skewness(value) AS s FROM events UNION ALL
  SELECT 'user_id', skewness(user_id) FROM events UNION ALL
  SELECT 'event_id', skewness(event_id) FROM events)""")
def q_skew_report(spark, sf):
    e = table(spark, sf, "events").select("value", "user_id", "event_id")
    sk = scaling.skewness_table(e)
    rows = [(c, round(v, 6) if v is not None else None, bool(v is not None and abs(v) > 1.0)) for c, v in sk.items()]
    return spark.createDataFrame(rows, "column_name string, skew double, skewed boolean")


# ---------------------------------------------------------------------------
# Collinearity
# ---------------------------------------------------------------------------

_VIF_SQL_BASE = """
WITH x AS (SELECT l_quantity AS x1, l_extendedprice AS x2,
                  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS x3 FROM lineitem),
m AS (SELECT quantile_cont(x3, 0.5) AS m3 FROM x),
f AS (SELECT x1, x2, coalesce(x3, m3) AS x3 FROM x, m),
g AS (SELECT sum(x1*x1) AS a, sum(x1*x2) AS b, sum(x1*x3) AS c, sum(x2*x2) AS d, sum(x2*x3) AS e,
             sum(x3*x3) AS ff FROM f),
v AS (SELECT a, b, c, d, e, ff, a*(d*ff - e*e) - b*(b*ff - c*e) + c*(b*e - d*c) AS det FROM g)"""


@query("vif_table", _VIF_SQL_BASE + """
SELECT 'l_quantity' AS feature, round(a * (d*ff - e*e) / det, 6) AS vif FROM v UNION ALL
SELECT 'l_extendedprice', round(d * (a*ff - c*c) / det, 6) FROM v UNION ALL
SELECT 'l_tax', round(ff * (a*d - b*b) / det, 6) FROM v""")
def q_vif_table(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice",
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("l_tax")).alias("l_tax"))
    t = collinear.vif_table(li, ["l_quantity", "l_extendedprice", "l_tax"])
    return t.select("feature", F.round("vif", 6).alias("vif"))


@query("vif_select")
def q_vif_select(spark, sf):
    """Greedy VIF removal over lineitem numerics plus a near-copy column."""
    li = table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") / F.col("l_quantity") + F.col("l_tax")).alias("unit_price"),
        (F.col("l_extendedprice") * 1.01 + F.col("l_quantity")).alias("gross"))
    st = collinear.fit_vif(li)
    return spark.createDataFrame([(c, True, st.vif.get(c)) for c in st.selected] +
                                 [(c, False, None) for c in st.dropped],
                                 "feature string, kept boolean, vif double")


# ---------------------------------------------------------------------------
# Evaluation
# ---------------------------------------------------------------------------

_DOC_LABEL_SQL = """
  SELECT l.doc_id, l.quality, l.toxic, d.n_chars,
         CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END AS pred
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def _doc_labels(spark, sf):
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return lab.join(d, "doc_id").select("doc_id", "quality", "toxic", "n_chars",
                                       (F.col("n_chars") > 1000).cast("int").alias("pred"))


@query("confusion_metrics", f"""
WITH j AS ({_DOC_LABEL_SQL}),
c AS (SELECT sum(CASE WHEN quality = 0 AND pred = 0 THEN 1 ELSE 0 END)::BIGINT AS tn,
             sum(CASE WHEN quality = 0 AND pred = 1 THEN 1 ELSE 0 END)::BIGINT AS fp,
             sum(CASE WHEN quality = 1 AND pred = 0 THEN 1 ELSE 0 END)::BIGINT AS fn,
             sum(CASE WHEN quality = 1 AND pred = 1 THEN 1 ELSE 0 END)::BIGINT AS tp FROM j)
SELECT tn, fp, fn, tp,
       round((tp + tn) * 1.0 / (tp + tn + fp + fn), 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp * 1.0 / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp * 1.0 / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM c""")
def q_confusion_metrics(spark, sf):
    return evaluate.confusion_metrics(_doc_labels(spark, sf), "quality", "pred")


@query("class_report", f"""
WITH j AS ({_DOC_LABEL_SQL}),
t AS (SELECT quality AS cls, 1 AS is_true, CASE WHEN pred = quality THEN 1 ELSE 0 END AS hit FROM j
      UNION ALL SELECT pred, 0, CASE WHEN pred = quality THEN 1 ELSE 0 END FROM j),
a AS (SELECT cls, sum(is_true) AS support, sum(is_true * hit) AS tp, sum(1 - is_true) AS predicted
      FROM t GROUP BY cls)
SELECT cls, round(CASE WHEN predicted = 0 THEN 0.0 ELSE tp * 1.0 / predicted END, 6) AS precision,
       round(CASE WHEN support = 0 THEN 0.0 ELSE tp * 1.0 / support END, 6) AS recall,
       round(CASE WHEN predicted + support = 0 THEN 0.0 ELSE 2.0 * tp / (predicted + support) END, 6) AS f1,
       support::BIGINT AS support
FROM a""")
def q_class_report(spark, sf):
    return evaluate.class_report(_doc_labels(spark, sf), "quality", "pred")


@query("auc_exact", f"""
WITH j AS ({_DOC_LABEL_SQL}),
g AS (SELECT n_chars::DOUBLE AS s, sum(quality) AS pos, sum(1 - quality) AS neg FROM j GROUP BY 1),
c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
      FROM g)
SELECT round(sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""")
def q_auc_exact(spark, sf):
    a = evaluate.auc_exact(_doc_labels(spark, sf), "quality", "n_chars")
    return a.select(F.round("auc", 6).alias("auc"))


_ORDER_EST_SQL = """
  SELECT o.o_orderkey, o.o_custkey, o.o_totalprice AS y, e.est AS p
  FROM orders o JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS est
                      FROM lineitem GROUP BY l_orderkey) e ON o.o_orderkey = e.l_orderkey"""


def _order_estimates(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    est = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("est"))
    return o.join(est, o.o_orderkey == est.l_orderkey).select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").alias("y"), F.col("est").alias("p"))


@query("regression_metrics", f"""
WITH j AS ({_ORDER_EST_SQL})
SELECT round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 6) AS mse,
       round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2
FROM j""")
def q_regression_metrics(spark, sf):
    return evaluate.regression_metrics(_order_estimates(spark, sf), "y", "p")


@query("mase", f"""
WITH j AS ({_ORDER_EST_SQL}),
d AS (SELECT y, p, abs(y - lag(y) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) AS dd FROM j)
SELECT round(CASE WHEN avg(dd) = 0 THEN NULL ELSE avg(abs(y - p)) / avg(dd) END, 6) AS mase FROM d""")
def q_mase(spark, sf):
    return evaluate.mase(_order_estimates(spark, sf), "y", "p", order="o_orderkey", series="o_custkey")


# ---------------------------------------------------------------------------
# Drift: orders before 1999 (reference) vs from 1999 (current)
# ---------------------------------------------------------------------------

def _drift_sides(spark, sf):
    o = table(spark, sf, "orders").select("o_totalprice", "o_orderpriority", "o_orderstatus", "o_orderdate")
    ref = o.where(F.year("o_orderdate") < 1999).drop("o_orderdate")
    cur = o.where(F.year("o_orderdate") >= 1999).drop("o_orderdate")
    return ref, cur


_SIDES_SQL = """
  SELECT o_totalprice, o_orderpriority, o_orderstatus,
         CASE WHEN year(o_orderdate) < 1999 THEN 0 ELSE 1 END AS side FROM orders"""

_NUM_CUM_SQL = f"""
t AS ({_SIDES_SQL}),
g AS (SELECT o_totalprice AS v, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS n_ref,
             sum(side) AS n_cur FROM t GROUP BY o_totalprice),
tt AS (SELECT sum(n_ref) AS tr, sum(n_cur) AS tc FROM g),
c AS (SELECT v, lead(v) OVER (ORDER BY v) AS nv,
             sum(n_ref) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
             sum(n_cur) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc FROM g)"""


@query("ks_numeric", f"""
WITH {_NUM_CUM_SQL}
SELECT 'o_totalprice' AS "column", round(max(abs(cr / tr - cc / tc)), 6) AS ks FROM c, tt""")
def q_ks_numeric(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    return drift.ks_numeric(ref, cur, ["o_totalprice"])


_WASS_SQL = f"""
WITH {_NUM_CUM_SQL},
w AS (SELECT sum(coalesce(abs(cr / tr - cc / tc) * (nv - v), 0)) AS w FROM c, tt),
sd AS (SELECT stddev_pop(o_totalprice) AS s FROM t WHERE side = 0)"""


@query("wasserstein_numeric", _WASS_SQL + """
SELECT 'o_totalprice' AS "column", round(w / s, 6) AS wasserstein FROM w, sd""")
def q_wasserstein_numeric(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    return drift.wasserstein_numeric(ref, cur, ["o_totalprice"])


@query("psi_numeric", f"""
WITH t AS ({_SIDES_SQL}),
q AS (SELECT {", ".join(f"quantile_cont(o_totalprice, {i / 10}) AS q{i}" for i in range(1, 10))}
      FROM t WHERE side = 0),
b AS (SELECT side, {" + ".join(f"(CASE WHEN q{i} < o_totalprice THEN 1 ELSE 0 END)" for i in range(1, 10))} AS bin
      FROM t, q WHERE o_totalprice IS NOT NULL),
c AS (SELECT bin, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS n_ref, sum(side) AS n_cur FROM b GROUP BY bin),
tt AS (SELECT sum(n_ref) AS tr, sum(n_cur) AS tc FROM c)
SELECT 'o_totalprice' AS "column",
       round(sum((greatest(n_cur / tc, 0.0001) - greatest(n_ref / tr, 0.0001))
                 * ln(greatest(n_cur / tc, 0.0001) / greatest(n_ref / tr, 0.0001))), 6) AS psi
FROM c, tt""")
def q_psi_numeric(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    return drift.psi_numeric(ref, cur, ["o_totalprice"])


_CAT_COUNTS_SQL = f"""
t AS ({_SIDES_SQL}),
l AS (SELECT 'o_orderpriority' AS "column", o_orderpriority AS v, side FROM t UNION ALL
      SELECT 'o_orderstatus', o_orderstatus, side FROM t),
c AS (SELECT "column", v, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS n_ref, sum(side) AS n_cur
      FROM l WHERE v IS NOT NULL GROUP BY "column", v),
tt AS (SELECT "column", sum(n_ref) AS tr, sum(n_cur) AS tc FROM c GROUP BY "column"),
pq AS (SELECT c."column", n_ref / tr AS p, n_cur / tc AS q FROM c JOIN tt USING ("column"))"""

_JS_SQL = f"""
WITH {_CAT_COUNTS_SQL},
js AS (SELECT "column",
         round(sqrt(greatest(sum((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                               + (CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)), 6) AS js
       FROM pq GROUP BY "column")"""


@query("js_categorical", _JS_SQL + "\nSELECT * FROM js")
def q_js_categorical(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    return drift.js_categorical(ref, cur, ["o_orderpriority", "o_orderstatus"])


@query("psi_categorical", f"""
WITH {_CAT_COUNTS_SQL}
SELECT "column", round(sum((greatest(q, 0.0001) - greatest(p, 0.0001)) * ln(greatest(q, 0.0001) / greatest(p, 0.0001))), 6)
       AS psi FROM pq GROUP BY "column" """)
def q_psi_categorical(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    return drift.psi_categorical(ref, cur, ["o_orderpriority", "o_orderstatus"])


@query("drift_gate", f"""
WITH {_CAT_COUNTS_SQL},
js AS (SELECT "column",
         round(sqrt(greatest(sum((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                               + (CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)), 6) AS score
       FROM pq GROUP BY "column"),
ng AS (SELECT o_totalprice AS v, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS n_ref,
              sum(side) AS n_cur FROM t GROUP BY o_totalprice),
ntt AS (SELECT sum(n_ref) AS tr, sum(n_cur) AS tc FROM ng),
nc AS (SELECT v, lead(v) OVER (ORDER BY v) AS nv,
              sum(n_ref) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
              sum(n_cur) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc FROM ng),
wn AS (SELECT sum(coalesce(abs(cr / tr - cc / tc) * (nv - v), 0)) AS w FROM nc, ntt),
sd AS (SELECT stddev_pop(o_totalprice) AS s FROM t WHERE side = 0),
scores AS (SELECT "column", score FROM js UNION ALL SELECT 'o_totalprice', round(w / s, 6) FROM wn, sd)
SELECT sum(CASE WHEN score >= 0.1 THEN 1 ELSE 0 END)::BIGINT AS n_drifted, count(*) AS n_columns,
       round(sum(CASE WHEN score >= 0.1 THEN 1 ELSE 0 END) * 1.0 / count(*), 6) AS share,
       sum(CASE WHEN score >= 0.1 THEN 1 ELSE 0 END) * 1.0 / count(*) >= 0.5 AS drift_detected
FROM scores""")
def q_drift_gate(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    return drift.drift_summary(drift.drift_scores(ref, cur))


@query("drift_sides", """
SELECT CASE WHEN year(o_orderdate) < 1999 THEN 'reference' ELSE 'current' END AS side,
       count(*) AS n_rows, 3 AS n_columns FROM orders GROUP BY 1""")
def q_drift_sides(spark, sf):
    ref, cur = _drift_sides(spark, sf)
    return drift.side_summary(ref, cur)


# ---------------------------------------------------------------------------
# Splits, scoring, selection
# ---------------------------------------------------------------------------

@query("strat_split", f"""
WITH h AS (SELECT doc_id, quality, ('0x' || substr(md5(doc_id || '|split|{config.SEED}'), 1, 13))::BIGINT / {2.0 ** 52} AS u FROM labels),
c AS (SELECT quality, quantile_cont(u, {1 - config.TEST_SIZE}) AS cut FROM h GROUP BY quality)
SELECT doc_id, h.quality, CASE WHEN u <= cut THEN 'train' ELSE 'test' END AS part FROM h JOIN c ON h.quality = c.quality""")
def q_strat_split(spark, sf):
    """Per-class 80/20 split of labelled documents by the hash of the id."""
    lab = table(spark, sf, "labels")
    train, test = split.stratified_split(lab, "quality", ["doc_id"])
    return (train.select("doc_id", "quality", F.lit("train").alias("part"))
            .unionByName(test.select("doc_id", "quality", F.lit("test").alias("part"))))


@query("score_format", """
SELECT l_orderkey, l_linenumber, (l_quantity / 50.0)::DOUBLE AS probability,
       printf('%.2f%%', l_quantity / 50.0 * 100) AS conversion_probability,
       CASE WHEN l_quantity / 50.0 > 0.5 THEN 1 ELSE 0 END AS predicted_label
FROM lineitem""")
def q_score_format(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                              (F.col("l_quantity") / 50.0).alias("probability"))
    return scoring.format_scores(li, "probability")


@query("align_features", """
SELECT l_orderkey, l_quantity, l_discount, 0.0::DOUBLE AS missing_feature FROM lineitem""")
def q_align_features(spark, sf):
    li = table(spark, sf, "lineitem")
    return scoring.align_features(li, ["l_quantity", "l_discount", "missing_feature"], keep=["l_orderkey"])


@query("top_k_importance", """
WITH t AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax,
                  CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y FROM lineitem),
i AS (SELECT 'l_quantity' AS feature, abs(corr(l_quantity, y)) AS importance FROM t UNION ALL
      SELECT 'l_extendedprice', abs(corr(l_extendedprice, y)) FROM t UNION ALL
      SELECT 'l_discount', abs(corr(l_discount, y)) FROM t UNION ALL
      SELECT 'l_tax', abs(corr(l_tax, y)) FROM t)
SELECT feature, round(importance, 6) AS importance FROM i ORDER BY importance DESC, feature LIMIT 2""")
def q_top_k_importance(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                              (F.col("l_returnflag") == "R").cast("double").alias("y"))
    imp = selection.corr_importance(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "y")
    return selection.top_k(imp, 2).select("feature", F.round("importance", 6).alias("importance"))


# ---------------------------------------------------------------------------
# Feature engineering
# ---------------------------------------------------------------------------

from ..operators import features as feats  # noqa: E402


@query("prefix_ordinal", """
WITH t AS (SELECT o_orderkey, replace(o_orderpriority, '-', '.') AS prio FROM orders)
SELECT o_orderkey,
       CAST(try_cast(trim(split_part(prio, '.', 1)) AS INTEGER) AS DOUBLE) AS prio_ordinal
FROM t""")
def q_prefix_ordinal(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.regexp_replace("o_orderpriority", "-", ".").alias("prio"))
    st = feats.fit_features(o, ["prio"], ratios=[], both_flags=[], collapse={}, equals=[])
    return st.transform(o)


@query("ratio_flag", """
SELECT l_orderkey, l_linenumber,
       coalesce(l_extendedprice, 0) / (CASE WHEN l_discount * 100 = 0 THEN 1 ELSE l_discount * 100 END)
         AS price_per_discount,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS returned_final,
       CASE WHEN l_tax = 0.08 THEN 1 ELSE 0 END AS top_tax
FROM lineitem""")
def q_ratio_flag(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_discount") * 100).alias("disc_pct"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_r"),
        (F.col("l_linestatus") == "F").cast("int").alias("is_f"), "l_tax")
    st = feats.FeatureState({}, ratios=[["price_per_discount", "l_extendedprice", "disc_pct"]],
                            both_flags=[["returned_final", "is_r", "is_f"]], collapse={},
                            equals=[["top_tax", "l_tax", 0.08]])
    return st.transform(li).select("l_orderkey", "l_linenumber", "price_per_discount", "returned_final",
                                   "top_tax")


@query("channel_collapse", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_tax = 0 THEN 'no_tax'
            WHEN l_discount = 0 THEN 'no_discount'
            WHEN l_quantity >= 40 THEN 'bulk'
            ELSE 'Other_Source' END AS channel
FROM lineitem""")
def q_channel_collapse(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") >= 40).cast("int").alias("bulk"),
        (F.col("l_discount") == 0).cast("int").alias("no_discount"),
        (F.col("l_tax") == 0).cast("int").alias("no_tax"))
    st = feats.FeatureState({}, ratios=[], both_flags=[], equals=[],
                            collapse={"channel": ["bulk", "no_discount", "no_tax"]})
    return st.transform(li)


# ---------------------------------------------------------------------------
# Models (rows-only checks: Spark ML results have no SQL counterpart)
# ---------------------------------------------------------------------------

def text_features(spark, sf):
    """Per-document numeric features computed from the whole text."""
    d = table(spark, sf, "documents")
    text = F.col("text")
    return d.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim(text), r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, "[0-9]", ""))).cast("double").alias("n_digits"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))).cast("double").alias("n_upper"),
        (F.col("lang") == "en").cast("double").alias("is_en"), "lang", "source")


def doc_features(spark, sf):
    """Text features of the labelled documents with the quality label."""
    lab = table(spark, sf, "labels")
    return text_features(spark, sf).join(lab.select("doc_id", "quality"), "doc_id")


DOC_FEATURES = ["n_chars", "n_words", "n_lines", "n_digits", "n_upper", "is_en"]


@query("train_models")
def q_train_models(spark, sf):
    """M1/M2/M3/M5: tune (15 seeded draws, 3-fold CV), fit, stack, compare by
    AUC.  All six families, and no deadline that would cut their draws."""
    from ..operators import training
    res = training.train_all(doc_features(spark, sf), DOC_FEATURES + ["source"], "quality", ["doc_id"],
                             stack=True, categorical=["source"], seconds=None)
    return res.results


@query("cluster_kmeans")
def q_cluster_kmeans(spark, sf):
    """K1/K2: engagement-style clusters of documents (suffix-matched features)."""
    from ..operators import clustering
    df = doc_features(spark, sf)
    model = clustering.fit_clusters(df, ["n_chars", "n_words", "n_lines"])
    return model.transform(df).groupBy("engagement_cluster").agg(F.count(F.lit(1)).alias("n_docs"))


@query("rf_importance")
def q_rf_importance(spark, sf):
    """L3: random-forest importances, top 3."""
    return selection.rf_importance(doc_features(spark, sf), "quality", DOC_FEATURES, k=3)


@query("gbt_importance")
def q_gbt_importance(spark, sf):
    """L4 (re-aimed): boosted-tree importances."""
    return selection.gbt_importance(doc_features(spark, sf), "quality", DOC_FEATURES, n_trees=100)


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    """AUC drop per permuted feature (10 repeats, 100 trees)."""
    return selection.permutation_importance(doc_features(spark, sf), "quality", DOC_FEATURES, keys=["doc_id"])


@query("rfe_cv")
def q_rfe_cv(spark, sf):
    """L1: recursive elimination with a balanced logistic regression."""
    _, hist = selection.rfe_cv(doc_features(spark, sf), "quality", DOC_FEATURES, ["doc_id"], folds=5)
    return hist


@query("linear_attribution")
def q_linear_attribution(spark, sf):
    """L4 exact linear form: mean |w (x - mean)|."""
    return selection.linear_attribution(doc_features(spark, sf), "quality", DOC_FEATURES)


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_TARGET = "shipped_late"


def line_features(spark, sf):
    """Line items with a placeholder, Yes/No flags, a text with a numeric
    prefix and a label (shipped in the later years) for the steps of a chain."""
    def yes(c):
        return F.when(c, F.lit("Yes")).when(~c, F.lit("No"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_orderkey") % 10 == 0, F.lit("Select")).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus", F.date_format("l_shipdate", "MMM").alias("ship_month"),
        F.concat(F.quarter("l_shipdate").cast("string"), F.lit(". quarter")).alias("ship_quarter"),
        yes(F.col("l_quantity") >= 40).alias("bulk"), yes(F.col("l_discount") == 0).alias("no_discount"),
        yes(F.col("l_tax") == 0).alias("no_tax"), (F.year("l_shipdate") >= 1999).cast("int").alias(LINE_TARGET))


def line_chain():
    """The 13 steps of Z6 (``lead_chain``) with the columns of line items."""
    from ..operators import clustering
    from .pipeline import Chain, Step, TypeState, fit_importance, fit_top_k
    protect = [*LINE_KEYS, LINE_TARGET]
    return Chain([
        Step("clean", lambda d, p: cleaning.fit_clean(d, static_drop=[], keep_cols=protect, target=LINE_TARGET,
                                                      name_mode="simple"),
             lambda f, d, training: f.transform(d, dedup=training), materialize_after=True, keeps_rows=False),
        Step("types", lambda d, p: TypeState(LINE_TARGET, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                                             ["bulk", "no_discount", "no_tax"])),
        Step("impute", lambda d, p: impute.fit_impute(d, {}, {"l_returnflag": {"strategy": "mode"}})),
        Step("clip", lambda d, p: outliers.fit_clip(d, ["l_extendedprice"], order=p["order"])),
        Step("engineer", lambda d, p: feats.fit_features(
            d, ["ship_quarter"], ratios=[["price_per_unit", "l_extendedprice", "l_quantity"]],
            both_flags=[["free_of_both", "no_discount", "no_tax"]],
            collapse={"channel": ["bulk", "no_discount", "no_tax"]}, equals=[["returned", "l_returnflag", "R"]])),
        Step("bin", lambda d, p: binning.fit_bins(d, {"l_quantity": {"strategy": "quantile", "bins": 4,
                                                                    "labels": VALUE_LABELS}}, p["order"])),
        Step("rare", lambda d, p: rare.fit_rare(d, {"ship_month": {"threshold": 0.05, "new_name": "Other"}})),
        Step("vif", lambda d, p: collinear.fit_vif(d.drop(*protect), order=p["order"])),
        Step("encode", lambda d, p: encoding.fit_one_hot(d, ["l_returnflag", "l_linestatus", "ship_month", "channel",
                                                             "l_quantity_binned"], ordinal={})),
        Step("scale", lambda d, p: scaling.fit_scaler(d.drop(*LINE_KEYS), ["l_extendedprice"], [], [],
                                                      skewed_to_robust=True, target=LINE_TARGET)),
        Step("importance", lambda d, p: fit_importance(d, LINE_TARGET, protect)),
        Step("cluster", lambda d, p: clustering.fit_clusters(d, ["l_quantity", "l_extendedprice", "price_per_unit"])),
        Step("select", lambda d, p: fit_top_k(d, p["importance"], protect)),
    ])


@query("feature_chain")
def q_feature_chain(spark, sf):
    """Z6 on the lineitem table: clean (with the whole-row dedup at training)
    -> types -> impute -> clip -> engineer -> bin -> rare -> VIF -> one-hot ->
    scale -> importance -> cluster -> select, fitted and replayed as one plan."""
    li = line_features(spark, sf)
    return line_chain().fit(li).transform(li)


# ---------------------------------------------------------------------------
# Reports with SQL counterparts: cleaning report, residual bins, D3 columns
# ---------------------------------------------------------------------------

@query("clean_report", f"""
WITH g AS ({_GAPS_SQL}),
d AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE o_orderkey % 4 = 0),
m AS (SELECT 'o_orderkey' AS c, avg(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END) AS share FROM d UNION ALL
      SELECT 'o_custkey', avg(CASE WHEN o_custkey IS NULL THEN 1.0 ELSE 0.0 END) FROM d UNION ALL
      SELECT 'o_totalprice', avg(CASE WHEN o_totalprice IS NULL THEN 1.0 ELSE 0.0 END) FROM d UNION ALL
      SELECT 'o_orderpriority', avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END) FROM d UNION ALL
      SELECT 'o_orderstatus', avg(CASE WHEN o_orderstatus IS NULL THEN 1.0 ELSE 0.0 END) FROM d UNION ALL
      SELECT 'o_orderdate', avg(CASE WHEN o_orderdate IS NULL THEN 1.0 ELSE 0.0 END) FROM d),
kept AS (SELECT o_orderkey, o_custkey, o_totalprice,
                CASE WHEN o_orderpriority IN ({_sql_list(config.PLACEHOLDERS)}) THEN NULL ELSE o_orderpriority END
                  AS o_orderpriority,
                CASE WHEN o_orderstatus IN ({_sql_list(config.PLACEHOLDERS)}) THEN NULL ELSE o_orderstatus END
                  AS o_orderstatus FROM d)
SELECT 'rows_before' AS item, CAST(count(*) AS VARCHAR) AS value FROM d
UNION ALL SELECT 'rows_after', CAST(count(*) AS VARCHAR) FROM (SELECT DISTINCT * FROM kept)
UNION ALL SELECT 'dropped_columns', string_agg(c, ',' ORDER BY c) FROM m WHERE share > 0.5
UNION ALL SELECT 'leak_columns', ''
UNION ALL SELECT 'original_columns', 'o_orderkey,o_custkey,o_totalprice,o_orderpriority,o_orderstatus,o_orderdate'
UNION ALL SELECT 'final_columns', (SELECT string_agg(c, ',' ORDER BY CASE c WHEN 'o_orderkey' THEN 1
      WHEN 'o_custkey' THEN 2 WHEN 'o_totalprice' THEN 3 WHEN 'o_orderpriority' THEN 4 WHEN 'o_orderstatus' THEN 5
      ELSE 6 END) FROM m WHERE share <= 0.5)""")
def q_clean_report(spark, sf):
    """C11: rows before/after the cleaning (duplicates added with UNION ALL)
    and the column lists decided at fit."""
    g = _orders_with_gaps(spark, sf)
    doubled = g.unionByName(g.where(F.col("o_orderkey") % 4 == 0))
    st = cleaning.fit_clean(doubled, dynamic_var_drop=False, static_drop=[], name_mode="simple")
    return cleaning.clean_report(doubled, st)


@query("residual_hist", f"""
WITH j AS ({_ORDER_EST_SQL}),
r AS (SELECT y - p AS residual FROM j),
s AS (SELECT min(residual) AS lo, max(residual) AS hi FROM r),
b AS (SELECT least(floor((residual - lo) / ((hi - lo) / 20)), 19)::INT AS bin, lo, (hi - lo) / 20 AS w
      FROM r, s WHERE residual IS NOT NULL)
SELECT 'residual' AS "column", bin, round(lo + bin * w, 6) AS lo, round(lo + (bin + 1) * w, 6) AS hi,
       count(*) AS n
FROM b GROUP BY bin, lo, w""")
def q_residual_hist(spark, sf):
    """M8: residuals of the lineitem-based order total, as 20 equal-width bins."""
    return evaluate.residual_table(_order_estimates(spark, sf), "y", "p", 20)


@query("variant_columns", """
WITH t AS (SELECT o_custkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS parity,
                  CASE WHEN year(o_orderdate) < 1999 THEN 0 ELSE 1 END AS side FROM orders),
s AS (SELECT side, stddev_samp(o_custkey) AS a, stddev_samp(o_totalprice) AS b,
             stddev_samp(CASE WHEN side = 0 THEN parity ELSE 0 END) AS c FROM t GROUP BY side)
SELECT column_name FROM (
  SELECT 'o_custkey' AS column_name, min(a) > 0 AS ok FROM s UNION ALL
  SELECT 'o_totalprice', min(b) > 0 FROM s UNION ALL
  SELECT 'parity', min(c) > 0 FROM s) WHERE ok""")
def q_variant_columns(spark, sf):
    """D3: numeric columns with a positive std on both sides (a column made
    constant on the current side drops out)."""
    o = table(spark, sf, "orders")
    base = o.select("o_custkey", "o_totalprice", (F.col("o_orderkey") % 2 == 0).cast("int").alias("parity"),
                    F.year("o_orderdate").alias("yr"))
    ref = base.where(F.col("yr") < 1999).drop("yr")
    cur = base.where(F.col("yr") >= 1999).drop("yr").withColumn("parity", F.lit(0))
    cols = split.variant_columns(ref, cur)
    return spark.createDataFrame([(c,) for c in cols], "column_name string")


_CONFORM_SCHEMA = {"O OrderKey": "o_orderkey", "O-Total Price": "o_totalprice",
                   "O Order Status": "o_orderstatus", "Sales Channel": "sales_channel"}


@query("conform_schema", """
SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(NULL AS VARCHAR) AS sales_channel FROM orders""")
def q_conform_schema(spark, sf):
    """Incoming columns named loosely (case, spaces, dashes) are matched
    by the simple naming rule, unknown ones dropped, missing ones added as
    NULL, order fixed."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("o order status"), F.col("o_orderkey").alias("O_ORDERKEY"),
        F.col("o_totalprice").alias("o total-price"), F.col("o_custkey").alias("junk"))
    return cleaning.conform(o, _CONFORM_SCHEMA)


@query("complete_cases", f"""
WITH g AS ({_GAPS_SQL})
SELECT o_orderkey, o_totalprice, o_orderpriority FROM g
WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL""")
def q_complete_cases(spark, sf):
    """Rows with every listed feature present (derived gaps in orders)."""
    g = _orders_with_gaps(spark, sf).select("o_orderkey", "o_totalprice", "o_orderpriority")
    return cleaning.complete_cases(g, ["o_totalprice", "o_orderpriority"])


@query("prefix_coerce", """
SELECT event_id, try_cast(substr(props, 7, length(props) - 7) AS DOUBLE) AS p_props,
       try_cast(event_type AS DOUBLE) AS p_type, value
FROM events""")
def q_prefix_coerce(spark, sf):
    """Numeric coercion of every column whose name has a prefix."""
    e = table(spark, sf, "events").select("event_id", F.expr("substr(props, 7, length(props) - 7)").alias("p_props"),
                                          F.col("event_type").alias("p_type"), "value")
    return cleaning.coerce_prefix(e, "p_")


@query("score_preview", """
SELECT l_orderkey, l_linenumber, (l_quantity / 50.0)::DOUBLE AS probability,
       printf('%.2f%%', l_quantity / 50.0 * 100) AS conversion_probability,
       CASE WHEN l_quantity / 50.0 > 0.5 THEN 1 ELSE 0 END AS predicted_label
FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 100""")
def q_score_preview(spark, sf):
    """The first 100 scored rows in key order (the limit is the feature)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                              (F.col("l_quantity") / 50.0).alias("probability"))
    head, _ = scoring.preview(scoring.format_scores(li, "probability"), 100, ["l_orderkey", "l_linenumber"])
    return head


@query("chain_lineage", f"""
WITH g AS ({_GAPS_SQL}),
d AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE o_orderkey % 4 = 0),
m AS (SELECT 'o_orderkey' AS c, avg(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END) AS share FROM d UNION ALL
      SELECT 'o_custkey', avg(CASE WHEN o_custkey IS NULL THEN 1.0 ELSE 0.0 END) FROM d UNION ALL
      SELECT 'o_totalprice', avg(CASE WHEN o_totalprice IS NULL THEN 1.0 ELSE 0.0 END) FROM d UNION ALL
      SELECT 'o_orderpriority', avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END) FROM d UNION ALL
      SELECT 'o_orderstatus', avg(CASE WHEN o_orderstatus IS NULL THEN 1.0 ELSE 0.0 END) FROM d UNION ALL
      SELECT 'o_orderdate', avg(CASE WHEN o_orderdate IS NULL THEN 1.0 ELSE 0.0 END) FROM d),
k AS (SELECT DISTINCT o_orderkey, o_custkey, o_totalprice,
        CASE WHEN o_orderpriority IN ({_sql_list(config.PLACEHOLDERS)}) THEN NULL ELSE o_orderpriority END AS p,
        CASE WHEN o_orderstatus IN ({_sql_list(config.PLACEHOLDERS)}) THEN NULL ELSE o_orderstatus END AS s FROM d),
n AS (SELECT (SELECT count(*) FROM d) AS n_in, (SELECT count(*) FROM k) AS n_out,
             (SELECT count(*) FROM m WHERE share <= 0.5)::INT AS kept,
             (SELECT string_agg(c, ',' ORDER BY c) FROM m WHERE share > 0.5) AS removed)
SELECT 'clean' AS stage, n_in AS rows_before, n_out AS rows_after, 6 AS cols_before, kept AS cols_after,
       removed AS removed_columns FROM n
UNION ALL SELECT 'impute', n_out, n_out, kept, kept, '' FROM n
UNION ALL SELECT 'clip', n_out, n_out, kept, kept, '' FROM n""")
def q_chain_lineage(spark, sf):
    """Stage lineage of a fitted chain (clean with dedup -> impute ->
    clip) over orders with derived gaps and duplicates; row counts are taken
    where the chain materialises (after the dedup)."""
    from .pipeline import Chain, Step
    g = _orders_with_gaps(spark, sf)
    doubled = g.unionByName(g.where(F.col("o_orderkey") % 4 == 0))
    chain = Chain([
        Step("clean", lambda d, p: cleaning.fit_clean(d, dynamic_var_drop=False, static_drop=[], name_mode="simple"),
             lambda f, d, training: f.transform(d, dedup=training), materialize_after=True, keeps_rows=False),
        Step("impute", lambda d, p: impute.fit_impute(d, {"o_totalprice": "median"},
                                                      {"o_orderpriority": {"strategy": "mode"}})),
        Step("clip", lambda d, p: outliers.fit_clip(d, ["o_totalprice"])),
    ])
    fitted, _ = chain.fit_transform(doubled)
    return fitted.lineage.table(spark)


from . import catalog_checks  # noqa: E402,F401  registers more queries
