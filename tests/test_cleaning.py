from pyspark.sql import functions as F

from fitframe import config
from fitframe.operators import cleaning
from tests.fixtures import lead_table


def test_fit_clean_on_lead_table(spark):
    raw = spark.createDataFrame(lead_table())
    st = cleaning.fit_clean(raw, keep_cols=["prospect_i_d"])
    # static lists (by either naming rule), high-missing, constant, leak
    assert "lead_number" in st.dropped_columns
    assert "magazine" not in st.final_columns          # static constant list
    assert "all_null" in st.dropped_columns             # > 50 % missing
    assert "constant_score" in st.dropped_columns       # variance < 0.01
    assert "asymmetrique_activity_score" in st.dropped_columns
    assert "prospect_i_d" in st.final_columns           # keep_cols veto
    assert st.leak_columns == ["convert_flag"]
    assert "converted" in st.final_columns


def test_placeholders_dedup_and_report(spark):
    df = spark.createDataFrame([("a", "Select"), ("a", "Select"), ("b", "x"), ("c", "")], "k string, v string")
    st = cleaning.fit_clean(df, drop_high_missing=False, dynamic_var_drop=False, static_drop=[],
                            name_mode="simple")
    out = st.transform(df, dedup=True)
    rows = sorted((r.k, r.v) for r in out.collect())
    assert rows == [("a", None), ("b", "x"), ("c", None)]
    assert st.transform(df).count() == 4                 # no row removal at scoring
    rep = {r.item: r.value for r in cleaning.clean_report(df, st).collect()}
    assert rep["rows_before"] == "4" and rep["rows_after"] == "3"


def test_convert_types(spark):
    df = spark.createDataFrame([("3", "Yes", "01 High"), ("abc", "No", "04 Very Low"), (None, "x", "zz")],
                               "total_visits string, do_not_email string, lead_quality string")
    out = cleaning.convert_types(df).collect()
    assert [r.total_visits for r in out] == [3.0, None, None]
    assert [r.do_not_email for r in out] == [1, 0, None]
    assert [r.lead_quality for r in out] == [3, 0, None]


def test_conform_schema(spark):
    df = spark.createDataFrame([("p1", "5", "junk")], "`Prospect ID` string, `TotalVisits` string, extra string")
    out = cleaning.conform(df)
    assert out.columns == list(config.EXPECTED_RAW_SCHEMA.values())
    r = out.first()
    assert r.prospect_id == "p1" and r.total_visits == "5" and r.city is None


def test_complete_cases_and_prefix(spark):
    df = spark.createDataFrame([(1.0, "2"), (None, "x")], "a double, n_b string")
    assert cleaning.complete_cases(df, ["a"]).count() == 1
    assert [r.n_b for r in cleaning.coerce_prefix(df, "n_").collect()] == [2.0, None]
    out = cleaning.add_missing(df, ["z"], 0.0)
    assert out.first().z == 0.0
    assert F is not None
