from fitframe.functions import names


def test_standardize_splits_capitals():
    assert names.standardize_name("Prospect ID") == "prospect_i_d"
    assert names.standardize_name("Get updates on DM Content") == "get_updates_on_d_m_content"
    assert names.standardize_name("TotalVisits") == "total_visits"
    assert names.standardize_name("  Lead__Source ") == "lead_source"


def test_simple_name_and_metric_sanitize():
    assert names.simple_name("Prospect ID") == "prospect_id"
    assert names.simple_name("TotalVisits") == "totalvisits"
    assert names.sanitize_metric_name_py("a:b(c)é") == "a_b_c__"
    assert names.sanitize_metric_name_py("ok-name_1./ x") == "ok-name_1./ x"


def test_strip_prefix_and_dedupe():
    assert names.strip_prefix("onehot__city_Mumbai") == "city_Mumbai"
    assert names.strip_prefix("plain") == "plain"
    assert names.dedupe_names(["a", "b", "a", "c", "b"]) == ["a", "b", "c"]
