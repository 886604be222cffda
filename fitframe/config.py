"""Default configuration of the lead-conversion chain.

FIXED VALUES: the lists, maps, labels and thresholds below must equal the
ones of the original lead-scoring pipeline so that results agree.  They are
given in their natural order and are only data; every operator also accepts
its own lists as parameters.
"""

# ---- fixed values: cleaning -------------------------------------------------
ID_COLS = [
    "Prospect ID",
    "Lead Number",
    "Last Activity",
    "Last Notable Activity",
    "Lead Profile",
    "I agree to pay the amount through cheque",
]
CONST_COLS = [
    "Magazine",
    "Receive More Updates About Our Courses",
    "Update me on Supply Chain Content",
    "Get updates on DM Content",
    "I agree to pay by cheque",
]
HIGH_MISS_COLS = [
    "Asymmetrique Activity Index",
    "Asymmetrique Profile Index",
    "Asymmetrique Activity Score",
    "Asymmetrique Profile Score",
]
PLACEHOLDERS = ["", "NA", "N/A", "null", "Null", "none", "None", "-", "--", "Select"]
MISSING_THRESHOLD = 0.5
VARIANCE_THRESHOLD = 0.01
LEAK_PATTERN = r"(?i)(convert|target)"
TARGET = "converted"

# ---- fixed values: typing ---------------------------------------------------
NUMERIC_COLUMNS = ["total_visits", "total_time_spent_on_website", "page_views_per_visit"]
BINARY_COLUMNS = [
    "do_not_email",
    "do_not_call",
    "search",
    "newspaper_article",
    "x_education_forums",
    "newspaper",
    "digital_advertisement",
    "through_recommendations",
    "a_free_copy_of_mastering_the_interview",
]
YES_NO = {"Yes": 1, "No": 0}
# One declared map for lead quality (the cleaning map of the original is
# overwritten by this one, so only this one is kept).
ORDINAL_MAPPINGS = {
    "lead_quality": {"01 High": 3, "02 Medium": 2, "03 Low": 1, "04 Very Low": 0},
}

# ---- fixed values: imputation -----------------------------------------------
NUMERIC_IMPUTE = {"total_visits": "median", "page_views_per_visit": "median"}
CATEGORICAL_IMPUTE = {
    "country": {"strategy": "constant", "fill_value": "Unknown_Country"},
    "specialization": {"strategy": "constant", "fill_value": "Not_Specified"},
    "what_is_your_current_occupation": {"strategy": "constant", "fill_value": "Not_Specified"},
    "what_matters_most_to_you_in_choosing_a_course": {"strategy": "constant", "fill_value": "Not_Specified"},
    "city": {"strategy": "constant", "fill_value": "Unknown_City"},
    "last_activity": {"strategy": "mode"},
}
DEFAULT_CATEGORICAL_FILL = "Missing"

# ---- fixed values: outliers -------------------------------------------------
IQR_K = 1.5

# ---- fixed values: feature engineering --------------------------------------
PREFIX_ORDINAL_COLS = ["specialization"]
LEAD_SOURCE_DUMMIES = [
    "search",
    "newspaper_article",
    "x_education_forums",
    "newspaper",
    "digital_advertisement",
    "through_recommendations",
]
OTHER_SOURCE = "Other_Source"

# ---- fixed values: binning --------------------------------------------------
BINNING = {
    "total_visits": {
        "strategy": "quantile", "bins": 4,
        "labels": ["Low_Visits", "Medium_Visits", "High_Visits", "Very_High_Visits"],
    },
    "total_time_spent_on_website": {
        "strategy": "quantile", "bins": 4,
        "labels": ["Low_Engagement", "Medium_Engagement", "High_Engagement", "Very_High_Engagement"],
    },
    "page_views_per_visit": {
        "strategy": "quantile", "bins": 4,
        "labels": ["Low_Page_Views", "Medium_Page_Views", "High_Page_Views", "Very_High_Page_Views"],
    },
}
UNKNOWN_BIN = "Unknown"

# ---- fixed values: rare labels ----------------------------------------------
RARE_LABELS = {
    "lead_source": {"threshold": 0.01, "new_name": "Other"},
    "country": {"threshold": 0.02, "new_name": "Other_Country"},
    "specialization": {"threshold": 0.02, "new_name": "Other_Specialization"},
    "last_activity": {"threshold": 0.01, "new_name": "Other_Activity"},
}

# ---- fixed values: encoding -------------------------------------------------
ONEHOT_COLUMNS = [
    "lead_origin",
    "lead_source",
    "what_is_your_current_occupation",
    "what_matters_most_to_you_in_choosing_a_course",
    "last_activity",
    "country",
    "specialization",
    "city",
    "tags",
    "lead_source_channel",
    "total_visits_binned",
    "total_time_spent_on_website_binned",
    "page_views_per_visit_binned",
]
ORDINAL_ENCODE = {
    "lead_quality": ["Low", "Medium", "High", "Very High"],
    "lead_score_band": ["00 Low", "01 Medium", "02 High"],
}
TARGET_ENCODE_COLUMNS = ["country", "lead_source", "specialization", "last_activity", "tags"]
TARGET_SMOOTHING = 20.0
TARGET_MIN_SAMPLES_LEAF = 20

# ---- fixed values: scaling and clustering -----------------------------------
STANDARD_SCALE_COLS = ["total_visits", "page_views_per_visit"]
ROBUST_SCALE_COLS = ["total_time_spent_on_website", "time_per_visit"]
MINMAX_SCALE_COLS: list = []
SKEW_THRESHOLD = 1.0
CLUSTER_FEATURES = ["total_visits", "total_time_spent_on_website", "time_per_visit"]
CLUSTER_K = 4
CLUSTER_MAX_ITER = 300
SEED = 42

# ---- fixed values: collinearity and selection -------------------------------
VIF_THRESHOLD = 5.0
TOP_K_IMPORTANCE = 50

# ---- fixed values: drift ----------------------------------------------------
DRIFT_COLUMN_THRESHOLD = 0.1
DRIFT_SHARE_THRESHOLD = 0.5
METRIC_NAME_PATTERN = r"[^a-zA-Z0-9_\-./ ]"

# ---- fixed values: scoring schema (raw name -> standard name) ---------------
EXPECTED_RAW_SCHEMA = {
    "Prospect ID": "prospect_id",
    "Lead Number": "lead_number",
    "Lead Origin": "lead_origin",
    "Lead Source": "lead_source",
    "Do Not Email": "do_not_email",
    "Do Not Call": "do_not_call",
    "TotalVisits": "total_visits",
    "Total Time Spent on Website": "total_time_spent_on_website",
    "Page Views Per Visit": "page_views_per_visit",
    "Last Activity": "last_activity",
    "Country": "country",
    "Specialization": "specialization",
    "How did you hear about X Education": "how_did_you_hear_about_x_education",
    "What is your current occupation": "what_is_your_current_occupation",
    "What matters most to you in choosing a course": "what_matters_most_to_you_in_choosing_a_course",
    "Search": "search",
    "Magazine": "magazine",
    "Newspaper Article": "newspaper_article",
    "X Education Forums": "x_education_forums",
    "Newspaper": "newspaper",
    "Digital Advertisement": "digital_advertisement",
    "Through Recommendations": "through_recommendations",
    "Receive More Updates About Our Courses": "receive_more_updates_about_our_courses",
    "Tags": "tags",
    "Lead Quality": "lead_quality",
    "Update me on Supply Chain Content": "update_me_on_supply_chain_content",
    "Get updates on DM Content": "get_updates_on_dm_content",
    "Lead Profile": "lead_profile",
    "City": "city",
    "Asymmetrique Activity Index": "asymmetrique_activity_index",
    "Asymmetrique Profile Index": "asymmetrique_profile_index",
    "Asymmetrique Activity Score": "asymmetrique_activity_score",
    "Asymmetrique Profile Score": "asymmetrique_profile_score",
    "I agree to pay the amount through cheque": "i_agree_to_pay_the_amount_through_cheque",
    "A free copy of Mastering The Interview": "a_free_copy_of_mastering_the_interview",
    "Last Notable Activity": "last_notable_activity",
}

# ---- fixed values: model tuning ranges --------------------------------------
TUNING_SPACE = {
    "LogisticRegression": {"C": ("float", 0.01, 10.0)},
    "RandomForest": {"n_estimators": ("int", 50, 200), "max_depth": ("int", 3, 15)},
    "XGBoost": {"n_estimators": ("int", 50, 200), "learning_rate": ("float", 0.01, 0.3),
                "max_depth": ("int", 3, 10)},
    "LightGBM": {"n_estimators": ("int", 50, 200), "learning_rate": ("float", 0.01, 0.2),
                 "num_leaves": ("int", 20, 150)},
    "CatBoost": {"iterations": ("int", 50, 200), "learning_rate": ("float", 0.01, 0.3),
                 "depth": ("int", 3, 10)},
    "GradientBoosting": {"n_estimators": ("int", 50, 200), "learning_rate": ("float", 0.01, 0.3),
                         "max_depth": ("int", 3, 10)},
}
TEST_SIZE = 0.2
CV_FOLDS = 3
STACK_FOLDS = 5
TUNE_SECONDS = 600
N_TRIALS = 15
