"""Seeded test inputs: the reference's own three fixtures and a lead table
with the features FIXTURES.md asks for (placeholders, Yes/No, text in numeric
columns, rare values, high-missing and constant columns, duplicates, a
collinear pair and a leak-named column)."""

from __future__ import annotations

import numpy as np
import pandas as pd

LEAD_RAW_COLUMNS = [
    "Prospect ID", "Lead Number", "Lead Origin", "Lead Source", "Do Not Email", "Do Not Call", "Converted",
    "TotalVisits", "Total Time Spent on Website", "Page Views Per Visit", "Last Activity", "Country",
    "Specialization", "How did you hear about X Education", "What is your current occupation",
    "What matters most to you in choosing a course", "Search", "Magazine", "Newspaper Article",
    "X Education Forums", "Newspaper", "Digital Advertisement", "Through Recommendations",
    "Receive More Updates About Our Courses", "Tags", "Lead Quality", "Update me on Supply Chain Content",
    "Get updates on DM Content", "Lead Profile", "City", "Asymmetrique Activity Index",
    "Asymmetrique Profile Index", "Asymmetrique Activity Score", "Asymmetrique Profile Score",
    "I agree to pay the amount through cheque", "A free copy of Mastering The Interview",
    "Last Notable Activity",
]


def missing_pair() -> pd.DataFrame:
    return pd.DataFrame({"a": [1.0, None, 3.0], "b": [4.0, 5.0, None]})


def random_matrix(n: int = 20, seed: int = 0) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    df = pd.DataFrame(rng.random((n, 3)), columns=["a", "b", "c"])
    df["y"] = rng.random(n)
    return df


def lead_table(n: int = 600, seed: int = 42) -> pd.DataFrame:
    rng = np.random.default_rng(seed)

    def pick(values, p=None, size=n):
        return rng.choice(np.array(values, dtype=object), size=size, p=p)

    yes_no = ["Yes", "No", "No", "No", "maybe"]
    visits = np.round(rng.gamma(1.5, 3.0, n), 0)
    time_spent = np.round(rng.gamma(1.2, 400.0, n), 0)
    pages = np.round(visits / np.maximum(rng.integers(1, 4, n), 1) + rng.random(n), 2)
    visits_txt = visits.astype(object)
    visits_txt[rng.random(n) < 0.03] = "abc"
    visits_txt[rng.random(n) < 0.05] = None
    conv = (rng.random(n) < 0.25 + 0.3 * (time_spent > 500)).astype(int).astype(str).astype(object)
    conv[rng.random(n) < 0.01] = None
    df = pd.DataFrame({
        "Prospect ID": [f"p-{i:05d}" for i in range(n)],
        "Lead Number": np.arange(100000, 100000 + n),
        "Lead Origin": pick(["API", "Landing Page Submission", "Lead Add Form", "Lead Import"],
                            [0.4, 0.45, 0.1, 0.05]),
        "Lead Source": pick(["Google", "Direct Traffic", "Olark Chat", "Organic Search", "Reference",
                             "bing", "Select", None, "Press_Release"],
                            [0.3, 0.25, 0.15, 0.12, 0.08, 0.004, 0.04, 0.05, 0.006]),
        "Do Not Email": pick(yes_no), "Do Not Call": pick(["No", "No", "Yes", None]),
        "Converted": conv,
        "TotalVisits": visits_txt,
        "Total Time Spent on Website": time_spent,
        "Page Views Per Visit": pages,
        "Last Activity": pick(["Email Opened", "SMS Sent", "Page Visited", None]),
        "Country": pick(["India", "United States", "Singapore", "Kenya", "", "N/A", None],
                        [0.6, 0.08, 0.05, 0.01, 0.06, 0.05, 0.15]),
        "Specialization": pick(["1.Finance Management", "2.Human Resource", "3.Marketing", "Select",
                                "Other", None], [0.2, 0.2, 0.2, 0.2, 0.05, 0.15]),
        "How did you hear about X Education": pick(["Select", "Online Search", "Word Of Mouth", None]),
        "What is your current occupation": pick(["Unemployed", "Working Professional", "Student", None]),
        "What matters most to you in choosing a course": pick(["Better Career Prospects", None]),
        "Search": pick(["No", "No", "No", "Yes"]), "Magazine": "No",
        "Newspaper Article": pick(["No", "Yes"], [0.9, 0.1]),
        "X Education Forums": pick(["No", "Yes"], [0.9, 0.1]),
        "Newspaper": pick(["No", "Yes"], [0.9, 0.1]),
        "Digital Advertisement": pick(["No", "Yes"], [0.9, 0.1]),
        "Through Recommendations": pick(["No", "Yes"], [0.85, 0.15]),
        "Receive More Updates About Our Courses": "No",
        "Tags": pick(["Will revert after reading the email", "Ringing", "Interested in other courses", None]),
        "Lead Quality": pick(["01 High", "02 Medium", "03 Low", "04 Very Low", "Might be", None]),
        "Update me on Supply Chain Content": "No", "Get updates on DM Content": "No",
        "Lead Profile": pick(["Select", "Potential Lead", None]),
        "City": pick(["Mumbai", "Thane & Outskirts", "Other Cities", "Select", None]),
        "Asymmetrique Activity Index": pick(["01.High", "02.Medium", None, None, None]),
        "Asymmetrique Profile Index": pick(["01.High", None, None, None]),
        "Asymmetrique Activity Score": pick([14.0, 15.0, None, None, None]),
        "Asymmetrique Profile Score": pick([15.0, 17.0, None, None, None]),
        "I agree to pay the amount through cheque": "No",
        "A free copy of Mastering The Interview": pick(["No", "Yes"]),
        "Last Notable Activity": pick(["Modified", "Email Opened"]),
    })
    df["Constant Score"] = 7.0
    df["All Null"] = None
    df["Visits Copy"] = pd.to_numeric(df["Total Time Spent on Website"]) * 2.0 + 1.0
    df["convert_flag"] = df["Converted"]
    dup = df.iloc[: n // 20].copy()
    out = pd.concat([df, dup], ignore_index=True)
    for c in out.columns:
        if out[c].dtype == object:
            out[c] = out[c].map(lambda v: None if v is None or (isinstance(v, float) and np.isnan(v)) else str(v))
    return out
