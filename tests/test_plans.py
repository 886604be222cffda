"""Plan guards over the registered queries: no cross products, no nested-loop
joins, no window without a partition key, and scans read only the columns a
query needs."""

import re

from fitframe.plans import catalog
from tests.conftest import SF

def _window_groups(line: str) -> int:
    """Number of top-level ``[...]`` groups after ``Window`` on a plan line:
    3 = (expressions, partition keys, order), 2 = no partition keys."""
    rest = line.split("Window ", 1)[1]
    depth, groups = 0, 0
    for ch in rest:
        if ch == "[":
            if depth == 0:
                groups += 1
            depth += 1
        elif ch == "]":
            depth -= 1
    return groups


def unpartitioned_windows(plan: str) -> int:
    return sum(1 for line in plan.split("\n") if "Window [" in line and _window_groups(line) < 3)


# ordered over a materialised state of at most rows_per_bucket rows (distinct
# scores or hashes); larger inputs are split into key ranges
BOUNDED_WINDOWS = {"auc_exact", "auc_one_class", "column_permutation"}
MODEL_QUERIES = {"train_models", "rfe_cv", "permutation_importance", "feature_chain", "cluster_kmeans",
                 "rf_importance", "gbt_importance", "linear_attribution"}


def test_registered_query_plans(spark):
    for name, fn in catalog.QUERIES.items():
        if name in MODEL_QUERIES:
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        if name in BOUNDED_WINDOWS:
            assert "Scan ExistingRDD" in plan or "LocalTableScan" in plan, name
        else:
            assert unpartitioned_windows(plan) == 0, name
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0     # nothing stays cached


def test_guard_detects_a_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = spark.range(10).select(F.sum("id").over(Window.orderBy("id")).alias("s"))
    good = spark.range(10).select(F.sum("id").over(Window.partitionBy(F.col("id") % 2).orderBy("id")).alias("s"))
    assert unpartitioned_windows(bad._jdf.queryExecution().executedPlan().toString()) == 1
    assert unpartitioned_windows(good._jdf.queryExecution().executedPlan().toString()) == 0


def test_scan_prunes_columns(spark):
    plan = catalog.QUERIES["iqr_clip"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert schema == "struct<event_id:bigint,value:double>"
