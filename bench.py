"""Bench: run the headline queries on ``$BENCH_SF_DIR`` (default sf0.1) with
``local[$BENCH_CPUS]`` and print ONE JSON line.

Each query's time covers its fit jobs (run while the DataFrame is built) and
the full execution of the result plan through the ``noop`` sink, so no time
goes into shipping rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fitframe.plans.catalog import QUERIES  # noqa: E402
from fitframe.session import build_session  # noqa: E402

HEADLINE = [
    "prep_chain", "impute_median_mode", "iqr_clip", "log_clip", "quantile_bin", "uniform_bin",
    "rare_labels", "describe_numeric", "describe_categorical", "missing_report", "histogram30",
    "one_hot", "target_encode", "standard_scale", "robust_scale", "skew_report", "vif_table",
    "confusion_metrics", "auc_exact", "regression_metrics", "mase", "ks_numeric",
    "wasserstein_numeric", "psi_numeric", "js_categorical", "drift_gate", "dedup", "target_profile",
    "strat_split", "feature_chain", "vif_select", "cluster_kmeans", "rf_importance", "linear_attribution", "rfe_cv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8))
    # warm the JVM (class loading, JIT, codegen caches) by running every
    # headline query once on the smallest tables, untimed
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for n in names:
            QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
