"""Headline timings: prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)

Each query is run once to completion into a sink that keeps nothing.  Models
are fitted inside the timing; nothing is taken from an earlier query.  A few
queries on the smallest tables start the JVM and the Python workers first.
"""

from __future__ import annotations

import json
import os
import time

from panelcast.plans import all_queries
from panelcast.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
QUERIES = (
    # facts to panel, calendar, scaling, features
    "panel_from_facts", "calendar_spine", "forward_fill", "robust_scale_transform", "holdout_split", "lag_features",
    "dq_gate",
    # recursion and evaluation on the supplier panel
    "hw_fitted", "hw_forecast", "evaluate_models", "best_model", "export_fits_wide", "running_abs_pct_error",
    # grouped sums with a small solve
    "ar_fit", "ar_interval", "ar_search", "bayes_fit", "regress_exog",
    # state space
    "kf_local_level", "kf_smoother", "kf_filter", "decompose_sum",
    # searches on the priority panel, fitted inside the timing
    "ets_fit", "arima_fit", "prophet_fit", "svr_fit", "mlp_fit", "rf_fit",
    # streaming
    "stream_bucket", "stream_kf_update",
)


def main() -> None:
    spark = local_session(CPUS, "bench")
    queries = all_queries()
    small = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.001")
    for name in ("best_model", "ar_search", "ets_fit") if os.path.isdir(small) else ():
        queries[name](spark, small).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in QUERIES:
        started = time.perf_counter()
        queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": FOLDER.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
