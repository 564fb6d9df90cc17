"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver).  A full warm-up
pass over all queries runs first (reported as ``cold``) so JVM start-up,
code generation and Python worker start are not charged; then two timed
passes run and each query reports its faster time (both totals are printed).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "training_set_v3",
    "features_v2",
    "features_v1",
    "user_month_next",
    "spend_more_label",
    "user_features",
    "purchase_position",
    "purchase_prob_by_views",
    "session_summary",
    "purchase_prob_by_duration",
    "missing_fraction",
    "hist_duration",
    "left_join_keys",
    "metric_auc",
    "class_balance",
]


# Model-backed queries (feature job + checkpoint + fit + exact evaluation); timed once after
# the warm passes and reported apart from the headline metric.
MODEL_QUERIES = ["gnb_scores", "logreg_scores", "forest_scores"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from cartlens.session import build_session
    from cartlens.plans.registry import queries

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          conf={"spark.driver.memory": "16g"})
    qs = queries()

    def run_all(names=HEADLINE) -> dict[str, float]:
        times = {}
        for name in names:
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        return times

    cold = run_all()   # first pass: JVM warm-up, code generation, Python workers
    warm1, warm2 = run_all(), run_all()
    best = {k: min(warm1[k], warm2[k]) for k in warm1}   # best of two warm passes
    models = run_all(MODEL_QUERIES)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(best.values()), 3),
                      "unit": "sec", "queries": best, "sf": sf, "cpus": cpus,
                      "warm_pass_totals_sec": [round(sum(warm1.values()), 3),
                                               round(sum(warm2.values()), 3)],
                      "cold_total_sec": round(sum(cold.values()), 3), "cold_queries": cold,
                      "model_queries": models}))
    spark.stop()


if __name__ == "__main__":
    main()
