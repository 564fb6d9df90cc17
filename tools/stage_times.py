"""Per-stage task statistics of one query from Spark's event log.

    python tools/stage_times.py QUERY [--sf-dir DIR] [--skewed]

Runs the registered query (or, with ``--skewed``, the per-user operators on a
log where one user owns a third of the rows) with the event log written to a
fresh scratch folder, then prints for every stage: tasks, max and median task
run time, and max and median records read per task (input plus shuffle).
A balanced stage has max close to median.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _summarise(log_dir: str) -> None:
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(f)]
    stages = defaultdict(list)
    names = {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    names[info["Stage ID"]] = info.get("Stage Name", "")[:60]
                elif kind == "SparkListenerTaskEnd" and "Task Metrics" in ev:
                    m = ev["Task Metrics"]
                    recs = m.get("Input Metrics", {}).get("Records Read", 0) + \
                        m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    stages[ev["Stage ID"]].append((m.get("Executor Run Time", 0), recs))
    print(f"{'stage':>5} {'tasks':>5} {'max ms':>7} {'med ms':>7} {'max rec':>9} {'med rec':>9}  name")
    for sid in sorted(stages):
        ts = stages[sid]
        run = [t for t, _ in ts]
        rec = [r for _, r in ts]
        print(f"{sid:>5} {len(ts):>5} {max(run):>7} {int(statistics.median(run)):>7} "
              f"{max(rec):>9} {int(statistics.median(rec)):>9}  {names.get(sid, '')}")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("query")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--skewed", action="store_true")
    args = ap.parse_args()
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    from pyspark.sql import functions as F

    from cartlens.session import build_session
    spark = build_session(conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                "spark.eventLog.compress": "false",
                                "spark.eventLog.rolling.enabled": "false"})
    if args.skewed:
        from cartlens.operators import users as U
        from cartlens.plans import features as C
        from cartlens.sources.adapters import Tables
        t = Tables(spark, args.sf_dir)
        log = t.line_sessions().withColumn(
            "user_id", F.when(F.col("session_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
        build = {"purchase_position": lambda: U.purchase_position(U.purchase_rows(log, t.products())),
                 "user_features": lambda: U.user_features(U.purchase_rows(log, t.products())),
                 "training_set_v3": lambda: C.training_set_v3(log, t.products(), "1995-01-01",
                                                              "2001-12-31")}[args.query]
        df = build()
    else:
        from cartlens.plans.registry import queries
        df = queries()[args.query](spark, args.sf_dir)
    df.write.format("noop").mode("overwrite").save()
    spark.stop()
    print(f"event log: {log_dir}")
    _summarise(log_dir)


if __name__ == "__main__":
    main()
