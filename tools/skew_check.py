"""Skew experiment: one user owns a third of the log.

    python tools/skew_check.py [--sf-dir DIR]

Derives a skewed log from the driver tables (every third order is re-assigned
to user 0), then for the per-user ordering operators prints how the hot
user's rows spread over the range partitions, and the wall time of the
headline per-user queries on the skewed and the original log.
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    from pyspark.sql import functions as F

    from cartlens.operators import users as U
    from cartlens.plans import features as C
    from cartlens.session import build_session
    from cartlens.sources.adapters import Tables

    spark = build_session()
    t = Tables(spark, args.sf_dir)
    base = t.line_sessions()
    hot = base.withColumn("user_id", F.when(F.col("session_id") % 3 == 0, F.lit(0))
                          .otherwise(F.col("user_id")))
    products = t.products()

    priced = U.purchase_rows(hot, products)
    nz = priced.where(F.col("purchase") != 0)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["user_id", *U.TREND_ORDER, "purchase"]
    spread = (nz.repartitionByRange(n, *keys).where(F.col("user_id") == 0)
              .groupBy(F.spark_partition_id().alias("p")).count().orderBy("p").collect())
    total_hot = sum(r["count"] for r in spread)
    print(f"hot user rows among non-zero purchases: {total_hot} of {nz.count()}")
    print("hot user rows per range partition:", [(r.p, r["count"]) for r in spread])

    def timed(label, make):
        make().write.format("noop").mode("overwrite").save()  # warm
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return label, round(time.perf_counter() - t0, 2)

    for name, log in (("original", base), ("skewed", hot)):
        res = [timed("training_set_v3", lambda: C.training_set_v3(log, products, "1995-01-01", "2001-12-31")),
               timed("user_features", lambda: U.user_features(U.purchase_rows(log, products))),
               timed("purchase_position", lambda: U.purchase_position(U.purchase_rows(log, products)))]
        print(name, res)


if __name__ == "__main__":
    main()
