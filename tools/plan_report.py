"""Write the physical plan trees of the headline queries to PLANS.md (generated part).

    python tools/plan_report.py [--sf-dir DIR] > /tmp/plans.txt

For each query: the operator tree of ``explain("formatted")``, the number of
shuffle exchanges, broadcast exchanges, Parquet scans, and the pushed filters
and read schema of every scan.
"""

from __future__ import annotations

import argparse
import io
import re
import sys
from contextlib import redirect_stdout
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

HEADLINE = ["training_set_v3", "features_v2", "user_features", "purchase_position",
            "metric_auc", "purchase_prob_by_views", "split_by_window", "missing_dates"]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from cartlens.session import build_session
    from cartlens.plans.registry import queries
    spark = build_session()
    qs = queries()
    for name in args.names or HEADLINE:
        df = qs[name](spark, args.sf_dir)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n(1)")[0].replace("== Physical Plan ==\n", "")
        shuffles = tree.count("Exchange") - tree.count("BroadcastExchange")
        scans = re.findall(r"Location: InMemoryFileIndex \[[^\]]*/(\w+)\.parquet\]", text)
        pushed = sorted(set(re.findall(r"PushedFilters: (\[.*\])", text)))
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<.*>)", text)))
        print(f"### `{name}`\n")
        print(f"shuffle exchanges: {shuffles}, broadcast exchanges: {tree.count('BroadcastExchange')}, "
              f"scans: {', '.join(scans)}\n")
        print("```\n" + tree.rstrip() + "\n```\n")
        print("pushed filters: " + "; ".join(p for p in pushed if p != "[]") + "\n")
        print("read schemas: " + "; ".join(f"`{s}`" for s in schemas) + "\n")


if __name__ == "__main__":
    main()
