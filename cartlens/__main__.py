"""Command line for the feature, training and scoring jobs.

    python -m cartlens explore      --sessions S --products P --out DIR
    python -m cartlens prepare-data --sessions S --products P --begin 2019.09.01 --end 2021.12.31 --out DIR
    python -m cartlens features-v2  --sessions S --products P --begin 2022-01-01 --end 2022-04-01 --out DIR
    python -m cartlens features-v1  --sessions S --products P [--begin ... --end ...] --out DIR
    python -m cartlens train --sessions S --products P --train B E --val B E [--model-dir DIR] [--out DIR]
    python -m cartlens serve-requests --requests DIR --model-dir DIR --log DIR --checkpoint DIR
    python -m cartlens compare --log DIR [--sessions S --products P] [--out DIR]
    python -m cartlens serve --sessions S --products P --window B E --train B E --model-dir DIR --log DIR

Lines that are no JSON objects are counted on standard error; ``--rejects DIR`` keeps them and
more than ``--max-reject-share`` of an input's lines end the job with status 2.

The session comes from ``SparkSession.builder.getOrCreate()``: under
``spark-submit`` the cluster's settings apply; run directly it is local.
"""

from __future__ import annotations

import argparse
import sys

from cartlens import jobs
from cartlens.sources import sinks as SK


def _session():
    from pyspark.sql import SparkSession
    builder = SparkSession.builder.appName("cartlens")
    try:
        return builder.getOrCreate()
    except Exception:  # noqa: BLE001 - no master configured: run locally
        from cartlens.session import build_session
        return build_session(master="local[*]")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="cartlens",
                                 description="Shop-session analytics jobs on Spark.")
    sub = ap.add_subparsers(dest="cmd", required=True)
    helps = {
        "explore": "write every exploration table as CSV",
        "prepare-data": "final feature job (training set, label last) as CSV",
        "features-v2": "second feature job (user-month spine with label) as CSV",
        "features-v1": "first feature job (user-month spine) as CSV",
        "train": "fit and evaluate the classifiers on time-based windows",
        "serve": "batch A/B scoring with a prediction log",
        "serve-requests": "score and log the request files that arrived since the last call",
        "compare": "compare the two arms over the stored prediction log",
    }
    for name, text in helps.items():
        p = sub.add_parser(name, help=text)
        p.add_argument("--sessions", required=name not in ("compare", "serve-requests"))
        p.add_argument("--products", required=name not in ("compare", "serve-requests"))
        p.add_argument("--format", choices=("json", "parquet"), default="json")
        p.add_argument("--rejects", help="write lines that are no JSON objects here")
        p.add_argument("--max-reject-share", type=float, default=0.01, help="refuse inputs with a larger share of such lines")
        if name == "compare":
            p.add_argument("--log", required=True)
            p.add_argument("--out")
        if name == "serve-requests":
            p.add_argument("--requests", required=True)
            p.add_argument("--model-dir", required=True, help="models that serve has stored")
            p.add_argument("--log", required=True)
            p.add_argument("--checkpoint", required=True)
            p.add_argument("--salt", type=int, default=0)
        if name == "explore":
            p.add_argument("--out", required=True)
            p.add_argument("--test-month", type=int, default=3)
            p.add_argument("--stage-dir", help="parse the JSON once into Parquet here")
        if name in ("prepare-data", "features-v2", "features-v1"):
            p.add_argument("--begin", required=name != "features-v1", default="2022-03-01")
            p.add_argument("--end", required=name != "features-v1", default="2022-05-01")
            p.add_argument("--out", required=True)
        if name == "train":
            p.add_argument("--train", nargs=2, required=True)
            p.add_argument("--val", nargs=2, required=True)
            p.add_argument("--model-dir")
            p.add_argument("--allow-overlap", action="store_true")
            p.add_argument("--out")
        if name == "serve":
            p.add_argument("--window", nargs=2, required=True)
            p.add_argument("--train", nargs=2, required=True)
            p.add_argument("--model-dir", required=True)
            p.add_argument("--log")
            p.add_argument("--salt", type=int, default=0)
    args = ap.parse_args(argv)
    spark = _session()
    found: list[dict] = []
    inputs = {"rejects_path": args.rejects, "max_reject_share": args.max_reject_share, "report": found}
    try:
        _run(spark, args, inputs)
    except jobs.TooManyRejects as err:
        print(f"refused: {err}", file=sys.stderr)
        return 2
    finally:
        for counts in found:
            lost = {k: v for k, v in counts.items() if k.startswith("unparsed_") and v}
            print(f"{counts['table']}: {counts['lines']} lines, {counts['corrupt_lines']} rejected", *[f"{k}={v}" for k, v in lost.items()],
                  file=sys.stderr)
    return 0


def _run(spark, args, inputs: dict) -> None:
    if args.cmd == "explore":
        jobs.explore(spark, args.sessions, args.products, args.test_month, args.out,
                     args.stage_dir, args.format, inputs=inputs)
    elif args.cmd == "prepare-data":
        jobs.prepare_data(spark, args.sessions, args.products, args.begin, args.end, args.out, args.format,
                          inputs=inputs)
    elif args.cmd == "features-v2":
        jobs.prepare_data_v2(spark, args.sessions, args.products, args.begin, args.end, args.out,
                             args.format, inputs=inputs)
    elif args.cmd == "features-v1":
        jobs.prepare_data_v1(spark, args.sessions, args.products, args.begin, args.end, args.out,
                             args.format, inputs=inputs)
    elif args.cmd == "train":
        details: dict = {}
        report = jobs.train_models(spark, args.sessions, args.products, tuple(args.train),
                                   tuple(args.val), model_dir=args.model_dir,
                                   allow_overlap=args.allow_overlap, fmt=args.format, details=details,
                                   inputs=inputs)
        if args.out:
            SK.write_csv(report, args.out)
        report.orderBy("model", "split").show(truncate=False)
        for kind, found in details.items():
            found["confusion"].orderBy("split", "label", "prediction").show()
            print(kind, dict(found["params"]))
    elif args.cmd == "serve":
        scored = jobs.serve_batch(spark, args.sessions, args.products, tuple(args.window),
                                  tuple(args.train), args.model_dir, args.log, args.salt, args.format,
                                  inputs=inputs)
        scored.groupBy("model_type").count().show()
    elif args.cmd == "serve-requests":
        from pyspark.ml import PipelineModel
        models = {arm: PipelineModel.load(f"{args.model_dir}/{arm}") for arm in ("BaseModel", "SecondModel")}
        print(jobs.serve_requests(spark, args.requests, models, args.log, args.checkpoint, args.salt), "batches")
    elif args.cmd == "compare":
        out = jobs.compare_log(spark, args.log, args.sessions, args.products, args.format, inputs=inputs)
        if args.out:
            SK.write_csv(out, args.out)
        out.show(truncate=False)


if __name__ == "__main__":
    sys.exit(main())
