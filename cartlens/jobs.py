"""The reference's entry points as Spark jobs over JSON-lines inputs.

* ``explore``          - the exploration tables (A1-A22, P15, J8), optionally as CSVs;
* ``prepare_data``     - the final feature job (C1), optionally written as CSV;
* ``prepare_data_v2``  - the second feature job (C2);
* ``prepare_data_v1``  - the first feature job (C3);
* ``train_models``     - fit, score and save the classifiers (M3-M9);
* ``serve_batch``      - the scoring service as a batch: arm, predict, log (B1-B3);
* ``compare_log``      - the two arms compared over the stored log (B4).

Every job takes ``inputs``, options of ``load_inputs`` for lines and values that do not parse.
Each job reads the session and product logs with their declared schemas,
builds one Spark plan and writes its result (CSV with header, Spark ML
models, JSON-lines prediction log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens.operators import monthly as M
from cartlens.operators.filters import check_windows
from cartlens.plans import abtest as B
from cartlens.plans import features as C
from cartlens.plans import models as ML
from cartlens.session import cut_lineage
from cartlens.sources import readers as RD
from cartlens.sources import schemas as S
from cartlens.sources import sinks as SK


class TooManyRejects(ValueError):
    """More lines of an input are no rows than the caller allows."""


def load_inputs(spark: SparkSession, sessions_path: str, products_path: str, fmt: str = "json",
                rejects_path: str | None = None, max_reject_share: float | None = None,
                report: list[dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """The two inputs: JSON lines, or (``fmt="parquet"``) tables as ``explore`` stages them.

    Month-partitioned Parquet keeps its partition column, so the jobs' time filters prune it.
    Lines that are no JSON object are no rows.  They are counted before anything else is done,
    together with the values of each column that do not parse; ``report`` gets one dict a table.
    More than ``max_reject_share`` of a table's lines raise ``TooManyRejects``.  With
    ``rejects_path`` the lines are written there (one JSON object with table and line each); as
    they are kept, any share is allowed then unless one is named.  Otherwise it is 0.01.
    """
    if max_reject_share is None:
        max_reject_share = 1.0 if rejects_path else 0.01
    if fmt == "parquet":
        return SK.read_sessions_by_month(spark, sessions_path), spark.read.parquet(products_path)
    if fmt != "json":
        raise ValueError(f"unknown input format {fmt!r}")
    sessions = RD.read_sessions(spark, sessions_path, keep_corrupt=True)
    products = RD.read_products(spark, products_path, keep_corrupt=True)
    bad = F.col(S.CORRUPT)
    if rejects_path:
        lines = [df.where(bad.isNotNull()).select(F.lit(name).alias("table"), bad.alias("line"))
                 for name, df in (("sessions", sessions), ("products", products))]
        lines[0].unionByName(lines[1]).write.mode("overwrite").json(rejects_path)
    for name, path, schema in (("sessions", sessions_path, S.SESSIONS), ("products", products_path, S.PRODUCTS)):
        counts = {"table": name, **RD.parse_report(spark, path, schema).first().asDict()}
        if report is not None:
            report.append(counts)
        if counts["corrupt_lines"] > max_reject_share * counts["lines"]:
            raise TooManyRejects(f"{counts['corrupt_lines']} of {counts['lines']} lines of the {name} are no JSON objects "
                                 f"(at most a share of {max_reject_share} is allowed)")
    return tuple(df.where(bad.isNull()).drop(S.CORRUPT) for df in (sessions, products))


def rejected_lines(spark: SparkSession, rejects_path: str) -> DataFrame:
    """Rejected lines per table."""
    rows = spark.read.schema("table string, line string").json(rejects_path)
    return rows.groupBy("table").agg(F.count("line").alias("lines"))


def _maybe_write(df: DataFrame, out_csv: str | None) -> DataFrame:
    if out_csv:
        SK.write_csv(df, out_csv)
    return df


def explore(spark: SparkSession, sessions_path: str, products_path: str,
            test_month: int = 3, out_dir: str | None = None,
            stage_dir: str | None = None, fmt: str = "json",
            inputs: dict | None = None) -> dict[str, DataFrame]:
    """The exploration tables (the data behind each plot and printed figure).

    Session-level tables use every row; discount and calendar tables use the
    cleaned rows (no missing user or product); per-user features use the
    training part (month != ``test_month``) joined to products.  With
    ``out_dir`` every table is written as CSV under its name.  With
    ``stage_dir`` (a shared folder) the JSON log is parsed once and stored as
    month-partitioned Parquet, which every table then scans (columnar, pruned)
    instead of parsing the JSON again.
    """
    from cartlens.functions.stats import histogram
    from cartlens.operators import filters as P
    from cartlens.operators import joins as J
    from cartlens.operators import sessions as A
    from cartlens.operators import users as U
    from cartlens.sources.readers import profile
    sessions, products = load_inputs(spark, sessions_path, products_path, fmt, **(inputs or {}))
    if stage_dir:
        SK.write_sessions_by_month(sessions, f"{stage_dir}/sessions")
        products.write.mode("overwrite").parquet(f"{stage_dir}/products")
        sessions, products = load_inputs(spark, f"{stage_dir}/sessions", f"{stage_dir}/products", "parquet")
    clean = P.drop_missing(sessions)
    priced = U.purchase_rows(sessions, products)
    train = P.split_by_month(priced, test_month).where(F.col("split") == "train").drop("split")
    extent = A.data_extent(sessions).first()
    tables = {
        "profile": profile(sessions.drop("month_start")),
        "event_type_counts": A.event_type_counts(sessions),
        "purchase_prob_by_views": A.purchase_prob_by_views(sessions),
        "purchase_prob_by_duration": A.purchase_prob_by_duration(sessions),
        "hist_session_products": A.hist_session_products(sessions),
        "hist_duration": A.hist_duration(sessions),
        "product_purchase_dist": A.product_purchase_dist(sessions),
        "best_conversion": A.best_conversion(sessions),
        "missing_fraction": A.missing_fraction(sessions),
        "distinct_counts": A.distinct_counts(clean),
        "discount_counts": A.discount_counts(clean),
        "conversion_by_discount": A.conversion_by_discount(clean),
        "hist_discount": A.hist_discount(clean),
        "hist_user_discount": histogram(U.user_mean_discount(clean), "mean_discount", 10),
        "price_quality": P.price_quality(products),
        "user_features": U.user_features(train),
        "hist_purchase": histogram(priced, "purchase", 10),
        "hist_log_purchase": histogram(priced.withColumn("log_purchase", F.log1p("purchase")),
                                       "log_purchase", 10),
    }
    if extent.first_ts is not None:
        tables["missing_dates"] = J.missing_dates(sessions, extent.first_ts.date(),
                                                  extent.last_ts.date())
    if out_dir:
        for name, df in tables.items():
            SK.write_csv(df, f"{out_dir}/{name}")
    return tables


def prepare_data(spark: SparkSession, sessions_path: str, products_path: str, begin, end,
                 out_csv: str | None = None, fmt: str = "json", inputs: dict | None = None, **options) -> DataFrame:
    """C1 training set for the month starts in [begin, end] (label last)."""
    sessions, products = load_inputs(spark, sessions_path, products_path, fmt, **(inputs or {}))
    return _maybe_write(C.training_set_v3(sessions, products, begin, end, **options), out_csv)


def prepare_data_v2(spark: SparkSession, sessions_path: str, products_path: str, begin, end,
                    out_csv: str | None = None, fmt: str = "json", inputs: dict | None = None) -> DataFrame:
    """User-month spine of the open window (begin, end) with label, deduplicated."""
    sessions, products = load_inputs(spark, sessions_path, products_path, fmt, **(inputs or {}))
    return _maybe_write(C.features_v2(sessions, products, begin, end), out_csv)


def prepare_data_v1(spark: SparkSession, sessions_path: str, products_path: str,
                    begin="2022-03-01", end="2022-05-01", out_csv: str | None = None,
                    fmt: str = "json", inputs: dict | None = None) -> DataFrame:
    """The first feature job (its window was fixed to March-April 2022)."""
    sessions, products = load_inputs(spark, sessions_path, products_path, fmt, **(inputs or {}))
    return _maybe_write(C.features_v1(sessions, products, begin, end), out_csv)


def train_models(spark: SparkSession, sessions_path: str, products_path: str,
                 train: tuple, val: tuple, kinds=("gnb", "logreg", "forest"),
                 model_dir: str | None = None, allow_overlap: bool = False,
                 trees: int = 100, depth: int = 16, fmt: str = "json",
                 details: dict | None = None, inputs: dict | None = None) -> DataFrame:
    """Fit each classifier on the training window, score both windows, optionally save.

    Returns (model, split, rows, accuracy, auc, predicted_positive) plus the
    majority-class baseline.  The forest uses the reference's 100 trees of
    depth 16 unless told otherwise.  ``details``, if given, gets the parameters (M9) and the
    confusion counts (M8) of each model: details[kind] = {"params": ..., "confusion": ...}.
    """
    sessions, products = load_inputs(spark, sessions_path, products_path, fmt, **(inputs or {}))
    data = ML.staged_rows(ML.labelled_splits(sessions, products, ML.Windows(train, val),
                                             allow_overlap=allow_overlap))
    out = None
    for kind in kinds:
        params = {"trees": trees, "depth": depth, "seed": 0} if kind == "forest" else {}
        model = ML.build(kind, **params).fit(data.where(F.col("split") == "train"))
        if model_dir:
            SK.save_model(model, f"{model_dir}/{kind}")
        if details is not None:
            details[kind] = {"params": ML.model_params(model), "confusion": ML.confusion_by_split(model, data, kind)}
        r = ML.evaluate(model, data, kind)
        out = r if out is None else out.unionByName(r)
    from cartlens.plans.metrics import baseline_accuracy
    base = baseline_accuracy(data, by=["split"]).select(
        F.lit("majority").alias("model"), "split", "rows",
        F.col("baseline_accuracy").alias("accuracy"), F.lit(None).cast("double").alias("auc"),
        "predicted_positive")
    return out.unionByName(base) if out is not None else base


def serve_batch(spark: SparkSession, sessions_path: str, products_path: str, window: tuple,
                train_window: tuple, model_dir: str, log_path: str | None = None,
                salt: int = 0, fmt: str = "json", allow_overlap: bool = False,
                inputs: dict | None = None) -> DataFrame:
    """The scoring service as a batch job.

    Requests are the user-months of ``window``; each user gets a stable arm;
    the arm's regressor (loaded from ``model_dir``, or trained on
    ``train_window`` and stored there if absent) predicts the third-month
    spend; randomly assigned rows are appended to the JSON-lines log.  The training rows are
    built only if a model is missing, and the windows must not overlap.
    """
    check_windows(train_window, window, allow_overlap=allow_overlap)
    sessions, products = load_inputs(spark, sessions_path, products_path, fmt, **(inputs or {}))
    built: list[DataFrame] = []

    def train_rows() -> DataFrame:
        if not built:
            built.append(cut_lineage(C.user_month_rows(sessions, products, *train_window, keep_third=True)))
        return built[0]

    base = SK.load_or_train(spark, f"{model_dir}/BaseModel", ML.build_regression("svr"), train_rows)
    second = SK.load_or_train(spark, f"{model_dir}/SecondModel", ML.build_regression("linear"), train_rows)
    # each arm reads the requests: compute them once
    requests = cut_lineage(B.assign_variant(
        C.user_month_rows(sessions, products, *window, keep_third=True), salt))
    scored = cut_lineage(B.score(requests, {"BaseModel": base, "SecondModel": second}))
    if log_path:
        SK.append_prediction_log(B.prediction_log(scored), log_path)
    return scored


def request_schema() -> T.StructType:
    """A request: user_id, the features of the final feature job, and a model name if one is asked for."""
    return T.StructType([T.StructField("user_id", T.LongType()), T.StructField("model_type", T.StringType())]
                        + [T.StructField(c, T.DoubleType()) for c in ML.FEATURES])


def serve_requests(spark: SparkSession, requests_dir: str, models: dict, log_path: str, checkpoint: str, salt: int = 0,
                   files_per_batch: int = 100) -> int:
    """B2/B3 for arriving request files: everything new in ``requests_dir`` is scored and logged.

    A file stream with an available-now trigger: the call ends when all files there are done, and
    the next call goes on behind them (``checkpoint``, a shared folder).  Each batch writes its
    own part of the log in place of what an earlier, killed attempt left there, so every request
    has exactly one log row.  Rows that name no model get the user's arm; requests that name
    one are scored but, as in the service, not logged.  Returns the number of batches.
    """
    done = []

    def write(batch: DataFrame, number: int) -> None:
        asked = batch.withColumn("model_type", F.nullif(F.trim("model_type"), F.lit("")))
        rows = B.prediction_log(B.score(B.assign_variant(asked, salt), models))
        rows.write.mode("overwrite").json(f"{log_path}/batch={number}")
        done.append(number)

    requests = spark.readStream.schema(request_schema()).option("maxFilesPerTrigger", files_per_batch).json(requests_dir)
    query = (requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(done)


def compare_log(spark: SparkSession, log_path: str, sessions_path: str | None = None, products_path: str | None = None,
                fmt: str = "json", replicates: int = 200, seed: int = 0, inputs: dict | None = None) -> DataFrame:
    """B4 over the stored prediction log.

    With the session and product logs every prediction meets the user's later third-month spend
    (as-of join): requests, matched and still pending ones, errors and a bootstrap interval per
    arm.  Without them there is no actual value: requests and mean prediction only.
    """
    log = SK.read_prediction_log(spark, log_path)
    if sessions_path is None or products_path is None:
        return B.compare_arms(log)
    sessions, products = load_inputs(spark, sessions_path, products_path, fmt, **(inputs or {}))
    nexts = M.user_month_next(M.user_month_facts(sessions, products))
    return B.compare_log(B.with_actual(log, nexts, B.last_month(sessions)), replicates, seed)
