"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the adapters and runs over the
whole tables.  ``present`` gives results a hash-stable form shared with the
oracle SQL (plans/oracle.py): timestamps and dates as text, doubles rounded to
6 places, decimals (money) rounded to 6 places as doubles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens.functions import timefeat as tf
from cartlens.functions.stats import histogram
from cartlens.operators import filters as P
from cartlens.operators import joins as J
from cartlens.operators import monthly as M
from cartlens.operators import sessions as A
from cartlens.operators import sketches as K
from cartlens.operators import users as U
from cartlens.plans import abtest as B
from cartlens.plans import features as C
from cartlens.plans import metrics as X
from cartlens.plans import models as ML
from cartlens.plans import search as SE
from cartlens.plans import stored_facts as ST
from cartlens.sources import variants as V
from cartlens.sources.adapters import Tables
from cartlens.session import checkpoint_dir, cut_lineage
from cartlens.sources.readers import preview, profile

# Fixed parameters of the registered queries (the [L] log spans 1995-01 .. 2001-11).
SPAN = ("1995-01-01", "2001-12-31")
TRAIN = ("1996-01-01", "1999-10-31")
VAL = ("2000-01-01", "2000-12-31")
V2_WINDOW = ("1997-11-01", "1998-02-01")
V1_WINDOW = ("1997-03-01", "1997-05-01")
OPEN_WINDOW = ("1996-03-01", "1996-05-01")
YEAR_SPEND_WINDOW = ("1997-01-01", "1998-12-31")
SPINE_WINDOW = ("1996-01-01", "1996-12-31")
EVENTS_DAYS = ("2024-01-01", "2024-01-31")
MONTH = (1996, 3)
TEST_MONTH = 3
USER = 7
PRODUCT = 7
RULE_THRESHOLD = 0.0
AB_SALT = 0

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_FORMAT)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.DecimalType):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _q(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(Tables(spark, sf_dir)))
    run.__doc__ = fn.__doc__
    run.__name__ = fn.__name__
    return run


def _clean(t: Tables) -> DataFrame:
    return P.drop_missing(t.line_sessions(inject_nulls=True))


def _priced(t: Tables) -> DataFrame:
    return U.purchase_rows(t.line_sessions(), t.products())


def _train_part(t: Tables) -> DataFrame:
    return P.split_by_month(_priced(t), TEST_MONTH).where(F.col("split") == "train").drop("split")


def _splits(t: Tables) -> DataFrame:
    return ML.labelled_splits(t.line_sessions(), t.products(), ML.Windows(TRAIN, VAL))


def _rule(df: DataFrame) -> DataFrame:
    score = F.col("spent_money_second_month") - F.col("spent_money_first_month")
    return df.withColumn("score", score).withColumn(
        "prediction", (score > F.lit(RULE_THRESHOLD)).cast("int"))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- sources
@query("scan_sessions")
def _scan_sessions(t):
    return t.line_sessions()


@query("scan_products")
def _scan_products(t):
    return t.products()


@query("profile_sessions")
def _profile_sessions(t):
    return profile(t.events_sessions())


@query("preview_sessions")
def _preview_sessions(t):
    return preview(t.events_sessions(), 5, ["timestamp", "session_id", "product_id", "event_type",
                                            "offered_discount", "purchase_id"])


@query("variant_fields")
def _variant_fields(t):
    # Events as JSON lines without a schema; every tenth event writes its user as text.
    user = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(
        F.col("user_id").cast("string"))
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "user_id": '), user,
                    F.lit(', "event_type": "'), "event_type", F.lit('", "props": '), "props", F.lit("}"))
    return V.field_report(V.parse_variants(t.table("events").select(line.alias("value"))))


# ---------------------------------------------------------------- projections / filters
@query("session_price_projection")
def _session_price_projection(t):
    return P.select_columns(J.with_price(t.line_sessions(), t.products(), "inner"))


@query("rename_columns")
def _rename_columns(t):
    d = A.session_duration(t.line_sessions())
    return P.rename(d, {"seconds_mod_day": "time_diff"}).select("session_id", "time_diff")


@query("drop_columns")
def _drop_columns(t):
    return P.drop_columns(tf.time_parts(t.line_sessions()), ["timestamp", "purchase_id", "date", "time"])


@query("filter_buys")
def _filter_buys(t):
    return P.filter_event(t.line_sessions())


@query("filter_time_open")
def _filter_time_open(t):
    return P.filter_between(t.line_sessions(), *OPEN_WINDOW)


@query("filter_month")
def _filter_month(t):
    return P.filter_month(t.line_sessions(), *MONTH)


@query("drop_missing_sessions")
def _drop_missing_sessions(t):
    return _clean(t)


@query("rows_missing_product")
def _rows_missing_product(t):
    return P.rows_missing(t.line_sessions(inject_nulls=True), "product_id")


@query("encode_event_type")
def _encode_event_type(t):
    return P.map_values(t.line_sessions())


@query("purchase_value")
def _purchase_value(t):
    return _priced(t)


@query("fill_zero")
def _fill_zero(t):
    # One scan: buys are NULL for user-months without a buy, then filled with 0.
    s = t.line_sessions().where(F.col("user_id").isNotNull())
    per = s.groupBy("user_id", F.year("timestamp").alias("year"), F.month("timestamp").alias("month")).agg(
        F.count(F.lit(1)).alias("all_events_month"),
        F.sum(F.when(F.col("event_type") == "BUY_PRODUCT", F.lit(1))).cast("bigint").alias(
            "buying_events_month"))
    return P.fill_zero(per, ["buying_events_month"])


@query("split_by_month")
def _split_by_month(t):
    return P.split_by_month(_priced(t), TEST_MONTH)


@query("split_by_window")
def _split_by_window(t):
    return _splits(t)


@query("user_history")
def _user_history(t):
    return P.user_history(t.line_sessions(), USER)


@query("product_lookup")
def _product_lookup(t):
    return P.product_lookup(t.products(), PRODUCT)


@query("price_quality")
def _price_quality(t):
    return P.price_quality(t.products())


@query("missing_purchase_views")
def _missing_purchase_views(t):
    return P.missing_purchase_among_views(t.line_sessions())


# ---------------------------------------------------------------- joins
@query("sessions_with_price")
def _sessions_with_price(t):
    return J.with_price(t.line_sessions(), t.products(), "inner")


@query("deals")
def _deals(t):
    return J.deals(t.line_sessions(inject_nulls=True), t.products())


@query("left_join_keys")
def _left_join_keys(t):
    # Every attached aggregate derives from the user-month table, which one exchange on the user deals out.
    facts = M.user_month_facts(t.line_sessions(), t.products())
    return J.with_user_totals(M.with_calendar(facts))


@query("user_month_next")
def _user_month_next(t):
    nxt = M.user_month_next(M.user_month_facts(t.line_sessions(), t.products()))
    return M.with_calendar(nxt).drop("month_idx", "window_buys")


def _stored(t) -> DataFrame:
    """The facts of the whole log as a bucketed table in the checkpoint folder."""
    name = f"cartlens_facts_{uuid.uuid4().hex}"
    facts = M.user_month_facts(t.line_sessions(), t.products())
    ST.store_facts(facts, name, f"{checkpoint_dir(t.spark)}/{name}", buckets=8)
    return t.spark.table(name)


@query("stored_left_join_keys")
def _stored_left_join_keys(t):
    return J.with_user_totals(M.with_calendar(_stored(t)))


@query("stored_user_month_next")
def _stored_user_month_next(t):
    return M.with_calendar(M.user_month_next(_stored(t))).drop("month_idx", "window_buys")


@query("user_month_spine")
def _user_month_spine(t):
    return J.user_month_spine(t.line_sessions(), *SPINE_WINDOW).drop("month_idx")


@query("session_summary")
def _session_summary(t):
    return A.session_summary(t.events_sessions())


@query("user_features")
def _user_features(t):
    return U.user_features(_train_part(t))


@query("missing_dates")
def _missing_dates(t):
    return J.missing_dates(t.line_sessions(), *SPAN)


# ---------------------------------------------------------------- aggregations
@query("event_type_counts")
def _event_type_counts(t):
    return A.event_type_counts(t.events_sessions())


@query("discount_counts")
def _discount_counts(t):
    return A.discount_counts(_clean(t))


@query("session_product_count")
def _session_product_count(t):
    return A.session_product_count(t.events_sessions())


@query("session_outcome")
def _session_outcome(t):
    return A.session_outcome(t.events_sessions())


@query("purchase_prob_by_views")
def _purchase_prob_by_views(t):
    return A.purchase_prob_by_views(t.events_sessions())


@query("session_duration")
def _session_duration(t):
    return A.session_duration(t.events_sessions())


@query("duration_outcome")
def _duration_outcome(t):
    return A.duration_outcome(t.events_sessions())


@query("purchase_prob_by_duration")
def _purchase_prob_by_duration(t):
    return A.purchase_prob_by_duration(t.events_sessions(), 10)


@query("product_purchase_dist")
def _product_purchase_dist(t):
    return A.product_purchase_dist(t.line_sessions())


@query("product_conversion")
def _product_conversion(t):
    return A.product_conversion(t.line_sessions())


@query("best_conversion")
def _best_conversion(t):
    return A.best_conversion(t.line_sessions())


@query("missing_fraction")
def _missing_fraction(t):
    return A.missing_fraction(t.line_sessions(inject_nulls=True))


@query("distinct_counts")
def _distinct_counts(t):
    return A.distinct_counts(P.drop_missing(t.events_sessions()))


@query("distinct_periods")
def _distinct_periods(t):
    return A.distinct_periods(_clean(t))


@query("distinct_running")
def _distinct_running(t):
    # Users, sessions and products of every three months in a row, from one pass over the log.
    return K.distinct_running(cut_lineage(K.month_sketches(t.line_sessions())), 3)


@query("data_extent")
def _data_extent(t):
    return A.data_extent(t.events_sessions())


@query("hist_session_products")
def _hist_session_products(t):
    return A.hist_session_products(t.events_sessions(), 10)


@query("hist_duration")
def _hist_duration(t):
    return A.hist_duration(t.events_sessions(), 10)


@query("hist_discount")
def _hist_discount(t):
    return A.hist_discount(_clean(t), 20)


@query("hist_user_discount")
def _hist_user_discount(t):
    return histogram(U.user_mean_discount(_clean(t)), "mean_discount", 10)


@query("hist_purchase")
def _hist_purchase(t):
    return histogram(_priced(t), "purchase", 10)


@query("hist_log_purchase")
def _hist_log_purchase(t):
    return histogram(_priced(t).withColumn("log_purchase", F.log1p("purchase")), "log_purchase", 10)


@query("conversion_by_discount")
def _conversion_by_discount(t):
    return A.conversion_by_discount(_clean(t))


@query("user_mean_discount")
def _user_mean_discount(t):
    return U.user_mean_discount(_train_part(t))


@query("user_total_spend")
def _user_total_spend(t):
    return U.user_total_spend(_train_part(t))


@query("user_corr_discount")
def _user_corr_discount(t):
    return U.user_corr_discount(_train_part(t))


@query("user_spending_trend")
def _user_spending_trend(t):
    return U.user_spending_trend(_train_part(t))


@query("user_trend_order2")
def _user_trend_order2(t):
    # Money over small whole numbers often ends in a 5 at the seventh place: round the last bits off first.
    trend = U.user_spending_trend(_train_part(t), order=2)
    return trend.withColumn("spending_trend", F.round("spending_trend", 9))


@query("user_trend_order3")
def _user_trend_order3(t):
    # Money over small whole numbers often ends in a 5 at the seventh place: round the last bits off first.
    trend = U.user_spending_trend(_train_part(t), order=3)
    return trend.withColumn("spending_trend", F.round("spending_trend", 9))


@query("user_month_buys")
def _user_month_buys(t):
    return M.user_month_buys(t.line_sessions())


@query("user_month_events")
def _user_month_events(t):
    return M.user_month_events(t.line_sessions())


@query("user_year_activity")
def _user_year_activity(t):
    return M.user_year_activity(t.line_sessions())


@query("user_month_spend")
def _user_month_spend(t):
    return M.user_month_spend(t.line_sessions(), t.products())


@query("user_year_spend")
def _user_year_spend(t):
    return M.user_year_spend(t.line_sessions(), t.products(), *YEAR_SPEND_WINDOW)


@query("two_month_average")
def _two_month_average(t):
    return M.spend_more_label(t.line_sessions(), t.products()).select(
        "user_id", "year", "month", "two_month_average")


@query("spend_more_label")
def _spend_more_label(t):
    return M.spend_more_label(t.line_sessions(), t.products())


@query("class_balance")
def _class_balance(t):
    return X.baseline_accuracy(_splits(t), by=["split"]).select("split", "rows", "positive_share")


# ---------------------------------------------------------------- composite jobs
@query("training_set_v3")
def _training_set_v3(t):
    return C.training_set_v3(t.line_sessions(), t.products(), *SPAN)


@query("features_v2")
def _features_v2(t):
    return C.features_v2(t.line_sessions(), t.products(), *V2_WINDOW)


@query("features_v1")
def _features_v1(t):
    return C.features_v1(t.line_sessions(), t.products(), *V1_WINDOW)


# ---------------------------------------------------------------- windows / sets
@query("purchase_position")
def _purchase_position(t):
    return U.purchase_position(_train_part(t))


def _yearly(t, dedupe: bool) -> list[DataFrame]:
    """The feature job of every year of the log, computed in one pass over it."""
    windows = {str(y): (f"{y}-01-01", f"{y}-12-31") for y in range(int(SPAN[0][:4]), int(SPAN[1][:4]) + 1)}
    rows = cut_lineage(C.training_sets(t.line_sessions(), t.products(), windows, dedupe=dedupe))
    return [rows.where(F.col("split") == y).drop("split") for y in windows]


@query("union_months")
def _union_months(t):
    return M.union_months(*_yearly(t, dedupe=True))


@query("dedupe_features")
def _dedupe_features(t):
    return M.dedupe(M.union_months(*_yearly(t, dedupe=False)))


@query("date_difference")
def _date_difference(t):
    return J.date_difference(t.events_sessions(), *EVENTS_DAYS)


# ---------------------------------------------------------------- scalar functions
@query("time_parts")
def _time_parts(t):
    return tf.time_parts(t.events_sessions()).select(
        "session_id", "timestamp", "date", "time", "day", "month", "year", "hour", "weekday")


@query("cyclic_hour")
def _cyclic_hour(t):
    s = t.events_sessions()
    sin, cos = tf.cyclic_hour("timestamp", 23.0)
    return s.select("session_id", "timestamp", F.hour("timestamp").alias("hour"),
                    sin.alias("hour_sin"), cos.alias("hour_cos"))


@query("cyclic_month")
def _cyclic_month(t):
    s = t.line_sessions()
    sin, cos = tf.cyclic_month(F.month("timestamp"))
    return s.select("session_id", "product_id", F.month("timestamp").alias("month"),
                    sin.alias("month_sin"), cos.alias("month_cos"))


@query("cyclic_day")
def _cyclic_day(t):
    s = t.events_sessions()
    wd = tf.weekday_sunday0("timestamp")
    wsin, wcos = tf.cyclic(wd, 7.0)
    dsin, dcos = tf.cyclic(F.dayofmonth("timestamp"), 31.0)
    return s.select("session_id", "timestamp", wd.alias("weekday"), wsin.alias("weekday_sin"),
                    wcos.alias("weekday_cos"), F.dayofmonth("timestamp").alias("day"),
                    dsin.alias("day_sin"), dcos.alias("day_cos"))


@query("parse_text_time")
def _parse_text_time(t):
    """the text form of each event time, and of each day, parsed back."""
    text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    return t.events_sessions().select(
        "session_id", tf.parse_timestamp(text, "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        tf.parse_date(F.date_format("timestamp", "yyyy-MM-dd")).alias("parsed_date"),
        tf.parse_timestamp("event_type", "yyyy-MM-dd HH:mm:ss").alias("not_a_time"))


@query("month_range")
def _month_range(t):
    """events per month start of the span (0 where a month has none)."""
    seen = t.line_sessions().select(tf.month_idx().alias("month_idx")).groupBy("month_idx").agg(
        F.count(F.lit(1)).alias("rows"))
    return (tf.month_starts(t.spark, *SPAN).join(seen, "month_idx", "left")
            .select("month_start", F.coalesce("rows", F.lit(0)).alias("rows")))


@query("month_steps")
def _month_steps(t):
    months = t.line_sessions().select(F.trunc(F.to_date("timestamp"), "MM").alias("month_start")).distinct()
    return months.select("month_start", tf.next_month_start("month_start", 1).alias("next_month"),
                         tf.next_month_start("month_start", 2).alias("third_month"))


# ---------------------------------------------------------------- models
@query("feature_label_rows")
def _feature_label_rows(t):
    return _splits(t).where(F.col("split") == "train").select(*C.V3_COLUMNS)


@query("baseline_accuracy")
def _baseline_accuracy(t):
    return X.baseline_accuracy(_splits(t), by=["split"]).drop("predicted_positive")


@query("gnb_class_stats")
def _gnb_class_stats(t):
    return ML.class_stats(_splits(t).where(F.col("split") == "train"))


@query("gnb_scores")
def _gnb_scores(t):
    return ML.fit_and_score(_splits(t), "gnb")


@query("logreg_scores")
def _logreg_scores(t):
    return ML.fit_and_score(_splits(t), "logreg")


@query("logit_scores")
def _logit_scores(t):
    return ML.fit_and_score(_splits(t), "logit")


@query("forest_scores")
def _forest_scores(t):
    return ML.fit_and_score(_splits(t), "forest", trees=100, depth=16, seed=0)


@query("metric_accuracy")
def _metric_accuracy(t):
    return X.accuracy(_rule(_splits(t)), by=["split"])


@query("metric_auc")
def _metric_auc(t):
    return X.auc(_rule(_splits(t)), by=["split"])


@query("metric_confusion")
def _metric_confusion(t):
    return X.confusion(_rule(_splits(t)).where(F.col("split") == "val"))


@query("model_selection")
def _model_selection(t):
    return ML.model_selection(_splits(t))


@query("model_search")
def _model_search(t):
    return SE.report(t.spark, SE.search(_splits(t), trials=10, seed=0))


@query("spend_regression")
def _spend_regression(t):
    return ML.spend_regression(t.line_sessions(), t.products(), ML.Windows(TRAIN, VAL))


@query("svr_scores")
def _svr_scores(t):
    return ML.spend_regression(t.line_sessions(), t.products(), ML.Windows(TRAIN, VAL), kind="svr")


@query("scale_features")
def _scale_features(t):
    return ML.scale_features(_splits(t).where(F.col("split") == "train"))


# ---------------------------------------------------------------- A/B scoring
def _requests(t) -> DataFrame:
    rows = ML.regression_rows(t.line_sessions(), t.products(), ML.Windows(TRAIN, VAL))
    return B.assign_variant(rows.where(F.col("split") == "val"), AB_SALT)


@query("ab_assign")
def _ab_assign(t):
    users = t.line_sessions().where(F.col("user_id").isNotNull()).select("user_id").distinct()
    return B.assign_variant(users, AB_SALT).select("user_id", "model_type")


@query("ab_score")
def _ab_score(t):
    rows = cut_lineage(ML.regression_rows(t.line_sessions(), t.products(), ML.Windows(TRAIN, VAL)))
    train = rows.where(F.col("split") == "train")
    linear = ML.build_regression().fit(train)
    nonlinear = ML.build_regression("svr").fit(train)
    req = B.assign_variant(rows.where(F.col("split") == "val"), AB_SALT)
    # The service's names are crossed: 'BaseModel' ran the non-linear model (B2).
    scored = B.score(req, {"BaseModel": nonlinear, "SecondModel": linear})
    return scored.select("user_id", "year", "model_type", "prediction", "spend_third")


@query("ab_compare")
def _ab_compare(t):
    req = _requests(t)
    pred = F.when(F.col("model_type") == "BaseModel", F.col("spent_money_second_month")).otherwise(
        (F.col("spent_money_first_month") + F.col("spent_money_second_month")) / 2)
    return B.compare_arms(req.withColumn("prediction", pred), actual="spend_third")


@query("ab_log_compare")
def _ab_log_compare(t):
    # The log of the rule scores: written on the 5th of the month after the two feature months, by
    # every fifth user two months later still.
    req = _requests(t)
    pred = F.when(F.col("model_type") == "BaseModel", F.col("spent_money_second_month")).otherwise(
        (F.col("spent_money_first_month") + F.col("spent_money_second_month")) / 2)
    month = F.col("month_idx") + 2 + F.when(F.col("user_id") % 5 == 0, 2).otherwise(0)
    time = F.date_format(F.date_add(tf.month_start_of_idx(month), 4), tf.PREDICTION_TIME_FORMAT)
    log = req.select(time.alias("prediction_time"), "model_type", pred.alias("prediction"), "user_id")
    sessions = t.line_sessions()
    nexts = M.user_month_next(M.user_month_facts(sessions, t.products()))
    return B.compare_log(B.with_actual(log, nexts, B.last_month(sessions)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(fn) for name, fn in QUERIES.items()}


SURVEY_IDS: dict[str, tuple[str, ...]] = {
    "S1": ("scan_sessions",), "S3": ("variant_fields",), "S2": ("scan_products",), "S7": ("profile_sessions",),
    "S8": ("preview_sessions",),
    "P1": ("session_price_projection",), "P2": ("rename_columns",), "P3": ("drop_columns",),
    "P4": ("filter_buys",), "P5": ("filter_time_open",), "P6": ("filter_month",),
    "P7": ("drop_missing_sessions",), "P8": ("rows_missing_product",),
    "P9": ("encode_event_type",), "P10": ("purchase_value",), "P11": ("fill_zero",),
    "P12": ("split_by_month",), "P13": ("split_by_window",), "P14": ("user_history",),
    "P15": ("product_lookup", "price_quality"), "P16": ("missing_purchase_views",),
    "J1": ("sessions_with_price",), "J2": ("deals",), "J3": ("left_join_keys", "stored_left_join_keys"),
    "J4": ("user_month_next", "stored_user_month_next"), "J5": ("user_month_spine",), "J6": ("session_summary",),
    "J7": ("user_features",), "J8": ("missing_dates",),
    "A1": ("event_type_counts",), "A2": ("discount_counts",), "A3": ("session_product_count",),
    "A4": ("session_outcome",), "A5": ("purchase_prob_by_views",), "A6": ("session_duration",),
    "A7": ("duration_outcome",), "A8": ("purchase_prob_by_duration",),
    "A9": ("product_purchase_dist",), "A10": ("product_conversion", "best_conversion"),
    "A11": ("missing_fraction",), "A12": ("distinct_counts", "distinct_running"), "A13": ("distinct_periods",),
    "A14": ("data_extent",),
    "A15": ("hist_session_products", "hist_duration", "hist_discount", "hist_user_discount",
            "hist_purchase"),
    "A16": ("hist_log_purchase",), "A17": ("conversion_by_discount",),
    "A18": ("user_mean_discount",), "A19": ("user_total_spend",), "A20": ("user_corr_discount",),
    "A21": ("user_spending_trend", "user_trend_order2", "user_trend_order3"), "A22": ("user_features",), "A23": ("user_month_buys",),
    "A24": ("user_month_events",), "A25": ("user_year_activity",), "A26": ("user_month_spend",),
    "A27": ("user_year_spend",), "A28": ("two_month_average",), "A29": ("spend_more_label",),
    "A30": ("class_balance",),
    "C1": ("training_set_v3",), "C2": ("features_v2",), "C3": ("features_v1",),
    "W1": ("purchase_position",), "W2": ("user_month_next",),
    "O1": ("duration_outcome",), "O2": ("preview_sessions",), "O3": ("best_conversion",),
    "U1": ("union_months",), "U2": ("dedupe_features",), "U3": ("date_difference",),
    "F1": ("parse_text_time",), "F2": ("time_parts",), "F3": ("time_parts",), "F4": ("cyclic_hour",),
    "F5": ("cyclic_month",), "F6": ("cyclic_day",), "F7": ("hist_log_purchase",),
    "F8": ("session_duration",), "F9": ("month_steps",), "F10": ("month_range",),
    "F11": ("missing_dates",), "F13": ("ab_assign",),
    "M1": ("feature_label_rows",), "M2": ("baseline_accuracy",),
    "M3": ("gnb_class_stats", "gnb_scores"), "M4": ("logreg_scores", "logit_scores"), "M5": ("forest_scores",),
    "M6": ("metric_accuracy",), "M7": ("metric_auc",), "M8": ("metric_confusion",),
    "M10": ("model_selection", "model_search"), "M11": ("spend_regression", "svr_scores"), "M12": ("scale_features",),
    "B1": ("ab_assign",), "B2": ("ab_score",), "B4": ("ab_compare", "ab_log_compare"),
}

# Operators the survey checks with pytest only ([F] T): id -> test module::function.
SURVEY_TESTS: dict[str, str] = {
    "S4": "test_sources_sinks.py::test_csv_roundtrip",
    "S5": "test_sources_sinks.py::test_prediction_log_append",
    "S6": "test_sources_sinks.py::test_model_save_load_and_broken_path",
    "F12": "test_functions.py::test_prediction_time_format",
    "M9": "test_sources_sinks.py::test_model_params_listed",
    "B3": "test_sources_sinks.py::test_prediction_log_append",
}
