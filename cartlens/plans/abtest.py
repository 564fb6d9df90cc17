"""The scoring service re-aimed as a batch job.

Instead of an HTTP request picking a model with ``random.randint``, every
request row gets a reproducible arm from a hash of its user id, both arms
score their rows (Spark ML pipelines), and the prediction log is appended as
JSON lines.  ``compare_arms`` is the analysis the log exists for.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.functions.timefeat import PREDICTION_TIME_FORMAT, arm_of, month_idx, now_formatted, parse_timestamp
from cartlens.session import cut_lineage

# The arm names of the scoring service.
ARMS = ("BaseModel", "SecondModel")


def assign_variant(df: DataFrame, salt: int = 0, out: str = "model_type") -> DataFrame:
    """B1: a stable arm per user (rows that already name a model keep it)."""
    arm = F.when(arm_of("user_id", salt) == 0, F.lit(ARMS[0])).otherwise(F.lit(ARMS[1]))
    if out in df.columns:
        return df.withColumn("randomly_assigned", F.col(out).isNull()).withColumn(
            out, F.coalesce(F.col(out), arm))
    return df.withColumn(out, arm).withColumn("randomly_assigned", F.lit(True))


def score(df: DataFrame, models: dict[str, PipelineModel], arm_col: str = "model_type") -> DataFrame:
    """B2: each row through its arm's model, then one union; no row is lost.

    The first model of ``models`` takes the rows that name it; every other name, an unknown
    one or NULL included, goes to the last model, as in the scoring service.  Narrow filters,
    no shuffle; each model sees only its own rows.
    """
    out, last = None, list(models)[-1]
    named = F.coalesce(F.col(arm_col).isin([m for m in models if m != last]), F.lit(False))
    for name, model in models.items():
        mine = F.col(arm_col) == name if name != last else ~named
        part = model.transform(df.where(mine))
        keep = [c for c in df.columns] + ["prediction"]
        part = part.select(*keep)
        out = part if out is None else out.unionByName(part)
    return out


def prediction_log(scored: DataFrame, only_random: bool = True) -> DataFrame:
    """Rows of the prediction log (prediction_time, model_type, prediction, user_id)."""
    rows = scored.where(F.col("randomly_assigned")) if only_random else scored
    return rows.select(now_formatted().alias("prediction_time"), "model_type",
                       F.col("prediction").cast("double").alias("prediction"),
                       F.col("user_id").cast("bigint").alias("user_id"))


def compare_arms(log: DataFrame, actual: str | None = None) -> DataFrame:
    """Per arm: requests, mean prediction and (with the actual value) mean absolute error."""
    aggs = [F.count(F.lit(1)).alias("requests"), F.avg("prediction").alias("mean_prediction")]
    if actual is not None:
        aggs.append(F.avg(F.abs(F.col("prediction") - F.col(actual))).alias("mae"))
    return log.groupBy("model_type").agg(*aggs)


# -- B4 over the stored log: what was spent later -------------------------------

MICRO = 1_000_000


def last_month(sessions: DataFrame) -> int | None:
    """Month number of the newest event (one row comes to the driver)."""
    return sessions.agg(F.max(month_idx())).first()[0]


def with_actual(log: DataFrame, nexts: DataFrame, known_month: int | None) -> DataFrame:
    """Each logged prediction with the third-month spend of the user's last purchase month before it.

    An as-of join: a prediction made in month t is about the latest month m <= t - 2 in which the
    user bought (its features are complete then), and ``actual`` is the user's spend in m + 2.
    ``nexts`` is ``monthly.user_month_next`` of the facts.  ``actual`` is NULL where the user has no
    such month, where the time does not parse, or where m + 2 lies after ``known_month``, the last
    month of the data (``pending``).

    Only the distinct (user, month) of the log meet the facts in the window, so a user costs its
    months there and a user with many predictions is a plain join key.
    """
    rows = log.withColumn("_at", month_idx(parse_timestamp("prediction_time", PREDICTION_TIME_FORMAT)))
    asked = rows.where("user_id IS NOT NULL AND _at IS NOT NULL").select("user_id", "_at").distinct()
    none = F.lit(None).cast("struct<month:int,spend:decimal(38,6)>")
    facts = nexts.where("buys > 0").select("user_id", (F.col("month_idx") + 2).alias("_at"), F.struct(
        F.col("month_idx").alias("month"), F.col("spend_next2").cast("decimal(38,6)").alias("spend")).alias("_fact"), F.lit(False).alias("_ask"))
    upto = Window.partitionBy("user_id").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # Facts of one month and user are one row, so the last fact up to a month is unique.
    found = (facts.unionByName(asked.select("user_id", "_at", none.alias("_fact"), F.lit(True).alias("_ask")))
             .withColumn("_last", F.max_by("_fact", F.when(F.col("_fact").isNotNull(), F.col("_at"))).over(upto))
             .where("_ask AND _last IS NOT NULL")
             .select("user_id", "_at", F.col("_last.month").alias("request_month"), F.col("_last.spend").alias("_spend")))
    late = F.col("request_month") + 2 > F.lit(known_month) if known_month is not None else F.lit(False)
    return (rows.join(cut_lineage(found), ["user_id", "_at"], "left").drop("_at")
            .withColumn("pending", F.coalesce(late, F.lit(False)))
            .withColumn("actual", F.when(~late, F.col("_spend"))).drop("_spend"))


def poisson_limits(draws: int = 12) -> list[int]:
    """A uniform 32-bit number at or above the first k limits stands for k Poisson(1) events."""
    below, term, out = 0.0, math.exp(-1.0), []
    for k in range(draws):
        below += term
        term /= k + 1
        out.append(math.floor(below * 2**32))
    return out


def compare_log(with_actuals: DataFrame, replicates: int = 200, seed: int = 0, level: float = 0.95) -> DataFrame:
    """B4 over the log: per arm the number of predictions, errors and a bootstrap interval of the MAE.

    Every row has a Poisson(1) weight in each of ``replicates`` resamples, drawn from a hash of the
    row and the seed, so one pass with partial sums gives all resamples and any partitioning gives
    the same numbers.  Errors are whole millionths, so sums are exact.  Equal rows draw alike.
    The interval runs between the nearest ranks of the resampled means.
    """
    if replicates % 4:
        raise ValueError("replicates come in fours (a digest has four numbers)")
    micro = F.round(F.col("prediction") * MICRO).cast("bigint")
    error = micro - (F.col("actual") * MICRO).cast("bigint")
    rows = with_actuals.select("model_type", micro.cast("decimal(20,0)").alias("p"), "pending", error.alias("e"), F.concat_ws(
        "|", F.col("user_id").cast("string"), "prediction_time", "model_type", micro.cast("string")).alias("key"))
    plain = rows.groupBy("model_type").agg(
        F.count("*").alias("requests"), F.count("e").alias("matched"), F.count_if("pending").alias("pending"),
        (F.avg("p").cast("double") / MICRO).alias("mean_prediction"), (F.avg(F.col("e").cast("decimal(20,0)")).cast("double") / MICRO).alias("mean_error"),
        (F.avg(F.abs("e").cast("decimal(20,0)")).cast("double") / MICRO).alias("mae"))
    dealt = rows.where("e IS NOT NULL").select("model_type", F.abs("e").cast("decimal(20,0)").alias("e"), "key", F.explode(
        F.sequence(F.lit(0), F.lit(replicates // 4 - 1))).alias("b"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("b").cast("string"), "key").cast("binary"))
    dealt = dealt.withColumn("h", digest)
    sums = []
    for k in range(4):
        number = F.conv(F.substring("h", 8 * k + 1, 8), 16, 10).cast("bigint")
        weight = sum(((number >= limit).cast("int") for limit in poisson_limits()), F.lit(0))
        sums += [F.sum(weight * F.col("e")).alias(f"e{k}"), F.sum(weight).alias(f"w{k}")]
    each = dealt.groupBy("model_type", "b").agg(*sums).select("model_type", F.explode(F.array(*[
        F.try_divide(F.col(f"e{k}").cast("double"), F.col(f"w{k}").cast("double")) / MICRO for k in range(4)])).alias("mean"))
    low, high = math.floor((1 - level) / 2 * replicates) + 1, math.ceil((1 + level) / 2 * replicates)
    ordered = each.where("mean IS NOT NULL").groupBy("model_type").agg(F.sort_array(F.collect_list("mean")).alias("m"))
    spans = ordered.select("model_type", F.get("m", F.lit(low - 1)).alias("mae_low"),
                           F.coalesce(F.get("m", F.lit(high - 1)), F.element_at("m", -1)).alias("mae_high"))
    return plain.join(spans, "model_type", "left")
