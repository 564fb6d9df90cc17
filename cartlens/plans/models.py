"""Model training and evaluation with Spark ML.

Training sets come from C1 over two month windows: validation strictly after
training with a two-month gap (labels of month m read month m+2), see
``filters.check_windows``.  Fitting runs on executors (tree statistics,
gradient aggregates); the driver only coordinates.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
    NaiveBayes, NaiveBayesModel, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions.timefeat import month_range
from cartlens.operators.filters import check_windows
from cartlens.plans.features import V3_COLUMNS, training_sets, user_month_rows
from cartlens.plans.metrics import auc
from cartlens.plans.svr import KernelSVR
from cartlens.session import checkpoint_dir, cut_lineage

FEATURES = [c for c in V3_COLUMNS if c != "label"]


@dataclass(frozen=True)
class Windows:
    train: tuple
    val: tuple


def labelled_splits(sessions: DataFrame, products: DataFrame, windows: Windows,
                    allow_overlap: bool = False) -> DataFrame:
    """C1 of both windows with a ``split`` column; overlapping windows are rejected."""
    check_windows(windows.train, windows.val, allow_overlap=allow_overlap)
    return training_sets(sessions, products, {"train": windows.train, "val": windows.val})


def staged_rows(data: DataFrame) -> DataFrame:
    """The labelled rows in the checkpoint folder, one partition a core.

    Training passes over few bytes many times: adaptive execution, which looks at the bytes, would
    leave cores without a partition, and more partitions would each bring statistics of all nodes.
    """
    n = data.sparkSession.sparkContext.defaultParallelism
    return cut_lineage(data.repartition(n, *data.columns))


def assemble(df: DataFrame, features=FEATURES, out: str = "features") -> DataFrame:
    """M1: feature columns -> vector, label last."""
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def class_stats(df: DataFrame, features=FEATURES, label: str = "label") -> DataFrame:
    """M3 statistics: count, mean and population variance per class and feature.

    The numbers a Gaussian naive Bayes model is made of, as one aggregate.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for f in features:
        aggs += [F.avg(f).alias(f"mean_{f}"), F.var_pop(f).alias(f"var_{f}")]
    return df.groupBy(label).agg(*aggs)


def _estimator(kind: str, seed: int = 0, trees: int = 100, depth: int = 16,
               n_features: int = len(FEATURES)):
    if kind == "gnb":
        return NaiveBayes(modelType="gaussian")
    if kind == "logreg":
        return LogisticRegression(maxIter=50)
    if kind == "logit":                                 # the same model by its likelihood's exact maximum
        return GeneralizedLinearRegression(family="binomial", link="logit", maxIter=50, tol=1e-10)
    if kind == "forest":
        # node ids are kept from level to level, or each level walks all trees from their roots
        return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True)
    if kind == "gbt":
        return GBTClassifier(maxIter=20, maxDepth=5, seed=seed)
    if kind == "svc":
        return LinearSVC(maxIter=50)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(layers=[n_features, 8, 2], seed=seed, maxIter=50)
    raise ValueError(f"unknown model kind {kind!r}")


def _scaler(kind: str | None):
    if kind is None or kind == "none":
        return None
    if kind == "standard":
        return StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)
    if kind == "minmax":
        return MinMaxScaler(inputCol="raw_features", outputCol="features")
    raise ValueError(f"unknown scaler {kind!r}")


def build(kind: str, scaler: str | None = None, features=FEATURES, **params) -> Pipeline:
    sc = _scaler(scaler)
    vec_out = "raw_features" if sc is not None else "features"
    stages = [VectorAssembler(inputCols=list(features), outputCol=vec_out)]
    if sc is not None:
        stages.append(sc)
    stages.append(_estimator(kind, n_features=len(features), **params))
    return Pipeline(stages=stages)


def with_score(pred: DataFrame, margin: bool = False) -> DataFrame:
    """Positive-class score: probability[1] if the model has one, else rawPrediction[1].

    With ``margin`` it is the difference of the raw predictions, which orders rows whose
    probabilities are all 0 or 1 in doubles (naive Bayes).
    """
    if "rawPrediction" not in pred.columns:             # a generalized linear model predicts the probability
        return pred.withColumn("score", F.col("prediction")).withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    if margin:
        raw = vector_to_array(F.col("rawPrediction"))
        return pred.withColumn("score", raw[1] - raw[0])
    col = "probability" if "probability" in pred.columns else "rawPrediction"
    return pred.withColumn("score", vector_to_array(F.col(col))[1])


def without_summary(model: PipelineModel) -> PipelineModel:
    """A copy of the model without its training summary, for scoring.

    The summary of a binary classifier refers to the Spark session, and a session in which an
    ``Observation`` was ever used can not be sent to tasks; scoring needs nothing of the summary.
    """
    out = model.copy()
    none = SparkContext.getOrCreate()._jvm.scala.Option.empty()
    for stage in out.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(none)
    return out


def scored_counts(model: PipelineModel, data: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per (split, score, prediction, label): all that the metrics need of the scored rows.

    ``weight`` names a column with the number of rows that each row stands for.
    """
    pred = with_score(without_summary(model).transform(data), margin=isinstance(model.stages[-1], NaiveBayesModel))
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return pred.groupBy("split", "score", "prediction", "label").agg(n.alias("n"))


def confusion_by_split(model: PipelineModel, data: DataFrame, name: str) -> DataFrame:
    """M8: rows per (split, label, prediction) of one model."""
    return (scored_counts(model, data)
            .groupBy("split", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))
            .agg(F.sum("n").alias("rows")).select(F.lit(name).alias("model"), "split", "label", "prediction", "rows"))


def evaluate(model: PipelineModel, data: DataFrame, name: str, weight: str | None = None) -> DataFrame:
    """Accuracy, AUC and number of predicted positives per split.

    Every row is scored once: the scored rows are reduced to counts per (split, score,
    prediction, label), and accuracy, positives and AUC all follow from those.
    """
    reduced = cut_lineage(scored_counts(model, data, weight))
    hit = F.when(F.col("label").cast("double") == F.col("prediction"), F.col("n")).otherwise(0)
    counts = reduced.groupBy("split").agg(
        F.sum("n").alias("rows"), (F.sum(hit) / F.sum("n")).alias("accuracy"),
        F.sum(F.when(F.col("prediction") == 1, F.col("n")).otherwise(0)).cast("bigint").alias("predicted_positive"))
    aucs = auc(reduced, by=["split"], weight="n").select("split", "auc")
    return counts.join(aucs, "split").select(
        F.lit(name).alias("model"), "split", "rows", "accuracy", "auc", "predicted_positive")


#: With more training rows than this, forests and boosted trees are fitted on counts of equal bins.
ROWS_PER_TREE = 500_000
TREE_KINDS = ("forest", "gbt")


def bin_thresholds(values, bins: int = 32) -> list[float]:
    """Thresholds of one feature as Spark's trees choose them from their sample of the rows.

    Midpoints of all values, or of values that part the sample about evenly if there are more than ``bins``.
    """
    counts = sorted(Counter(float(v) for v in values).items())
    steps = list(zip(counts, counts[1:]))
    if len(counts) <= bins:
        return sorted({(a + b) / 2 for (a, _), (b, _) in steps})
    stride = sum(n for _, n in counts) / bins
    out, target, seen = set(), stride, counts[0][1]
    for (a, _), (b, n) in steps:
        before, seen = seen, seen + n
        if abs(before - target) < abs(seen - target):
            out.add((a + b) / 2)
            target += stride
    return sorted(out)


def binned_counts(data: DataFrame, rows: int, scaler: str | None = None, features=FEATURES,
                  seed: int = 0, bins: int = 32) -> DataFrame:
    """Rows per (split, label, bin of every feature), as ``n``; bins are numbers in columns ``bin_0``, ``bin_1``, ...

    A tree sees of a row only its bins, so these counts hold all that it can learn from the ``rows``
    training rows; there are as many of them as different binned rows, however large the input is.
    """
    sc = _scaler(scaler)
    vec = VectorAssembler(inputCols=list(features), outputCol="features" if sc is None else "raw_features")
    prepare = Pipeline(stages=[vec] if sc is None else [vec, sc]).fit(data.where(F.col("split") == "train"))
    inputs, names = ([f"{kind}_{i}" for i in range(len(features))] for kind in ("x", "bin"))

    def wide(df: DataFrame) -> DataFrame:
        out = prepare.transform(df).select("split", "label", vector_to_array(F.col("features")).alias("x"))
        return out.select("split", "label", *[F.col("x")[i].alias(c) for i, c in enumerate(inputs)])

    # thresholds come from a sample of the size that Spark's trees take for theirs; every row is counted
    train, share = data.where(F.col("split") == "train"), max(bins * bins, 10_000) / rows
    seen = wide(train.sample(share, seed) if share < 1 else train).toPandas()
    # a bucket holds its lower bound, a tree's left side its threshold: the bound is the next number
    splits = [[-math.inf, *[math.nextafter(t, math.inf) for t in bin_thresholds(seen[c], bins) or [0.0]], math.inf] for c in inputs]
    binned = Bucketizer(splitsArray=splits, inputCols=inputs, outputCols=names).transform(wide(data))
    # bins are in order: trees would try Bucketizer's columns, which are marked as nominal, as categories
    ordered = [F.col(c).alias(c, metadata={"ml_attr": {"type": "numeric"}}) for c in names]
    return cut_lineage(binned.select("split", "label", *ordered).groupBy("split", "label", *names).agg(F.count(F.lit(1)).alias("n")))


def _drawn(trees: int, seed: int):
    """Bootstrap counts of every tree: a row is drawn Poisson(1) times, so ``n`` equal rows Poisson(n) times."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            keys, rows = part.pop("key"), part.pop("n")
            draws = [np.random.default_rng([seed, k % 2**64]).poisson(n, trees) for k, n in zip(keys, rows)]
            drawn = pd.DataFrame(np.array(draws).reshape(-1, trees), part.index, [f"draw_{k}" for k in range(trees)])
            yield pd.concat([part, drawn], axis=1)
    return run


def binned_forest(train: DataFrame, vec: VectorAssembler, bins: int, trees: int = 100, depth: int = 16, seed: int = 0,
                  parallelism: int = 8) -> RandomForestClassificationModel:
    """A forest over counted rows: each tree is fitted on its own bootstrap counts.

    The draws depend on the counted row and the seed alone, and sums of counts are exact, so the
    forest does not depend on partitions.  Draws are columns of Parquet files in the checkpoint folder, of which
    a tree reads its own.  ``parallelism`` trees are fitted at a time, since each has a short job a level.
    """
    spark, names = train.sparkSession, vec.getInputCols()
    keyed = train.select("label", *names, "n", F.xxhash64("label", *names).alias("key"))
    fields = [f"label {dict(train.dtypes)['label']}", *[f"{c} double" for c in names], *[f"draw_{k} bigint" for k in range(trees)]]
    path = f"{checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    keyed.mapInPandas(_drawn(trees, seed), ", ".join(fields)).write.parquet(path)
    drawn = vec.transform(spark.read.parquet(path))

    def fit(k: int):
        one = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", maxDepth=depth,
                                     maxBins=bins, weightCol=f"draw_{k}", seed=seed * trees + k)
        return one.fit(drawn.where(F.col(f"draw_{k}") > 0))._java_obj.trees()[0]

    with ThreadPool(parallelism) as pool:
        fitted = pool.map(inheritable_thread_target(spark)(fit), range(trees), chunksize=1)
    jvm = spark.sparkContext._jvm.org.apache.spark.ml.classification
    array = spark.sparkContext._gateway.new_array(jvm.DecisionTreeClassificationModel, trees)
    for k, tree in enumerate(fitted):
        array[k] = tree
    return RandomForestClassificationModel(jvm.RandomForestClassificationModel(f"forest_{uuid.uuid4().hex}", array, len(names), 2))


def fit_binned(counts: DataFrame, kind: str, **params) -> PipelineModel:
    """The tree model ``kind`` of counted rows, over their bins; one partition for 50,000 of them, at most one a core."""
    names = [c for c in counts.columns if c.startswith("bin_")]
    train = counts.where(F.col("split") == "train")
    n = train.count()
    train = train.repartition(max(1, min(train.sparkSession.sparkContext.defaultParallelism, math.ceil(n / 50_000))), *names)
    # the trees look at every counted row for the bins that there are, of which no feature has more than 32
    bins, vec = max(32, math.isqrt(n) + 1), VectorAssembler(inputCols=names, outputCol="features")
    if kind == "forest":
        model = binned_forest(train, vec, bins, **params)
    else:
        model = _estimator(kind, **params).setWeightCol("n").setMaxBins(bins).fit(vec.transform(train))
    return PipelineModel([vec, model])


def fit_and_score(data: DataFrame, kind: str, scaler: str | None = None,
                  checkpoint: bool = True, counts: DataFrame | None = None, **params) -> DataFrame:
    """M3-M5: fit on the train split, report both splits.

    The labelled data is checkpointed first (reliable storage), so fitting and
    every evaluation pass read it instead of recomputing the feature job.  Trees over more than
    ``ROWS_PER_TREE`` training rows are fitted and scored on ``binned_counts`` (``counts`` if given), since
    Spark's forest keeps two numbers per row and tree and passes over all of them for every level.
    """
    if checkpoint:
        data = staged_rows(data)
    name = kind if scaler in (None, "none") else f"{kind}+{scaler}"
    train = data.where(F.col("split") == "train")
    if checkpoint and kind in TREE_KINDS and (rows := train.count()) > ROWS_PER_TREE:
        counts = binned_counts(data, rows, scaler)
    if counts is not None:
        return evaluate(fit_binned(counts, kind, **params), counts, name, weight="n")
    return evaluate(build(kind, scaler, **params).fit(train), data, name)


def model_params(model: PipelineModel) -> list[tuple[str, str]]:
    """M9: the fitted estimator's parameters as (name, value) pairs."""
    last = model.stages[-1]
    return sorted((p.name, str(v)) for p, v in last.extractParamMap().items())


#: Every classifier with every preprocessing.
DEFAULT_GRID = tuple((kind, scaler) for kind in ("logreg", "forest", "gbt", "svc", "mlp")
                     for scaler in ("none", "standard", "minmax"))


def model_selection(data: DataFrame, grid=DEFAULT_GRID, parallelism: int = 3) -> DataFrame:
    """M10 (re-aim of the AutoML searches): explicit grid, chosen by validation AUC.

    The labelled data is checkpointed once into the reliable checkpoint folder
    so every fit re-reads it instead of recomputing C1 (and survives a lost
    executor).  ``parallelism`` entries are fitted at a time, since the many
    short jobs of one fit leave cores idle.  Tree models of more than
    ``ROWS_PER_TREE`` training rows share the counts of binned rows of their scaler.
    """
    data = staged_rows(data)
    rows, counts = data.where(F.col("split") == "train").count(), {}
    if rows > ROWS_PER_TREE:
        counts = {(kind, scaler): scaler for kind, scaler in grid if kind in TREE_KINDS}
        by_scaler = {scaler: binned_counts(data, rows, scaler) for scaler in dict.fromkeys(counts.values())}
        counts = {entry: by_scaler[scaler] for entry, scaler in counts.items()}
    fit = inheritable_thread_target(data.sparkSession)(
        lambda entry: fit_and_score(data, *entry, checkpoint=False, counts=counts.get(tuple(entry))))
    with ThreadPool(parallelism) as pool:
        results = reduce(DataFrame.unionByName, pool.map(fit, grid, chunksize=1))
    results = cut_lineage(results)  # a few rows; read twice below, evaluated once
    # The choice: the grid entry with the highest validation AUC (ties: model name).
    best = (results.where(F.col("split") == "val").where(F.col("auc").isNotNull())
            .orderBy(F.desc("auc"), "model").limit(1).select("model", F.lit(True).alias("chosen")))
    return (results.join(F.broadcast(best), "model", "left")
            .withColumn("chosen", F.coalesce("chosen", F.lit(False))))


def spend_regression(sessions: DataFrame, products: DataFrame,
                     windows: Windows, kind: str = "linear") -> DataFrame:
    """Regression of the third-month spend on the C1 features (``kind`` as in ``build_regression``).

    Returns RMSE and R^2 per split (the served regressors of the scoring service).
    """
    rows = cut_lineage(regression_rows(sessions, products, windows))
    model = build_regression(kind).fit(rows.where(F.col("split") == "train"))
    return regression_report(model.transform(rows))


def regression_report(pred: DataFrame, label: str = "spend_third") -> DataFrame:
    """RMSE and R^2 per split from one aggregate (SST = n * population variance)."""
    err = F.col("prediction") - F.col(label)
    n = F.count(F.lit(1))
    sst = F.var_pop(label) * n
    return pred.groupBy("split").agg(
        n.alias("rows"), F.sqrt(F.avg(err * err)).alias("rmse"),
        (1 - F.try_divide(F.sum(err * err), sst)).alias("r2"))


def build_regression(kind: str = "linear", features=FEATURES, seed: int = 0,
                     trees: int = 100, depth: int = 16) -> Pipeline:
    """Regressors of the third-month spend.

    ``linear`` and ``svr`` (RBF kernel, C = 10000) are the served ones; ``forest`` is offered besides.
    """
    if kind == "linear":
        est = LinearRegression(labelCol="spend_third", maxIter=50)
    elif kind == "svr":
        est = KernelSVR(labelCol="spend_third", C=10000.0, seed=seed)
    elif kind == "forest":
        est = RandomForestRegressor(labelCol="spend_third", numTrees=trees, maxDepth=depth, seed=seed)
    else:
        raise ValueError(f"unknown regression kind {kind!r}")
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), est])


def regression_rows(sessions: DataFrame, products: DataFrame, windows: Windows) -> DataFrame:
    """C1 rows (before dedupe, user kept) of both windows with the third-month spend."""
    check_windows(windows.train, windows.val)
    t0, t1 = month_range(*windows.train)
    v0, v1 = month_range(*windows.val)
    hull = (windows.train[0], windows.val[1]) if t0 <= v0 else (windows.val[0], windows.train[1])
    rows = user_month_rows(sessions, products, *hull, keep_third=True)
    m = F.col("month_idx")
    split = F.when(m.between(t0, t1), F.lit("train")).when(m.between(v0, v1), F.lit("val"))
    return rows.withColumn("split", split).where(F.col("split").isNotNull())


def scale_features(df: DataFrame, features=FEATURES) -> DataFrame:
    """Z-scores with the sample standard deviation.

    The statistics are one aggregate row (2 values per feature, a proven bound)
    brought to the driver and applied as literals -- what ``StandardScaler``
    does, without a vector column.
    """
    df = cut_lineage(df)  # read twice (statistics, then scaling): compute the input once
    stats = df.agg(*[F.avg(f).alias(f"m_{f}") for f in features],
                   *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).first()
    cols = []
    for f in features:
        mean, sd = stats[f"m_{f}"], stats[f"s_{f}"]
        if mean is None or not sd:
            cols.append(F.lit(0.0).alias(f"z_{f}"))
        else:
            cols.append(((F.col(f) - F.lit(mean)) / F.lit(sd)).alias(f"z_{f}"))
    return df.select(*cols, "label")
