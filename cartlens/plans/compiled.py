"""Fitted models as SQL text: one expression that Spark and other SQL engines read alike.

``compile_model`` turns a fitted pipeline (assembler, scaler, linear model, naive Bayes, tree, forest
or boosted trees) into texts for ``score`` and ``prediction`` over the input columns.  Scoring then
needs no vector column, no broadcast model and no Spark ML on the reading side, and a stored
prediction can be checked by any engine.  Additions keep Spark's order, so sums agree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Compiled:
    """SQL texts: ``score`` (positive-class score, or the regression's value) and ``prediction``."""

    score: str
    prediction: str

    def columns(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score`` and ``prediction``."""
        return df.withColumn("score", F.expr(self.score)).withColumn("prediction", F.expr(self.prediction))


def number(x: float) -> str:
    """A double in the shortest text that reads back as the same number."""
    x = float(x)
    if not math.isfinite(x):
        raise ValueError(f"a fitted model holds {x}")
    return f"CAST('{x!r}' AS DOUBLE)"


def _sum(terms: list[str]) -> str:
    return "(" + " + ".join(terms or [number(0)]) + ")"


def _dot(weights, inputs: list[str], intercept: float) -> str:
    return _sum([f"{number(w)} * {x}" for w, x in zip(weights, inputs)] + [number(intercept)])


def _leaves(node, inputs: list[str], leaf, left: list[int]) -> str:
    """Nested CASE of a tree; ``left`` holds how many nodes may still come."""
    left[0] -= 1
    if left[0] < 0:
        raise ValueError("the model has more nodes than max_nodes: score it with Spark ML")
    if node.subtreeDepth() == 0:
        return leaf(node)
    split = node.split()
    if not hasattr(split, "threshold") or "Continuous" not in split.getClass().getName():
        raise ValueError("only splits of numbers can be compiled")
    return (f"CASE WHEN {inputs[split.featureIndex()]} <= {number(split.threshold())} "
            f"THEN {_leaves(node.leftChild(), inputs, leaf, left)} ELSE {_leaves(node.rightChild(), inputs, leaf, left)} END")


def _value(node) -> str:
    return number(node.prediction())


def _share(node) -> str:
    """Share of the positive class in a leaf."""
    stats = list(node.impurityStats().stats())
    return number(stats[1] / sum(stats)) if sum(stats) else number(0)


def _trees(model, inputs, leaf, left) -> list[str]:
    return [_leaves(t._java_obj.rootNode(), inputs, leaf, left) for t in model.trees]


def _binary(model) -> None:
    if getattr(model, "numClasses", 2) != 2:
        raise ValueError("only two classes can be compiled")


def _final(model, inputs: list[str], max_nodes: int) -> Compiled:
    kind, left = type(model).__name__, [max_nodes]
    if kind in ("LinearRegressionModel", "GeneralizedLinearRegressionModel"):
        value = _dot(model.coefficients, inputs, model.intercept)
        if kind == "LinearRegressionModel" or model.getOrDefault("family") == "gaussian":
            return Compiled(value, value)
        if model.getOrDefault("family") != "binomial":
            raise ValueError("of the generalized models only gaussian and binomial (logit) are compiled")
        return Compiled(f"(1 / (1 + exp(-{value})))", f"CASE WHEN {value} > 0 THEN {number(1)} ELSE {number(0)} END")
    if kind == "LogisticRegressionModel":
        _binary(model)
        value = _dot(model.coefficients, inputs, model.intercept)
        return Compiled(f"(1 / (1 + exp(-{value})))", f"CASE WHEN {value} > 0 THEN {number(1)} ELSE {number(0)} END")
    if kind == "LinearSVCModel":
        value = _dot(model.coefficients, inputs, model.intercept)
        return Compiled(value, f"CASE WHEN {value} > 0 THEN {number(1)} ELSE {number(0)} END")
    if kind == "NaiveBayesModel" and model.getOrDefault("modelType") == "gaussian":
        _binary(model)
        mean, var, prior = model.theta.toArray(), model.sigma.toArray(), list(model.pi)

        def raw(c: int) -> str:
            return _sum([number(prior[c])] + [
                f"(-(({x} - {number(m)}) * ({x} - {number(m)}) / {number(v)} + {number(math.log(2 * math.pi * v))}) / 2)"
                for x, m, v in zip(inputs, mean[c], var[c])])

        return Compiled(f"({raw(1)} - {raw(0)})", f"CASE WHEN {raw(1)} > {raw(0)} THEN {number(1)} ELSE {number(0)} END")
    if kind == "DecisionTreeRegressionModel":
        value = _leaves(model._java_obj.rootNode(), inputs, _value, left)
        return Compiled(value, value)
    if kind == "RandomForestRegressionModel":
        value = f"({_sum(_trees(model, inputs, _value, left))} / {len(model.trees)})"
        return Compiled(value, value)
    if kind == "DecisionTreeClassificationModel":
        _binary(model)
        share = _leaves(model._java_obj.rootNode(), inputs, _share, left)
        return Compiled(share, f"CASE WHEN {share} > 0.5 THEN {number(1)} ELSE {number(0)} END")
    if kind == "RandomForestClassificationModel":
        _binary(model)
        votes = _sum(_trees(model, inputs, _share, left))
        share = f"({votes} / {len(model.trees)})"
        return Compiled(share, f"CASE WHEN {share} > 0.5 THEN {number(1)} ELSE {number(0)} END")
    if kind in ("GBTClassificationModel", "GBTRegressionModel"):
        value = _sum([f"{number(w)} * {t}" for w, t in zip(model.treeWeights, _trees(model, inputs, _value, left))])
        if kind == "GBTRegressionModel":
            return Compiled(value, value)
        return Compiled(f"(1 / (1 + exp(-2 * {value})))", f"CASE WHEN {value} > 0 THEN {number(1)} ELSE {number(0)} END")
    raise ValueError(f"no expression for a {kind}")


def compile_model(model: PipelineModel, max_nodes: int = 5000) -> Compiled:
    """Texts of a fitted pipeline; ``max_nodes`` bounds the size of a forest's text."""
    inputs: dict[str, list[str]] = {}
    for stage in model.stages[:-1]:
        kind = type(stage).__name__
        if kind == "VectorAssembler":
            inputs[stage.getOutputCol()] = [f"CAST({c} AS DOUBLE)" for c in stage.getInputCols()]
        elif kind == "StandardScalerModel":
            x = inputs[stage.getInputCol()]
            if stage.getWithMean():
                x = [f"({c} - {number(m)})" for c, m in zip(x, stage.mean)]
            if stage.getWithStd():
                x = [f"({c} * {number(1 / s if s else 0.0)})" for c, s in zip(x, stage.std)]
            inputs[stage.getOutputCol()] = x
        elif kind == "MinMaxScalerModel":
            lo, hi = stage.getMin(), stage.getMax()
            inputs[stage.getOutputCol()] = [
                f"(({c} - {number(a)}) * {number((hi - lo) / (b - a))} + {number(lo)})" if b > a else number((lo + hi) / 2)
                for c, a, b in zip(inputs[stage.getInputCol()], stage.originalMin, stage.originalMax)]
        else:
            raise ValueError(f"no expression for a {kind}")
    last = model.stages[-1]
    return _final(last, inputs[last.getFeaturesCol()], max_nodes)
