"""M10, model-based search: tree-structured Parzen choice of the next trials from the finished ones.

Every trial is a Spark ML fit on one staged table; what the search itself handles is one record a
trial.  Finished trials are parted into the better quarter and the rest; each parameter's values in
the two parts give two densities (counts for choices, normal kernels for numbers), candidates are
drawn from the first, and the one with the largest ratio of the two is tried next.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.plans import models as ML


@dataclass(frozen=True)
class Choice:
    """One of several values."""

    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)

    def suggest(self, good: list, rng: random.Random):
        return rng.choices(self.values, [1 + good.count(v) for v in self.values])[0]

    def log_density(self, value, seen: list) -> float:
        return math.log((1 + seen.count(value)) / (len(self.values) + len(seen)))


@dataclass(frozen=True)
class Span:
    """A number between two bounds, by its logarithm if ``log``; rounded if ``whole``."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def _in(self, x: float) -> float:
        return math.log(x) if self.log else float(x)

    def _out(self, x: float):
        x = min(max(math.exp(x) if self.log else x, self.low), self.high)
        return round(x) if self.whole else x

    def draw(self, rng: random.Random):
        return self._out(rng.uniform(self._in(self.low), self._in(self.high)))

    def _width(self, n: int) -> float:
        return (self._in(self.high) - self._in(self.low)) / max(2.0, 1.5 * n)

    def suggest(self, good: list, rng: random.Random):
        at = rng.randrange(len(good) + 1)
        if at == len(good):                              # the uniform prior counts as one more trial
            return self.draw(rng)
        return self._out(rng.gauss(self._in(good[at]), self._width(len(good))))

    def log_density(self, value, seen: list) -> float:
        lo, hi, x, w = self._in(self.low), self._in(self.high), self._in(value), self._width(len(seen))
        total = 1 / (hi - lo) + sum(math.exp(-((x - self._in(s)) / w) ** 2 / 2) / (w * math.sqrt(2 * math.pi)) for s in seen)
        return math.log(total / (len(seen) + 1))


#: Classifiers with the parameters that each of them has; ``scaler`` belongs to all.
SPACE: dict[str, dict[str, Choice | Span]] = {
    "logreg": {"regParam": Span(1e-5, 1.0, log=True), "elasticNetParam": Span(0.0, 1.0)},
    "forest": {"numTrees": Span(5, 60, whole=True), "maxDepth": Span(2, 10, whole=True)},
    "gbt": {"maxIter": Span(5, 30, whole=True), "maxDepth": Span(2, 6, whole=True), "stepSize": Span(0.02, 0.5, log=True)},
    "svc": {"regParam": Span(1e-5, 1.0, log=True)},
    "mlp": {"maxIter": Span(20, 100, whole=True), "stepSize": Span(0.005, 0.2, log=True)},
}
SCALERS = Choice(("none", "standard", "minmax"))


@dataclass(frozen=True)
class Trial:
    number: int
    kind: str
    params: tuple                                        # (name, value) pairs, ``scaler`` among them
    score: float | None = None


def propose(done: list[Trial], seed: int, space=None, startup: int = 5, better: float = 0.25, candidates: int = 24) -> Trial:
    """The next trial; it depends only on the finished ones and the seed.

    The classifier is chosen as one more parameter; the parameters of a classifier learn from the
    trials of that classifier.  Trials without a score count as the worst.
    """
    space = space or SPACE
    number = len(done)
    rng = random.Random(f"{seed}:{number}")
    kinds = Choice(tuple(space))

    def parameters(kind: str) -> dict:
        return {"scaler": SCALERS, **space[kind]}

    if number < startup:
        kind = kinds.draw(rng)
        return Trial(number, kind, tuple((k, p.draw(rng)) for k, p in parameters(kind).items()))
    order = sorted(done, key=lambda t: (-(t.score if t.score is not None else -math.inf), t.number))
    cut = max(1, math.ceil(better * number))
    good, bad = order[:cut], order[cut:]
    best, best_gain = None, -math.inf
    for _ in range(candidates):
        kind = kinds.suggest([t.kind for t in good], rng)
        gain = kinds.log_density(kind, [t.kind for t in good]) - kinds.log_density(kind, [t.kind for t in bad])
        params = []
        for name, p in parameters(kind).items():
            in_good, in_bad = ([dict(t.params)[name] for t in part if t.kind == kind] for part in (good, bad))
            value = p.suggest(in_good, rng)
            gain += p.log_density(value, in_good) - p.log_density(value, in_bad)
            params.append((name, value))
        if gain > best_gain and not any(t.kind == kind and t.params == tuple(params) for t in done):
            best, best_gain = Trial(number, kind, tuple(params)), gain
    if best is None:                                     # every candidate was tried already
        kind = kinds.draw(rng)
        best = Trial(number, kind, tuple((k, p.draw(rng)) for k, p in parameters(kind).items()))
    return best


def pipeline(trial: Trial, features=ML.FEATURES, seed: int = 0) -> Pipeline:
    """The trial's pipeline with its parameters set on the classifier."""
    params = dict(trial.params)
    pipe = ML.build(trial.kind, params.pop("scaler"), features=features)
    last = pipe.getStages()[-1]
    for name, value in params.items():
        last.set(last.getParam(name), value)
    if last.hasParam("seed"):
        last.set(last.getParam("seed"), seed)
    return pipe


def search(data: DataFrame, trials: int = 10, seed: int = 0, features=ML.FEATURES, space=None) -> list[Trial]:
    """Finished trials in order; ``data`` has ``label`` and ``split`` and is staged once.

    The score is the AUC of the validation split, as in the grid search.
    """
    data = ML.staged_rows(data)
    train, done = data.where(F.col("split") == "train"), []
    for _ in range(trials):
        trial = propose(done, seed, space)
        model = pipeline(trial, features, seed).fit(train)
        row = ML.evaluate(model, data.where(F.col("split") == "val"), trial.kind).first()
        done.append(Trial(trial.number, trial.kind, trial.params, row.auc if row else None))
    return done


def report(spark, done: list[Trial]) -> DataFrame:
    """One row a trial: number, model, scaler, parameters, validation AUC and whether it is chosen."""
    best = max((t for t in done if t.score is not None), key=lambda t: (t.score, -t.number), default=None)
    rows = [(t.number, t.kind, dict(t.params)["scaler"], ", ".join(f"{k}={v:.6g}" for k, v in t.params if k != "scaler"),
             t.score, t is best) for t in done]
    return spark.createDataFrame(rows, "trial int, model string, scaler string, parameters string, auc double, chosen boolean")
