from __future__ import annotations

import math
import random

import pytest

from cartlens.plans import models as ML
from cartlens.plans import search as S

COLUMNS = ["a", "b", "c"]


def test_densities_sum_to_one_and_stay_in_bounds():
    rng = random.Random(1)
    choice, span, whole = S.Choice(("x", "y", "z")), S.Span(1e-4, 1.0, log=True), S.Span(2, 9, whole=True)
    assert sum(math.exp(choice.log_density(v, ["x", "x"])) for v in choice.values) == pytest.approx(1)
    steps = 4000
    grid = [math.exp(math.log(1e-4) * (1 - (k + .5) / steps)) for k in range(steps)]
    mass = sum(math.exp(span.log_density(x, [1e-2] * 9)) for x in grid) * -math.log(1e-4) / steps
    assert mass == pytest.approx(1, abs=.01)
    for p in (span, whole):
        for _ in range(200):
            v = p.suggest([p.draw(rng) for _ in range(3)], rng)
            assert p.low <= v <= p.high and (p is span or isinstance(v, int))


def test_proposals_repeat_and_move_to_the_better_trials():
    done = []
    for _ in range(40):
        t = S.propose(done, seed=4)
        assert t == S.propose(done, seed=4)
        reg = dict(t.params).get("regParam")
        score = 0.5 + (0.4 - abs(math.log10(reg) + 2) / 10 if t.kind == "svc" else 0.0)
        done.append(S.Trial(t.number, t.kind, t.params, score if t.number % 7 else None))
    late = done[20:]
    assert sum(t.kind == "svc" for t in late) > 12 > sum(t.kind == "svc" for t in done[:5])
    assert [t.kind for t in done[:5]] != [S.propose(done[:k], seed=9).kind for k in range(5)]


def test_search_beats_the_grid_at_equal_fits(spark):
    # Few rows, weak signal, many noise columns: what the grid's fixed settings overfit.
    rng = random.Random(0)
    columns = [f"x{k}" for k in range(60)]
    rows = []
    for k in range(300):
        x = [rng.gauss(0, 1) for _ in columns]
        rows.append((*x, int(x[0] + x[1] + rng.gauss(0, 1.5) > 0), "train" if k % 3 else "val"))
    data = spark.createDataFrame(rows, ", ".join([*(f"{c} double" for c in columns), "label int", "split string"]))
    data = data.repartition(2).checkpoint()
    cheap = {"logreg": S.SPACE["logreg"], "svc": S.SPACE["svc"], "forest": {"numTrees": S.Span(5, 12, whole=True), "maxDepth": S.Span(2, 4, whole=True)}}
    grid = []
    for kind, scaler in [(k, s) for k in ("logreg", "svc", "forest") for s in ("none", "standard", "minmax")]:
        params = {"trees": 12, "depth": 16, "seed": 0} if kind == "forest" else {}
        model = ML.build(kind, scaler, features=columns, **params).fit(data.where("split = 'train'"))
        grid.append(ML.evaluate(model, data.where("split = 'val'"), kind).first().auc)
    done = S.search(data, len(grid), seed=1, features=columns, space=cheap)
    again = S.search(data, 3, seed=1, features=columns, space=cheap)
    assert [(t.kind, t.params) for t in again] == [(t.kind, t.params) for t in done[:3]]
    assert max(t.score for t in done) > max(grid)
    out = S.report(spark, done).collect()
    assert len(out) == len(grid) and sum(r.chosen for r in out) == 1
    assert next(r for r in out if r.chosen).auc == max(t.score for t in done)
