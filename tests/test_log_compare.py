"""B4 over the log: as-of join and Poisson bootstrap against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

from pyspark.sql import functions as F

from cartlens.plans import abtest as B


def _weights(seed, block, key):
    h = hashlib.md5(f"{seed}:{block}:{key}".encode()).hexdigest()
    out = []
    for k in range(4):
        u = int(h[8 * k:8 * k + 8], 16)
        out.append(sum(u >= x for x in B.poisson_limits()))
    return out


def _rows(spark, n=300):
    rng = random.Random(7)
    log = [(f"{rng.randrange(1, 13):02d}/{rng.randrange(1, 28):02d}/2021 0{rng.randrange(9)}:00:00:{k:06d}", rng.choice("AB"),
            round(rng.uniform(0, 500), 3), rng.choice([None, *range(12)])) for k in range(n)]
    log += log[:5]
    facts = [(u, 2020 * 12 + m, rng.randrange(3), round(rng.uniform(0, 400), 2)) for u in range(10) for m in rng.sample(range(24), 9)]
    return (log, facts, spark.createDataFrame(log, "prediction_time string, model_type string, prediction double, user_id long"),
            spark.createDataFrame(facts, "user_id long, month_idx int, buys long, s double")
            .select("user_id", "month_idx", "buys", F.col("s").cast("decimal(38,6)").alias("spend_next2")))


def _actual(row, facts, known):
    month = 2021 * 12 + int(row[0][:2]) - 1
    best = max((f for f in facts if f[0] == row[3] and f[2] > 0 and f[1] <= month - 2), key=lambda f: f[1], default=None)
    if best is None:
        return None, False
    return (None, True) if best[1] + 2 > known else (best[3], False)


def test_as_of_join_equals_brute_force(spark):
    log, facts, df, nexts = _rows(spark)
    known = 2021 * 12 + 8
    got = B.with_actual(df.repartition(5), nexts, known).collect()
    assert len(got) == len(log)
    want = sorted((str(r), str(_actual(r, facts, known))) for r in log)
    have = sorted((str((r.prediction_time, r.model_type, r.prediction, r.user_id)),
                   str((None if r.actual is None else float(r.actual), r.pending))) for r in got)
    assert have == want and len({w[1] for w in want}) > 5


def test_bootstrap_equals_brute_force_under_any_partitioning(spark):
    log, facts, df, nexts = _rows(spark)
    known = 2021 * 12 + 11
    joined = B.with_actual(df, nexts, known)
    out = []
    for parts in (1, 7):
        out.append(sorted(tuple(r) for r in B.compare_log(joined.repartition(parts), replicates=40, seed=3).collect()))
    assert out[0] == out[1]
    for arm, requests, matched, pending, _, _, mae, low, high in out[0]:
        rows = [(r, _actual(r, facts, known)[0]) for r in log if r[1] == arm]
        errors = [(f"{r[3]}|{r[0]}|{r[1]}|{round(r[2] * 1e6)}", abs(round(r[2] * 1e6) - round(a * 1e6))) for r, a in rows if a is not None]
        assert requests == len(rows) and matched == len(errors)
        assert math.isclose(mae, sum(e for _, e in errors) / len(errors) / 1e6, rel_tol=1e-9)
        means = []
        for b in range(10):
            w = [_weights(3, b, key) for key, _ in errors]
            means += [sum(x[k] * e for x, (_, e) in zip(w, errors)) / sum(x[k] for x in w) / 1e6 for k in range(4)]
        means.sort()
        assert math.isclose(low, means[1], rel_tol=1e-9) and math.isclose(high, means[38], rel_tol=1e-9)
        assert low < mae < high


def test_empty_log(spark):
    _, _, df, nexts = _rows(spark, 10)
    assert B.compare_log(B.with_actual(df.limit(0), nexts, None)).count() == 0
