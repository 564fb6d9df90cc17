"""JSON input, CSV output, prediction log and model persistence."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cartlens.plans import abtest as AB
from cartlens.sources import readers as RD
from cartlens.sources import sinks as SK
from cartlens.sources import schemas as S
from conftest import SESSIONS_SMALL


def _write_jsonl(path, records, bad_lines=()):
    with open(path, "w") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")
        for line in bad_lines:
            fh.write(line + "\n")


def test_read_sessions_json_with_corrupt_line(spark, tmp_path):
    recs = []
    for sid, t, u, p, e, d, pid in SESSIONS_SMALL:
        recs.append({"session_id": sid, "timestamp": t.isoformat(), "user_id": u, "product_id": p,
                     "event_type": e, "offered_discount": d, "purchase_id": pid})
    path = tmp_path / "sessions.jsonl"
    _write_jsonl(path, recs, bad_lines=['{"session_id": 99, "timestamp": '])
    df = RD.read_sessions(spark, str(path), keep_corrupt=True).cache()
    assert df.count() == len(SESSIONS_SMALL) + 1
    bad = df.where(F.col(S.CORRUPT).isNotNull()).collect()
    assert len(bad) == 1 and bad[0].session_id is None
    good = df.where(F.col(S.CORRUPT).isNull())
    assert dict(good.dtypes)["timestamp"] == "timestamp_ntz"
    assert good.where(F.col("user_id").isNull()).count() == 1
    first = good.where("session_id = 2 AND event_type = 'BUY_PRODUCT'").first()
    assert str(first.timestamp) == "2021-12-12 00:10:00"


def test_profile_and_preview(spark, sessions):
    prof = {r["column"]: (r.data_type, r.non_null, r.rows) for r in RD.profile(sessions).collect()}
    assert prof["user_id"] == ("bigint", 12, 13)
    assert prof["purchase_id"] == ("bigint", 6, 13)
    head = RD.preview(sessions, 2, ["timestamp", "session_id"]).collect()
    assert [r.session_id for r in head] == [1, 1]


def test_read_generic_jsonl(spark, tmp_path):
    path = tmp_path / "users.jsonl"
    _write_jsonl(path, [{"user_id": 1, "city": "A"}, {"user_id": 2, "city": "B"}])
    assert RD.read_jsonl(spark, str(path), "user_id long, city string").count() == 2


def test_csv_roundtrip(spark, sessions, products, tmp_path):
    from cartlens.plans.features import training_set_v3
    out = training_set_v3(sessions, products, "2021-11-01", "2022-01-31")
    path = str(tmp_path / "train_csv")
    SK.write_csv(out, path)
    back = SK.read_csv(spark, path, out.schema)
    assert back.columns == out.columns
    assert sorted(back.collect()) == sorted(out.collect())


def test_prediction_log_append(spark, tmp_path):
    reqs = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "user_id long, x double")
    arms = AB.assign_variant(reqs, salt=1)
    scored = arms.withColumn("prediction", F.col("x") * 2)
    log = AB.prediction_log(scored)
    path = str(tmp_path / "predictions")
    SK.append_prediction_log(log, path)
    SK.append_prediction_log(log, path)
    back = SK.read_prediction_log(spark, path)
    assert back.count() == 6
    t = back.first().prediction_time
    assert len(t) == len("12/03/2026 07:00:00:000000") and t[2] == "/" and t[-7] == ":"
    assert set(r.model_type for r in back.collect()) <= set(AB.ARMS)


def test_named_model_type_is_not_logged(spark):
    reqs = spark.createDataFrame([(1, "BaseModel"), (2, None)], "user_id long, model_type string")
    arms = AB.assign_variant(reqs)
    scored = arms.withColumn("prediction", F.lit(1.0))
    assert [r.user_id for r in AB.prediction_log(scored).collect()] == [2]


def test_xxhash_arm_is_stable(spark):
    reqs = spark.createDataFrame([(i,) for i in range(200)], "user_id long")
    a = AB.assign_variant(reqs, salt=5).collect()
    b = AB.assign_variant(reqs, salt=5).collect()
    assert a == b
    share = sum(r.model_type == "BaseModel" for r in a) / len(a)
    assert 0.3 < share < 0.7


def test_model_save_load_and_broken_path(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    train = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    est = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                           LinearRegression(labelCol="y")])
    path = str(tmp_path / "model")
    m1 = SK.load_or_train(spark, path, est, train)
    m2 = SK.load_or_train(spark, path, est, train)  # loads, does not retrain
    p1 = m1.transform(train).select("prediction").collect()
    p2 = m2.transform(train).select("prediction").collect()
    assert p1 == p2
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "metadata").write_text("not a model")
    with pytest.raises(Exception):
        SK.load_or_train(spark, str(broken), est, train)


def test_model_params_listed(spark):
    from cartlens.plans import models as ML
    train = spark.createDataFrame([(float(i % 5), float(i % 3), i % 2) for i in range(40)],
                                  "a double, b double, label int")
    model = ML.build("logreg", features=["a", "b"]).fit(train)
    params = dict(ML.model_params(model))
    assert params["maxIter"] == "50"
