"""Request files as a stream: each request is logged exactly once, also after a killed run."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cartlens import jobs
from cartlens.plans import abtest as B
from cartlens.plans import models as ML
from cartlens.sources import sinks as SK


class _Model:
    def __init__(self, by):
        self.by = by

    def transform(self, df):
        return df.withColumn("prediction", F.col("spent_money_first_month") + self.by)


MODELS = {"BaseModel": _Model(1000.0), "SecondModel": _Model(2000.0)}


def _file(folder, name, users, model=None):
    with open(folder / name, "w") as fh:
        for u in users:
            fh.write(json.dumps({"user_id": u, **{c: float(u) for c in ML.FEATURES}, **({"model_type": model} if model else {})}) + "\n")


def test_each_request_has_one_log_row(spark, tmp_path, monkeypatch):
    inbox, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    inbox.mkdir()
    _file(inbox, "a.json", range(0, 10))
    _file(inbox, "b.json", range(10, 20))
    assert jobs.serve_requests(spark, str(inbox), MODELS, log, state, files_per_batch=1) == 2
    _file(inbox, "c.json", range(20, 30))
    _file(inbox, "d.json", range(90, 95), model="SecondModel")        # names its model: scored, not logged
    # A run that is killed after its batch was written and before the stream noted it.
    real = B.prediction_log

    def dying(scored):
        rows = real(scored)
        rows.write.mode("overwrite").json(f"{log}/batch=2")
        raise RuntimeError("killed")

    monkeypatch.setattr(B, "prediction_log", dying)
    with pytest.raises(Exception, match="killed"):
        jobs.serve_requests(spark, str(inbox), MODELS, log, state)
    monkeypatch.setattr(B, "prediction_log", real)
    assert jobs.serve_requests(spark, str(inbox), MODELS, log, state) == 1
    assert jobs.serve_requests(spark, str(inbox), MODELS, log, state) == 0
    rows = SK.read_prediction_log(spark, log).collect()
    assert sorted(r.user_id for r in rows) == list(range(30))
    assert {r.model_type for r in rows} == {"BaseModel", "SecondModel"}
    assert all(r.prediction == r.user_id + (1000 if r.model_type == "BaseModel" else 2000) for r in rows)
