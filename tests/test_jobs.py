"""The reference's entry points as jobs over JSON-lines files, and the CLI."""

from __future__ import annotations

import json

import pytest

from cartlens import jobs
from cartlens.__main__ import main
from cartlens.sources import sinks as SK
from conftest import PRODUCTS_SMALL, SESSIONS_SMALL, rows


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    d = tmp_path_factory.mktemp("jsonl")
    sp, pp = d / "sessions.jsonl", d / "products.jsonl"
    with open(sp, "w") as fh:
        for sid, t, u, p, e, disc, pid in SESSIONS_SMALL:
            # the space separator of a plain str(datetime) must parse as well as 'T'
            stamp = str(t) if sid % 2 else t.isoformat()
            fh.write(json.dumps({"session_id": sid, "timestamp": stamp, "user_id": u,
                                 "product_id": p, "event_type": e, "offered_discount": disc,
                                 "purchase_id": pid}) + "\n")
    with open(pp, "w") as fh:
        for pid, price in PRODUCTS_SMALL:
            fh.write(json.dumps({"product_id": pid, "price": price}) + "\n")
    return str(sp), str(pp)


def test_prepare_data_with_dotted_dates(spark, inputs, tmp_path):
    out = str(tmp_path / "train_csv")
    df = jobs.prepare_data(spark, *inputs, "2021.11.01", "2022.01.31", out_csv=out)
    assert df.count() == 5
    back = SK.read_csv(spark, out, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_prepare_data_v2_v1(spark, inputs):
    assert jobs.prepare_data_v2(spark, *inputs, "2021.11.01", "2022.02.01").count() == 11
    assert jobs.prepare_data_v1(spark, *inputs, "2021-11-01", "2022-02-01").count() == 12


def test_train_models_reports_and_saves(spark, inputs, tmp_path):
    report = jobs.train_models(spark, *inputs, ("2021-11-01", "2021-12-31"),
                               ("2022-03-01", "2022-03-31"), kinds=("logreg", "forest"),
                               model_dir=str(tmp_path / "models"), trees=5, depth=3)
    models = {r.model for r in report.collect()}
    assert models == {"logreg", "forest", "majority"}
    assert (tmp_path / "models" / "forest" / "metadata").exists()
    with pytest.raises(ValueError):
        jobs.train_models(spark, *inputs, ("2021-11-01", "2021-12-31"), ("2021-12-01", "2022-01-31"))


def test_serve_batch_loads_after_first_run(spark, inputs, tmp_path):
    args = (spark, *inputs, ("2021-11-01", "2022-01-31"), ("2021-11-01", "2022-01-31"),
            str(tmp_path / "models"), str(tmp_path / "log"))
    with pytest.raises(ValueError):              # the windows overlap
        jobs.serve_batch(*args)
    first = jobs.serve_batch(*args, allow_overlap=True).collect()
    assert len(first) == 5 and {r.model_type for r in first} <= {"BaseModel", "SecondModel"}
    second = jobs.serve_batch(*args, allow_overlap=True).collect()   # models now load from disk
    assert sorted(r.prediction for r in first) == sorted(r.prediction for r in second)
    assert SK.read_prediction_log(spark, str(tmp_path / "log")).count() == 10


def test_cli_prepare_data(spark, inputs, tmp_path):
    out = str(tmp_path / "cli_csv")
    assert main(["prepare-data", "--sessions", inputs[0], "--products", inputs[1],
                 "--begin", "2021.11.01", "--end", "2022.01.31", "--out", out]) == 0
    assert spark.read.option("header", True).csv(out).count() == 5


def test_explore_writes_every_table(spark, inputs, tmp_path):
    out = str(tmp_path / "explore")
    assert main(["explore", "--sessions", inputs[0], "--products", inputs[1], "--out", out]) == 0
    tables = jobs.explore(spark, *inputs)
    for name in tables:
        assert (tmp_path / "explore" / name).exists(), name
    probs = {r.n_products: r.purchase_prob for r in tables["purchase_prob_by_views"].collect()}
    assert probs == {0: 0.0, 1: 0.8, 2: 0.5, 3: 1.0}
    gaps = [str(r.date) for r in tables["missing_dates"].collect()]
    assert "2021-11-05" not in gaps and "2021-11-06" in gaps


def test_explore_from_staged_parquet_equals_json(spark, inputs, tmp_path):
    direct = jobs.explore(spark, *inputs)
    staged = jobs.explore(spark, *inputs, stage_dir=str(tmp_path / "stage"))
    for name in ("purchase_prob_by_views", "user_features", "missing_fraction", "missing_dates"):
        # float aggregates may differ in the last bit with another row order
        assert rows(direct[name]) == rows(staged[name]), name


def test_every_job_counts_rejected_lines_and_refuses_too_many(spark, inputs, tmp_path, capsys):
    text = open(inputs[0]).read()
    bad = tmp_path / "bad.jsonl"
    bad.write_text(text + '{"session_id": 1, "user_id": "x7", "timestamp": "soon"}\n{broken\n')
    args = ["--sessions", str(bad), "--products", inputs[1]]
    window = ["--begin", "2021.11.01", "--end", "2022.01.31", "--out", str(tmp_path / "o")]
    assert main(["prepare-data", *args, *window]) == 2
    assert not (tmp_path / "o").exists() and "refused: 1 of" in capsys.readouterr().err
    assert main(["prepare-data", *args, *window, "--max-reject-share", "0.5", "--rejects", str(tmp_path / "r")]) == 0
    err = capsys.readouterr().err
    assert "1 rejected" in err and "unparsed_user_id=1" in err and "unparsed_timestamp=1" in err
    assert {r.table: r.lines for r in jobs.rejected_lines(spark, str(tmp_path / "r")).collect()} == {"sessions": 1}
    report: list = []
    allow = {"max_reject_share": 0.5, "report": report}
    jobs.prepare_data_v2(spark, str(bad), inputs[1], "2021.11.01", "2022.02.01", inputs=allow)
    jobs.prepare_data_v1(spark, str(bad), inputs[1], "2021-11-01", "2022-02-01", inputs=allow)
    jobs.explore(spark, str(bad), inputs[1], inputs=allow)
    assert [r["corrupt_lines"] for r in report if r["table"] == "sessions"] == [1, 1, 1]
    windows = (("2021-11-01", "2021-11-30"), ("2022-03-01", "2022-03-31"))
    for job in (lambda **k: jobs.train_models(spark, str(bad), inputs[1], *windows, kinds=("gnb",), **k),
                lambda **k: jobs.serve_batch(spark, str(bad), inputs[1], windows[1], windows[0], str(tmp_path / "m"), **k),
                lambda **k: jobs.explore(spark, str(bad), inputs[1], **k)):
        with pytest.raises(jobs.TooManyRejects):
            job()


def test_cli_compare_against_later_spend(spark, inputs, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    rows_ = [("01/05/2022 00:00:00:000000", "BaseModel", 500.0, 102), ("01/20/2022 10:00:00:000001", "SecondModel", 90.0, 103),
             ("03/01/2022 00:00:00:000000", "BaseModel", 1.0, 104), ("not a time", "BaseModel", 2.0, 102), ("01/05/2022 00:00:00:000000", None, 3.0, None)]
    with open(log / "a.json", "w") as fh:
        for t, m, p, u in rows_:
            fh.write(json.dumps({"prediction_time": t, "model_type": m, "prediction": p, "user_id": u}) + "\n")
    got = {r.model_type: r for r in jobs.compare_log(spark, str(log), *inputs, replicates=8).collect()}
    # user 102 bought 250 in November and 600 in January; 103 bought in November only; 104's third month is to come
    assert (got["BaseModel"].requests, got["BaseModel"].matched, got["BaseModel"].pending) == (3, 1, 1)
    assert got["BaseModel"].mae == 100.0 and got["BaseModel"].mean_error == -100.0 and got["BaseModel"].mae_low == 100.0
    assert (got["SecondModel"].matched, got["SecondModel"].mae) == (1, 90.0)
    assert (got[None].requests, got[None].matched) == (1, 0)
    assert main(["compare", "--log", str(log), "--sessions", inputs[0], "--products", inputs[1], "--out", str(tmp_path / "c")]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3
    assert main(["compare", "--log", str(log)]) == 0


def test_cli_serves_request_files_with_the_stored_models(spark, inputs, tmp_path):
    from cartlens.plans import models as ML
    jobs.serve_batch(spark, *inputs, ("2021-11-01", "2022-01-31"), ("2021-11-01", "2022-01-31"), str(tmp_path / "m"), allow_overlap=True)
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "r.json", "w") as fh:
        for u in range(6):
            fh.write(json.dumps({"user_id": u, **{c: 1.0 for c in ML.FEATURES}}) + "\n")
    args = ["serve-requests", "--requests", str(tmp_path / "in"), "--model-dir", str(tmp_path / "m"), "--log", str(tmp_path / "l"),
            "--checkpoint", str(tmp_path / "s")]
    assert main(args) == 0 and main(args) == 0
    log = SK.read_prediction_log(spark, str(tmp_path / "l")).collect()
    assert sorted(r.user_id for r in log) == list(range(6)) and all(r.prediction is not None for r in log)
