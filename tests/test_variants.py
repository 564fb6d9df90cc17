from __future__ import annotations

from cartlens.sources import variants as V

LINES = ['{"user_id": 1, "name": "a", "born": "1990-01-02"}', '{"user_id": "x7", "name": "b", "extra": {"a": [1, 2]}}',
         '{"user_id": 3.0, "name": null, "born": 5}', '{broken', '[1, 2]', '"text"', '', '{}', '{"user_id": 4, "na me": "q"}']


def test_fields_types_and_rejects(spark, tmp_path):
    path = tmp_path / "users.jsonl"
    path.write_text("\n".join(LINES) + "\n")
    df = V.read_variants(spark, str(path))
    assert df.count() == 8 and {r.line for r in V.rejected(df).collect()} == {"{broken", "[1, 2]", '"text"'}
    report = {(r.field, r.data_type): r["rows"] for r in V.field_report(df).collect()}
    assert report[("name", "STRING")] == 2 and report[("name", "VOID")] == 1 and report[("na me", "STRING")] == 1
    assert sum(n for (f, _), n in report.items() if f == "user_id") == 4 and ("user_id", "STRING") in report
    assert "user_id: VARIANT" in V.variant_schema(df) and "extra: OBJECT<a: ARRAY<BIGINT>>" in V.variant_schema(df)


def test_typed_columns_keep_what_does_not_fit(spark, tmp_path):
    path = tmp_path / "users.jsonl"
    path.write_text("\n".join(LINES) + "\n")
    got = V.with_fields(V.read_variants(spark, str(path)), {"user_id": "bigint", "born": "date", "na me": "string"})
    rows = {(r.user_id, str(r.born), r["na me"]): (sorted(r._drifted), str(r._rest)) for r in got.collect()}
    assert rows[(1, "1990-01-02", None)][0] == [] and rows[(4, "None", "q")][0] == []
    assert rows[(3, "None", None)][0] == ["born"] and rows[(None, "None", None)] is not None
    assert got.count() == 5
    drifted = [r for r in got.collect() if "user_id" in r._drifted]
    assert len(drifted) == 1 and "x7" in str(drifted[0]._rest) and '"a":[1,2]' in str(drifted[0]._rest)
