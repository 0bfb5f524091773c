from __future__ import annotations

import json

from pyspark.sql import functions as F

from postquarry.operators import catalog as C
from postquarry.operators import shape as SH
from postquarry.sinks import tables as K
from postquarry.sources import files as S


def test_months_and_flags(spark, tmp_path):
    for name in ("stream-2022-01", "stream-2022-02", "other"):
        (tmp_path / name).mkdir()
    months = C.months_found(S.list_months(spark, str(tmp_path)))
    made = spark.createDataFrame([(2022, 1), (2020, 5)], "year INT, month INT")
    got = sorted(tuple(r) for r in C.month_catalog(months, {"stats": made, "index": made.limit(0)}).collect())
    assert got == [(2022, 1, True, False), (2022, 2, False, False)]


def test_new_users_are_added_once(spark, tmp_path):
    path = str(tmp_path / "users")
    spark.createDataFrame([("1", "known")], "id_str STRING, content STRING").write.parquet(path)
    seen = spark.createDataFrame([("1", "x", 1), ("2", "late", 3), ("2", "early", 2), (None, "none", 1)], "id_str STRING, content STRING, o INT")
    K.append_new_rows(seen, path, "id_str", ["o"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("1", "known"), ("2", "early")]


def shape(spark, objects, batch=None):
    rows = [(json.dumps(o), b) for o, b in zip(objects, batch or [0] * len(objects))]
    return spark.createDataFrame(rows, "value STRING, batch INT")


def test_shape_union(spark):
    objects = [{"town": "x", "floors": 12}, {"town": "x", "roof": "flat", "a.b": None, "deep": {"er": [{"k": 1}, {"k": 1.5, "j": True}]}}]
    got = {(r["path"], r["type"]): (r["n"], r["required"]) for r in SH.key_presence(shape(spark, objects), "value").collect()}
    assert got["town", "string"] == (2, True) and got["floors", "integer"] == (1, False) and got["roof", "string"] == (1, False)
    assert got["deep", "object"] == (1, False) and got["deep.er", "array"] == (1, True) and got["deep.er[]", "object"] == (2, False)
    assert got["deep.er[].k", "integer"] == (1, True) and got["deep.er[].k", "number"] == (1, True) and got["deep.er[].j", "boolean"] == (1, False)
    assert got["a\\.b", "null"] == (1, False) and got["", "object"] == (2, False)


def test_shape_has_no_depth_limit_and_counts_malformed(spark):
    deep: dict = {}
    for _ in range(60):
        deep = {"d": deep}
    df = shape(spark, [deep]).unionByName(spark.createDataFrame([("{x", 0)], "value STRING, batch INT"))
    got = {(r["path"], r["type"]) for r in SH.key_presence(df, "value").collect()}
    assert (".".join("d" * 60), "object") in got and ("", "malformed") in got


def test_drift(spark):
    objects = [{"a": 1, "b": 1}, {"a": 1, "b": 1}, {"a": 1}, {"a": 1, "b": 1, "c": "x"}, {"c": "y"}]
    presence = SH.key_presence(shape(spark, objects, [1, 1, 2, 2, 3]), "value", "batch")
    got = {tuple(r) for r in SH.schema_drift(presence, "batch").collect()}
    assert got == {
        (2, "b", "integer", "now optional"), (2, "c", "string", "added"),
        (3, "a", "integer", "removed"), (3, "b", "integer", "removed"), (3, "c", "string", "now required"),
    }


def test_drift_goes_by_the_order_of_numbers(spark):
    objects = [{"a": 1}] * 9 + [{"a": 1, "b": 1}] * 3
    presence = SH.key_presence(shape(spark, objects, list(range(1, 13))), "value", "batch")
    assert {tuple(r) for r in SH.schema_drift(presence, "batch").collect()} == {(10, "b", "integer", "added")}


def test_marks_in_keys_are_told_from_paths(spark):
    objects = [{"a.b": 1, "a": {"b": 2}, "a[]": 3, "": 4, "c\\": 5}]
    got = {r["path"] for r in SH.key_presence(shape(spark, objects), "value").where("type = 'integer'").collect()}
    assert got == {"a\\.b", "a.b", "a\\[]", "\\", "c\\\\"}


def test_types_of_numbers_and_texts_that_are_no_json(spark):
    texts = ['[1, 1.0, 1e3, 9223372036854775807, 9223372036854775808, -0.5]', '{"a": 1, "a": 2}', "", '{"a": NaN}', "null", '"x"', "[[], [[{}]]]"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "value STRING")
    got = {(r["path"], r["type"]): r["n"] for r in SH.key_presence(df, "value").collect()}
    assert got == {
        ("", "array"): 2, ("[]", "integer"): 2, ("[]", "number"): 4, ("", "malformed"): 3, ("", "null"): 1, ("", "string"): 1,
        ("[]", "array"): 2, ("[][]", "array"): 1, ("[][][]", "object"): 1,
    }


def test_shape_runs_without_python(spark):
    df = SH.key_presence(shape(spark, [{"a": 1}], [1]).repartition(2), "value", "batch")
    plan = SH.schema_drift(df, "batch")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_partition_values_without_reading(spark, tmp_path):
    root = str(tmp_path / "t")
    assert S.list_partition_values(spark, root, "day").count() == 0
    spark.range(1).select("id", F.lit("20220101").alias("day")).write.partitionBy("day").json(root)
    assert [r["day"] for r in S.list_partition_values(spark, root, "day").collect()] == ["20220101"]


def test_json_lines_plain_and_gzip(spark, tmp_path):
    import gzip

    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{broken\n')
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress(b'{"id": 2}\n'))
    got = S.read_jsonl(spark, str(tmp_path), "id INT")
    assert sorted(str(r["id"]) for r in got.collect()) == ["1", "2", "None"]
