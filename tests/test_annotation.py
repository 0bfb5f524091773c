from __future__ import annotations

from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postquarry.functions import answers as A
from postquarry.operators import annotation as AN
from postquarry.sinks import tables as K
from postquarry.sources import files as S

COLUMNS = "id INT, text STRING, text_relevant STRING, text_class STRING, media_relevant STRING, media_class STRING"
CODERS = {
    "ada": [(1, "t1", "r", "as", "n", None), (2, "t2", "y", "ag", None, None), (3, "t3", "n", "as", None, None), (4, "t4", None, "", None, None), (5, "t5", "q", None, None, None)],
    "bob": [(1, "t1", "R", "as", "n", None), (2, "t2", "n", "wl", None, None), (3, "t3", "n", None, None, None), (4, "t4", None, None, None, None), (5, "t5", "r", None, None, None)],
    "cyd": [(1, "t1", "r", "as", "n", None), (2, "t2", "r", "ag", None, None), (4, "t4", None, None, None, None)],
}


@pytest.fixture(scope="module")
def coded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("coders")
    for coder, rows in CODERS.items():
        pq.write_table(spark.createDataFrame(rows, COLUMNS).toArrow(), folder / f"annot_2022_01_en_{coder}.parquet")
    return S.read_coder_tables(spark, str(folder), COLUMNS)


@pytest.fixture(scope="module")
def cells(coded):
    return AN.answer_cells(coded, "id", "coder").cache()


@pytest.fixture(scope="module")
def answers(cells):
    return AN.answers_long(cells).cache()


def test_coder_comes_from_the_file_name(coded):
    assert {r["coder"]: r["n"] for r in coded.groupBy("coder").agg(F.count("*").alias("n")).collect()} == {"ada": 5, "bob": 5, "cyd": 3}


def test_answers(answers):
    got = {(r["item"], r["question"], r["answer"]): r["coders"] for r in AN.coders_per_answer(answers).collect()}
    assert got[1, "text_relevant", "r"] == "ada; bob; cyd"
    assert got[2, "text_relevant", "r"] == "ada; cyd" and got[2, "text_relevant", "n"] == "bob"
    assert got[3, "text_class", "as"] == "ada"
    assert not any(item == 4 for item, _, _ in got)
    maps = {(r["item"], r["question"]): r["coders"] for r in AN.coder_map(answers).collect()}
    assert maps[2, "text_class"] == {"ag": ["ada", "cyd"], "wl": ["bob"]}


def test_broken_answers(cells):
    got = {(r["coder"], r["item"], r["question"], r["problem"]) for r in AN.broken_cells(cells).collect()}
    assert got == {("ada", 5, "text_relevant", "wrong value"), ("ada", 3, "text_class", "inconsistent"), ("bob", 2, "text_class", "inconsistent")}
    assert {tuple(r) for r in AN.broken_counts(cells).collect()} == {("ada", 2, 2), ("bob", 1, 1)}


def test_inconsistent_answers_still_count_unless_dropped(cells, answers):
    assert answers.where("item = 3 AND question = 'text_class'").count() == 1
    assert AN.answers_long(cells, drop_inconsistent=True).where("item = 3 AND question = 'text_class'").count() == 0


def matrix_of(rows: list[tuple[int, str, str]], items: list[int], domain: list[str]) -> list[list[int]]:
    n = len({coder for _, coder, _ in rows})
    counts = Counter((item, code) for item, _, code in rows)
    return [[*(counts[i, c] for c in domain), n - sum(counts[i, c] for c in domain)] for i in items]


def kappa_of(matrix: list[list[int]]) -> float | None:
    n, size = sum(matrix[0]), len(matrix)
    observed = sum((sum(k * k for k in row) - n) / (n * (n - 1)) for row in matrix) / size
    chance = sum((sum(col) / (size * n)) ** 2 for col in zip(*matrix))
    return None if abs(1 - chance) < 1e-12 else (observed - chance) / (1 - chance)


def test_matrix_and_kappa_match_a_direct_computation(coded, answers):
    items = coded.select("id")
    for question, domain in A.QUESTIONS.items():
        rows = [(r["item"], r["coder"], r["answer"]) for r in answers.where(F.col("question") == question).collect()]
        got = AN.rating_matrix(items, answers, question, list(domain), "id").orderBy("item").collect()
        want = matrix_of(rows, [1, 2, 3, 4, 5], list(domain)) if rows else [[0] * (len(domain) + 1)] * 5
        assert [list(r)[1:] for r in got] == want
    kappas = {r["question"]: r for r in AN.fleiss_kappa(items, answers, A.QUESTIONS, "id").collect()}
    for question in ("text_relevant", "text_class", "media_relevant"):
        rows = [(r["item"], r["coder"], r["answer"]) for r in answers.where(F.col("question") == question).collect()]
        assert kappas[question]["kappa"] == pytest.approx(kappa_of(matrix_of(rows, [1, 2, 3, 4, 5], list(A.QUESTIONS[question]))), abs=5e-4)
    assert kappas["media_class"]["kappa"] is None and kappas["media_class"]["interpretation"] is None


def test_full_agreement_is_one_and_single_class_is_undefined(spark):
    items = spark.createDataFrame([(1,), (2,)], "item INT")
    full = spark.createDataFrame([(i, "q", "ab"[i - 1], c) for i in (1, 2) for c in "xyz"], "item INT, question STRING, answer STRING, coder STRING")
    row = AN.fleiss_kappa(items, full, {"q": ["a", "b"]}).first()
    assert row["kappa"] == 1.0 and row["interpretation"] == "Almost perfect agreement"
    same = full.withColumn("answer", F.lit("a"))
    assert AN.fleiss_kappa(items, same, {"q": ["a", "b"]}).first()["kappa"] is None
    assert AN.fleiss_kappa(items, full.where("coder = 'x'"), {"q": ["a", "b"]}).first()["kappa"] is None
    elsewhere = full.withColumn("item", F.lit(-1).cast(full.schema["item"].dataType)).withColumn("answer", F.lit("b"))
    assert tuple(AN.fleiss_kappa(items, full.unionByName(elsewhere), {"q": ["a", "b"]}).first()) == tuple(row)


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (-0.1, 0.0, 0.2, 0.4, 0.6, 0.8, None, float("nan"))], "k DOUBLE")
    assert [r[0] for r in df.select(A.kappa_band(F.col("k"))).collect()] == [
        "Poor aggreement", "Slight agreement", "Fair agreement", "Moderate agreement", "Substantial agreement", "Almost perfect agreement", None, None,
    ]


def test_agreed_per_item_and_per_question(answers):
    per_item = {tuple(r) for r in AN.agreed(answers, A.QUESTIONS).collect()}
    assert per_item == {(1, "text_relevant", "r"), (1, "text_class", "as"), (1, "media_relevant", "n"), (3, "text_relevant", "n"), (3, "text_class", "as"), (5, "text_relevant", "r")}
    assert {tuple(r) for r in AN.agreed(answers, A.QUESTIONS, per_item=False).collect()} == per_item


def test_disagreed(spark, answers, tmp_path):
    meta = spark.createDataFrame([(i, f"t{i}") for i in range(1, 6)], "id INT, text STRING")
    table = AN.disagreed(answers, A.QUESTIONS, meta, "id")
    assert table.columns[2:] == sorted(table.columns[2:], reverse=True)
    row = table.collect()
    assert len(row) == 1 and row[0]["item"] == 2 and row[0]["text"] == "t2"
    assert (row[0]["text_relevant_RELEVANT"], row[0]["text_relevant_NOT_RELEVANT"], row[0]["text_class_WETLANDS"]) == ("ada; cyd", "bob", "bob")
    assert [r[0] for r in AN.needed_columns(answers, A.QUESTIONS).collect()] == [
        "text_relevant_RELEVANT", "text_relevant_NOT_RELEVANT", "text_class_WETLANDS", "text_class_AGRICULTURAL",
    ]
    K.write_csv(table, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == table.columns


EXPORT = """[
 {"id": "t1", "annotator": 1, "annotation_id": 10, "rel": "yes", "kind": "a", "note": "first", "text": "one"},
 {"id": "t2", "annotator": 1, "annotation_id": 11, "rel": "no", "text": "two"},
 {"id": "t1", "annotator": 2, "annotation_id": 12, "rel": "yes", "kind": "b", "text": "changed"},
 {"id": "t3", "annotator": 2, "annotation_id": null, "text": "three"}
]"""
CHOICES = {"rel": ["yes", "no"], "kind": ["a", "b"]}


@pytest.fixture(scope="module")
def export(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("export") / "export.json"
    path.write_text(EXPORT)
    return S.read_tool_export(spark, str(path), "id STRING, annotator INT, annotation_id BIGINT, rel STRING, kind STRING, note STRING, text STRING")


def test_wide_answers_of_tasks_that_recur(spark, export):
    users = spark.createDataFrame([(1, "Ada")], "user_id INT, name STRING")
    got = {r["task"]: r.asDict() for r in AN.wide_answers(export, CHOICES, ["text"], users).collect()}
    assert set(got) == {"t1", "t2"}
    assert got["t1"]["rel-yes"] == "2; Ada" and got["t1"]["kind-a"] == "Ada" and got["t1"]["kind-b"] == "2" and got["t1"]["text"] == "one"
    assert got["t2"]["kind-000"] == "Ada" and got["t2"]["rel-yes"] is None


def test_choice_counts_are_zero_filled(export):
    got = {(r["task"], r["question"], r["option"]): r["n"] for r in AN.choice_counts(AN.choice_answers(export, list(CHOICES)), CHOICES).collect()}
    assert len(got) == 2 * 6 and got["t1", "rel", "yes"] == 2 and got["t1", "rel", "000"] == 0 and got["t2", "kind", "000"] == 1
    assert [r["answer"] for r in AN.unknown_choices(AN.choice_answers(export, ["kind"]), {"kind": ["a"]}).collect()] == ["b"]


def test_free_text_missing_and_progress(export):
    assert [tuple(r) for r in AN.free_text(export, ["note"]).collect()] == [("t1", "note", 1, "first")]
    assert AN.free_text_map(AN.free_text(export, ["note"])).first()["texts"] == {1: "first"}
    assert [r["id"] for r in AN.missing_tasks(export).collect()] == ["t3"]
    assert tuple(AN.progress(export.withColumn("project", F.lit("p")), "project").first()) == ("p", 3, 2, 3)


def test_codes_outside_the_domain_do_not_break_agreement(spark):
    rows = [(1, "q", "a", "x"), (1, "q", "zz", "y"), (2, "q", "a", "x"), (2, "q", "b", "y")]
    answers = spark.createDataFrame(rows, "item INT, question STRING, answer STRING, coder STRING")
    assert [tuple(r) for r in AN.agreed(answers, {"q": ["a", "b"]}).collect()] == [(1, "q", "a")]
    assert [r["item"] for r in AN.disagreed(answers, {"q": ["a", "b"]}).collect()] == [2]


def test_tasks_follow_the_number_of_lines(spark, monkeypatch):
    from postquarry import session
    from postquarry.plans import answer_queries as Q

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    lines = Q.coded_lines(spark, sf)
    held = lines.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held < lines.count() / 6
    listed = AN.disagreed_long(Q.long_answers(spark, sf))
    assert listed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # lines by order, nothing after that
    kappa = AN.fleiss_kappa(Q.order_items(spark, sf), Q.long_answers(spark, sf), Q.DOMAINS)
    plan = kappa._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and not [line for line in plan.splitlines() if "LeftSemi" in line and "Broadcast" in line]
