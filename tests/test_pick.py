from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from postquarry.operators import buckets as B
from postquarry.operators import filters as FL
from postquarry.operators import pick as PK
from postquarry.operators.numbering import number_rows

SLOT = ["lang", "slot_date", "slot_hour"]


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        ("en", "2021-12-31 23:59:55", 0), ("en", "2022-01-01 00:01:00", 1), ("en", "2022-01-01 00:01:00", 2), ("en", "2022-01-01 00:30:00", 3),
        ("en", "2022-01-31 23:10:00", 4), ("de", "2022-01-01 00:02:00", 5), ("en", "2022-02-01 00:00:00", 6),
    ]
    df = spark.createDataFrame([(lang, datetime.fromisoformat(at), n) for lang, at, n in rows], "lang STRING, ts TIMESTAMP_NTZ, line_no INT")
    return PK.with_slot(df, "ts")


def picked(df):
    return sorted(r["line_no"] for r in df.collect())


def test_first_seen_wins_ties(posts):
    january = FL.in_month(posts, "ts", 2022, 1)
    assert picked(PK.first_k(january, SLOT, ["ts", "line_no"])) == [1, 4, 5]


def test_previous_month_never_takes_a_slot(posts):
    assert 0 in picked(PK.first_k(posts, SLOT, ["ts", "line_no"]))
    assert picked(FL.in_month(posts, "ts", 2022, 1)) == [1, 2, 3, 4, 5]


def test_skipped_minutes_are_filtered_before_the_pick(posts):
    assert picked(PK.first_k(FL.in_month(posts, "ts", 2022, 1), SLOT, ["ts", "line_no"], 1, 5)) == [3, 4]


def test_first_k_with_positions(posts):
    got = PK.first_k(posts.where("lang = 'en' AND slot_date = '2022-01-01'"), SLOT, ["ts", "line_no"], 2, rank="pos")
    assert sorted((r["line_no"], r["pos"]) for r in got.collect()) == [(1, 0), (2, 1)]


def test_missing_slots_cover_the_grid(posts):
    january = FL.in_month(posts, "ts", 2022, 1)
    missing = PK.missing_slots(january, ["en", "de", "fr"], "2022-01-01", "2022-01-31")
    rows = {tuple(r) for r in missing.collect()}
    assert len(rows) == 3 * 31 * 24 - 3
    assert ("en", date(2022, 1, 1), 0) not in rows and ("fr", date(2022, 1, 1), 0) in rows


def test_hour_range_is_half_open(posts):
    assert picked(FL.in_hour(posts, "ts", "2022-01-31 23:00:00", "en")) == [4]
    assert picked(FL.in_hour(posts, "ts", "2022-01-01 00:00:00", "en")) == [1, 2, 3]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_numbering_with_a_hot_group_and_a_null_group(spark, partitions):
    """One group holds two thirds of the rows; its numbers are still dense."""
    df = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2990, F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.xxhash64("id").alias("o"), "id",
    )
    got = number_rows(df, ["o"], ["g"], partitions=partitions).toPandas()
    for _, rows in got.groupby("g", dropna=False):
        assert sorted(rows["position"]) == list(range(len(rows)))
        assert rows.sort_values("position")["o"].is_monotonic_increasing
    assert len(got) == 3000


def test_numbering_without_groups(spark):
    got = number_rows(spark.range(500).select((F.lit(1000) - F.col("id")).alias("k")), ["k"], partitions=7).collect()
    assert all(r["k"] == 501 + r["position"] for r in got) and len(got) == 500


def test_numbering_of_nothing(spark):
    assert number_rows(spark.range(0), ["id"]).count() == 0


def test_tasks(spark):
    df = spark.createDataFrame([(2, "b", "u2", None), (1, "a", "u1", True)], "k INT, text STRING, post_url STRING, contains_media BOOLEAN")
    got = PK.task_export(df, ["k"]).orderBy("task_idx").collect()
    assert [tuple(r) for r in got] == [(0, "a", "u1", True, None), (1, "b", "u2", False, None)]


def test_lookup_keeps_request_columns(spark):
    data = spark.createDataFrame([("d", "a", "m", i, f"v{i}") for i in range(5)], "dump STRING, archive STRING, member STRING, line_no BIGINT, value STRING")
    asked = spark.createDataFrame([("d", "a", "m", 3, 0), ("d", "a", "m", 1, 1)], "dump STRING, archive STRING, member STRING, line_no BIGINT, req_pos INT")
    assert [r["value"] for r in PK.lookup(data, asked).orderBy("req_pos").collect()] == ["v3", "v1"]


def test_distinct_sample_is_stable_and_distinct(spark):
    df = spark.range(400).select((F.col("id") % 100).alias("k"), F.col("id").alias("o"))
    one = sorted(tuple(r) for r in B.sample_distinct(df, "k", 20, 5, ["o"]).collect())
    two = sorted(tuple(r) for r in B.sample_distinct(df.repartition(9), "k", 20, 5, ["o"]).collect())
    assert one == two and len(one) == 20 and all(k == o for k, o in one)
    assert one != sorted(tuple(r) for r in B.sample_distinct(df, "k", 20, 6, ["o"]).collect())


def test_index_sums(spark):
    df = spark.createDataFrame([("en", 1), ("en", 1), ("en", 3), ("de", 3)], "lang STRING, bucket INT")
    index = B.bucket_index(df)
    assert sorted(tuple(r) for r in index.collect()) == [("de", 3, 1, 0), ("en", 1, 2, 0), ("en", 3, 1, 2)]


@pytest.mark.parametrize("n", [1, 250, 999, 1000, 5000])
def test_a_large_sample_is_cut_by_hash_groups(spark, n):
    df = spark.range(1000).select(F.col("id").alias("k"))
    small = {r["k"] for r in B.sample_distinct(df, "k", n, 9).collect()}
    large = {r["k"] for r in B.sample_distinct(df, "k", n, 9, direct=0).collect()}
    assert small == large and len(small) == min(n, 1000)


def test_draws_do_not_depend_on_chunks(spark, monkeypatch):
    index = spark.createDataFrame([("en", 0, 70, 0), ("de", 0, 9, 0)], "lang STRING, bucket INT, n BIGINT, first_row BIGINT")
    whole = sorted(map(tuple, B.sample_positions(index, 100, 1).collect()))
    monkeypatch.setattr(B, "STRIPE", 7)
    assert sorted(map(tuple, B.sample_positions(index, 100, 1).collect())) == whole
    assert len(whole) == 200 and {d for _, d, _ in whole} == set(range(100))


def test_new_days_with_and_without_a_list(spark, monkeypatch):
    df = spark.createDataFrame([("1", 1), ("2", 2), (None, 3)], "day STRING, id INT")
    known = spark.createDataFrame([("1",), ("1",), (None,)], "day STRING")
    want = [2, 3]
    assert sorted(r["id"] for r in B.new_days(df, known).collect()) == want
    assert sorted(r["id"] for r in B.new_days(df, known.limit(0)).collect()) == [1, 2, 3]
    monkeypatch.setattr(B, "LISTED_DAYS", 0)
    assert sorted(r["id"] for r in B.new_days(df, known).collect()) == want


def test_null_keys_are_never_sampled(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), ("c", 4), ("a", 5)], "k string, o int")
    for direct in (100, 0):
        assert {r["k"] for r in B.sample_distinct(df, "k", 3, 1, ["o"], direct=direct).collect()} == {"a", "b", "c"}
