from __future__ import annotations

import json

from postquarry.functions import posts as P
from postquarry.operators import stats as ST
from postquarry.sinks import tables as K
from postquarry.sources import files as S
from pyspark.sql import functions as F


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 4, 5, 49, 50, 14999, 15000, 15001, -1, None)], "n BIGINT")
    got = {r["label"]: r["n"] for r in ST.histogram(df, "n").collect()}
    assert got == {"0-5": 2, "5-50": 2, "50-500": 1, "500-2000": 0, "2000-5000": 0, "5000-8000": 0, "8000-10000": 0, "10000-15000": 2}


def test_equal_bins_hold_every_value(spark):
    df = spark.range(101).select(F.col("id").alias("v"))
    got = [r["n"] for r in ST.histogram_equal(df, "v").orderBy("bin").collect()]
    assert got == [10] * 9 + [11]


def test_equal_bins_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v DOUBLE")
    rows = ST.histogram_equal(df, "v").orderBy("bin").collect()
    assert [r["n"] for r in rows] == [0, 0, 0, 0, 0, 2, 0, 0, 0, 0]
    assert rows[0]["low"] == 2.5 and rows[-1]["high"] == 3.5


def counted(spark):
    rows = [("a1", "m1", "en", None), ("a1", "m1", "en", "x"), ("a1", "m2", "de", None), ("a2", "m1", "en", None), ("a2", "m3", None, "y")]
    return spark.createDataFrame(rows, "archive STRING, member STRING, lang STRING, reject_reason STRING")


def test_levels_add_up(spark):
    levels = ST.hierarchy_counts(counted(spark), ["archive", "member"], reject_col="reject_reason").collect()
    whole = [r for r in levels if r["level_mask"] == 7]
    assert [(r["total"], r["accepted"]) for r in whole] == [(5, 3)]
    for mask in {r["level_mask"] for r in levels}:
        assert sum(r["total"] for r in levels if r["level_mask"] == mask) == 5
        assert sum(r["accepted"] for r in levels if r["level_mask"] == mask) == 3
    assert {r["level_mask"] for r in levels} == {0, 1, 2, 3, 6, 7}


def test_nested_documents(spark):
    finest = counted(spark).where("lang IS NOT NULL").groupBy("archive", "member", "lang").agg(
        F.count("*").alias("total"), F.count_if(F.col("reject_reason").isNull()).alias("accepted"))
    got = {r["archive"]: json.loads(r["stats"]) for r in K.nested_stats(finest, "archive", "member", "lang").collect()}
    assert got["a1"] == {
        "total_posts": 3, "accepted_posts": {"de": 1, "en": 1},
        "items": {"m1": {"total_posts": 2, "accepted_posts": {"en": 1}}, "m2": {"total_posts": 1, "accepted_posts": {"de": 1}}},
    }


def test_tags_count_repeats_and_case(spark):
    df = spark.createDataFrame([("en", '{"hashtags":[{"text":"a"},{"text":"a"},{"text":"A"}]}'), ("en", None)], "lang STRING, entities STRING")
    tags = ST.frequency(df.withColumn("tags", P.hashtags(F.col("entities"))), ["lang"], "tags")
    assert {(r["tag"], r["n"]) for r in tags.collect()} == {("a", 2), ("A", 1)}


def test_count_map_round_trip(spark, tmp_path):
    (tmp_path / "langs.json").write_text('{"en": 5, "de": 2}')
    assert {tuple(r) for r in S.read_count_map(spark, str(tmp_path / "langs.json")).collect()} == {("en", 5), ("de", 2)}
