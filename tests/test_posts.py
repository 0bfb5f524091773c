from __future__ import annotations

import json
from datetime import datetime

import pytest
from post_fixtures import ENVELOPE, SPECIAL, post
from pyspark.sql import functions as F

from postquarry.functions import naming as N
from postquarry.functions import posts as P
from postquarry.functions import times as TM
from postquarry.operators import filters as FL


@pytest.fixture(scope="module")
def posts(spark):
    lines = [json.dumps(p) for p in SPECIAL.values()] + [json.dumps(ENVELOPE), json.dumps({"data": SPECIAL[12] | {"id": 18}}), "{broken"]
    return P.parse_posts(spark.createDataFrame([(v,) for v in lines], "value STRING")).cache()


def by_id(df, *columns):
    return {r["id"]: tuple(r)[1:] for r in df.select("id", *columns).collect()}


def test_envelope_and_bare_parse_alike(posts):
    got = by_id(posts, "lang", "text")
    assert got[1] == ("en", "text 1") and got[18] == ("en", "text 12")


def test_malformed_line_is_kept_aside(posts):
    assert [r[0] for r in posts.where("_corrupt_record = '{broken'").select("id").collect()] == [None]


def test_new_generation_yields_nulls(posts):
    row = posts.where("id = 17 AND _corrupt_record IS NULL").select(
        P.post_url(F.col("user.screen_name"), F.col("id")).alias("u"), TM.event_time(F.col("timestamp_ms")).alias("t"),
        P.full_text(F.col("truncated"), F.col("text"), F.col("extended_tweet.full_text")).alias("x"),
    ).first()
    assert tuple(row) == (None, None, "new generation")


def test_full_text(posts):
    got = by_id(posts, P.full_text(F.col("truncated"), F.col("text"), F.col("extended_tweet.full_text")))
    assert got[1] == ("text 1",) and got[2] == ("the full text",) and got[3] == ("text 3",)


def test_media_by_key_presence(posts):
    ent, ext = F.col("entities"), F.col("extended_entities")
    got = by_id(posts, P.contains_media(ent, ext), P.media_urls(ent, ext))
    assert got[1] == (None, [])
    assert got[12] == (True, ["m1"])
    assert got[13] == (True, ["m2", "m3"])
    assert got[14] == (True, [])
    assert got[15] == (True, [])
    assert sorted(r[0] for r in FL.with_media(posts).select("id").collect()) == [12, 13, 14, 15, 18]


def test_hashtags_keep_repeats_and_case(posts):
    got = by_id(posts, P.hashtags(F.col("entities")))
    assert got[12] == (["a", "A", "a"],) and got[1] == ([],) and got[13] == ([],)


def test_url_and_time(posts):
    got = by_id(posts, P.post_url(F.col("user.screen_name"), F.col("id")), TM.event_time(F.col("timestamp_ms")), TM.event_time(F.col("timestamp_ms"), "Europe/Vienna"))
    assert got[1] == ("https://x.com/name1/status/1", datetime(2022, 1, 1, 0, 0, 10), datetime(2022, 1, 1, 1, 0, 10))


def test_original_sensitive_location(posts):
    ids = lambda df: {r[0] for r in df.where("id IS NOT NULL").select("id").collect()}
    everything = ids(posts)
    assert everything - ids(FL.original_only(posts)) == {4, 5, 6, 7}
    assert everything - ids(FL.drop_sensitive(posts)) == {8}
    assert ids(FL.require_any(posts)) == {10, 11, 17}
    assert ids(FL.require_any(posts, empty_is_missing=True)) == {11}
    assert ids(FL.truncated_only(posts)) == {2, 3}


def test_reject_reason_names_the_first_rule(spark):
    lines = [post(1, possibly_sensitive=True), post(2), post(3, geo={"a": 1}, lang="xx"), post(4, geo={"a": 1}), post(5, geo={"a": 1}, quoted_status_id=1)]
    df = P.parse_posts(spark.createDataFrame([(json.dumps(p),) for p in lines], "value STRING"))
    judged = FL.with_reject_reason(df, FL.post_rules(["en"], sensitive=True, location=True))
    assert by_id(judged, "reject_reason") == {
        1: (FL.SENSITIVE,), 2: (FL.NO_LOCATION,), 3: (FL.OTHER,), 4: (None,), 5: (FL.OTHER,),
    }
    counts = {r["reason"]: r["n"] for r in FL.reject_counts(judged).collect()}
    assert sum(counts.values()) == 5 and counts["accepted"] == FL.accepted(judged).count() == 1


def test_missing_language_is_rejected(spark):
    df = spark.createDataFrame([(None,)], "lang STRING").withColumns({m: F.lit(None).cast("string") for m in P.ORIGIN_MARKERS})
    assert FL.with_reject_reason(df, FL.post_rules(["en"])).first()["reject_reason"] == FL.OTHER


@pytest.mark.parametrize(("minutes", "at", "want"), [
    (15, "2022-01-01 23:59:59", "2022-01-01 23:45:00"),
    (25, "2022-01-01 00:03:00", "2022-01-01 00:00:00"),
    (25, "2022-01-01 23:59:00", "2022-01-01 23:45:00"),
    (60, "2022-01-01 10:59:00", "2022-01-01 10:00:00"),
    (1440, "2022-01-01 10:59:00", "2022-01-01 00:00:00"),
])
def test_bucket_start(spark, minutes, at, want):
    df = spark.createDataFrame([(datetime.fromisoformat(at),)], "ts TIMESTAMP_NTZ")
    assert TM.with_bucket(df, "ts", minutes).first()["bucket"] == datetime.fromisoformat(want)


def test_bucket_of_an_instant_uses_the_zone(spark):
    df = spark.sql("SELECT TIMESTAMP '2022-01-01 23:50:00 UTC' AS ts")
    assert TM.with_bucket(df, "ts", 15, "Europe/Vienna").first()["bucket"] == datetime(2022, 1, 2, 0, 45)


def test_names(spark):
    one = spark.range(1).select(
        N.member_stem(F.lit("20220101/20220101000000.json.gz")), N.archive_date(F.lit("/d/stream-20220101.tar")),
        N.dump_month(F.lit("/d/archive-stream-2022-01")), N.padded_lang(F.lit("en")), N.padded_lang(F.lit("longer")),
        N.padded_month(F.lit(3)), N.coder_of(F.lit("annot_2022_en_ada.parquet")), TM.bucket_time(F.lit("202201010045.jsonl.gz")),
        TM.bucket_time(F.lit("nothing")),
    ).first()
    assert tuple(one) == ("20220101000000", "20220101", "2022-01", "en_", "longer", "03", "ada", datetime(2022, 1, 1, 0, 45), None)


def test_time_that_is_no_number_is_null(spark):
    df = spark.createDataFrame([("x",), (None,), ("1640995200999",)], "ms STRING")
    assert [r[0] for r in df.select(TM.event_time(F.col("ms"))).collect()] == [None, None, datetime(2022, 1, 1)]


def test_named_fields_only(spark, posts):
    line = spark.createDataFrame([(json.dumps({"data": SPECIAL[12]}),)], "value STRING")
    df = P.parse_posts(line, fields=["lang", "id"])
    assert df.columns == ["id", "lang", "_corrupt_record"] and tuple(df.first()) == (12, "en", None)


def test_a_filter_does_not_parse_twice(spark):
    df = P.parse_posts(spark.createDataFrame([("{}",)], "value STRING")).where("lang = 'en' AND truncated")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
