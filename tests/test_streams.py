"""Streams give what the batch operators give on every window the watermark has closed."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postquarry.functions import times as TM
from postquarry.operators import pick as PK
from postquarry.session import scratch_path
from postquarry.sources.files import read_repacked
from postquarry.streaming import streams as S
from pyspark.sql import types as T

SCHEMA = "lang STRING, ts TIMESTAMP_NTZ, id BIGINT"
START = datetime(2022, 1, 1)


def source(spark, folder, batches):
    """One file per micro-batch."""
    for i, rows in enumerate(batches):
        spark.createDataFrame([(lang, START + timedelta(minutes=m), n) for lang, m, n in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    schema = spark.read.parquet(f"{folder}/0").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*"), spark.read.schema(schema).parquet(f"{folder}/*")


BATCHES = [
    [("en", 5, 1), ("en", 61, 2), ("de", 10, 3)],
    [("en", 130, 4), ("de", 70, 5), ("en", 3, 6)],
    [("en", 400, 7), ("de", 399, 8)],
]


@pytest.fixture
def stream(spark, tmp_path):
    return source(spark, str(tmp_path / "in"), BATCHES)


def run(df, label):
    return S.run_to_table(df, scratch_path(df.sparkSession, label), scratch_path(df.sparkSession, f"{label}-state"))


def test_first_per_hour_equals_batch_on_closed_windows(stream):
    live, batch = stream
    got = {(r["lang"], r["hour_start"], r["id"]) for r in run(S.first_per_hour(live, "ts", "lang", ["id"], ["id"]), "first").collect()}
    slots = PK.first_k(PK.with_slot(batch, "ts"), ["lang", "slot_date", "slot_hour"], ["ts", "id"])
    closed = START + timedelta(minutes=400 - 60)
    want = {(r["lang"], START + timedelta(hours=r["slot_hour"]), r["id"]) for r in slots.collect() if START + timedelta(hours=r["slot_hour"] + 1) <= closed}
    assert got == want and len(got) == 5


def test_minute_counts_equal_batch_on_closed_windows(stream):
    live, batch = stream
    got = {tuple(r) for r in run(S.minute_counts(live, "ts", "lang"), "minutes").collect()}
    counts = batch.groupBy(TM.bucket_start(F.col("ts"), 1).alias("m"), "lang").agg(F.count("*").alias("n")).collect()
    assert got == {tuple(r) for r in counts if r["m"] + timedelta(minutes=1) <= START + timedelta(minutes=340)}


def test_repeats_across_batches_are_dropped(spark, tmp_path):
    live, _ = source(spark, str(tmp_path / "in"), [[("en", 1, 1), ("en", 2, 1), ("en", 3, 2)], [("en", 4, 2), ("en", 5, 3)]])
    assert sorted(r["id"] for r in run(S.drop_repeats(live, ["id"], "ts").select("id"), "ids").collect()) == [1, 2, 3]


def test_late_rows_go_to_their_own_table(spark, tmp_path, stream):
    """Row 6 (minute 3) is within the hour after batch 0; a row two hours old is late."""
    live, _ = source(spark, str(tmp_path / "late"), [*BATCHES, [("en", 20, 9), ("en", 350, 10)]])
    root, late, state = (str(tmp_path / p) for p in ("rows", "late_rows", "state"))
    S.repack_stream(live, root, late, state, "ts").trigger(availableNow=True).start().awaitTermination()
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("bucket", T.StringType())])
    kept = {(r["id"], r["bucket"]) for r in read_repacked(spark, root, schema).collect()}
    assert {i for i, _ in kept} == set(range(1, 9)) | {10}
    assert (6, "202201010000") in kept and (1, "202201010000") in kept and (2, "202201010100") in kept
    gone = spark.read.schema("id BIGINT, day STRING, lang STRING, bucket STRING").json(late)
    assert [r["id"] for r in gone.collect()] == [9]
    assert [tuple(r) for r in S.late_counts(gone).collect()] == [("20220101", "en", "202201010015", 1)]


def test_a_repeated_micro_batch_leaves_no_duplicates(spark, tmp_path, stream):
    live, batch = stream
    root, late = (str(tmp_path / p) for p in ("rows", "late_rows"))
    for attempt in ("a", "b"):  # a lost checkpoint replays the same batches
        S.repack_stream(live, root, late, str(tmp_path / attempt), "ts").trigger(availableNow=True).start().awaitTermination()
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert sorted(r["id"] for r in read_repacked(spark, root, schema).collect()) == sorted(r["id"] for r in batch.collect())


def test_the_watermark_outlives_a_restart_and_values_stay_exact(spark, tmp_path):
    schema = "lang STRING, ts TIMESTAMP_NTZ, id BIGINT, note STRING"
    big, state, folder = (1 << 62) + 1, str(tmp_path / "state"), str(tmp_path / "in")
    runs = [
        [("en", START + timedelta(hours=9, microseconds=7), big, "a\n\"b\""), ("de", None, None, None)],
        [("en", START + timedelta(hours=7, minutes=59), 2, "é"), ("en", START + timedelta(hours=8), 3, ""), (None, None, 4, "no time")],
    ]
    for part in runs:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        live = spark.readStream.schema(schema).parquet(folder)
        S.repack_stream(live, str(tmp_path / "rows"), str(tmp_path / "late"), state, "ts").trigger(availableNow=True).start().awaitTermination()
    read = lambda p: {(r["id"], r["note"], r["ts"]) for r in spark.read.schema(schema).json(str(tmp_path / p)).collect()}
    assert read("late") == {(2, "é", START + timedelta(hours=7, minutes=59))}
    assert read("rows") == {
        (big, "a\n\"b\"", START + timedelta(hours=9, microseconds=7)), (None, None, None), (3, "", START + timedelta(hours=8)), (4, "no time", None),
    }
