from __future__ import annotations

import gzip
import json
from collections import Counter
from pathlib import Path

import pytest
from post_fixtures import post
from pyspark.sql import functions as F

from postquarry.functions import posts as P
from postquarry.functions import times as TM
from postquarry.operators import buckets as B
from postquarry.plans.stages import read_posts
from postquarry.sinks import tables as K
from postquarry.sources import files as S


@pytest.fixture(scope="module")
def posts(spark):
    times = ["2022-01-01 00:01:00", "2022-01-01 00:14:59", "2022-01-01 00:15:00", "2022-01-01 23:59:00", "2022-01-02 05:00:00"]
    made = [post(i * 10 + j, at, lang) for i, at in enumerate(times) for j, lang in enumerate(["en", "en", "de"])]
    lines = spark.createDataFrame([(json.dumps(p), "d", "a", "m", i) for i, p in enumerate(made)], "value STRING, dump STRING, archive STRING, member STRING, line_no BIGINT")
    return P.parse_posts(lines, keep_raw=True).withColumn("ts", TM.event_time(F.col("timestamp_ms"))).cache()


@pytest.mark.parametrize(("folders", "compression"), [(True, "gzip"), (False, "gzip"), (False, "none")])
def test_round_trip_keeps_every_line(spark, posts, tmp_path, folders, compression):
    root = str(tmp_path / "out")
    K.repack(posts, root, "ts", ["ts", "line_no"], compression=compression, bucket_folders=folders, raw_col="value")
    back = S.read_repacked(spark, root, bucket_folders=folders)
    assert Counter(r[0] for r in back.select("value").collect()) == Counter(r[0] for r in posts.select("value").collect())
    assert {r[0] for r in back.select("day").distinct().collect()} == {"20220101", "20220102"}
    names = [p.name for p in Path(root).rglob("part-*") if not p.name.endswith(".crc")]
    assert all(n.endswith(".gz") for n in names) == (compression == "gzip")
    if folders:
        assert {r[0] for r in back.where("lang = 'de'").select("bucket").collect()} == {"202201010000", "202201010015", "202201012345", "202201020500"}


def test_existing_days_are_skipped_or_replaced(spark, posts, tmp_path):
    root = str(tmp_path / "out")
    K.repack(posts.where("day(ts) = 1"), root, "ts", ["line_no"], raw_col="value")
    K.repack(posts, root, "ts", ["line_no"], raw_col="value")
    assert S.read_repacked(spark, root).count() == 15
    K.repack(posts.where("day(ts) = 2"), root, "ts", ["line_no"], existing="overwrite", raw_col="value")
    assert S.read_repacked(spark, root).count() == 15


@pytest.mark.parametrize("existing", ["skip", "overwrite"])
def test_late_rows_of_another_archive_replace_nothing(spark, posts, tmp_path, existing):
    root = str(tmp_path / "out")
    first = posts.where("day(ts) = 1").withColumn("archive", F.lit("20220101"))
    second = posts.where("id < 3").unionByName(posts.where("day(ts) = 2")).withColumn("archive", F.lit("20220102"))
    for rows in (first, second, second):
        K.repack(rows, root, "ts", ["line_no"], existing=existing, raw_col="value", origin_col="archive")
    back = spark.read.text(root).groupBy("origin", "day").count().orderBy("origin", "day").collect()
    assert [(r["day"], r["count"]) for r in back] == [(20220101, 12), (20220101, 3), (20220102, 3)]


def test_options_that_lose_data_do_not_exist(posts, tmp_path):
    with pytest.raises(ValueError):
        K.repack(posts, str(tmp_path), "ts", [], compression="delete")
    with pytest.raises(ValueError):
        K.repack(posts, str(tmp_path), "ts", [], existing="truncate")


def test_language_prunes_folders(spark, posts, tmp_path):
    root = str(tmp_path / "out")
    K.repack(posts, root, "ts", ["line_no"], raw_col="value")
    df = S.read_repacked(spark, root, langs=["de"])
    assert df.count() == 5
    assert "PartitionFilters: [lang" in df._jdf.queryExecution().toString().replace("isnotnull(lang", "[lang") or "lang#" in str(df._jdf.queryExecution())


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    """A plain repacked tree with one empty file and two languages."""
    root = tmp_path_factory.mktemp("tree")
    number = 0
    for day, lang, bucket, count in [
        ("20220101", "en", "202201010000", 3), ("20220101", "en", "202201010015", 0), ("20220101", "en", "202201010030", 5),
        ("20220102", "en", "202201020000", 2), ("20220101", "de", "202201010000", 4),
    ]:
        folder = root / "2022-01" / day / lang
        folder.mkdir(parents=True, exist_ok=True)
        lines = []
        for _ in range(count):
            lines.append(json.dumps(post(number, lang=lang)) + "\n")
            number += 1
        (folder / f"{bucket}.jsonl.gz").write_bytes(gzip.compress("".join(lines).encode()))
    return str(root)


def test_tree_reader_numbers_lines(spark, tree):
    df = S.read_repacked_tree(spark, tree, langs=["en"])
    got = sorted((r["member"], r["line_no"]) for r in df.collect())
    assert got == [("202201010000.jsonl.gz", i) for i in range(3)] + [("202201010030.jsonl.gz", i) for i in range(5)] + [("202201020000.jsonl.gz", i) for i in range(2)]
    assert {r[0] for r in df.select("dump").collect()} == {"repack-2022-01"}


def test_posts_from_a_tree(spark, tree):
    df = read_posts(spark, "repack", tree, ["de"])
    assert {r["lang"] for r in df.collect()} == {"de"} and {"dump", "archive", "member", "line_no"} <= set(df.columns)


def test_tree_index(spark, tree):
    index = S.repack_tree_index(spark, tree).orderBy("language", "dt")
    got = [(r["language"], r["path"], r["day"], r["minute"], r["n"], r["first_row"]) for r in index.collect()]
    assert got == [
        ("de", "2022-01/20220101/de/202201010000.jsonl.gz", 1, 0, 4, 0),
        ("en", "2022-01/20220101/en/202201010000.jsonl.gz", 1, 0, 3, 0),
        ("en", "2022-01/20220101/en/202201010030.jsonl.gz", 1, 30, 5, 3),
        ("en", "2022-01/20220102/en/202201020000.jsonl.gz", 2, 0, 2, 8),
    ]
    assert {r["language"]: r["total"] for r in B.index_totals(index, "language").collect()} == {"de": 4, "en": 10}


@pytest.mark.parametrize("stripe", [1, 2, 3, 1 << 16])
def test_positions_at_the_edges(spark, tree, stripe):
    index = S.repack_tree_index(spark, tree).select("language", "path", "dt", "n", "first_row")
    asked = spark.createDataFrame([("en", p) for p in (0, 2, 3, 7, 8, 9, 9, 10, -1)] + [("de", 3), ("fr", 0)], "language STRING, position BIGINT")
    got = sorted((r["language"], r["position"], r["path"][-21:-9], r["offset"]) for r in B.locate_positions(asked, index, "language", stripe=stripe).collect())
    assert got == [
        ("de", 3, "202201010000", 3), ("en", 0, "202201010000", 0), ("en", 2, "202201010000", 2), ("en", 3, "202201010030", 0),
        ("en", 7, "202201010030", 4), ("en", 8, "202201020000", 0), ("en", 9, "202201020000", 1), ("en", 9, "202201020000", 1),
    ]


def test_random_lines_from_files(spark, tree):
    index = S.repack_tree_index(spark, tree).select("language", "path", "n", "first_row")
    draws = B.sample_positions(index, 40, 3, "language")
    located = B.locate_positions(draws, index, "language")
    lines = S.read_repacked_tree(spark, tree).select(
        F.col("lang").alias("language"), F.concat_ws("/", F.substring("dump", 8, 7), "archive", "lang", "member").alias("path"), F.col("line_no").alias("offset"), "value"
    )
    rows = B.rows_at(lines, located, "language", "path").select("language", "draw", "position", F.get_json_object("value", "$.id").cast("int").alias("id")).collect()
    assert len(rows) == 80
    first = {"en": 0, "de": 10}
    assert all(r["id"] == first[r["language"]] + r["position"] for r in rows)
    assert {r["position"] for r in rows if r["language"] == "de"} == {0, 1, 2, 3}


def test_lines_per_file(spark, tree):
    assert sorted(r["n"] for r in S.lines_per_file(spark, f"{tree}/*/*/*").collect()) == [2, 3, 4, 5]


def test_tree_packs_files_into_tasks(spark, tree):
    one, many = S.read_repacked_tree(spark, tree), S.read_repacked_tree(spark, tree, slice_bytes=1)
    assert one.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert many.where("lang = 'de'").rdd.getNumPartitions() == 1
    assert S.read_repacked_tree(spark, tree, months=["2022-02"]).count() == 0


def test_index_table_is_rebuilt(spark, tree, tmp_path):
    index = S.repack_tree_index(spark, tree)
    for _ in range(2):
        K.write_index(index, str(tmp_path / "index"))
    assert spark.read.parquet(str(tmp_path / "index")).count() == 4


def test_rows_at_numbers_only_the_drawn_buckets(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 6)).alias("bucket"), F.lit("en").alias("lang"), "id")
    index = B.bucket_index(df)
    asked = spark.createDataFrame([("en", p) for p in (0, 99, 600, 999, 999)], "lang STRING, position BIGINT")
    got = sorted((r["position"], r["id"]) for r in B.rows_at(df, B.locate_positions(asked, index), order_cols=["id"]).collect())
    ordered = [r["id"] for r in df.orderBy("bucket", "id").collect()]
    assert got == [(p, ordered[p]) for p in (0, 99, 600, 999, 999)]
