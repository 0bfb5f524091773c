from __future__ import annotations

import json

import pytest
from post_fixtures import SPECIAL, post, small_archive, write_tar
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from postquarry.plans import stages as ST
from postquarry.sources import files as S


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    import gzip

    folder = tmp_path_factory.mktemp("dump")
    posts = [post(i, f"2022-01-01 0{i % 3}:0{i % 6}:00", "en" if i % 3 else "de", text="forest water" if i % 2 else "none",
                  entities={"hashtags": [{"text": "x"}]}) for i in range(30)]
    late = [post(100, "2021-12-31 23:59:00"), post(101, quoted_status_id=5), post(102, lang="xx")]
    body = "".join(json.dumps(p) + "\n" for p in posts + late).encode()
    write_tar(folder / "stream-2022-01" / "stream-20220101.tar", [("20220101/20220101000000.json.gz", gzip.compress(body))])
    return str(folder)


def test_run_with_every_sink(spark, root, tmp_path):
    out = str(tmp_path)
    posts = ST.read_posts(spark, "dump", root, keep_raw=True)
    stages = ST.build_stages([
        ("filter", {"langs": ["en", "de"]}),
        ("pin", {}),
        ("stats", {"path": f"{out}/stats", "collect_hashtags": True}),
        ("index", {"path": f"{out}/index"}),
        ("annotation", {"path": f"{out}/candidates", "year": 2022, "month": 1}),
        ("repack", {"path": f"{out}/repack"}),
        ("auto_relevance", {"path": f"{out}/relevant", "words": ["forest", "water"]}),
        ("schema", {"path": f"{out}/schema"}),
    ])
    left = ST.run_stages(posts, stages)
    assert left.count() == 31
    levels = spark.read.parquet(f"{out}/stats/levels")
    assert [(r["total"], r["accepted"]) for r in levels.where("level_mask = 7").collect()] == [(33, 31)]
    assert {tuple(r) for r in spark.read.parquet(f"{out}/stats/hashtags").select("lang", "tag", "n").collect()} == {("de", "x", 10), ("en", "x", 20)}
    assert spark.read.parquet(f"{out}/index").count() == 31
    candidates = S.read_picked(spark, f"{out}/candidates")
    assert candidates.count() == 3 and [r["date_created"] for r in candidates.collect()] == sorted(r["date_created"] for r in candidates.collect())
    assert "2021" not in {r["year_created"] for r in candidates.collect()}
    back = ST.read_posts(spark, "repack", f"{out}/repack", keep_raw=True)
    places = ["dump", "archive", "member", "line_no", "value", "id"]
    assert sorted(map(tuple, back.select(*places).collect())) == sorted(map(tuple, left.select(*places).collect()))
    assert ST.read_posts(spark, "repack", f"{out}/repack", ["de"], months=["2022-01"]).count() == 10
    assert ST.read_posts(spark, "repack", f"{out}/repack", months=["2021-12"]).count() == 1
    assert spark.read.json(f"{out}/relevant").count() == 15
    assert "timestamp_ms" in {r["path"] for r in spark.read.json(f"{out}/schema").collect()}


def test_stages_follow_the_chosen_order_with_their_own_parameters(spark):
    seen = []
    registry = {
        name: (lambda n: lambda **p: ST.Stage(n, lambda df: (seen.append((n, p)), df)[1]))(name) for name in ("a", "b", "c")
    }
    ST.run_stages(spark.range(1), ST.build_stages([("c", {"x": 1}), ("a", {"x": 2})], registry))
    assert seen == [("c", {"x": 1}), ("a", {"x": 2})]
    with pytest.raises(KeyError):
        ST.build_stages([("nothing", {})], registry)


def test_missing_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="needs columns"):
        ST.run_stages(spark.range(1), ST.build_stages([("filter", {"langs": ["en"]})]))


def test_a_rejected_row_reaches_no_later_stage(spark, root):
    posts = ST.read_posts(spark, "dump", root)
    counted = []
    later = ST.sink("count", lambda df: counted.append(df.count()))
    ST.run_stages(posts, [*ST.build_stages([("filter", {"langs": ["de"]})]), later])
    assert counted == [10]


def test_bot_filter_with_a_model_in_a_pandas_udf(spark, root):
    @pandas_udf("array<float>")
    def embed(texts):
        return texts.map(lambda t: [1.0, 0.0] if "forest" in t else [0.0, 1.0])

    refs = spark.createDataFrame([(f"{label}_{i}", label, v) for label, v in (("b", [0.0, 1.0]), ("h", [1.0, 0.0])) for i in range(3)], "ref_id STRING, label STRING, vec ARRAY<FLOAT>")
    posts = ST.read_posts(spark, "dump", root)
    stage = ST.build_stages([("bot-filter1", {"embed": lambda df: df.withColumn("vec", embed("text")), "refs": refs})])
    assert ST.run_stages(posts, stage).where("text <> 'forest water'").count() == 0


def test_media_filter_and_map_rows(spark, tmp_path):
    import gzip

    body = "".join(json.dumps(p) + "\n" for p in SPECIAL.values()).encode()
    write_tar(tmp_path / "s-2022-01" / "s-20220101.tar", [("d/20220101000000.json.gz", gzip.compress(body))])
    posts = ST.read_posts(spark, "dump", str(tmp_path))
    assert ST.run_stages(posts, ST.build_stages([("media-filter", {})])).count() == 4
    doubled = ST.map_rows(posts.select("id"), lambda it: (f.assign(id=f.id * 2) for f in it), "id BIGINT")
    assert doubled.agg(F.sum("id")).first()[0] == 2 * sum(SPECIAL)


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        ST.read_posts(spark, "else", "/nowhere")


def test_full_posts_and_task_sink(spark, tmp_path):
    small_archive(tmp_path / "in")
    from postquarry.operators import pick as PK
    from postquarry.sinks import tables as K

    posts = ST.read_posts(spark, "dump", str(tmp_path / "in"), keep_raw=True, badMember="skip").where("id IS NOT NULL")
    K.write_full_posts(PK.full_posts(posts), str(tmp_path / "full"))
    row = spark.read.parquet(str(tmp_path / "full")).where("post_url_computed LIKE '%/1'").first()
    assert json.loads(row["content"])["id"] == 1 and row["text"] == "text 1" and row["location_index"]["line_no"] == 0
    tasks = spark.createDataFrame([(0, "a")], "task_idx INT, post_text STRING")
    K.write_tasks(tasks, str(tmp_path / "tasks"))
    K.write_tasks(tasks.unionByName(tasks), str(tmp_path / "tasks"), rewrite=False)
    assert spark.read.json(str(tmp_path / "tasks")).count() == 1
    K.write_tasks(tasks.unionByName(tasks), str(tmp_path / "tasks"))
    assert spark.read.json(str(tmp_path / "tasks")).count() == 2


def test_a_second_month_and_a_second_filter_leave_the_first(spark, tmp_path):
    import gzip

    for month, numbers in (("2022-01", range(4)), ("2022-02", range(10, 13))):
        made = [post(n, f"{month}-01 00:00:00", possibly_sensitive=n % 2 == 0, entities={"hashtags": [{"text": "x"}]}) for n in numbers]
        body = "".join(json.dumps(p) + "\n" for p in made).encode()
        write_tar(tmp_path / f"s-{month}" / f"s-{month.replace('-', '')}01.tar", [("d/20220101000000.json.gz", gzip.compress(body))])
    for month in ("2022-01", "2022-02"):
        posts = ST.read_posts(spark, "dump", str(tmp_path), dump=month)
        ST.run_stages(posts, ST.build_stages([
            ("filter", {"langs": ["en"], "filter_sensitive": True}), ("filter", {"langs": ["en", "de"]}),
            ("stats", {"path": str(tmp_path / "stats"), "collect_hashtags": True}),
        ]))
    levels = spark.read.parquet(str(tmp_path / "stats" / "levels")).where("level_mask = 7")
    assert sorted((r["dump"], r["total"], r["accepted"]) for r in levels.collect()) == [("2022-01", 4, 2), ("2022-02", 3, 1)]
    tags = spark.read.parquet(str(tmp_path / "stats" / "hashtags"))
    assert sorted((r["dump"], r["n"]) for r in tags.collect()) == [("2022-01", 2), ("2022-02", 1)]


def test_status_is_kept_between_runs(spark, root, tmp_path):
    status, out = str(tmp_path / "status"), str(tmp_path)
    listing = spark.createDataFrame([("/x/stream-2022-01",), ("/x/stream-2022-02",), ("/x/other",)], "path STRING")
    flags = lambda: {tuple(r) for r in S.read_status(spark, status, listing).collect()}
    assert flags() == {(2022, 1, False, False, False), (2022, 2, False, False, False)}
    posts = ST.read_posts(spark, "dump", root, keep_raw=True)
    ST.run_stages(posts, ST.build_stages([("index", {"path": f"{out}/index", "status": status})]))
    ST.run_stages(posts.where("lang = 'none such'"), ST.build_stages([("stats", {"path": f"{out}/stats", "status": status})]))
    assert flags() == {(2022, 1, False, True, False), (2022, 2, False, False, False)}
    for _ in range(2):
        ST.run_stages(posts, ST.build_stages([("stats", {"path": f"{out}/stats", "status": status}),
                                              ("annotation", {"path": f"{out}/picked", "year": 2022, "month": 2, "status": status})]))
    assert flags() == {(2022, 1, True, True, False), (2022, 2, False, False, True)}


def test_full_posts_stage(spark, root, tmp_path):
    posts = ST.read_posts(spark, "dump", root, keep_raw=True)
    ST.run_stages(posts, ST.build_stages([("filter", {"langs": ["de"]}), ("full-posts", {"path": str(tmp_path / "full")})]))
    stored = spark.read.parquet(str(tmp_path / "full")).select("content", "language").collect()
    assert len(stored) == 10 and {json.loads(r["content"])["id"] % 3 for r in stored} == {0}


@pytest.mark.parametrize("plain", [True, False])
def test_random_posts_come_from_rows_that_exist(spark, root, tmp_path, plain):
    import gzip

    folder = tmp_path / "repacked"
    if plain:  # a plain tree with blank lines
        for lang, bucket, ids in (("en", "202201010000", [1, 2]), ("en", "202201010015", [3]), ("de", "202201010000", [4])):
            day = folder / "2022-01" / "20220101" / lang
            day.mkdir(parents=True, exist_ok=True)
            body = "\n\n  \n".join(json.dumps(post(i, "2022-01-01 00:00:00", lang)) for i in ids) + "\n\n"
            (day / f"{bucket}.jsonl.gz").write_bytes(gzip.compress(body.encode()))
        want = {"en": {1, 2, 3}, "de": {4}}
    else:
        ST.run_stages(ST.read_posts(spark, "dump", root, keep_raw=True), ST.build_stages([("filter", {"langs": ["en", "de"]}), ("repack", {"path": str(folder)})]))
        want = {"en": {i for i in range(30) if i % 3}, "de": {i for i in range(30) if not i % 3}}
    drawn = ST.read_posts(spark, "random", str(folder), n=200, seed=3)
    rows = [(r["lang"], r["draw"], r["id"]) for r in drawn.collect()]
    assert sorted(r[:2] for r in rows) == sorted((lang, k) for lang in want for k in range(200))
    found = {lang: {i for x, _, i in rows if x == lang} for lang in want}
    assert found["de"] == want["de"] and found["en"] <= want["en"] | {100}
    assert len(found["en"]) == len(want["en"]) or not plain
    again = ST.read_posts(spark, "random", str(folder), n=200, seed=3, langs=["en"])
    assert sorted((r["draw"], r["id"]) for r in again.collect()) == sorted(r[1:] for r in rows if r[0] == "en")
    with pytest.raises(TypeError):
        ST.read_posts(spark, "random", str(folder), n=1, seed=3, other=1)

