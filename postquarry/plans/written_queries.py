"""Sinks, file readers and stages: whole tables are written, in several runs where that matters, and read back.

Roles: orders stand for dated posts (status = language, year = dump), documents for post JSON.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postquarry.functions import posts as P
from postquarry.functions import times as TM
from postquarry.operators import catalog as C
from postquarry.operators import filters as FL
from postquarry.operators import pick as PK
from postquarry.operators import stats as ST
from postquarry.plans import answer_queries as AQ
from postquarry.plans import bucket_queries as BQ
from postquarry.plans import post_queries as PQ
from postquarry.plans import stages as SG
from postquarry.plans.derived import write_archive
from postquarry.plans.registry import QUERIES, query, table
from postquarry.session import scratch_path, ship_package
from postquarry.sinks import tables as K
from postquarry.sources import files as FS
from postquarry.sources.archive import open_folder


def order_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as posts: dump by year, archive by day, member by priority."""
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("ts"), F.col("o_orderstatus").alias("lang"),
        F.concat(F.lit("dump-"), F.year("o_orderdate")).alias("dump"), F.date_format("o_orderdate", "yyyyMMdd").alias("archive"),
        F.col("o_orderpriority").alias("member"),
        P.post_url(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("url"),
    )


def in_runs(df: DataFrame, even: str) -> list[DataFrame]:
    """The rows in two runs, and the first run once more: what a sink is to survive."""
    first, second = df.where(even), df.where(f"NOT ({even})")
    return [first, second, first]


ORDER_SQL = """
    p AS (SELECT o_orderkey, o_orderdate AS ts, o_orderstatus AS lang, 'dump-' || year(o_orderdate) AS dump,
                 strftime(o_orderdate, '%Y%m%d') AS archive, o_orderpriority AS member FROM orders)"""


@query("K3 P13", """
    SELECT o_orderkey, 'https://x.com/' || o_custkey || '/status/' || o_orderkey AS post_url_computed, o_orderdate AS date_created,
           o_orderstatus AS language, CAST(year(o_orderdate) AS INTEGER) AS year_created, CAST(month(o_orderdate) AS INTEGER) AS month_created
    FROM orders""")
def index_written(spark, sf):
    path = scratch_path(spark, "post-index")
    for run in in_runs(order_posts(spark, sf), "month(ts) <= 6"):
        K.write_post_index(PK.index_rows(run, "ts", "lang", "url", ["o_orderkey"]), path)
    return spark.read.parquet(path).select(
        "o_orderkey", "post_url_computed", "date_created", "language", "year_created", "month_created"
    )


def located_posts(spark: SparkSession, sf: str, keep_raw: bool = False) -> DataFrame:
    """Post JSON of all documents with a location made from its id."""
    value = PQ.json_posts(spark, sf)
    posts = P.parse_posts(value, keep_raw=keep_raw)
    place = [F.lit("dump-2022-01"), F.lit("day"), F.col("lang"), F.col("id")]
    return posts.withColumns(dict(zip(PK.LOCATION, place)))


POST_SQL = """
    SELECT CAST(doc_id AS VARCHAR) AS platform_id, TIMESTAMP '2022-01-01 00:00:00' + to_seconds((999 + doc_id * 77777) // 1000) AS date_created,
           lang AS language, md5(text) AS text_md5, doc_id AS line_no FROM documents"""


@query("K4 P14 S18", POST_SQL + " ORDER BY date_created, platform_id")
def candidates_written(spark, sf):
    path = scratch_path(spark, "candidates")
    for run in in_runs(located_posts(spark, sf), "lang IN ('en', 'de')"):
        K.write_candidates(PK.candidates(run), path)
    return FS.read_picked(spark, path).select(
        "platform_id", "date_created", "language", F.md5("text").alias("text_md5"), F.col("location_index.line_no").alias("line_no")
    )


@query("K13 P14", POST_SQL.replace("CAST(doc_id AS VARCHAR) AS platform_id, ", ""))
def full_posts_written(spark, sf):
    path = scratch_path(spark, "full-posts")
    for run in in_runs(located_posts(spark, sf, keep_raw=True), "lang IN ('en', 'de')"):
        K.write_full_posts(PK.full_posts(run), path)
    stored = P.parse_posts(spark.read.parquet(path).select("date_created", "language", "location_index", "content"), "content", fields=["text"])
    return stored.select(
        "date_created", "language", F.md5("text").alias("text_md5"), F.col("location_index.line_no").alias("line_no")
    )


@query("K5 A1", f"""WITH {ORDER_SQL}
    SELECT dump, archive, lang, CAST(grouping_id(dump, archive, lang) AS INTEGER) AS level_mask, count(*) AS total, count(*) AS accepted
    FROM p GROUP BY GROUPING SETS ((dump, archive, lang), (dump, archive), (dump, lang), (dump))""")
def stats_written(spark, sf):
    path = scratch_path(spark, "stats")
    for run in in_runs(order_posts(spark, sf), "year(ts) % 2 = 0"):
        K.write_stats(ST.hierarchy_counts(run, ["dump", "archive"]).where("level_mask < 4"), path, ("dump",))
    return spark.read.parquet(path).select("dump", "archive", "lang", F.col("level_mask").cast("int").alias("level_mask"), "total", "accepted")


@query("K5 J9", f"""WITH {ORDER_SQL}
    SELECT archive, member, lang, sum(count(*)) OVER (PARTITION BY archive)::BIGINT AS archive_total,
           sum(count(*)) OVER (PARTITION BY archive, member)::BIGINT AS member_total, count(*) AS accepted
    FROM p GROUP BY archive, member, lang""")
def stats_nested(spark, sf):
    path = scratch_path(spark, "nested-stats")
    finest = ST.hierarchy_counts(order_posts(spark, sf), ["archive", "member"]).where("level_mask = 0")
    K.write_json(K.nested_stats(finest, "archive", "member", "lang"), path)
    counts = "total_posts BIGINT, accepted_posts MAP<STRING, BIGINT>"
    nested = FS.read_jsonl(spark, path, "archive STRING, stats STRING").select(
        "archive", F.from_json("stats", f"{counts}, items MAP<STRING, STRUCT<{counts}>>").alias("s"))
    members = nested.select("archive", F.col("s.total_posts").alias("archive_total"), F.explode("s.items").alias("member", "m"))
    return members.select("archive", "member", "archive_total", F.col("m.total_posts").alias("member_total"), F.explode("m.accepted_posts").alias("lang", "accepted"))


@query("K6 A4", f"WITH {ORDER_SQL} SELECT dump, lang, member AS tag, count(*) AS n FROM p GROUP BY ALL")
def tags_written(spark, sf):
    path = scratch_path(spark, "tags")
    for run in in_runs(order_posts(spark, sf).withColumn("tags", F.array("member")), "year(ts) % 2 = 0"):
        K.write_tag_counts(ST.frequency(run, ["dump", "lang"], "tags"), path, by=("dump",))
    return spark.read.parquet(path).select("dump", "lang", "tag", "n")


@query("K7 S17", """
    SELECT source || ':' || doc_id AS location, md5(text) AS post_md5, lang || ',' || source AS words FROM documents""")
def relevant_written(spark, sf):
    path = scratch_path(spark, "relevant")
    rows = table(spark, sf, "documents").select(
        F.array("source", F.col("doc_id").cast("string")).alias("location"), F.col("text").alias("post"), F.array("lang", "source").alias("words"),
        (F.lit("2022-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("doc_id").cast("int"))).alias("ts"), "lang",
    )
    for name, run in zip(("english", "others", "english"), in_runs(rows, "lang = 'en'")):
        K.write_relevant(run, path, "ts", run=name)
    return FS.read_relevance(spark, path).select(
        F.array_join("location", ":").alias("location"), F.md5("post").alias("post_md5"), F.array_join("words", ",").alias("words"))


@query("K8 S7", """
    SELECT row_number() OVER (ORDER BY doc_id) - 1 AS task_idx, doc_id, md5(text) AS text_md5, source AS post_url,
           coalesce(toxic = 1, false) AS has_media
    FROM documents LEFT JOIN labels USING (doc_id)""")
def tasks_written(spark, sf):
    path = scratch_path(spark, "tasks")
    docs = PQ.labelled_docs(spark, sf).withColumn("media", F.col("toxic") == 1)
    K.write_tasks(PK.task_export(docs, ["doc_id"], "text", "source", "media", ["doc_id"]), path)
    K.write_tasks(docs.select("doc_id"), path, rewrite=False)
    tasks = FS.read_jsonl(spark, path, "task_idx BIGINT, doc_id BIGINT, post_text STRING, post_url STRING, has_media BOOLEAN")
    return tasks.select("task_idx", "doc_id", F.md5("post_text").alias("text_md5"), "post_url", "has_media")


def csv_again(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, "csv")
    K.write_csv(df, path)
    return spark.read.schema(df.schema).option("header", True).csv(path)


@query("K9", QUERIES["agreed_wide"].sql)
def agreed_csv(spark, sf):
    return csv_again(spark, AQ.agreed_wide(spark, sf))


@query("K10", QUERIES["wide_answers"].sql)
def wide_csv(spark, sf):
    return csv_again(spark, AQ.wide_answers(spark, sf))


@query("K11 A5", BQ.INDEX_SQL)
def bucket_index_written(spark, sf):
    path = scratch_path(spark, "bucket-index")
    index = BQ.event_index(spark, sf)
    for _ in range(2):
        K.write_index(index, path)
    return spark.read.parquet(path)


@query("K12 J7", "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS known FROM customer")
def rows_appended(spark, sf):
    path = scratch_path(spark, "customers")
    customers, orders = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders")
    customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").withColumn("known", F.lit(True)).write.parquet(path)
    for _ in range(2):
        K.append_new_rows(customers.withColumn("known", F.lit(False)), path, "c_custkey", ["c_custkey"])
    return spark.read.parquet(path)


@query("K14 A18", QUERIES["key_presence"].sql)
def key_presence_written(spark, sf):
    path, found = scratch_path(spark, "shape"), PQ.key_presence(spark, sf)
    K.write_json(found, path)
    return FS.read_jsonl(spark, path, found.schema)


@query("S6", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def lines_counted(spark, sf):
    path = scratch_path(spark, "lines")
    docs = table(spark, sf, "documents")
    docs.select(F.to_json(F.struct("doc_id", "text")).alias("value"), "lang").write.partitionBy("lang").option("compression", "gzip").text(path)
    files = FS.lines_per_file(spark, path)
    return files.groupBy(F.regexp_extract("path", "/lang=([^/]+)/", 1).alias("lang")).agg(F.sum("n").alias("n"))


@query("S9 J11", "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def months_listed(spark, sf):
    path = scratch_path(spark, "months")
    orders = table(spark, sf, "orders").withColumn("stream", TM.year_month(F.col("o_orderdate")))
    orders.select("o_orderkey", "stream").hint("rebalance", "stream").write.partitionBy("stream").parquet(path)
    return C.months_found(FS.list_months(spark, path))


@query("S13 U1", "SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_linenumber AS VARCHAR) AS coder FROM lineitem")
def coder_tables(spark, sf):
    ship_package(spark)
    path = scratch_path(spark, "coders")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A file per coder and batch, named after the coder; files of a repeated task replace each other."""
        fs, base = open_folder(path)
        fs.create_dir(base, recursive=True)
        for number, batch in enumerate(batches):
            for coder, rows in batch.groupby("l_linenumber"):
                rows.to_parquet(f"{base}/part-{TaskContext.get().partitionId()}-{number}_{coder}.parquet", filesystem=fs, index=False)
            yield pd.DataFrame({"n": [len(batch)]})

    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    lines.mapInPandas(write, "n BIGINT").groupBy().sum("n").collect()
    return FS.read_coder_tables(spark, path, lines.schema)


@query("S14", "SELECT conv_id AS id, turn AS annotator, role AS flag FROM conversations")
def tool_export_read(spark, sf):
    """One file per block of 500 conversations holds one array of records."""
    path = scratch_path(spark, "export")
    records = table(spark, sf, "conversations").groupBy(F.expr("conv_id div 500").alias("block")).agg(
        F.to_json(F.collect_list(F.struct(F.col("conv_id").alias("id"), F.col("turn").alias("annotator"), F.col("role").alias("flag")))).alias("value"))
    records.write.partitionBy("block").text(path)
    return FS.read_tool_export(spark, path, "id BIGINT, annotator BIGINT, flag STRING").select("id", "annotator", "flag")


@query("S15", """
    SELECT 'all' AS label, CAST(len(embedding) AS INTEGER) AS dim, round(embedding[1]::DOUBLE, 5) AS x FROM embeddings""")
def vector_files_read(spark, sf):
    """One file per block of 500 vectors holds one array of arrays."""
    path = scratch_path(spark, "vectors")
    blocks = table(spark, sf, "embeddings").groupBy(F.expr("vec_id div 500").alias("block")).agg(
        F.to_json(F.collect_list(F.col("embedding").cast("array<double>"))).alias("value"))
    blocks.write.partitionBy("block").text(path)
    return FS.read_vector_file(spark, path, "all").select("label", F.size("vec").alias("dim"), F.round(F.col("vec")[0], 5).alias("x"))


@query("S16", "SELECT lang AS key, count(*) AS n FROM documents GROUP BY lang")
def count_map_read(spark, sf):
    path = scratch_path(spark, "counts")
    counts = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    counts.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("lang", "n")))).alias("value")).write.text(path)
    return FS.read_count_map(spark, path)


STAGE_LANGS = ["en", "de"]


def staged(spark: SparkSession, sf: str, selection: list) -> None:
    """The documents as an archive of post JSON, sent through stages."""
    path = scratch_path(spark, "posts")
    write_archive(PQ.json_posts(spark, sf), path, "2022-01")
    posts = SG.read_posts(spark, "dump", path, keep_raw=True)
    SG.run_stages(posts, SG.build_stages(selection))


@query("X1 X2 X3 A2 K5", """
    SELECT d.lang, count(*) AS total, count(*) FILTER (WHERE d.lang IN ('en', 'de') AND coalesce(l.toxic, 0) <> 1) AS accepted
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.lang""")
def stage_totals(spark, sf):
    path = scratch_path(spark, "run")
    staged(spark, sf, [("filter", {"langs": STAGE_LANGS, "filter_sensitive": True}), ("stats", {"path": path})])
    levels = spark.read.parquet(f"{path}/levels").where("level_mask = 0")
    return levels.groupBy("lang").agg(F.sum("total").alias("total"), F.sum("accepted").alias("accepted"))


@query("X1 X3 K1 K2 S5 F1", """
    SELECT d.doc_id AS id, d.lang, md5(d.text) AS text_md5, '2022-01' AS dump FROM documents d WHERE d.lang IN ('en', 'de')""")
def stage_repack(spark, sf):
    path = scratch_path(spark, "repacked")
    staged(spark, sf, [("filter", {"langs": STAGE_LANGS}), ("repack", {"path": path})])
    return SG.read_posts(spark, "repack", path, langs=STAGE_LANGS).select("id", "lang", F.md5("text").alias("text_md5"), "dump")


@query("X3 T6 W6", """
    WITH r AS (SELECT doc_id, lang, text, row_number() OVER (PARTITION BY lang ORDER BY (999 + doc_id * 77777) // 900000, doc_id) - 1 AS position FROM documents),
         t AS (SELECT lang, count(*) AS total FROM documents GROUP BY 1),
         d AS (SELECT lang, draw, CAST('0x' || substr(md5('11:' || lang || ':' || draw), 1, 15) AS BIGINT) % total AS position
               FROM t, (SELECT unnest(range(0, 100)) AS draw))
    SELECT lang, draw, r.doc_id AS id, md5(r.text) AS text_md5 FROM d JOIN r USING (lang, position) WHERE lang <> 'de'""")
def random_posts(spark, sf):
    """Random posts of the repacked documents, sent through a filter stage."""
    path = scratch_path(spark, "repacked")
    SG.run_stages(located_posts(spark, sf, keep_raw=True), SG.build_stages([("repack", {"path": path})]))
    langs = [row[0] for row in table(spark, sf, "documents").select("lang").distinct().collect()]
    drawn = SG.read_posts(spark, "random", path, n=100, seed=11)
    left = SG.run_stages(drawn, SG.build_stages([("filter", {"langs": [x for x in langs if x != "de"]})]))
    return left.select("lang", "draw", "id", F.md5("text").alias("text_md5"))


@query("J11 X1 X2", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, true AS stats,
           bool_or(o_orderstatus = 'F') AS index, year(o_orderdate) = 1995 AND month(o_orderdate) IN (3, 4) AS annotation
    FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""")
def month_status(spark, sf):
    """What several runs of stages leave in the status: all months counted, those with finished orders indexed, two picked from."""
    status, out = scratch_path(spark, "status"), scratch_path(spark, "staged")
    made = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("id_str"), F.col("o_orderstatus").alias("lang"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string").alias("timestamp_ms"), F.col("o_orderpriority").alias("text"),
        F.struct(F.col("o_custkey").cast("string").alias("screen_name")).alias("user"),
    )
    posts = P.parse_posts(table(spark, sf, "orders").select(F.to_json(made).alias("value")))
    day = TM.event_time(F.col("timestamp_ms"), "UTC")
    place = [F.concat(F.lit("stream-"), TM.year_month(day)), F.date_format(day, "yyyyMMdd"), F.col("text"), F.col("id")]
    posts = posts.withColumns(dict(zip(PK.LOCATION, place)))
    runs = [(posts, ("stats", {"path": f"{out}/stats"}))]
    runs += [(run, ("index", {"path": f"{out}/index"})) for run in in_runs(posts.where("lang = 'F'"), "id % 2 = 0")]
    runs += [(posts, ("annotation", {"path": f"{out}/picked", "year": 1995, "month": month})) for month in (3, 4)]
    for run, (name, options) in runs:
        SG.run_stages(run, SG.build_stages([(name, {**options, "status": status})]))
    return FS.read_status(spark, status, posts.select(F.concat(F.lit("/data/"), "dump").alias("path")))


@query("X5 F5 F6", """
    SELECT doc_id, n_chars FROM documents JOIN labels USING (doc_id) WHERE (toxic = 1 OR quality = 0) AND n_chars > 140""")
def long_media_posts(spark, sf):
    """Long posts with media, by the media stage and a function over batches."""
    kept = SG.run_stages(located_posts(spark, sf), SG.build_stages([("media-filter", {})]))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["id"], "n_chars": batch["text"].str.len()})

    return SG.map_rows(FL.truncated_only(kept).select("id", "text"), measure, "doc_id BIGINT, n_chars BIGINT")


@query("X4 F9 J4", QUERIES["knn_filter"].sql)
def bot_stage(spark, sf):
    """The bot stage with stored vectors in place of a model."""
    posts, refs = BQ.vector_sides(spark, sf)

    def embed(df: DataFrame) -> DataFrame:
        return df.join(posts.withColumnRenamed("embedding", "vec"), "vec_id")

    stages = SG.build_stages([("bot-filter1", {"embed": embed, "refs": refs, "key_col": "vec_id"})])
    return SG.run_stages(posts.select("vec_id"), stages)
