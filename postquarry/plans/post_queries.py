"""Filters, statistics, picking and projections.

Roles: documents with their labels stand for posts (toxic = sensitive, a missing label
row = missing fields); events stand for timed posts (event_type = language).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postquarry.functions import naming as N
from postquarry.functions import posts as P
from postquarry.functions import times as TM
from postquarry.operators import catalog as C
from postquarry.operators import filters as FL
from postquarry.operators import pick as PK
from postquarry.operators import shape as SH
from postquarry.operators import stats as ST
from postquarry.plans.registry import query, table

LANGS = ["en", "de"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def labelled_docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


def tag_frequency(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", F.array(F.get_json_object("props", "$.k")).alias("tags"))
    return ST.frequency(events, ["event_type"], "tags")


@query("F1 F3", """
    SELECT d.doc_id, d.lang, d.source, d.n_chars FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE d.lang IN ('en', 'de') AND coalesce(l.toxic, 0) <> 1""")
def filter_posts(spark, sf):
    kept = FL.drop_sensitive(FL.in_languages(labelled_docs(spark, sf), LANGS), "toxic")
    return kept.select("doc_id", "lang", "source", "n_chars")


@query("F2", """
    SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE l.quality IS NULL AND l.toxic IS NULL""")
def original_posts(spark, sf):
    return FL.original_only(labelled_docs(spark, sf), ["quality", "toxic"]).select("doc_id", "lang")


@query("F4", """
    SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE l.quality IS NOT NULL OR l.toxic IS NOT NULL""")
def located_posts(spark, sf):
    return FL.require_any(labelled_docs(spark, sf), ["quality", "toxic"]).select("doc_id", "lang")


def _rules():
    return FL.post_rules(LANGS, True, True, sensitive_col="toxic", place_cols=["quality"], marker_cols=["parent"])


def judged_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their reject reason; low-quality ones play the reposts."""
    docs = labelled_docs(spark, sf).withColumn("parent", F.when(F.col("quality") == 0, F.col("doc_id")))
    return FL.with_reject_reason(docs, _rules())


REASON_SQL = """
    CASE WHEN coalesce(l.toxic, 0) = 1 THEN 'filter out: sensitive'
         WHEN l.quality IS NULL THEN 'filter out: location'
         WHEN d.lang NOT IN ('en', 'de') OR l.quality = 0 THEN 'filtered out' END"""


@query("F7 A2", f"""
    SELECT coalesce({REASON_SQL}, 'accepted') AS reason, count(*) AS n
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def reject_reasons(spark, sf):
    return FL.reject_counts(judged_docs(spark, sf))


@query("A3", "SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang")
def lang_counts(spark, sf):
    return ST.frequency(table(spark, sf, "documents"), ["lang"]).orderBy(F.desc("n"), "lang")


@query("A1", """
    SELECT strftime(ts, '%Y%m%d') AS archive, strftime(ts, '%H') AS member, event_type AS lang,
           CAST(grouping_id(strftime(ts, '%Y%m%d'), strftime(ts, '%H'), event_type) AS INTEGER) AS level_mask,
           count(*) AS total, count(*) AS accepted
    FROM events GROUP BY GROUPING SETS (
        (strftime(ts, '%Y%m%d'), strftime(ts, '%H'), event_type), (strftime(ts, '%Y%m%d'), strftime(ts, '%H')),
        (strftime(ts, '%Y%m%d'), event_type), (strftime(ts, '%Y%m%d')), (event_type), ())""")
def stats_rollup(spark, sf):
    events = table(spark, sf, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("archive"), F.date_format("ts", "HH").alias("member"), F.col("event_type").alias("lang")
    )
    return ST.hierarchy_counts(events, ["archive", "member"])


@query("A1 A2 F7", f"""
    WITH j AS (SELECT d.source AS archive, d.lang, {REASON_SQL} AS reason
               FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT archive, lang, CAST(grouping_id(archive, lang) AS INTEGER) AS level_mask, count(*) AS total,
           count(*) FILTER (WHERE reason IS NULL) AS accepted
    FROM j GROUP BY GROUPING SETS ((archive, lang), (archive), (lang), ())""")
def stats_accepted(spark, sf):
    docs = judged_docs(spark, sf).withColumnRenamed("source", "archive")
    return ST.hierarchy_counts(docs, ["archive"], "lang", "reject_reason")


TAGS_SQL = "SELECT event_type, json_extract_string(props, '$.k') AS tag, count(*) AS n FROM events GROUP BY ALL"


@query("A4 P5", TAGS_SQL)
def tag_counts(spark, sf):
    return tag_frequency(spark, sf)


HIST_SQL = f"""
    SELECT b.i AS bin, b.label, count(t.n) AS n
    FROM (VALUES (0, '0-5', 0, 5), (1, '5-50', 5, 50), (2, '50-500', 50, 500), (3, '500-2000', 500, 2000),
                 (4, '2000-5000', 2000, 5000), (5, '5000-8000', 5000, 8000), (6, '8000-10000', 8000, 10000),
                 (7, '10000-15000', 10000, 15001)) b(i, label, lo, hi)
    LEFT JOIN ({TAGS_SQL}) t ON t.n >= b.lo AND t.n < b.hi GROUP BY ALL"""


@query("A6 J9 P22", HIST_SQL)
def hist_custom(spark, sf):
    return ST.histogram(tag_frequency(spark, sf), "n")


@query("A8 F18", f"SELECT CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (WHERE n > 0) AS filled_bins FROM ({HIST_SQL})")
def hist_total(spark, sf):
    return ST.histogram(tag_frequency(spark, sf), "n").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("filled_bins"))


@query("A7 J9", """
    WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
         v AS (SELECT CAST(least(floor(10.0 * (value - lo) / (hi - lo)) + 1, 10) AS INTEGER) AS bin FROM events, s)
    SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (hi - lo) * (b.bin - 1) / 10, 6) AS low,
           round(lo + (hi - lo) * b.bin / 10, 6) AS high, count(v.bin) AS n
    FROM (SELECT unnest(range(1, 11)) AS bin) b CROSS JOIN s LEFT JOIN v ON v.bin = b.bin GROUP BY ALL""")
def hist_equal(spark, sf):
    bins = ST.histogram_equal(table(spark, sf, "events"), "value", 10)
    return bins.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


SLOT = ["event_type", "slot_date", "slot_hour"]


def slotted_events(spark: SparkSession, sf: str) -> DataFrame:
    return PK.with_slot(table(spark, sf, "events"), "ts")


def date_text(df: DataFrame) -> DataFrame:
    """Dates as text, which every engine prints alike."""
    return df.withColumn("slot_date", F.col("slot_date").cast("string"))


@query("W1 Q2", """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS slot_date, CAST(hour(ts) AS INTEGER) AS slot_hour, event_id, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), hour(ts) ORDER BY ts, event_id) = 1""")
def first_per_slot(spark, sf):
    return date_text(PK.first_k(slotted_events(spark, sf), SLOT, ["ts", "event_id"])).select(*SLOT, "event_id", "ts")


@query("W2 W3 F10 T5 Q3", """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS slot_date, CAST(hour(ts) AS INTEGER) AS slot_hour, event_id,
           CAST(row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), hour(ts) ORDER BY ts, event_id) - 1 AS INTEGER) AS pos
    FROM events WHERE minute(ts) >= 5
    QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), hour(ts) ORDER BY ts, event_id) <= 5""")
def first_k_per_slot(spark, sf):
    picked = PK.first_k(slotted_events(spark, sf), SLOT, ["ts", "event_id"], 5, 5, "ts", "pos")
    return date_text(picked).select(*SLOT, "event_id", "pos")


@query("J5 U5", """
    SELECT t.event_type, strftime(d, '%Y-%m-%d') AS slot_date, CAST(h AS INTEGER) AS slot_hour
    FROM (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS event_type) t,
         range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY) days(d), range(0, 24) hours(h)
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = t.event_type AND CAST(e.ts AS DATE) = CAST(d AS DATE) AND hour(e.ts) = h)""")
def missing_slots(spark, sf):
    return date_text(PK.missing_slots(slotted_events(spark, sf), EVENT_TYPES, "2024-01-01", "2024-01-31", "event_type"))


@query("F11 T1", """
    SELECT event_id, ts, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-15 10:00:00' AND ts < TIMESTAMP '2024-01-15 11:00:00' AND event_type = 'click'""")
def hour_range(spark, sf):
    hour = FL.in_hour(table(spark, sf, "events"), "ts", "2024-01-15 10:00:00", "click", "event_type")
    return hour.select("event_id", "ts", "event_type").orderBy("ts", "event_id")


@query("P1 P3 P8 P13", """
    SELECT 'twitter' AS platform, 'https://x.com/' || user_id || '/status/' || event_id AS post_url_computed,
           ts AS date_created, event_type AS language, event_id, strftime(ts, '%Y-%m') || '-' || event_type AS ym_lang,
           CAST(year(ts) AS INTEGER) AS year_created, CAST(month(ts) AS INTEGER) AS month_created,
           CAST(day(ts) AS INTEGER) AS day_created, CAST(hour(ts) AS INTEGER) AS hour_created FROM events""")
def post_index(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "ts", "event_type", P.post_url(F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("url"),
        TM.year_month_lang(F.col("ts"), F.col("event_type")).alias("ym_lang"),
    )
    return PK.index_rows(events, "ts", "event_type", "url", ["event_id", "ym_lang"])


@query("J1 W2 S11", """
    WITH p AS (SELECT event_id, CAST(row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), hour(ts) ORDER BY ts, event_id) - 1 AS INTEGER) AS pos
               FROM events QUALIFY pos < 5)
    SELECT p.event_id, p.pos, e.user_id, e.value, e.props FROM p JOIN events e USING (event_id)""")
def first_k_lookup(spark, sf):
    picked = PK.first_k(slotted_events(spark, sf), SLOT, ["ts", "event_id"], 5, rank="pos").select("event_id", "pos")
    return PK.lookup(table(spark, sf, "events").select("event_id", "user_id", "value", "props"), picked, ["event_id"], pin=True)


@query("J1 S11", """
    SELECT o.o_orderkey AS l_orderkey, l.l_linenumber, o.o_custkey, l.l_partkey, l.l_suppkey, l.l_quantity
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_linenumber = 1""")
def location_lookup(spark, sf):
    requests = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), "o_custkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return PK.lookup(lines, requests, ["l_orderkey", "l_linenumber"])


@query("P15 T1 W7", """
    SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS task_idx, text AS post_text,
           'https://x.com/' || role || '/status/' || conv_id AS post_url, role = 'assistant' AS has_media,
           CAST(NULL AS VARCHAR) AS image FROM conversations""")
def task_export(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "conv_id", "turn", "text", P.post_url(F.col("role"), F.col("conv_id").cast("string")).alias("post_url"),
        F.when(F.col("role") == "assistant", True).alias("contains_media"),
    )
    return PK.task_export(rows, ["conv_id", "turn"])


@query("P16", "SELECT text AS post_text FROM conversations")
def text_tasks(spark, sf):
    return PK.text_tasks(table(spark, sf, "conversations"))


def json_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as post JSON: English ones enveloped, the others bare."""
    doc = F.col
    listed = doc("quality").isNotNull()
    media = F.array(F.struct(F.concat(F.lit("https://m/"), doc("doc_id")).alias("media_url_https")))
    entities = F.struct(
        F.array(F.struct(doc("lang").alias("text")), F.struct(doc("source").alias("text"))).alias("hashtags"),
        F.when(doc("toxic") == 1, media).alias("media"),
    )
    post = F.struct(
        doc("doc_id").alias("id"),
        doc("doc_id").cast("string").alias("id_str"),
        (F.lit(1640995200999) + doc("doc_id") * 77777).cast("string").alias("timestamp_ms"),
        doc("lang"),
        doc("text").alias("text"),
        (doc("n_chars") > 140).alias("truncated"),
        F.when(listed, F.struct(doc("text").alias("full_text"))).alias("extended_tweet"),
        F.struct(doc("source").alias("screen_name"), doc("doc_id").cast("string").alias("id_str")).alias("user"),
        F.when(listed, doc("toxic") == 1).alias("possibly_sensitive"),
        entities.alias("entities"),
        F.when(doc("quality") == 0, F.struct(F.concat(media, media).alias("media"))).alias("extended_entities"),
    )
    value = F.when(doc("lang") == "en", F.to_json(F.struct(post.alias("data")))).otherwise(F.to_json(post))
    return labelled_docs(spark, sf).select(value.alias("value"))


@query("S4 P1 P2 P4 P5 P6 P7 P23", """
    SELECT d.doc_id AS id, 'https://x.com/' || d.source || '/status/' || d.doc_id AS post_url,
           TIMESTAMP '2022-01-01 00:00:00' + to_seconds((999 + d.doc_id * 77777) // 1000) AS date_created,
           md5(d.text) AS text_md5,
           d.lang || '; ' || d.source AS tags,
           CASE WHEN l.toxic = 1 OR l.quality = 0 THEN 'true' END AS contains_media,
           CASE WHEN l.quality = 0 THEN 'https://m/' || d.doc_id || '; https://m/' || d.doc_id
                WHEN l.toxic = 1 THEN 'https://m/' || d.doc_id ELSE '' END AS media,
           d.n_chars > 140 AS truncated, CASE WHEN l.quality IS NOT NULL THEN CAST(l.toxic = 1 AS VARCHAR) END AS possibly_sensitive,
           CAST(d.doc_id AS VARCHAR) AS user_id
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def parsed_posts(spark, sf):
    posts = P.parse_posts(json_posts(spark, sf))
    entities, extended = F.col("entities"), F.col("extended_entities")
    return posts.select(
        "id", P.post_url(F.col("user.screen_name"), F.col("id")).alias("post_url"),
        TM.event_time(F.col("timestamp_ms")).alias("date_created"),
        F.md5(P.full_text(F.col("truncated"), F.col("text"), F.col("extended_tweet.full_text"))).alias("text_md5"),
        F.array_join(P.hashtags(entities), "; ").alias("tags"),
        P.contains_media(entities, extended).cast("string").alias("contains_media"),
        F.array_join(P.media_urls(entities, extended), "; ").alias("media"),
        "truncated", F.col("possibly_sensitive").cast("string").alias("possibly_sensitive"),
        P.short_user(F.col("user.id_str"), F.col("user.display_name"))["id_str"].alias("user_id"),
    )


@query("P8 P10 P11 K15", """
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y-%m') || '-' || lower(o_orderstatus) AS ym_lang,
           'MAIN_' || strftime(o_orderdate, '%Y_%m') || '_' || rpad(lower(o_orderstatus), 3, '_') || '_twitter' AS table_name,
           strftime(o_orderdate, '%Y') || '_' || lower(strftime(o_orderdate, '%b')) || '_' || lower(o_orderstatus) || '_twitter_1' AS title
    FROM orders""")
def naming_keys(spark, sf):
    day, lang = F.col("o_orderdate"), F.lower("o_orderstatus")
    return table(spark, sf, "orders").select(
        TM.year_month(day).alias("ym"), TM.year_month_lang(day, lang).alias("ym_lang"),
        N.table_name(F.lit("MAIN"), day, lang, F.lit("twitter")).alias("table_name"),
        N.project_title(day, lang, F.lit("twitter"), F.lit("1")).alias("title"),
    ).distinct()


@query("P9", """
    SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stem, strftime(ts, '%Y%m%d') AS archive, strftime(ts, '%Y-%m') AS dump,
           date_trunc('minute', ts) AS file_time FROM events""")
def member_names(spark, sf):
    ts = F.col("ts")
    day = F.date_format(ts, "yyyyMMdd")
    return table(spark, sf, "events").select(
        "event_id",
        N.member_stem(F.concat(day, F.lit("/"), F.date_format(ts, "yyyyMMddHHmmss"), F.lit(".json.gz"))).alias("stem"),
        N.archive_date(F.concat(F.lit("dump/stream-"), day, F.lit(".tar"))).alias("archive"),
        N.dump_month(F.concat(F.lit("stream-"), F.date_format(ts, "yyyy-MM"))).alias("dump"),
        TM.bucket_time(F.concat(TM.bucket_name(ts), F.lit(".jsonl.gz"))).alias("file_time"),
    )


@query("J7", """
    SELECT user_id, event_id, ts FROM events
    WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def new_users(spark, sf):
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"))
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return C.new_rows(events, known, "user_id", ["ts", "event_id"])


@query("J11", """
    WITH m AS (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders),
         s AS (SELECT DISTINCT year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem),
         e AS (SELECT DISTINCT year(ts) AS y, month(ts) AS m FROM events)
    SELECT CAST(m.y AS INTEGER) AS year, CAST(m.m AS INTEGER) AS month, s.y IS NOT NULL AS stats, e.y IS NOT NULL AS index
    FROM m LEFT JOIN s ON m.y = s.y AND m.m = s.m LEFT JOIN e ON m.y = e.y AND m.m = e.m""")
def month_catalog(spark, sf):
    def months(df: DataFrame, col: str) -> DataFrame:
        return df.select(F.year(col).alias("year"), F.month(col).alias("month"))

    listing = table(spark, sf, "orders").select(F.concat(F.lit("/data/stream-"), TM.year_month(F.col("o_orderdate"))).alias("path"))
    outputs = {"stats": months(table(spark, sf, "lineitem"), "l_shipdate"), "index": months(table(spark, sf, "events"), "ts")}
    return C.month_catalog(C.months_found(listing), outputs)


@query("A18", """
    WITH c AS (SELECT count(*) AS n, count(l.quality) AS m FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT '' AS path, 'object' AS type, n, false AS required FROM c
    UNION ALL SELECT 'doc_id', 'integer', n, true FROM c UNION ALL SELECT 'lang', 'string', n, true FROM c
    UNION ALL SELECT 'labels', 'object', m, m = n FROM c UNION ALL SELECT 'labels.quality', 'integer', m, true FROM c
    UNION ALL SELECT 'labels.toxic', 'boolean', m, true FROM c UNION ALL SELECT 'tags', 'array', n, true FROM c
    UNION ALL SELECT 'tags[]', 'object', 2 * n, false FROM c UNION ALL SELECT 'tags[].text', 'string', 2 * n, true FROM c""")
def key_presence(spark, sf):
    labels = F.struct("quality", (F.col("toxic") == 1).alias("toxic"))
    tags = F.array(F.struct(F.col("lang").alias("text")), F.struct(F.col("source").alias("text")))
    record = F.struct("doc_id", "lang", F.when(F.col("quality").isNotNull(), labels).alias("labels"), tags.alias("tags"))
    return SH.key_presence(labelled_docs(spark, sf).select(F.to_json(record).alias("value")), "value")


@query("A19", """
    WITH p AS (SELECT turn, role AS path, count(*) AS n, sum(count(*)) OVER (PARTITION BY turn) AS total
               FROM conversations GROUP BY turn, role),
         b AS (SELECT turn, lag(turn) OVER (ORDER BY turn) AS prev FROM (SELECT DISTINCT turn FROM conversations)),
         cur AS (SELECT p.turn, p.path, p.n = p.total AS req FROM p JOIN b USING (turn) WHERE b.prev IS NOT NULL),
         old AS (SELECT b.turn, p.path, p.n = p.total AS req FROM p JOIN b ON b.prev = p.turn)
    SELECT CAST(coalesce(c.turn, o.turn) AS VARCHAR) AS turn, coalesce(c.path, o.path) AS path, 'string' AS type,
           CASE WHEN o.path IS NULL THEN 'added' WHEN c.path IS NULL THEN 'removed'
                WHEN c.req THEN 'now required' ELSE 'now optional' END AS change
    FROM cur c FULL JOIN old o ON c.turn = o.turn AND c.path = o.path
    WHERE c.req IS DISTINCT FROM o.req""")
def schema_drift(spark, sf):
    rows = table(spark, sf, "conversations").select("turn", F.to_json(F.create_map("role", "text")).alias("value"))
    drift = SH.schema_drift(SH.key_presence(rows, "value", "turn"), "turn")
    return drift.withColumn("turn", F.col("turn").cast("string"))
