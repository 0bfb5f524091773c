"""Buckets, positional index, sampling, relevance, archives and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postquarry.functions import times as TM
from postquarry.operators import buckets as B
from postquarry.operators import pick as PK
from postquarry.operators import relevance as R
from postquarry.operators.numbering import number_rows
from postquarry.plans.derived import write_archive
from postquarry.plans.registry import query, table
from postquarry.session import materialize, scratch_path
from postquarry.sinks import tables as K
from postquarry.sources import members as MB
from postquarry.sources.archive import lookup_lines, read_archive
from postquarry.sources.files import read_repacked
from postquarry.streaming import streams as S

BUCKET_SQL = "time_bucket(INTERVAL '15 minutes', ts)"
INDEX_SQL = f"""
    SELECT event_type, bucket, n, CAST(coalesce(sum(n) OVER (PARTITION BY event_type ORDER BY bucket
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_row
    FROM (SELECT event_type, {BUCKET_SQL} AS bucket, count(*) AS n FROM events GROUP BY ALL)"""


def bucketed_events(spark: SparkSession, sf: str) -> DataFrame:
    return TM.with_bucket(table(spark, sf, "events"), "ts", 15)


def event_index(spark: SparkSession, sf: str) -> DataFrame:
    return B.bucket_index(bucketed_events(spark, sf), "event_type")


@query("P12", f"SELECT event_id, {BUCKET_SQL} AS bucket FROM events")
def time_buckets_15(spark, sf):
    return bucketed_events(spark, sf).select("event_id", "bucket")


@query("P12", """
    SELECT event_id, date_trunc('day', ts) + to_minutes((hour(ts) * 60 + minute(ts)) // 25 * 25) AS bucket FROM events""")
def time_buckets_25(spark, sf):
    return TM.with_bucket(table(spark, sf, "events"), "ts", 25).select("event_id", "bucket")


@query("A5 W4 T2 F13", INDEX_SQL + " ORDER BY event_type, bucket")
def bucket_index(spark, sf):
    return event_index(spark, sf).orderBy("event_type", "bucket")


@query("T4", "SELECT event_type, count(*) AS total FROM events GROUP BY event_type")
def index_totals(spark, sf):
    return B.index_totals(event_index(spark, sf), "event_type")


@query("J2 F19 W6", f"""
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS position,
           {BUCKET_SQL} AS bucket, row_number() OVER (PARTITION BY event_type, {BUCKET_SQL} ORDER BY ts, event_id) - 1 AS "offset"
    FROM events""")
def range_probe(spark, sf):
    numbered = number_rows(table(spark, sf, "events").select("event_id", "event_type", "ts"), ["ts", "event_id"], ["event_type"])
    return B.locate_positions(numbered.drop("ts"), event_index(spark, sf), "event_type")


DRAWS_SQL = """
    SELECT t.event_type, d.draw, CAST('0x' || substr(md5('7:' || t.event_type || ':' || d.draw), 1, 15) AS BIGINT) % t.total AS position
    FROM (SELECT event_type, count(*) AS total FROM events GROUP BY 1) t, (SELECT unnest(range(0, 200)) AS draw) d"""


@query("T6", DRAWS_SQL)
def random_positions(spark, sf):
    return B.sample_positions(event_index(spark, sf), 200, 7, "event_type")


@query("T6 J2 J1 Q5", f"""
    WITH r AS (SELECT event_id, event_type, value, {BUCKET_SQL} AS bucket,
                      row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS position FROM events)
    SELECT d.event_type, d.draw, d.position, r.bucket, r.event_id, r.value FROM ({DRAWS_SQL}) d JOIN r USING (event_type, position)""")
def random_rows(spark, sf):
    events = bucketed_events(spark, sf).select("event_id", "event_type", "ts", "value", "bucket")
    index = B.bucket_index(events, "event_type")
    draws = B.sample_positions(index, 200, 7, "event_type")
    located = B.locate_positions(draws, index, "event_type")
    return B.rows_at(events, located, "event_type", order_cols=["ts", "event_id"]).select("event_type", "draw", "position", "bucket", "event_id", "value")


@query("T7", """
    SELECT user_id, event_id, ts FROM events
    WHERE user_id IN (SELECT user_id FROM (SELECT DISTINCT user_id FROM events) ORDER BY md5('42:' || user_id) LIMIT 50)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def sample_distinct(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return B.sample_distinct(events, "user_id", 50, 42, ["ts", "event_id"])


@query("J6 F12 U5 Q4", """
    SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events
    WHERE strftime(ts, '%Y%m%d') NOT IN (SELECT strftime(o_orderdate + INTERVAL 305 MONTH + INTERVAL 14 DAY, '%Y%m%d') FROM orders)""")
def new_days(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    # The orders' days, moved so that they end within the events.
    held = table(spark, sf, "orders").select(F.date_format(F.date_add(F.add_months("o_orderdate", 305), 14), "yyyyMMdd").alias("day"))
    return B.new_days(events, held).select("event_id", "day")


# Words of the relevance query: frequent words of the test texts.
WORDS = ["the", "and", "thth", "ration", "lyon", "where", "retion", "andand", "onon", "der", "que", "les"]
WORDS_SQL = ", ".join(f"'{w}'" for w in WORDS)
TOKENS_SQL = r"list_filter(list_distinct(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')), lambda t: t <> '')"


@query("J3 F8", f"""
    SELECT doc_id, lang, array_to_string(list_sort(w), '; ') AS words, CAST(len(w) AS INTEGER) AS n_words
    FROM (SELECT doc_id, lang, list_filter({TOKENS_SQL}, lambda t: t IN ({WORDS_SQL})) AS w FROM documents) WHERE len(w) >= 2""")
def relevant_words(spark, sf):
    hits = R.match_words(table(spark, sf, "documents"), ["doc_id", "lang"], "text", WORDS)
    return hits.withColumn("words", F.array_join("words", "; "))


@query("J3 F8 A22", f"""
    WITH w AS (SELECT DISTINCT unnest({TOKENS_SQL}) AS word FROM benchmark),
         t AS (SELECT doc_id, unnest({TOKENS_SQL}) AS word FROM documents)
    SELECT doc_id, md5(string_agg(word, ' ' ORDER BY word)) AS words_md5, CAST(count(*) AS INTEGER) AS n_words
    FROM t JOIN w USING (word) GROUP BY doc_id HAVING count(*) >= 2""")
def relevant_words_table(spark, sf):
    words = table(spark, sf, "benchmark").select(F.explode(R.tokens(F.col("text"))).alias("word"))
    hits = R.match_words(table(spark, sf, "documents"), ["doc_id"], "text", words)
    return hits.select("doc_id", F.md5(F.array_join("words", " ")).alias("words_md5"), "n_words")


def vector_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Vectors with a label row are references (b = low quality or toxic, h = the rest); the others are posts."""
    vectors, labels = table(spark, sf, "embeddings").select("vec_id", "embedding"), table(spark, sf, "labels")
    by_id = vectors.join(labels.withColumnRenamed("doc_id", "vec_id"), "vec_id")
    bot = (F.col("toxic") == 1) | (F.col("quality") == 0)
    refs = by_id.select(F.col("vec_id").alias("ref_id"), F.when(bot, "b").otherwise("h").alias("label"), F.col("embedding").alias("vec"))
    return vectors.join(labels.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_anti"), refs


NEAREST_SQL = """
    WITH r AS (SELECT e.vec_id AS ref_id, CASE WHEN l.toxic = 1 OR l.quality = 0 THEN 'b' ELSE 'h' END AS label, e.embedding AS v
               FROM embeddings e JOIN labels l ON l.doc_id = e.vec_id),
         p AS (SELECT vec_id, embedding AS v FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)),
         s AS (SELECT p.vec_id, r.ref_id, r.label, round(list_cosine_similarity(p.v::DOUBLE[], r.v::DOUBLE[]), 12) AS c FROM p, r),
         k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, ref_id) AS rank FROM s)
    """


def _rounded(neighbours: DataFrame) -> DataFrame:
    return neighbours.withColumn("cosine", F.round("cosine", 6))


@query("J4 W5", NEAREST_SQL + "SELECT vec_id, CAST(rank AS INTEGER) AS rank, ref_id, label, round(c, 6) AS cosine FROM k WHERE rank <= 3")
def nearest_refs(spark, sf):
    posts, refs = vector_sides(spark, sf)
    return _rounded(R.nearest(posts, "vec_id", "embedding", refs))


@query("J4 W5 (blocked)", NEAREST_SQL + "SELECT vec_id, CAST(rank AS INTEGER) AS rank, ref_id, label, round(c, 6) AS cosine FROM k WHERE rank <= 3")
def nearest_refs_blocked(spark, sf):
    posts, refs = vector_sides(spark, sf)
    return _rounded(R.nearest(posts, "vec_id", "embedding", refs, broadcast_bytes=0))


@query("F9 J4 W5", NEAREST_SQL + "SELECT vec_id FROM k WHERE rank <= 3 GROUP BY vec_id HAVING bool_or(label = 'h')")
def knn_filter(spark, sf):
    posts, refs = vector_sides(spark, sf)
    return R.drop_bots(posts, R.nearest(posts, "vec_id", "embedding", refs), "vec_id").select("vec_id")


@query("U4", """
    SELECT CASE WHEN l.toxic = 1 THEN 'b_' ELSE 'h_' END || e.vec_id AS ref_id, CASE WHEN l.toxic = 1 THEN 'b' ELSE 'h' END AS label,
           CAST(len(e.embedding) AS INTEGER) AS dim
    FROM embeddings e JOIN labels l ON l.doc_id = e.vec_id""")
def reference_vectors(spark, sf):
    vectors, labels = table(spark, sf, "embeddings"), table(spark, sf, "labels").withColumnRenamed("doc_id", "vec_id")
    def side(condition: str) -> DataFrame:
        chosen = vectors.join(labels.where(condition).select("vec_id"), "vec_id", "left_semi")
        return chosen.select(F.col("vec_id").alias("ref_id"), F.col("embedding").alias("vec"))

    merged = R.reference_set({"b": side("toxic = 1"), "h": side("toxic = 0")})
    return merged.select("ref_id", "label", F.size("vec").alias("dim"))


EVENT_JSON = "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def event_archive(spark: SparkSession, sf: str, damaged: bool = False) -> str:
    """The events as an archive of tar files in the shared folder."""
    value = F.to_json(F.struct("event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value", "props"))
    path = scratch_path(spark, "archive")
    write_archive(table(spark, sf, "events").select(value.alias("value")), path, "2024-01", damaged=damaged)
    return path


@query("S1 S3", "SELECT event_id, user_id, event_type, value, props, ts FROM events")
def archive_scan(spark, sf):
    lines = read_archive(spark, event_archive(spark, sf), sliceBytes=1 << 16)
    events = lines.select(F.from_json("value", EVENT_JSON).alias("e")).select("e.*")
    return events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("S10 S11 W1 J1", """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS slot_date, CAST(hour(ts) AS INTEGER) AS slot_hour, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), hour(ts) ORDER BY ts, event_id) = 1""")
def archive_lookup(spark, sf):
    path = event_archive(spark, sf)
    lines = read_archive(spark, path)
    parsed = lines.select(*PK.LOCATION, F.from_json("value", EVENT_JSON).alias("e")).select(*PK.LOCATION, "e.event_type", "e.event_id", F.col("e.ts").cast("timestamp_ntz").alias("ts"))
    slot = ["event_type", "slot_date", "slot_hour"]
    picked = PK.first_k(PK.with_slot(parsed, "ts"), slot, ["ts", "event_id"]).select(*PK.LOCATION, *slot)
    found = lookup_lines(spark, path, picked)
    found = found.withColumn("slot_date", F.col("slot_date").cast("string"))
    return found.select(*slot, F.from_json("value", EVENT_JSON)["event_id"].alias("event_id"))


@query("S1 S2 S12", """
    SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, true AS damage_reported FROM events GROUP BY event_type""")
def archive_damaged(spark, sf):
    """An archive in which every second member breaks off: the others are read in full, the broken ones are reported each."""
    path = event_archive(spark, sf, damaged=True)
    index = materialize(MB.index_members(spark, path), "member-index")
    lines = materialize(MB.read_members(spark, path, index, bad_member="report", slice_bytes=1 << 22), "damaged-lines")
    reported = lines.where("member_error is not null").select("archive", "member").distinct().count()
    cut = index.where(F.col("member").contains("|cut.")).count()
    events = lines.where("member_error is null").select(F.from_json("value", EVENT_JSON).alias("e"))
    return events.groupBy("e.event_type").agg(F.count("*").alias("n"), F.sum("e.event_id").alias("ids")).withColumn(
        "damage_reported", F.lit(reported == cut and 2 * cut == index.count()))


@query("S1 S10 S11 J1", """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS slot_date, CAST(hour(ts) AS INTEGER) AS slot_hour, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), hour(ts) ORDER BY ts, event_id) = 1""")
def archive_index_lookup(spark, sf):
    """The first event of every slot, found in one pass over the archive and opened again at its member's place."""
    path = event_archive(spark, sf)
    index = materialize(MB.index_members(spark, path), "member-index")
    parsed = MB.read_members(spark, path, index, slice_bytes=1 << 22).select(
        *PK.LOCATION, F.from_json("value", EVENT_JSON).alias("e")
    ).select(*PK.LOCATION, "e.event_type", "e.event_id", F.col("e.ts").cast("timestamp_ntz").alias("ts"))
    slot = ["event_type", "slot_date", "slot_hour"]
    picked = PK.first_k(PK.with_slot(parsed, "ts"), slot, ["ts", "event_id"]).select(*PK.LOCATION, *slot)
    found = MB.lookup_members(spark, path, index, picked).withColumn("slot_date", F.col("slot_date").cast("string"))
    return found.select(*slot, F.from_json("value", EVENT_JSON)["event_id"].alias("event_id"))


EVENT_ROWS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("value", T.DoubleType()), T.StructField("bucket", T.StringType()),
])


@query("K1 K2 S5 U2", f"""
    SELECT event_id, ts, value, event_type AS lang, strftime(ts, '%Y%m%d') AS day, strftime({BUCKET_SQL}, '%Y%m%d%H%M') AS bucket
    FROM events WHERE event_type IN ('click', 'view')""")
def repacked_scan(spark, sf):
    root = scratch_path(spark, "repacked")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value", F.col("event_type").alias("lang"))
    K.repack(events, root, "ts", ["ts", "event_id"])
    return read_repacked(spark, root, EVENT_ROWS, ["click", "view"]).select("event_id", "ts", "value", "lang", "day", "bucket")


@query("K2 T5", f"""
    SELECT event_id, event_type AS lang, strftime(ts, '%Y%m%d') AS day, strftime({BUCKET_SQL}, '%Y%m%d%H%M') AS bucket FROM events""")
def repacked_again(spark, sf):
    """Some days, then all days without those already there, then some days anew: every row once."""
    root = scratch_path(spark, "repacked-again")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value", F.col("event_type").alias("lang"))
    for days, existing in (("day(ts) % 2 = 0", "overwrite"), ("true", "skip"), ("day(ts) % 3 = 0", "overwrite")):
        K.repack(events.where(days), root, "ts", ["ts", "event_id"], existing=existing)
    return read_repacked(spark, root, EVENT_ROWS).select("event_id", "lang", "day", "bucket")


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream; the glob also accepts a folder of part files."""
    return spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/event[s].parquet")


def _run(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    return S.run_to_table(df, scratch_path(spark, label), scratch_path(spark, f"{label}-state"))


@query("R3 W1", """
    SELECT event_type, date_trunc('hour', ts) AS hour_start, event_id, value FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)
    QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts, event_id) = 1""")
def stream_first_per_hour(spark, sf):
    return _run(S.first_per_hour(event_stream(spark, sf), "ts", "event_type", ["event_id"], ["event_id", "value"]), "first")


@query("R4", """
    SELECT date_trunc('minute', ts) AS minute_start, event_type, count(*) AS n FROM events
    WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)
    GROUP BY ALL""")
def stream_minute_counts(spark, sf):
    return _run(S.minute_counts(event_stream(spark, sf), "ts", "event_type"), "minutes")


@query("R5", "SELECT DISTINCT user_id FROM events")
def stream_distinct_users(spark, sf):
    return _run(S.drop_repeats(event_stream(spark, sf).select("user_id", "ts"), ["user_id"], "ts").select("user_id"), "users")


@query("R1", f"""
    SELECT strftime(ts, '%Y%m%d') AS day, event_type AS lang, strftime({BUCKET_SQL}, '%Y%m%d%H%M') AS bucket, count(*) AS n
    FROM events GROUP BY ALL""")
def stream_repack(spark, sf):
    root, late, state = (scratch_path(spark, f"stream-{part}") for part in ("rows", "late", "state"))
    events = event_stream(spark, sf).select("event_id", "ts", "user_id", "value", F.col("event_type").alias("lang"))
    S.repack_stream(events, root, late, state, "ts").trigger(availableNow=True).start().awaitTermination()
    rows = read_repacked(spark, root, EVENT_ROWS)
    return rows.groupBy("day", "lang", "bucket").agg(F.count("*").alias("n"))


@query("R1 R2", f"""
    WITH e AS (SELECT *, (year(ts) * 12 + month(ts)) * 2 + (day(ts) > 15)::INT + (event_type = 'error')::INT AS arrival FROM events),
         b AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM e GROUP BY arrival),
         m AS (SELECT e.*, coalesce(date_trunc('millisecond', ts) < date_trunc('millisecond', newest) - INTERVAL 1 HOUR, false) AS late FROM e JOIN b USING (arrival))
    SELECT strftime(ts, '%Y%m%d') AS day, event_type AS lang, strftime({BUCKET_SQL}, '%Y%m%d%H%M') AS bucket,
           count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS n_late FROM m GROUP BY ALL""")
def stream_late(spark, sf):
    """All events in the half months in which they arrive, errors one later; the stream is stopped and started again for each."""
    arrival = (F.year("ts") * 12 + F.month("ts")) * 2 + (F.dayofmonth("ts") > 15).cast("int") + (F.col("event_type") == "error").cast("int")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value", F.col("event_type").alias("lang"), arrival.alias("arrival"))
    source, root, late, state = (scratch_path(spark, f"stream-{part}") for part in ("arrivals", "rows", "late", "state"))
    for (at,) in sorted(events.select("arrival").distinct().collect()):
        landed = events.where(F.col("arrival") == at).drop("arrival")
        landed.write.mode("append").parquet(source)
        stream = spark.readStream.schema(landed.schema).parquet(source)
        S.repack_stream(stream, root, late, state, "ts").trigger(availableNow=True).start().awaitTermination()
    both = read_repacked(spark, root, EVENT_ROWS).withColumn("late", F.lit(0)).unionByName(
        read_repacked(spark, late, EVENT_ROWS).withColumn("late", F.lit(1))
    )
    return both.groupBy("day", "lang", "bucket").agg(F.count_if(F.col("late") == 0).alias("n"), F.count_if(F.col("late") == 1).alias("n_late"))
