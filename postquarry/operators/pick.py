"""First posts per slot, empty slots, lookup by location and task tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.functions import posts as P
from postquarry.functions import times as TM
from postquarry.operators.filters import after_minutes
from postquarry.operators.numbering import number_rows
from postquarry.session import materialize

LOCATION = ["dump", "archive", "member", "line_no"]


def with_slot(df: DataFrame, ts_col: str) -> DataFrame:
    """Add ``slot_date`` and ``slot_hour``; the full date, so months never mix."""
    return df.withColumn("slot_date", F.to_date(ts_col)).withColumn("slot_hour", F.hour(ts_col))


def first_k(
    df: DataFrame,
    slot_cols: list[str],
    order_cols: list[str],
    k: int = 1,
    skip_minutes: int = 0,
    ts_col: str = "ts",
    rank: str | None = None,
) -> DataFrame:
    """The first ``k`` rows of every slot; ``rank`` names a 0-based position column.

    Every task cuts its own rows to ``k`` per slot before the shuffle (group limit), so
    a crowded slot moves at most ``k`` rows per task.
    """
    window = Window.partitionBy(*slot_cols).orderBy(*order_cols)
    ranked = after_minutes(df, ts_col, skip_minutes).withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= k)
    return ranked.withColumn(rank, F.col("_rn") - 1).drop("_rn") if rank else ranked.drop("_rn")


def missing_slots(picked: DataFrame, langs: list[str], first_day: str, last_day: str, lang_col: str = "lang") -> DataFrame:
    """Every (language, date, hour) between two days that ``picked`` has no row for."""
    day = F.explode(F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"), F.expr("INTERVAL 1 DAY")))
    grid = (
        picked.sparkSession.range(0, 1, 1, 1)
        .select(day.alias("slot_date"))
        .withColumn("slot_hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .withColumn(lang_col, F.explode(F.array(*[F.lit(v) for v in langs])))
    )
    return grid.join(picked.select(lang_col, "slot_date", "slot_hour").distinct(), [lang_col, "slot_date", "slot_hour"], "left_anti")


def lookup(df: DataFrame, requests: DataFrame, loc_cols: list[str] = LOCATION, pin: bool = False) -> DataFrame:
    """Rows of ``df`` at the requested locations, with the columns of the request.

    With ``pin`` the requests are written first: a request computed from a large table
    looks large to the planner, the size of its files shows whether it can be broadcast.
    """
    return (materialize(requests, "requests") if pin else requests).join(df, loc_cols)


def index_rows(df: DataFrame, ts_col: str, lang_col: str, url: str, extra_cols: list[str], platform: str = P.PLATFORM) -> DataFrame:
    """Index projection: platform, address, time, language, location and date parts."""
    parts = TM.date_parts(F.col(ts_col))
    return df.select(
        F.lit(platform).alias("platform"),
        F.col(url).alias("post_url_computed"),
        F.col(ts_col).alias("date_created"),
        F.col(lang_col).alias("language"),
        *extra_cols,
        *[column.alias(name) for name, column in parts.items()],
    )


def candidates(posts: DataFrame, tz: str = "UTC") -> DataFrame:
    """Candidate projection of parsed posts that carry location columns."""
    created = TM.event_time(F.col("timestamp_ms"), tz)
    rows = posts.select(
        P.post_url(F.col("user.screen_name"), F.col("id")).alias("post_url"),
        F.struct(*LOCATION).alias("location_index"),
        F.col("id_str").alias("platform_id"),
        created.alias("date_created"),
        F.col("lang").alias("language"),
        P.full_text(F.col("truncated"), F.col("text"), F.col("extended_tweet.full_text")).alias("text"),
        P.contains_media(F.col("entities"), F.col("extended_entities")).alias("contains_media"),
        F.struct(P.media_urls(F.col("entities"), F.col("extended_entities")).alias("media")).alias("extra"),
    )
    return rows.withColumns(TM.date_parts(F.col("date_created")))


def full_posts(posts: DataFrame, raw_col: str = "value", tz: str = "UTC") -> DataFrame:
    """Full-post projection: the whole source text beside the derived columns."""
    millis = F.coalesce(F.col("timestamp_ms"), F.col("timestamp"))
    rows = posts.select(
        F.lit(P.PLATFORM).alias("platform"),
        P.post_url(F.col("user.screen_name"), F.col("id")).alias("post_url_computed"),
        TM.event_time(millis, tz).alias("date_created"),
        F.col(raw_col).alias("content"),
        P.full_text(F.col("truncated"), F.col("text"), F.col("extended_tweet.full_text")).alias("text"),
        F.col("lang").alias("language"),
        F.struct(*LOCATION).alias("location_index"),
    )
    return rows.withColumns(TM.date_parts(F.col("date_created")))


def task_export(
    df: DataFrame,
    order_cols: list[str],
    text_col: str = "text",
    url_col: str = "post_url",
    media_col: str = "contains_media",
    id_cols: list[str] | None = None,
) -> DataFrame:
    """Annotation tasks numbered in order: text, address, media flag, empty image."""
    numbered = number_rows(df, order_cols, name="task_idx")
    return numbered.select(
        "task_idx",
        *(id_cols or []),
        F.col(text_col).alias("post_text"),
        F.col(url_col).alias("post_url"),
        F.coalesce(F.col(media_col), F.lit(False)).alias("has_media"),
        F.lit(None).cast("string").alias("image"),
    )


def text_tasks(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Tasks that hold the text alone."""
    return df.select(F.col(text_col).alias("post_text"))
