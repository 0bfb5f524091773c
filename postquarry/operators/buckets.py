"""Positional index of time buckets and sampling by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.operators.numbering import number_rows
from postquarry.session import materialize

# Positions are looked up in stripes of this many rows.
STRIPE = 1 << 16


def bucket_index(
    df: DataFrame,
    lang_col: str = "lang",
    bucket_col: str = "bucket",
    file_cols: list[str] | None = None,
) -> DataFrame:
    """Rows per bucket and the global row number each bucket starts at, per language.

    Returns ``lang, bucket, <file_cols>, n, first_row``. The running sum goes over one
    row per bucket (or bucket file), a number bounded by the calendar, not by the rows.
    """
    file_cols = file_cols or []
    keys = [lang_col, bucket_col, *file_cols]
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return index_counts(counted, lang_col, [bucket_col, *file_cols])


def index_counts(counted: DataFrame, lang_col: str, order_cols: list[str]) -> DataFrame:
    """Exclusive running sum of ``n`` per language; empty buckets are left out."""
    before = Window.partitionBy(lang_col).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return counted.where("n > 0").withColumn("first_row", F.coalesce(F.sum("n").over(before), F.lit(0)))


def index_totals(index: DataFrame, lang_col: str = "lang") -> DataFrame:
    """Rows per language according to the index."""
    return index.groupBy(lang_col).agg(F.max(F.col("first_row") + F.col("n")).alias("total"))


def locate_positions(
    positions: DataFrame,
    index: DataFrame,
    lang_col: str = "lang",
    position_col: str = "position",
    stripe: int = STRIPE,
) -> DataFrame:
    """For each (language, position) the bucket holding it and the offset inside.

    Positions and buckets are cut into stripes of ``stripe`` rows; a bucket is listed in
    every stripe it reaches into. Within a stripe the two are merged in order of
    position, and each position takes the last bucket start before it. Repeated
    positions are looked up once. Positions outside the index drop out.
    """
    bucket_cols = [c for c in index.columns if c != lang_col]
    wanted = positions.select(lang_col, position_col).where(F.col(position_col) >= 0).distinct()
    first, last = F.col("first_row"), F.col("first_row") + F.col("n") - 1
    starts = index.select(
        lang_col,
        F.explode(F.sequence(F.floor(first / stripe), F.floor(last / stripe))).alias("_stripe"),
        first.alias("_at"),
        F.struct(*bucket_cols).alias("_bucket"),
    ).withColumn("_kind", F.lit(0))
    asked = wanted.select(
        lang_col,
        F.floor(F.col(position_col) / stripe).alias("_stripe"),
        F.col(position_col).cast("bigint").alias("_at"),
        F.lit(1).alias("_kind"),
    )
    merged = starts.unionByName(asked, allowMissingColumns=True)
    upto = Window.partitionBy(lang_col, "_stripe").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        merged.withColumn("_bucket", F.last("_bucket", ignorenulls=True).over(upto))
        .where(F.col("_kind") == 1)
        .select(lang_col, F.col("_at").alias(position_col), "_bucket.*")
        .where(F.col(position_col) < F.col("first_row") + F.col("n"))
        .withColumn("offset", F.col(position_col) - F.col("first_row"))
        .drop("n", "first_row")
    )
    return positions.join(found, [lang_col, position_col])


def sample_positions(index: DataFrame, n: int, seed: int, lang_col: str = "lang") -> DataFrame:
    """``n`` random positions per language, with replacement: ``lang, draw, position``.

    The position of a draw is a hash of seed, language and draw number, so it does not
    depend on the number of partitions. Draws are listed in chunks that are spread over
    the tasks before they are opened.
    """
    last = n - 1
    chunks = index_totals(index, lang_col).select(
        lang_col, "total", F.explode(F.sequence(F.lit(0), F.lit(last // STRIPE))).alias("_chunk")
    )
    if last >= STRIPE:
        chunks = chunks.repartition(lang_col, "_chunk")
    first = F.col("_chunk").cast("bigint") * STRIPE
    draws = chunks.select(
        lang_col, "total", F.explode(F.sequence(first, F.least(first + STRIPE - 1, F.lit(last).cast("bigint")))).alias("draw")
    )
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(lang_col), F.col("draw").cast("string")))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return draws.select(lang_col, "draw", F.pmod(number, F.col("total")).alias("position"))


def rows_at(
    df: DataFrame,
    located: DataFrame,
    lang_col: str = "lang",
    bucket_col: str = "bucket",
    offset_col: str = "offset",
    order_cols: list[str] | None = None,
) -> DataFrame:
    """The rows of ``df`` at the located places.

    The places are written first: from the size of the files Spark knows whether to
    broadcast them, so a sample does not shuffle the whole table. Files know the line
    number of a row; for a table without offsets ``order_cols`` (unique within a bucket)
    define them, and only the buckets that were drawn are numbered.
    """
    places = materialize(located, "located")
    if order_cols:
        drawn = df.join(places.select(lang_col, bucket_col).distinct(), [lang_col, bucket_col], "left_semi")
        df = number_rows(drawn, order_cols, [lang_col, bucket_col], offset_col)
    return places.join(df, [lang_col, bucket_col, offset_col])


def random_rows(
    df: DataFrame, n: int, seed: int, order_cols: list[str], lang_col: str = "lang", bucket_col: str = "bucket",
) -> DataFrame:
    """``n`` random rows per language, with replacement: the columns of ``df``, ``draw, position, offset``.

    Only rows that exist are counted and numbered, so every draw gives a row. ``order_cols`` are unique within
    a bucket. Rows without a language or bucket are never drawn; a language without rows has no draws.
    """
    held = df.where(F.col(lang_col).isNotNull() & F.col(bucket_col).isNotNull())
    index = bucket_index(held, lang_col, bucket_col)
    located = locate_positions(sample_positions(index, n, seed, lang_col), index, lang_col)
    return rows_at(held, located, lang_col, bucket_col, order_cols=order_cols)


def sample_distinct(
    df: DataFrame, key_col: str, n: int, seed: int, order_cols: list[str] | None = None, direct: int = 100_000,
) -> DataFrame:
    """``n`` distinct keys in the order of a seeded hash, with ``order_cols`` one row each.

    The keys alone are deduplicated and ranked; the rows follow by a join with the
    ``n`` winners; a null key never wins. Of several rows of a key the first by ``order_cols`` is
    taken; without it all rows of the chosen keys are. Beyond
    ``direct`` the winners are not sorted as a whole: keys are counted by the first four
    digits of their hash, whole groups are taken while they fit, and only the group that
    the ``n``-th key falls into is sorted.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key_col).cast("string")))
    keys = df.select(key_col).where(F.col(key_col).isNotNull()).distinct().withColumn("_rank", digest)
    if n <= direct:
        winners = keys.orderBy("_rank").limit(n)
    else:
        group = F.substring("_rank", 1, 4)
        taken, edge = 0, None
        for row in keys.groupBy(group.alias("g")).agg(F.count("*").alias("c")).orderBy("g").collect():
            if taken + row["c"] > n:
                edge = row["g"]
                break
            taken += row["c"]
        winners = keys
        if edge is not None:
            rest = keys.where(group == edge).orderBy("_rank").limit(n - taken)
            winners = keys.where(group < edge).unionByName(rest)
    chosen = df.join(winners.drop("_rank"), key_col, "left_semi")
    if not order_cols:
        return chosen
    first = Window.partitionBy(key_col).orderBy(*order_cols)
    return chosen.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


# Days of an output are listed literally up to this many (more than a century).
LISTED_DAYS = 40_000


def new_days(df: DataFrame, existing: DataFrame, day_col: str = "day") -> DataFrame:
    """Rows of days the output does not hold yet.

    Days are few and each holds many rows, so joining by day would gather them. The days
    are bounded by the calendar and become a literal list; anything longer is joined.
    """
    days = existing.select(day_col).where(F.col(day_col).isNotNull()).distinct()
    listed = [row[0] for row in days.limit(LISTED_DAYS + 1).collect()]
    if len(listed) > LISTED_DAYS:
        return df.join(days, day_col, "left_anti")
    return df.where(F.col(day_col).isNull() | ~F.col(day_col).isin(listed)) if listed else df
