"""Writers. Outputs are told apart by partition columns, not by file names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postquarry.functions import times as TM
from postquarry.operators.buckets import new_days
from postquarry.operators.catalog import new_rows
from postquarry.sources.files import TIME_FORMATS, list_partition_values


def repack_rows(df: DataFrame, ts_col: str, minutes: int = 15, tz: str = "UTC") -> DataFrame:
    """Add the text partition columns ``day`` and ``bucket``."""
    bucketed = TM.with_bucket(df, ts_col, minutes, tz, "_start")
    return (
        bucketed.withColumn("day", F.date_format("_start", "yyyyMMdd"))
        .withColumn("bucket", TM.bucket_name(F.col("_start"))).drop("_start")
    )


def repack(
    df: DataFrame,
    root: str,
    ts_col: str,
    order_cols: list[str],
    minutes: int = 15,
    compression: str = "gzip",
    existing: str = "skip",
    tz: str = "UTC",
    raw_col: str | None = None,
    bucket_folders: bool = False,
    origin_col: str | None = None,
) -> None:
    """Write lines under ``day/lang`` folders, in order of bucket and ``order_cols``.

    With ``raw_col`` a line is that column as it is (the source text of a post);
    otherwise it is the row as JSON with its ``bucket``. ``bucket_folders`` adds a folder
    per bucket: one file per quarter of an hour and language, which is fine for one month
    and far too many files for many years.

    ``origin_col`` names what the rows were read from (the archive's day) and puts a folder
    ``origin`` above the others. ``existing`` then goes by it: ``skip`` leaves out rows of origins that the output
    holds, ``overwrite`` replaces the folders of the origins that occur. A row that an archive holds of the day
    before stands beside that day's own rows and replaces none of them. Without it both go by the day of
    the rows, so a run must hold whole days. Rows are rebalanced by folder: small ones share a
    task, and one larger than the advisory size is split over several tasks and files
    instead of going through one.
    """
    if compression not in ("gzip", "none"):
        raise ValueError("compression must be gzip or none")
    if existing not in ("skip", "overwrite"):
        raise ValueError("existing must be skip or overwrite")
    rows = repack_rows(df, ts_col, minutes, tz)
    keys = ["day", "lang", "bucket"]
    folders = keys if bucket_folders else keys[:2]
    if origin_col:
        rows = rows.withColumn("origin", F.col(origin_col).cast("string"))
        keys, folders = ["origin", *keys], ["origin", *folders]
    if existing == "skip":
        rows = new_days(rows, list_partition_values(df.sparkSession, root, folders[0]), folders[0])
    placed = rows.hint("rebalance", *folders).sortWithinPartitions(*keys, *order_cols)
    if raw_col:
        placed = placed.select(F.col(raw_col).alias("value"), *folders)
    (
        placed.write.mode("append" if existing == "skip" else "overwrite").format("text" if raw_col else "json")
        .option("partitionOverwriteMode", "dynamic").option("compression", compression).options(**TIME_FORMATS)
        .partitionBy(*folders).save(root)
    )


def write_by(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Partitioned table; used for the post index, candidates, relevant posts and statistics."""
    (
        df.hint("rebalance", *partition_cols).write.mode(mode).format(fmt)
        .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).save(path)
    )


def write_post_index(index: DataFrame, path: str) -> None:
    """By month as well, so that indexing one month leaves the others as they are."""
    write_by(index, path, ["year_created", "month_created", "language"])


def write_candidates(candidates: DataFrame, path: str) -> None:
    write_by(candidates, path, ["year_created", "month_created", "language"])


def write_full_posts(posts: DataFrame, path: str) -> None:
    write_by(posts, path, ["year_created", "month_created", "language"])


def write_relevant(relevant: DataFrame, path: str, ts_col: str, lang_col: str = "lang", run: str | None = None) -> None:
    """Relevant posts per year-month and language, added to those of other runs.

    With ``run`` the rows stand below a folder of that name, which is replaced as a whole: a run that is repeated leaves
    its rows once, and none of an attempt before. Without it rows are appended, and a repeat doubles them.
    """
    rows = relevant.withColumn("ym", TM.year_month(F.col(ts_col)))
    if run is None:
        write_by(rows, path, ["ym", lang_col], "json", "append")
    else:
        (
            rows.hint("rebalance", "ym", lang_col).write.mode("overwrite").format("json")
            .option("partitionOverwriteMode", "static").partitionBy("ym", lang_col).save(f"{path.rstrip('/')}/run={run}")
        )


def write_stats(levels: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """The level table, one folder per level, below folders of ``by``: what a run does not hold stays."""
    write_by(levels, path, [*by, "level_mask"])


def nested_stats(finest: DataFrame, archive: str, member: str, lang: str, total: str = "total") -> DataFrame:
    """One JSON document per archive: ``{total_posts, accepted_posts, items: {member: {...}}}``.

    ``finest`` has one row per (archive, member, language), so a document is bounded by
    the members of an archive.
    """
    per_member = finest.groupBy(archive, member).agg(
        F.sum(total).alias("total_posts"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(lang), F.col("accepted"))))).alias("accepted_posts"),
    )
    per_lang = finest.groupBy(archive, lang).agg(F.sum("accepted").alias("n"))
    accepted = per_lang.groupBy(archive).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(lang, "n")))).alias("accepted_posts"))
    items = per_member.groupBy(archive).agg(
        F.sum("total_posts").alias("total_posts"),
        F.map_from_entries(F.sort_array(F.collect_list(
            F.struct(F.col(member), F.to_json(F.struct("total_posts", "accepted_posts")))
        ))).alias("items"),
    )
    document = F.to_json(F.struct("total_posts", "accepted_posts", F.transform_values("items", lambda _, v: F.from_json(
        v, "total_posts BIGINT, accepted_posts MAP<STRING, BIGINT>")).alias("items")))
    return items.join(accepted, archive).select(archive, document.alias("stats"))


def write_status(months: DataFrame, path: str, output: str) -> None:
    """Mark ``year, month`` as held by an output; marks of other months and outputs stay, one made twice stands once."""
    marks = months.select("year", "month").distinct().withColumn("output", F.lit(output)).withColumn("available", F.lit(True))
    marks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("output", "year", "month").parquet(path)


def write_tag_counts(counts: DataFrame, path: str, lang_col: str = "lang", by: tuple[str, ...] = ()) -> None:
    write_by(counts, path, [*by, lang_col])


def write_tasks(tasks: DataFrame, path: str, rewrite: bool = True) -> None:
    """Annotation tasks as JSON lines; an existing folder is replaced or left alone."""
    tasks.write.mode("overwrite" if rewrite else "ignore").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Agreement, disagreement and wide answer tables with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_index(index: DataFrame, path: str) -> None:
    """The repack index, rebuilt as a whole."""
    index.write.mode("overwrite").parquet(path)


def append_new_rows(df: DataFrame, path: str, key: str, order_cols: list[str]) -> None:
    """Append the rows whose key the table at ``path`` lacks."""
    known = df.sparkSession.read.parquet(path)
    new_rows(df, known, key, order_cols).select(*known.columns).write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
