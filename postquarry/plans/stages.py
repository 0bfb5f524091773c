"""Named, configurable stages: an ordered choice of table functions over one source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postquarry.functions import posts as P
from postquarry.functions import times as TM
from postquarry.operators import buckets as B
from postquarry.operators import catalog as C
from postquarry.operators import filters as FL
from postquarry.operators import pick as PK
from postquarry.operators import relevance as R
from postquarry.operators import shape as SH
from postquarry.operators import stats as ST
from postquarry.session import materialize, small_table
from postquarry.sinks import tables as K
from postquarry.sources.archive import read_archive
from postquarry.sources.files import list_partition_values, read_repacked_lines, read_repacked_tree

#: Why the filter stage rejected a row; null for the rows that go on.
REJECT = "reject_reason"


@dataclass
class Stage:
    """``apply`` turns the incoming table into what the next stage sees.

    ``requires`` are columns the incoming table must have. A sink writes and hands its
    input on, so every sink of a run is carried out. Rejected rows, with their reason, reach only
    stages that ask for them (``sees_rejected``).
    """

    name: str
    apply: Callable[[DataFrame], DataFrame]
    requires: list[str] = field(default_factory=list)
    sees_rejected: bool = False
    is_sink: bool = False


def sink(
    name: str, write: Callable[[DataFrame], None], requires: list[str] | None = None, sees_rejected: bool = False,
    status: str | None = None, month: tuple[int, int] | None = None,
) -> Stage:
    """``status`` is the folder in which what was written is marked afterwards: ``month``, else the months of the posts' dumps.

    Dumps are collected in the pass that writes; a run that fails marks nothing.
    """

    def apply(df: DataFrame) -> DataFrame:
        if status is None:
            write(df)
            return df
        spark = df.sparkSession
        if month is not None:
            write(df)
            K.write_status(small_table(spark, [month], ["year", "month"]), status, name)
            return df
        seen = Observation()
        write(df.observe(seen, F.collect_set("dump").alias("dumps")))
        try:
            dumps = seen.get["dumps"]
        except Py4JJavaError:
            # Where nothing was left to write, the counter is dropped from the plan with the empty table.
            dumps = []
        if dumps:
            K.write_status(C.months_found(small_table(spark, [(d,) for d in sorted(dumps)], ["path"])), status, name)
        return df

    return Stage(name, apply, [*(requires or []), *(["dump"] if status and month is None else [])], sees_rejected, is_sink=True)


def accepted(df: DataFrame) -> DataFrame:
    return FL.accepted(df, REJECT) if REJECT in df.columns else df


def _filter(langs: list[str], filter_sensitive: bool = False, filter_no_location: bool = False) -> Stage:
    def apply(df: DataFrame) -> DataFrame:
        rules = FL.post_rules(langs, filter_sensitive, filter_no_location)
        earlier = F.col(REJECT) if REJECT in df.columns else F.lit(None).cast("string")
        return FL.with_reject_reason(df, rules, "_found").withColumn(REJECT, F.coalesce(earlier, "_found")).drop("_found")

    return Stage("filter", apply, ["lang", *P.ORIGIN_MARKERS], sees_rejected=True)


def _stats(path: str, collect_hashtags: bool = False, status: str | None = None) -> Stage:
    def write(df: DataFrame) -> None:
        # The sum over all dumps is left to the reader: a run holds some of them.
        levels = ST.hierarchy_counts(df, ["dump", "archive", "member"], reject_col=REJECT if REJECT in df.columns else None)
        K.write_stats(levels.where("level_mask < 8"), f"{path}/levels", ("dump",))
        if collect_hashtags:
            tags = accepted(df).withColumn("tags", P.hashtags(F.col("entities")))
            K.write_tag_counts(ST.frequency(tags, ["dump", "lang"], "tags"), f"{path}/hashtags", by=("dump",))

    return sink("stats", write, ["dump", "archive", "member", "lang"], sees_rejected=True, status=status)


def _index(path: str, tz: str = "UTC", status: str | None = None) -> Stage:
    def write(df: DataFrame) -> None:
        located = df.select(
            TM.event_time(F.col("timestamp_ms"), tz).alias("ts"), "lang",
            P.post_url(F.col("user.screen_name"), F.col("id")).alias("url"), F.struct(*PK.LOCATION).alias("location_index"),
        )
        K.write_post_index(PK.index_rows(located, "ts", "lang", "url", ["location_index"]), path)

    return sink("index", write, ["timestamp_ms", "user", "id", *PK.LOCATION], status=status)


def _full_posts(path: str, tz: str = "UTC") -> Stage:
    """The source text of every post beside its address, time and place."""
    return sink(
        "full-posts", lambda df: K.write_full_posts(PK.full_posts(df, tz=tz), path),
        ["value", "timestamp_ms", "timestamp", "user", "id", "text", *PK.LOCATION],
    )


def _annotation(path: str, year: int, month: int, skip_minutes: int = 0, tz: str = "UTC", status: str | None = None) -> Stage:
    def write(df: DataFrame) -> None:
        timed = FL.in_month(df.withColumn("_ts", TM.event_time(F.col("timestamp_ms"), tz)), "_ts", year, month)
        slotted = PK.with_slot(timed, "_ts")
        picked = PK.first_k(slotted, ["lang", "slot_date", "slot_hour"], ["_ts", *PK.LOCATION], 1, skip_minutes, "_ts")
        K.write_candidates(PK.candidates(picked, tz), path)

    return sink("annotation", write, ["timestamp_ms", "lang", *PK.LOCATION], status=status, month=(year, month))


def _repack(path: str, time_group_resolution: int = 15, gzip_files: bool = True, skip_existing_days: bool = True, tz: str = "UTC") -> Stage:
    """Lines with their place in the source, as ``read_posts("repack")`` reads them; days of archives are kept apart."""

    def write(df: DataFrame) -> None:
        K.repack(
            df.select(*PK.LOCATION, "lang", "value", TM.event_time(F.col("timestamp_ms"), tz).alias("_ts")), path, "_ts", ["_ts", *PK.LOCATION],
            time_group_resolution, "gzip" if gzip_files else "none", "skip" if skip_existing_days else "overwrite",
            origin_col="archive",
        )

    return sink("repack", write, ["timestamp_ms", "lang", "value", *PK.LOCATION])


def _auto_relevance(path: str, words: list[str], min_relevant_words: int = 2, tz: str = "UTC", run: str | None = None) -> Stage:
    """``run`` names what is replaced when the run is repeated; without it rows are appended."""

    def write(df: DataFrame) -> None:
        posts = df.withColumn("_text", P.full_text(F.col("truncated"), F.col("text"), F.col("extended_tweet.full_text")))
        hits = R.match_words(posts, [*PK.LOCATION, "lang", "id_str", "timestamp_ms", "_text"], "_text", words, min_relevant_words)
        rows = hits.select(
            F.array(*[F.col(c).cast("string") for c in PK.LOCATION]).alias("location"),
            "lang", TM.event_time(F.col("timestamp_ms"), tz).alias("ts"), F.col("id_str"), F.col("_text").alias("text"), "words",
        )
        K.write_relevant(rows, path, "ts", run=run)

    return sink("auto_relevance", write, ["text", "lang", *PK.LOCATION])


def _bot_filter(embed: Callable[[DataFrame], DataFrame], refs: DataFrame, key_col: str = "id_str", vec_col: str = "vec") -> Stage:
    """``embed`` adds the vector column (a model in a pandas UDF, or a join with stored vectors)."""

    def apply(df: DataFrame) -> DataFrame:
        with_vectors = embed(df)
        neighbours = R.nearest(with_vectors, key_col, vec_col, refs)
        return R.drop_bots(df, neighbours, key_col)

    return Stage("bot-filter1", apply, [key_col])


def _schema(path: str, json_col: str = "value") -> Stage:
    return sink("schema", lambda df: K.write_json(SH.key_presence(df, json_col), path), [json_col])


def _pin() -> Stage:
    """Write the posts so far to the shared folder, so that later sinks do not unpack the source again."""
    return Stage("pin", lambda df: materialize(df, "posts"), sees_rejected=True)


def _media_filter() -> Stage:
    return Stage("media-filter", FL.with_media, ["entities", "extended_entities"])


# The names of the stages (all but "pin").
REGISTRY: dict[str, Callable[..., Stage]] = {
    "filter": _filter,
    "stats": _stats,
    "index": _index,
    "full-posts": _full_posts,
    "schema": _schema,
    "annotation": _annotation,
    "media-filter": _media_filter,
    "repack": _repack,
    "auto_relevance": _auto_relevance,
    "bot-filter1": _bot_filter,
    "pin": _pin,
}


def build_stages(selection: list[tuple[str, dict[str, Any]]], registry: dict[str, Callable[..., Stage]] | None = None) -> list[Stage]:
    """Stages in the chosen order, each with the parameters of its own name; unknown ones are refused."""
    known = registry or REGISTRY
    unknown = [name for name, _ in selection if name not in known]
    if unknown:
        raise KeyError(f"unknown stages: {unknown}")
    return [known[name](**params) for name, params in selection]


def run_stages(df: DataFrame, stages: list[Stage]) -> DataFrame:
    """Pass the table through the stages and return the accepted rows; a stage whose columns are missing is an error.

    A stage that is no sink and does not see rejected rows ends their way: put ``stats`` before it.
    """
    for stage in stages:
        missing = [c for c in stage.requires if c not in df.columns]
        if missing:
            raise ValueError(f"stage {stage.name!r} needs columns {missing}")
        if stage.sees_rejected:
            df = stage.apply(df)
        elif stage.is_sink:
            stage.apply(accepted(df))
        else:
            df = stage.apply(accepted(df))
    return accepted(df)


def read_posts(spark: SparkSession, source: str, path: str, langs: list[str] | None = None, keep_raw: bool = False, **options: Any) -> DataFrame:
    """Posts with location from ``dump`` (archives), ``repack`` (what the repack stage wrote, or a plain repacked tree) or ``random``.

    ``random`` draws ``n`` posts per language, with replacement and by ``seed``, from a repacked source; ``draw`` numbers them.
    ``langs`` keeps the posts of these languages; ``options`` go to the archive reader, a repacked
    source has ``months``.
    """
    if source == "dump":
        posts = P.parse_posts(read_archive(spark, path, **options), keep_raw=keep_raw)
        return posts.where(F.col("lang").isin(langs)) if langs is not None else posts
    if source in ("repack", "random"):
        months = options.pop("months", None)
        draws = (options.pop("n"), options.pop("seed")) if source == "random" else None
        if options:
            raise TypeError(f"a {source} source has no options {sorted(options)}")
        own = not list_partition_values(spark, path, "origin").isEmpty()
        lines = (read_repacked_lines if own else read_repacked_tree)(spark, path, months=months, langs=langs)
        if draws:
            # Files of a plain tree are named by their bucket.
            bucketed = lines if own else lines.withColumn("bucket", F.regexp_extract("member", r"^\d+", 0))
            lines = B.random_rows(bucketed, *draws, PK.LOCATION).drop("offset")
        return P.parse_posts(lines.withColumnRenamed("lang", "folder_lang"), keep_raw=keep_raw)
    raise ValueError(f"unknown source {source!r}")


def map_rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Any function over batches of rows (pandas in, pandas out)."""
    return df.mapInPandas(fn, schema)
