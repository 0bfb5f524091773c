"""Streaming forms of the arrival-order computations.

All of them work on event time and give what the batch operator gives on every window
the watermark has closed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from postquarry.sinks.tables import repack_rows
from postquarry.sources.files import TIME_FORMATS


def with_instant(df: DataFrame, ts_col: str, delay: str, name: str = "_instant") -> DataFrame:
    """Add the watermarked instant of a zone-free time (read in the session zone)."""
    return df.withColumn(name, F.col(ts_col).cast("timestamp")).withWatermark(name, delay)


def first_per_hour(df: DataFrame, ts_col: str, lang_col: str, order_cols: list[str], cols: list[str], delay: str = "1 hour") -> DataFrame:
    """The earliest row of every closed (language, hour)."""
    stream = with_instant(df, ts_col, delay)
    first = F.min_by(F.struct(*cols), F.struct(ts_col, *order_cols))
    return (
        stream.groupBy(lang_col, F.window("_instant", "1 hour")).agg(first.alias("_first"))
        .select(lang_col, F.col("window.start").cast("timestamp_ntz").alias("hour_start"), "_first.*")
    )


def minute_counts(df: DataFrame, ts_col: str, lang_col: str, delay: str = "1 hour") -> DataFrame:
    """Rows per closed minute and language; higher levels add these up in batch."""
    return (
        with_instant(df, ts_col, delay).groupBy(F.window("_instant", "1 minute"), lang_col).agg(F.count("*").alias("n"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("minute_start"), lang_col, "n")
    )


def drop_repeats(df: DataFrame, key_cols: list[str], ts_col: str, delay: str = "1 hour") -> DataFrame:
    """The first arrival of every key; a key is remembered for ``delay``.

    Repeats inside one Arrow batch are dropped before the shuffle, so a key that fills a
    large part of the stream does not send all its rows to one state partition.
    """

    def drop_local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeated = batch.select(key_cols).to_pandas().duplicated()
            yield batch.filter(pa.array(~repeated.to_numpy()))

    return with_instant(df.mapInArrow(drop_local, df.schema), ts_col, delay).dropDuplicatesWithinWatermark(key_cols).drop("_instant")


def mark_late(df: DataFrame, ts_col: str, cols: list[str], delay: str = "1 hour") -> DataFrame:
    """``cols`` with ``late``: whether a row is older than the stream's watermark, which the query's own checkpoint keeps.

    Windowed operators drop such rows unseen; here the watermark is only asked for, and every row goes on. A row without a
    time is never late. Rows are dealt by their hash, so no bucket or language goes through one task. ``cols`` pass
    through pandas: texts come back as they are, nullable integers only up to 2**53.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = with_instant(df, ts_col, delay).select(
        *cols, "_instant", F.unix_millis("_instant").alias("_ms"), F.pmod(F.hash(*cols), F.lit(width)).alias("_part")
    )

    def mark(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        for frame in frames:
            yield frame[cols].assign(late=frame["_ms"] < watermark)

    out = T.StructType([dealt.schema[c] for c in cols] + [T.StructField("late", T.BooleanType())])
    return dealt.groupBy("_part").applyInPandasWithState(mark, out, "n INT", "append", GroupStateTimeout.NoTimeout)


def repack_stream(
    df: DataFrame,
    root: str,
    late_root: str,
    checkpoint: str,
    ts_col: str,
    minutes: int = 15,
    delay: str = "1 hour",
) -> DataStreamWriter:
    """Append every row to the bucket of its event time; rows too late go to a table of their own, in the same layout.

    A row is late when it is more than ``delay`` older than the newest row of the earlier micro-batches: the
    stream's watermark, which outlives a restart with the checkpoint. Rows travel as the JSON lines that are written.
    Both outputs carry ``batch_id`` as a partition and replace it, so a repeated micro-batch leaves no duplicates.
    Call ``start()`` on the result.
    """
    rows = repack_rows(df, ts_col, minutes)
    line = F.to_json(F.struct(*[c for c in rows.columns if c not in ("day", "lang")]), TIME_FORMATS)
    packed = rows.select(F.col(ts_col).alias("_ts"), "day", "lang", F.concat("bucket", F.date_format(ts_col, "yyyyMMddHHmmssSSSSSS")).alias("_order"), line.alias("value"))
    marked = mark_late(packed, "_ts", ["day", "lang", "_order", "value"], delay)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for late, path in ((False, root), (True, late_root)):
            (
                batch.where(F.col("late") == late).withColumn("batch_id", F.lit(batch_id)).hint("rebalance", "day", "lang")
                .sortWithinPartitions("day", "lang", "_order").select("value", "day", "lang", "batch_id")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .option("compression", "gzip").partitionBy("day", "lang", "batch_id").text(path)
            )
        batch.unpersist()

    return marked.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)


def late_counts(late: DataFrame) -> DataFrame:
    """Late rows per bucket."""
    return late.groupBy("day", "lang", "bucket").agg(F.count("*").alias("n_late"))


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over everything available into a Parquet table and read it back."""
    query = (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .option("path", path).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
