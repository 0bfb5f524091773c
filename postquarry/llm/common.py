"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other letters as they are; ``lower`` alone does it for plain ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def fold(doc_id: str, n: int) -> Column:
    """crc32 of an id written as text, mod ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def store(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts lineage and survives lost executors. The folder is removed when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def on_exit(spark: SparkSession, path: str) -> None:
    """Let Hadoop delete a folder when the driver ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that a table doesn't have."""
    while name in df.columns:
        name = "_" + name
    return name


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Upper bounds that cut an integer column into ``buckets`` ranges of about equal rows.

    Only the bounds reach the driver. Unlike a sampled range partitioning they are plain
    numbers, so a recomputed task deals every row as before.
    """
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 20 * buckets)).alias("b")).first()["b"]
    return sorted(set(found or []))


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """0-based range of a value among ``bounds``; null goes first. Two steps over about sqrt(n) bounds each."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    below = lambda b: b < key
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.size(F.filter(F.array(*[F.lit(b) for b in bounds[step - 1 :: step]]), below)) * step
    fine = F.size(F.filter(F.slice(every, coarse + 1, F.lit(step)), below))
    return F.coalesce(F.when(key.isNotNull(), coarse + fine), F.lit(0)).cast("int")


def running_total(df: DataFrame, group: str, order: list[str], size: str, name: str) -> DataFrame:
    """Add the sum of ``size`` over the rows before a row of its group, in the order given.

    ``order`` starts with an integer column, whose ranges split even a group that holds most rows;
    ``group`` has no nulls. Only totals by group and range cross from one range to the next.
    """
    bounds = range_bounds(df, order[0], shuffle_width(df.sparkSession))
    placed = df.withColumn("_range", bucket_of(F.col(order[0]), bounds))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy(group, "_range").agg(F.sum(size).alias("_sum")).select(
        group, "_range", F.coalesce(F.sum("_sum").over(before(group).orderBy("_range")), F.lit(0)).alias("_base")
    )
    inside = F.coalesce(F.sum(size).over(before(group, "_range").orderBy(*order)), F.lit(0))
    return (
        placed.withColumn("_inside", inside).join(bases, [group, "_range"])
        .withColumn(name, F.col("_base") + F.col("_inside")).drop("_range", "_base", "_inside")
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of an undirected graph (u, v); component is its smallest id.

    Alternates large-star and small-star steps, each a grouping and an equi-join, until the edges
    stay the same. Every round is written to the shared folder, so plans stay short. Hubs are
    grouped with map-side minima and joined where Spark may split skewed keys.
    """
    star = store(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges",
    )
    mark = None
    while True:
        both = star.union(star.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")
        ).select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct()
        seen = Observation()
        star = store(small.observe(
            seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ), "edges")
        if mark == (mark := (seen.get["n"], seen.get["h"])):
            break
    return star.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        star.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
