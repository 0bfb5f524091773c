"""Dense row numbers over data of any size and skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.session import materialize

_LOW_BITS = (1 << 33) - 1


def number_rows(
    df: DataFrame,
    order_cols: list[str],
    group_cols: list[str] | None = None,
    name: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """Add the 0-based position of a row in the order of ``order_cols``, per group.

    ``order_cols`` must be unique within a group. Rows are range-partitioned and sorted,
    so a group of any size is spread over as many partitions as it fills; a window would
    hand it to one task. The rows are written once with their place in the partition,
    which pins what the range sampling decided; the start of every (partition, group)
    is a running sum over one row per pair.
    """
    group_cols = group_cols or []
    keys = [*group_cols, *order_cols]
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_place", 33).cast("int")
    runs = placed.groupBy(*group_cols, part.alias("_part")).agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    before = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        *[F.col(c).alias(f"_g_{c}") for c in group_cols],
        F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first").bitwiseAND(F.lit(_LOW_BITS))).alias("_shift"),
    )
    # Written, so that the planner knows how small they are and broadcasts them.
    offsets = materialize(shifts, "offsets")
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group_cols]
    condition = reduce(lambda a, b: a & b, same, part == F.col("_p"))
    return (
        placed.join(offsets, condition)
        .withColumn(name, F.col("_place").bitwiseAND(F.lit(_LOW_BITS)) + F.col("_shift"))
        .select(*df.columns, name)
    )
