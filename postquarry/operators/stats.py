"""Counts by hierarchy level, frequencies and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postquarry.session import small_table

# The edges of the frequency histogram.
FREQUENCY_EDGES = [0, 5, 50, 500, 2000, 5000, 8000, 10000, 15000]


def hierarchy_counts(
    df: DataFrame,
    level_cols: list[str],
    lang_col: str = "lang",
    reject_col: str | None = None,
) -> DataFrame:
    """Counts per (levels, language) and per level, from the finest level up to the whole.

    Levels are ordered from the outermost in. ``level_mask`` is the grouping id over
    (levels..., language): a set bit means the column is summed over. ``total`` counts
    every row and ``accepted`` the rows without a reject reason.

    The rows are counted once at the finest level; the grouping sets then add up those
    counts, so only the small counted table is multiplied.
    """
    keys = [*level_cols, lang_col]
    accepted = F.count_if(F.col(reject_col).isNull()) if reject_col else F.count("*")
    finest = df.groupBy(*keys).agg(F.count("*").alias("total"), accepted.alias("accepted"))
    sets = []
    for depth in range(len(level_cols), -1, -1):
        prefix = [F.col(c) for c in level_cols[:depth]]
        sets += [[*prefix, F.col(lang_col)], prefix]
    return finest.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id().cast("int").alias("level_mask"),
        F.sum("total").alias("total"),
        F.sum("accepted").alias("accepted"),
    )


def frequency(df: DataFrame, by_cols: list[str], explode_col: str | None = None, tag: str = "tag") -> DataFrame:
    """Row counts by columns; with ``explode_col`` every list element counts, repeats too."""
    if explode_col:
        df = df.select(*by_cols, F.explode(explode_col).alias(tag))
        by_cols = [*by_cols, tag]
    return df.groupBy(*by_cols).agg(F.count("*").alias("n"))


def bin_label(low: Column, high: Column) -> Column:
    """``low-high``."""
    return F.concat_ws("-", low.cast("string"), high.cast("string"))


def _bin_of(value: Column, edges: list[float]) -> Column:
    """0-based bin: half-open, the last one closed; null outside."""
    chain = F.when(value < edges[0], F.lit(None).cast("int")).when(value > edges[-1], F.lit(None).cast("int"))
    for index, upper in enumerate(edges[1:-1]):
        chain = chain.when(value < upper, F.lit(index))
    return chain.when(value <= edges[-1], F.lit(len(edges) - 2))


def histogram(df: DataFrame, value_col: str, edges: list[float] = FREQUENCY_EDGES) -> DataFrame:
    """Counts per bin of fixed edges; bins without rows stay with 0, values outside drop out."""
    counted = (
        df.select(_bin_of(F.col(value_col), edges).alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("bin").agg(F.count("*").alias("n"))
    )
    ranges = [(i, edges[i], edges[i + 1]) for i in range(len(edges) - 1)]
    bins = small_table(df.sparkSession, ranges, ["bin", "low", "high"])
    return zero_filled(bins.select("bin", bin_label(F.col("low"), F.col("high")).alias("label")), counted, ["bin"])


def histogram_equal(df: DataFrame, value_col: str, n_bins: int = 10) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value.

    When all values are equal the range is widened by one half to each side.
    """
    values = df.select(F.col(value_col).cast("double").alias("v")).where("v IS NOT NULL")
    span = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    flat = span["lo"] == span["hi"]
    low = F.when(flat, span["lo"] - 0.5).otherwise(span["lo"])
    high = F.when(flat, span["hi"] + 0.5).otherwise(span["hi"])
    binned = values.select(
        F.least(F.width_bucket("v", low, high, F.lit(n_bins)), F.lit(n_bins)).cast("int").alias("bin")
    )
    counted = binned.groupBy("bin").agg(F.count("*").alias("n"))
    bins = df.sparkSession.range(1, n_bins + 1, 1, 1).select(
        F.col("id").cast("int").alias("bin"),
        (low + (high - low) * (F.col("id") - 1) / n_bins).alias("low"),
        (low + (high - low) * F.col("id") / n_bins).alias("high"),
    )
    return zero_filled(bins, counted, ["bin"])


def zero_filled(domain: DataFrame, counts: DataFrame, on: list[str], n: str = "n") -> DataFrame:
    """Every row of the domain with its count, 0 where none was counted."""
    return domain.join(counts, on, "left").withColumn(n, F.coalesce(F.col(n), F.lit(0).cast("bigint")))
