"""Months found against outputs made, and rows a dimension does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.functions import naming as N


def months_found(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """Distinct months of a folder listing: ``year, month``."""
    month = N.dump_month(F.col(path_col))
    return (
        listing.select(month.alias("_m")).where("_m IS NOT NULL")
        .select(F.substring("_m", 1, 4).cast("int").alias("year"), F.substring("_m", 6, 2).cast("int").alias("month"))
        .distinct()
    )


def month_catalog(months: DataFrame, outputs: dict[str, DataFrame]) -> DataFrame:
    """Every month with one availability flag per output (tables with ``year, month``)."""
    catalog = months.select("year", "month").distinct()
    for name, table in outputs.items():
        made = table.select("year", "month").distinct().withColumn(name, F.lit(True))
        catalog = catalog.join(made, ["year", "month"], "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    return catalog


def new_rows(df: DataFrame, known: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """First row of every key the known table lacks.

    Rows are cut to one per key before anything is joined, so a key that holds a large
    part of all rows travels once per task.
    """
    first = Window.partitionBy(key).orderBy(*order_cols)
    ranked = df.where(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    return ranked.join(known.select(key), key, "left_anti")
