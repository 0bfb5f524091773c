"""Queries of this subpackage and their SQL twins, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Runner] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under the name of its function."""

    def add(run: Runner) -> Runner:
        QUERIES[run.__name__] = run
        if sql:
            ORACLE_SQL[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
