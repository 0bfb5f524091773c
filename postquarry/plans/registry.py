"""Registry of named queries over the driver tables, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    run: Runner
    operators: str
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(operators: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under the name of its function."""

    def add(run: Runner) -> Runner:
        if run.__name__ in QUERIES:
            raise ValueError(f"query {run.__name__} is registered twice")
        QUERIES[run.__name__] = Query(run, operators, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
