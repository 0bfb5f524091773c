"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "postquarry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, Arrow).

    On a cluster leave ``master`` unset and pass sizing through spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed wherever a task runs a function of the package and the package is not
    installed on the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="postquarry-")) / "postquarry.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a temporary folder, kept
    in the session settings so that one session keeps using one folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    own = spark.conf.get("spark.postquarry.shared", None)
    if own:
        return own
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="postquarry-")
    spark.conf.set("spark.postquarry.shared", own)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage and fixes values that a recomputed task could change (row numbers
    taken from partition positions). The files outlive a lost executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Largest measured table that is sent whole to every executor.
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast when its measured text size is within the bound, else as it is.

    Meant for word lists and dimensions, whose size Spark cannot tell before it runs.
    """
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


# Rows of one task where rows meet by a key.
TASK_ROWS = 250_000


def dealt(df: DataFrame, rows: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as the number of ``rows`` asks for, and no fewer than the session's.

    A grouping, window or join on these or more columns then stays in place, and what a task holds
    does not grow with the table. ``rows`` is counted: give what is cheap to count.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(width, -(-rows.count() // TASK_ROWS)), *keys)


def small_table(spark: SparkSession, rows: list[tuple[Any, ...]], names: list[str]) -> DataFrame:
    """A few literal rows as a table, without starting a Python worker."""
    cells = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*cells)))
