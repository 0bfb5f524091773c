"""A stored index of archive members, and readers that go straight to a member.

``index_members`` walks the headers of every archive once, one task per archive, and gives one row per member with its
place in the file. ``read_members`` deals members to tasks by their bytes and opens each at its place; any condition on
the index prunes the read, so a lookup of one line opens one member and walks no header.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.session import broadcast_if_small, materialize, ship_package
from postquarry.sources.archive import MEMBER_ENDINGS, OPEN_COST, TarJsonlReader, list_archives, member_stem, open_folder, walk_members

PLACE = ["dump", "archive", "member"]
INDEX = "dump string, archive string, path string, stem string, member string, offset long, size long, fault string"
_INDEX = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in (f.split() for f in INDEX.split(", "))])


def index_members(spark: SparkSession, root: str) -> DataFrame:
    """One row per member of all archives below ``root``: its name, and the place and size of its packed bytes.

    A fault of an archive (a broken header, a cut) is a row of its own with an empty member, its offset and a message.
    The driver lists the archives only. Store the result; it holds as long as the archives stay as they are.
    """
    ship_package(spark)
    found = list(list_archives(root))
    archives = spark.createDataFrame([f[:3] for f in found], "path string, dump string, archive string")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(root)
        for batch in batches:
            for row in batch.to_pylist():
                place = row["dump"], row["archive"], row["path"]
                with fs.open_input_file(row["path"]) as raw:
                    _, members, faults = walk_members(raw, raw.size())
                rows = [
                    (*place, member_stem(m.name), m.name, m.offset_data, m.size, None)
                    for m in members if m.isfile() and m.name.endswith(MEMBER_ENDINGS)
                ] + [(*place, "", "", offset, 0, message) for offset, message in faults]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)

    return archives.repartition(max(1, len(found))).mapInArrow(walk, INDEX)


def read_members(
    spark: SparkSession, root: str, index: DataFrame, bad_member: str = "fail", slice_bytes: int = 256 << 20
) -> DataFrame:
    """Lines of the members in ``index`` (rows of ``index_members``, or some of them): dump, archive, member, line_no, value.

    Members are dealt to tasks by packed bytes, in the order of their names within an archive. An optional column ``lines``
    names the line numbers that are wanted; others are not given. ``bad_member`` is fail, report (adds ``member_error``, a
    row per damaged member and per fault) or skip, as for ``read_archive``.
    """
    ship_package(spark)
    reader = TarJsonlReader({"path": root, "badmember": bad_member})
    if "lines" not in index.columns:
        index = index.withColumn("lines", F.lit(None).cast("array<long>"))
    if bad_member == "fail":
        fault = index.where("fault is not null").select("path", "offset", "fault").first()
        if fault:
            raise ValueError(f"{fault['path']}, byte {fault['offset']}: {fault['fault']}")
    elif bad_member == "skip":
        index = index.where("fault is null")
    sums = index.agg(F.sum(F.col("size") + OPEN_COST).alias("bytes"), F.count("*").alias("members")).first()
    slices = max(1, min(sums["members"], -(-(sums["bytes"] or 0) // slice_bytes)))
    order = Window.partitionBy("path").orderBy("stem", "member", "offset").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("size") + OPEN_COST).over(order), F.lit(0))
    dealt = (
        index.withColumn("slice", F.floor(before / slice_bytes)).repartition(slices, "path", "slice")
        .sortWithinPartitions("path", "stem", "member", "offset")
        .select("dump", "archive", "path", "member", "offset", "size", "fault", "lines")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(root)
        path, raw = None, None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    place = {name: row[name] for name in PLACE}
                    if row["fault"] is not None:
                        yield reader._batch(place, [-1], [None], f"byte {row['offset']}: {row['fault']}")
                        continue
                    if row["path"] != path:
                        if raw:
                            raw.close()
                        path, raw = row["path"], fs.open_input_file(row["path"])
                    wanted = None if row["lines"] is None else pa.array([*row["lines"], -1], pa.int64())
                    for lines in reader._lines(raw.get_stream(row["offset"], row["size"]), place):
                        yield lines if wanted is None else lines.filter(pa.compute.is_in(lines.column("line_no"), value_set=wanted))
        finally:
            if raw:
                raw.close()

    error = ", member_error string" if bad_member == "report" else ""
    return dealt.mapInArrow(read, f"dump string, archive string, member string, line_no long, value string{error}")


def lookup_members(spark: SparkSession, root: str, index: DataFrame, requests: DataFrame, **options: str | int) -> DataFrame:
    """Lines at requested locations (``dump, archive, member, line_no`` and any other columns), opened by the index.

    Every requested member is unpacked once and gives the requested lines alone; there is no limit on requests, and member
    names may hold any sign. The line numbers of one member are gathered in one row.
    """
    requests = materialize(requests, "requests")
    lines = requests.groupBy(*PLACE).agg(F.collect_set(F.col("line_no").cast("long")).alias("lines"))
    wanted = index.where("fault is null").join(broadcast_if_small(lines), PLACE)
    found = read_members(spark, root, wanted, **options)
    return requests.join(found, [*PLACE, "line_no"])
