"""Data sources for compressed JSON lines: tar archives and plain trees of bucket files.

``read_archive`` (``spark.read.format("tar_jsonl")``) gives one row per line with its location:
``dump, archive, member, line_no, value`` and, with ``badMember=report``, ``member_error``.

``read_tree`` (``tree_jsonl``) gives the same for a plain repacked tree, with ``lang``.

The driver lists files and their sizes, nothing more. An archive is cut into slices of
about ``sliceBytes``; the task of a slice walks the tar headers (seeking from one to the
next) and unpacks every n-th member, so one large archive keeps many tasks busy and no
archive is ever held in memory. A member is unpacked completely before its first line
is passed on, as a damaged member must give no lines; what exceeds ``SPOOL_BYTES`` goes
to the task's local disk.

Options
    sliceBytes            bytes of archive per task (default 256 MiB)
    dump, archive, member only this dump / archive / member (also pushed from filters;
                          several members separated by ``|``)
    badMember             fail (default), report or skip

What is damaged hides nothing else: behind a broken header the walk goes on at the next block that is
a header, and the members before a cut stay. ``fail`` and ``report`` show every such place.
"""

from __future__ import annotations

import bz2
import gzip
import re
import shutil
import tarfile
import tempfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from postquarry.session import materialize, ship_package

# What a dump folder, an archive and a member are called.
DUMP_NAME = re.compile(r"(\d{4}-\d{2})$")
ARCHIVE_NAME = re.compile(r"(\d{8})\.tar$")
TREE_FILE = re.compile(r"/(\d{4}-\d{2})/(\d{8})/([^/]+)/(\d{12}\.jsonl\.gz)$")
MEMBER_ENDINGS = (".json.gz", ".json.bz2")

SPOOL_BYTES = 8 << 20
OPEN_COST = 1 << 20
BATCH_ROWS = 4096
BATCH_BYTES = 8 << 20
UNPACK_ERRORS = (OSError, EOFError, ValueError, tarfile.TarError, gzip.zlib.error)


class ArchiveSlice(InputPartition):
    """Members ``index, index + count, ...`` (by stem) of one archive."""

    def __init__(self, path: str, dump: str, archive: str, index: int, count: int) -> None:
        super().__init__((path, index))
        self.path, self.dump, self.archive, self.index, self.count = path, dump, archive, index, count


class FilePack(InputPartition):
    """Some files of a plain tree: (path, location columns) pairs."""

    def __init__(self, files: list[tuple[str, dict[str, str]]]) -> None:
        super().__init__(files)
        self.files = files


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a local path or a URI as Spark writes them."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def list_tree(root: str) -> Iterator[tuple[str, dict[str, str], int]]:
    """(path, location, size) of every bucket file, in order of month, day, language, bucket."""
    fs, base = open_folder(root)
    infos = fs.get_file_info(pafs.FileSelector(base, recursive=True))
    for info in sorted(infos, key=lambda i: i.path):
        found = TREE_FILE.search(info.path)
        if info.type == pafs.FileType.File and found:
            month, day, lang, member = found.groups()
            yield info.path, {"dump": f"repack-{month}", "archive": day, "lang": lang, "member": member}, info.size


def member_stem(name: str) -> str:
    return name.rsplit("/", 1)[-1].split(".", 1)[0]


def list_archives(root: str) -> Iterator[tuple[str, str, str, int]]:
    """(path, dump, archive, size) of every archive, sorted; ``root`` is a dump or holds dumps."""
    fs, base = open_folder(root)
    infos = fs.get_file_info(pafs.FileSelector(base, recursive=True))
    for info in sorted(infos, key=lambda i: i.path):
        archive = ARCHIVE_NAME.search(info.path)
        dump = DUMP_NAME.search(info.path.rsplit("/", 1)[0])
        if info.type == pafs.FileType.File and archive and dump:
            yield info.path, dump.group(1), archive.group(1), info.size


def unpack(source: BinaryIO, name: str) -> BinaryIO:
    """The whole member, unpacked into memory or, when large, a temporary file."""
    stream = bz2.open(source) if name.endswith(".bz2") else gzip.open(source)
    spool = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)
    try:
        shutil.copyfileobj(stream, spool, 1 << 20)
    except BaseException:
        spool.close()
        raise
    spool.seek(0)
    return spool


def is_blank(raw: BinaryIO, start: int, end: int) -> bool:
    """Whether a file holds nothing but zero bytes from ``start`` to ``end``."""
    raw.seek(start)
    while start < end:
        part = raw.read(min(1 << 20, end - start))
        if not part or part.strip(b"\0"):
            return not part
        start += len(part)
    return True


def walk_members(raw: BinaryIO, size: int) -> tuple[tarfile.TarFile | None, list[tarfile.TarInfo], list[tuple[int, str]]]:
    """An open tar file, its members and its faults, as (offset, message), none of which ends the walk.

    What lies between two members must be blank, else a header is broken there; the file must go on behind
    its last member, with the blank blocks that mark the end.
    """
    members: list[tarfile.TarInfo] = []
    faults: list[tuple[int, str]] = []
    try:
        tar = tarfile.open(fileobj=raw, mode="r:", ignore_zeros=True)
    except tarfile.ReadError as error:
        return None, [], [(0, str(error))]
    expected = 0
    while True:
        try:
            member = tar.next()
        except tarfile.ReadError as error:
            faults.append((tar.offset, str(error)))
            if tar.offset >= size:
                return tar, members, faults
            tar.offset += tarfile.BLOCKSIZE
            expected = tar.offset
            continue
        place = raw.tell()
        if not is_blank(raw, expected, member.offset if member else size):
            faults.append((expected, "broken header"))
        raw.seek(place)
        if member is None:
            break
        members.append(member)
        expected = tar.offset
    if members and expected >= size:
        faults.append((size, "no end mark"))
    return tar, members, faults


class LineReader(DataSourceReader):
    """What both layouts share: location filters, unpacking, batches of lines."""

    location: tuple[str, ...] = ()

    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"]
        self.slice_bytes = int(options.get("slicebytes", 256 << 20))
        self.bad_member = options.get("badmember", "fail")
        if self.bad_member not in ("skip", "fail", "report"):
            raise ValueError(f"badMember must be skip, fail or report, not {self.bad_member!r}")
        self.wanted: dict[str, set[str]] = {}
        for column in self.location:
            if options.get(column):
                self._restrict(column, set(options[column].split("|")))

    def _restrict(self, column: str, values: set[str]) -> None:
        self.wanted[column] = self.wanted[column] & values if column in self.wanted else values

    def _is_wanted(self, **found: str) -> bool:
        return all(column not in self.wanted or value in self.wanted[column] for column, value in found.items())

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for item in filters:
            if isinstance(item, EqualTo) and item.attribute[0] in self.location:
                self._restrict(item.attribute[0], {item.value})
            elif isinstance(item, In) and item.attribute[0] in self.location:
                self._restrict(item.attribute[0], set(item.value))
            else:
                yield item

    def _lines(self, source: BinaryIO, found: dict[str, str]) -> Iterator[pa.RecordBatch]:
        """Batches of one unpacked member; nothing, an error or a report if it is damaged."""
        try:
            lines = unpack(source, found["member"])
        except UNPACK_ERRORS as error:
            if self.bad_member == "fail":
                raise
            if self.bad_member == "report":
                yield self._batch(found, [-1], [None], f"{type(error).__name__}: {error}")
            return
        with lines:
            numbers: list[int] = []
            values: list[str] = []
            held = 0
            for number, line in enumerate(lines):
                text = line.decode("utf-8", "replace").rstrip("\r\n")
                if text.strip():
                    numbers.append(number)
                    values.append(text)
                    held += len(line)
                if len(values) == BATCH_ROWS or held > BATCH_BYTES:
                    yield self._batch(found, numbers, values)
                    numbers, values, held = [], [], 0
            if values:
                yield self._batch(found, numbers, values)

    def _batch(self, found: dict[str, str], numbers: list[int], values: list, error: str | None = None) -> pa.RecordBatch:
        rows = len(numbers)
        columns = {name: pa.array([found[name]] * rows, pa.string()) for name in self.location}
        columns["line_no"] = pa.array(numbers, pa.int64())
        columns["value"] = pa.array(values, pa.string())
        if self.bad_member == "report":
            columns["member_error"] = pa.array([error] * rows, pa.string())
        return pa.RecordBatch.from_pydict(columns)


class TarJsonlReader(LineReader):
    location = ("dump", "archive", "member")

    def partitions(self) -> list[ArchiveSlice]:
        slices: list[ArchiveSlice] = []
        for path, dump, archive, size in list_archives(self.root):
            if self._is_wanted(dump=dump, archive=archive):
                count = max(1, -(-size // self.slice_bytes))
                slices += [ArchiveSlice(path, dump, archive, i, count) for i in range(count)]
        return slices

    def read(self, partition: ArchiveSlice | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes when no partition was planned
            return
        found = {"dump": partition.dump, "archive": partition.archive}
        fs, _ = open_folder(self.root)
        with fs.open_input_file(partition.path) as raw:
            tar, members, faults = walk_members(raw, raw.size())
            for offset, message in faults:
                text = f"{partition.path}, byte {offset}: {message}"
                if self.bad_member == "fail":
                    raise tarfile.ReadError(text)
                if self.bad_member == "report" and partition.index == 0:
                    yield self._batch({**found, "member": ""}, [-1], [None], text)
            members = [m for m in members if m.isfile() and m.name.endswith(MEMBER_ENDINGS)]
            members.sort(key=lambda m: (member_stem(m.name), m.name))
            for member in members[partition.index::partition.count]:
                if self._is_wanted(member=member.name):
                    yield from self._lines(tar.extractfile(member), {**found, "member": member.name})


class TreeReader(LineReader):
    location = ("dump", "archive", "lang", "member")

    def partitions(self) -> list[FilePack]:
        packs: list[FilePack] = []
        pack: list[tuple[str, dict[str, str]]] = []
        held = 0
        for path, found, size in list_tree(self.root):
            if not self._is_wanted(**found):
                continue
            if pack and held + size > self.slice_bytes:
                packs.append(FilePack(pack))
                pack, held = [], 0
            pack.append((path, found))
            held += size + OPEN_COST
        return [*packs, FilePack(pack)] if pack else packs

    def read(self, partition: FilePack | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        fs, _ = open_folder(self.root)
        for path, found in partition.files:
            with fs.open_input_file(path) as raw:
                yield from self._lines(raw, found)


class TarJsonlSource(DataSource):
    reader_class: type[LineReader] = TarJsonlReader

    @classmethod
    def name(cls) -> str:
        return "tar_jsonl"

    def schema(self) -> str:
        names = [*[f"{name} STRING" for name in self.reader_class.location], "line_no BIGINT", "value STRING"]
        if self._lower().get("badmember") == "report":
            names.append("member_error STRING")
        return ", ".join(names)

    def reader(self, schema: StructType) -> LineReader:
        return self.reader_class(self._lower())

    def _lower(self) -> dict[str, str]:
        return {key.lower(): value for key, value in self.options.items()}


class TreeSource(TarJsonlSource):
    reader_class = TreeReader

    @classmethod
    def name(cls) -> str:
        return "tree_jsonl"


def _read(spark: SparkSession, source: type[DataSource], path: str, options: dict[str, str | int]) -> DataFrame:
    ship_package(spark)
    spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(source.name()).options(**options).load(path)


def read_archive(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """Lines of all archives below ``path`` with their location."""
    return _read(spark, TarJsonlSource, path, options)


def read_tree(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """Lines of a plain tree ``YYYY-MM/YYYYMMDD/<lang>/<bucket>.jsonl.gz`` with their location.

    ``dump`` is ``repack-YYYY-MM``, ``archive`` the day and ``member`` the file name.
    """
    return _read(spark, TreeSource, path, options)


def lookup_lines(spark: SparkSession, path: str, requests: DataFrame, max_members: int = 100_000, **options: str | int) -> DataFrame:
    """Lines at requested locations (``dump, archive, member, line_no`` and any other columns).

    Every requested member is unpacked once. When the request names no more than
    ``max_members`` members they prune the scan; a longer request joins with all of it.
    """
    requests = materialize(requests, "requests")
    members = requests.select("dump", "archive", "member").distinct().limit(max_members + 1).collect()
    if len(members) <= max_members:
        for column in ("dump", "archive", "member"):
            options[column] = "|".join(sorted({row[column] for row in members})) or "-"
    lines = read_archive(spark, path, **options)
    return requests.join(lines, ["dump", "archive", "member", "line_no"])
