"""Inputs that Spark derives from the tables: an archive of tar files."""

from __future__ import annotations

import bz2
import gzip
import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from postquarry.session import ship_package
from postquarry.sources.archive import open_folder


#: Lines that are joined and packed at a time.
PACKED_LINES = 256


def pack_lines(lines: pd.Series, bzip2: bool) -> bytes:
    """The lines as one compressed member, some of them at a time."""
    packed = io.BytesIO()
    with bz2.open(packed, "wb") if bzip2 else gzip.open(packed, "wb") as member:
        for start in range(0, max(1, len(lines)), PACKED_LINES):
            member.write(("\n".join(lines.iloc[start : start + PACKED_LINES]) + "\n").encode())
    return packed.getvalue()


def write_archive(df: DataFrame, root: str, month: str, value_col: str = "value", damaged: bool = False) -> int:
    """Write the JSON lines of ``df`` as tar files below ``<root>/dump-<month>``; returns the lines written.

    Every task writes one tar and every batch of rows one member, gzip and bzip2 in
    turn, so nothing is gathered. A tar appears under its name only when it is complete. With ``damaged`` a copy of each
    member that breaks off in the middle stands behind it, with a bar in its name.
    """
    ship_package(df.sparkSession)
    folder = f"{root}/dump-{month}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        final = f"{base}/part-{context.partitionId():08d}.tar"
        partial = f"{base}/_{context.partitionId()}-{context.taskAttemptId()}.tmp"
        written = 0
        with fs.open_output_stream(partial) as out, tarfile.open(fileobj=out, mode="w|") as tar:
            for number, batch in enumerate(batches):
                packed = pack_lines(batch[value_col], number % 2 == 1)
                info = tarfile.TarInfo(f"lines/{number:08d}.json.{'bz2' if number % 2 else 'gz'}")
                info.size = len(packed)
                tar.addfile(info, io.BytesIO(packed))
                if damaged:
                    cut = tarfile.TarInfo(f"lines/{number:08d}|cut.json.{'bz2' if number % 2 else 'gz'}")
                    cut.size = len(packed) // 2
                    tar.addfile(cut, io.BytesIO(packed[: cut.size]))
                written += len(batch)
        fs.move(partial, final)
        yield pd.DataFrame({"n": [written]})

    return df.select(value_col).mapInPandas(write, "n BIGINT").groupBy().sum("n").first()[0]
