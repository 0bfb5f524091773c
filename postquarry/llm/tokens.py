"""Token files: Parquet list columns that let a reader fetch token ids or metadata alone.

Each file holds a range of documents in order: order keys, local start, number of tokens and the ids as
a list column. Ids are dictionary-encoded or delta-packed, row groups and pages are kept small, and
the page indexes of Parquet let a reader skip to the rows it wants; a reader of the metadata columns
never touches the ids.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.llm.common import bucket_of, on_exit, range_bounds, shuffle_width
from postquarry.session import scratch_path, ship_package

KEPT_WORDS, JOINED_WORDS, BATCH_BYTES = 800_000, 256, 4 << 20

# A byte-level tokenizer cuts before a space that a letter, a digit or a printable ASCII sign follows.
CUT, NO_CUT = r" ([!-~\p{L}\p{N}])", r" (?:[^!-~\p{L}\p{N}]|$)"


class Encoder:
    """A tokenizer with a memory for words.

    Texts are cut by Arrow before the spaces where a byte-level tokenizer cuts in any case, so a word with its
    space is encoded once and remembered. New words are put together, encoded as one text and told
    apart by the bytes that their ids stand for. Any other tokenizer is given whole texts. The
    memory, a string array with the ids beside it, is emptied when it is full.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        added = [a["content"] for a in said.get("added_tokens") or []]
        kind = said.get("pre_tokenizer") or {}
        self.splits = (
            kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
            and not said.get("normalizer") and not said.get("truncation") and not any(" " in a for a in added)
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token.encode()) if token in added else len(token)
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _ask(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(f.ids, "<u4") for f in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: pa.StringArray) -> None:
        """Add words, none of them known, to the memory."""
        ids = [self.ids]
        for k in range(0, len(words), JOINED_WORDS * 64):
            some = words.slice(k, JOINED_WORDS * 64)
            ends = pa.array([*range(0, len(some), JOINED_WORDS), len(some)], pa.int32())
            ids += self._ask([" " + text for text in pc.binary_join(pa.ListArray.from_arrays(ends, some), " ").to_pylist()])
        new = np.concatenate(ids[1:])
        lengths = pc.add(pc.binary_length(words), 1).to_numpy()
        ends = np.searchsorted(np.cumsum(self.bytes_of[new]), np.cumsum(lengths, dtype=np.int64)) + 1
        self.words = pa.concat_arrays([self.words, words])
        self.ids = np.concatenate([self.ids, new])
        self.sizes = np.concatenate([self.sizes, np.diff(ends, prepend=0)])

    def _places(self, words: pa.StringArray) -> np.ndarray:
        """Places in the memory, where new words are added."""
        found = pc.index_in(words, value_set=self.words)
        missing = found.is_null()
        new = words.filter(missing).unique()
        if len(new) and len(self.words) and len(self.words) + len(new) > KEPT_WORDS:
            self._forget()
            return self._places(words)
        if len(new):
            base = len(self.words)
            self._learn(new)
            late = pc.add(pc.index_in(words.filter(missing), value_set=new), base)
            found = pc.replace_with_mask(found, missing, late.cast(pa.int32()))
        return found.to_numpy()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, sizes = self.encode_array(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []

    def encode_array(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        if not self.splits or not len(texts):
            found = self._ask(texts.to_pylist())
            return np.concatenate([np.zeros(0, "<u4"), *found]), np.array([len(f) for f in found], np.int64)
        if pc.any(pc.match_substring_regex(texts, NO_CUT)).as_py():
            # Mark the cuts with a NUL; texts that hold one are not cut.
            marked = pc.replace_substring_regex(texts, CUT, "\0\\1")
            whole = pc.match_substring(texts, "\0")
            parts = pc.split_pattern(pc.if_else(whole, "", marked), "\0")
            heads = pc.if_else(whole, texts, parts.values.take(parts.offsets[:-1]))
        else:
            parts = pc.split_pattern(texts, " ")
            heads = parts.values.take(parts.offsets[:-1])
        first = parts.offsets.to_numpy()[:-1]
        inside = np.ones(len(parts.values), bool)
        inside[first] = False
        at = np.empty(len(inside), np.int64)
        at[inside] = self._places(parts.values.filter(pa.array(inside)))
        at[first] = len(self.sizes) + np.arange(len(first))
        starting = self._ask(heads.to_pylist())
        ids, sizes = np.concatenate([self.ids, *starting]), np.concatenate([self.sizes, [len(f) for f in starting]])
        each = sizes[at]
        shift = (np.cumsum(sizes) - sizes)[at] - (np.cumsum(each) - each)
        return ids[np.repeat(shift, each) + np.arange(each.sum())], np.add.reduceat(each, first)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _encode_rows(path: str, end_id: int, order: pa.DataType):
    schema = pa.schema([
        ("file", pa.int32()), ("key", order), ("doc_id", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file, start = _encoder(path), None, 0
        for batch in batches:
            texts = batch.column(3)
            k = 0
            while k < batch.num_rows:
                # Some megabytes of text at a time, whatever the batch.
                n, size = 0, 0
                while k + n < batch.num_rows and (n == 0 or size < BATCH_BYTES):
                    size += len(texts[k + n].as_buffer())
                    n += 1
                part = batch.slice(k, n)
                k += n
                found, sizes = encoder.encode_array(part.column(3))
                ids = pa.array(np.insert(found, np.cumsum(sizes), end_id).view("<i4"))
                counts = (sizes + 1).tolist()
                starts = []
                for f, c in zip(part.column(0).to_pylist(), counts):
                    if f != file:
                        file, start = f, 0
                    starts.append(start)
                    start += c
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(offsets, ids),
                ], schema=schema)
        # The worker goes on to other tasks: give back what this one needed for a while.
        pa.default_memory_pool().release_unused()

    return encode


def write_tokens(
    df: DataFrame, tokenizer: str, end_id: int, to: str, order: Column | None = None, bounds: list[int] | None = None,
    doc_id: str = "doc_id", text: str = "text", encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20, page_bytes: int = 1 << 20,
) -> None:
    """Encode every text, append ``end_id`` and write the ids to a new folder in ascending order.

    ``order`` (default: the document id) is a whole number; ties go by id and text, null comes first. Null text
    counts as empty and gives the end id alone. ``encoding`` is "dictionary" or "delta". Texts are dealt
    to ranges of the order once and encoded where they are written; other columns are ignored.
    """
    ship_package(df.sparkSession)
    order = F.col(doc_id) if order is None else order
    rows = df.select(order.cast("long").alias("key"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if bounds is None:
        bounds = range_bounds(rows.select("key"), "key", shuffle_width(df.sparkSession))
    version = {"dictionary": ("PARQUET_1_0", "true"), "delta": ("PARQUET_2_0", "false")}[encoding]
    (
        rows.select(bucket_of(F.col("key"), bounds).alias("file"), "key", "doc_id", "text")
        .repartitionById(len(bounds) + 1, "file").sortWithinPartitions("file", "key", "doc_id", "text")
        .mapInArrow(
            _encode_rows(tokenizer, end_id, pa.int64()),
            "file int, key long, doc_id long, local_start long, n_tokens long, ids array<int>",
        )
        .write.options(**{
            "compression": "zstd", "parquet.block.size": str(row_group_bytes), "parquet.page.size": str(page_bytes),
            "parquet.dictionary.page.size": str(page_bytes), "parquet.writer.version": version[0],
            "parquet.enable.dictionary": version[1], "parquet.page.row.count.limit": "1000",
            "parquet.column.index.truncate.length": "64",
        }).parquet(to)
    )


def read_starts(spark: SparkSession, path: str) -> DataFrame:
    """(file, base): ids in all files before a file, from the metadata columns alone; one row per file."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sums = spark.read.parquet(path).groupBy("file").agg(F.sum("n_tokens").alias("_sum"))
    return sums.select("file", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("base"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        ids, at = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
        sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(sums, pa.int64())],
            names=[*batch.schema.names[:-1], "ids_crc32"],
        )


def digest_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and crc32 of the ids of every document, read back from the files."""
    ship_package(spark)
    stored = spark.read.parquet(path).select("file", "doc_id", "local_start", "n_tokens", "ids")
    summed = stored.mapInArrow(_checksums, "file int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    # One row per file, as many as there are ranges.
    return summed.join(F.broadcast(read_starts(spark, path)), "file").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_folder(spark: SparkSession) -> str:
    """A new folder under the shared one, removed when the session ends."""
    path = scratch_path(spark, "tokens")
    on_exit(spark, path)
    return path
