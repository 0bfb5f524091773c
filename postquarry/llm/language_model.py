"""Language-model scoring with a log-frequency Bloom filter.

Counts of all words and of all pairs of neighbouring tokens are quantised to powers of two. An n-gram of level q is put into
a Bloom filter q times, once per level; its count is read back by probing level after level until one
is missing. The filter grows with its entries: Spark builds it in blocks and writes them to the shared folder in pieces of a
few MiB, and every worker fetches the pieces from there, so that nothing of it passes through the driver. A filter of moderate
size is held whole by the workers, of a larger one a worker holds one piece at a time; smoothed probabilities come from
such probes alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postquarry.llm.common import on_exit, store
from postquarry.llm.words import blocks, hash_words, mix
from postquarry.session import scratch_path, ship_package

#: The end of a text as a token, and the mark that tells pairs from words.
END = np.uint64(0xE07D0F7E47)
PAIR = np.uint64(0x9E3779B97F4A7C15)
BLOCK_BITS, PROBES = 1 << 19, 4


@dataclass
class Settings:
    frequent: int = 1 << 17  # words whose exact counts every task holds
    contexts: int | None = None  # so many most frequent words alone make up pairs; None: all words
    part_tokens: int = 1 << 19  # training tokens for each part of the n-grams, which one task counts
    bits_per_entry: int = 10
    piece_bytes: int = 4 << 20  # of a piece of the filter; there are as many pieces as it needs
    held_bytes: int = 128 << 20  # a filter up to that size is held whole by a worker, of others one piece at a time
    weight: float = 0.7  # of the pair's share against the word's


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of each text, an end after each; number of tokens per text."""
    words, counts = hash_words(texts)
    out = np.full(len(words) + len(texts), END, np.uint64)
    ends = np.cumsum(counts + 1) - 1
    kept = np.ones(len(out), bool)
    kept[ends] = False
    out[kept] = words
    return out, counts + 1


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, one more for every doubling."""
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1


def bits_at(grams: np.ndarray, level: int, probe: int) -> np.ndarray:
    """Bit of an n-gram within its block."""
    shift = (level * 64 + probe) * 0xD1342543DE82EF95 % (1 << 64)
    return mix(grams + np.uint64(shift)) & np.uint64(BLOCK_BITS - 1)


def block_of(grams: np.ndarray, n_blocks: int) -> np.ndarray:
    return (mix(grams ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(n_blocks)).astype(np.int64)


class LogFilter:
    def __init__(self, raw: np.ndarray) -> None:
        self.raw = raw
        self.n_blocks = max(1, len(raw) * 8 // BLOCK_BITS)

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """The middle of the last level found, 0 if there is none. Never less than the level put in."""
        return counts_of(self.levels(grams, block_of(grams, self.n_blocks)))

    def levels(self, grams: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The last level found of n-grams whose blocks are given."""
        level = np.zeros(len(grams), np.int64)
        if not len(self.raw):
            return level
        at = block * (BLOCK_BITS // 8)
        live, q = np.arange(len(grams)), 1
        while len(live) and q < 64:
            found = np.ones(len(live), bool)
            for probe in range(PROBES):
                bit = bits_at(grams[live], q, probe)
                found &= (self.raw[at[live] + (bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            live = live[found]
            level[live] = q
            q += 1
        return level


def counts_of(level: np.ndarray) -> np.ndarray:
    return np.where(level > 0, 1.5 * 2.0 ** (level - 1) - 0.5 * (level == 1), 0.0)


@dataclass
class Pieces:
    """Where a written filter lies: one folder per piece of ``step`` blocks. Workers read it, the driver only names it."""

    path: str
    n_blocks: int
    step: int
    held_bytes: int

    def read(self, first: int, last: int) -> np.ndarray:
        """The bytes of the blocks from ``first`` up to ``last``, whole pieces."""
        size = BLOCK_BITS // 8
        raw = np.zeros((last - first) * size, np.uint8)
        store, root = pyarrow.fs.FileSystem.from_uri(self.path)
        for piece in range(first // self.step, -(-last // self.step)):
            for file in store.get_file_info(pyarrow.fs.FileSelector(f"{root}/piece={piece}", allow_not_found=True)):
                if file.base_name.endswith(".parquet"):
                    with store.open_input_file(file.path) as source:
                        for batch in pyarrow.parquet.ParquetFile(source).iter_batches(64, columns=["block", "raw"]):
                            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                                raw[(block - first) * size : (block - first + 1) * size] = np.frombuffer(data, np.uint8)
        return raw

    def whole(self) -> np.ndarray | None:
        """All of the filter, if it is to be held; a worker keeps the one it read last."""
        if self.n_blocks * (BLOCK_BITS // 8) > self.held_bytes:
            return None
        if self.path not in _held:
            _held.clear()
            _held[self.path] = self.read(0, self.n_blocks)
        return _held[self.path]

    def counts(self, grams: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Counts of n-grams whose blocks are given."""
        if (raw := self.whole()) is not None:
            return counts_of(LogFilter(raw).levels(grams, block))
        level = np.zeros(len(grams), np.int64)
        order = np.argsort(block, kind="stable")
        edges = np.searchsorted(block[order], np.arange(0, self.n_blocks + self.step, self.step))
        for first, a, b in zip(range(0, self.n_blocks, self.step), edges, edges[1:]):
            if a < b:
                here = order[a:b]
                level[here] = LogFilter(self.read(first, min(first + self.step, self.n_blocks))).levels(grams[here], block[here] - first)
        return counts_of(level)


_held: dict[str, np.ndarray] = {}


def write_pieces(filled: DataFrame, n_blocks: int, settings: Settings) -> Pieces:
    """Write blocks (block, raw) to the shared folder in pieces of ``piece_bytes``, one block at least."""
    spark = filled.sparkSession
    step = max(1, settings.piece_bytes * 8 // BLOCK_BITS)
    path = scratch_path(spark, "filter")
    filled.withColumn("piece", F.expr(f"block div {step}")).repartition("piece").write.partitionBy("piece").option(
        "compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    on_exit(spark, path)
    return Pieces(path, n_blocks, step, settings.held_bytes)


def _fill_block(block: tuple[pa.Scalar, ...], grams: pa.Table) -> pa.Table:
    """The bits of one block; its n-grams are about as many as the block has room for."""
    bits = np.zeros(BLOCK_BITS, bool)
    gram, level = grams.column("gram").to_numpy().view(np.uint64), levels_of(grams.column("n").to_numpy())
    for q in range(1, int(level.max(initial=0)) + 1):
        for probe in range(PROBES):
            bits[bits_at(gram[level >= q], q, probe).astype(np.int64)] = True
    return pa.table({"block": pa.array([block[0].as_py()], pa.int32()), "raw": pa.array([np.packbits(bits, bitorder="little").tobytes()])})


_GRAMS = pa.schema([("gram", pa.int64()), ("n", pa.int64())])


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts within about 30 MB of text at a time."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        if parts := [np.unique(tokens_of(texts[a:b])[0], return_counts=True) for a, b in blocks(texts)]:
            grams, n = summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], schema=_GRAMS)


_PACKED = "part int, grams binary, counts binary"


def packed(grams: np.ndarray, n: np.ndarray, n_parts: int) -> pa.RecordBatch:
    """One row per part with its n-grams and their counts as bytes."""
    part = block_of(grams, n_parts)
    order = np.argsort(part, kind="stable")
    grams, n = grams[order], n[order]
    ids, starts = np.unique(part[order], return_index=True)
    limits = [*starts.tolist(), len(grams)]
    cells = [pa.array([x[a:b].tobytes() for a, b in zip(limits, limits[1:])], pa.binary()) for x in (grams, n)]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), *cells], names=["part", "grams", "counts"])


def _pack_words(n_parts: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield packed(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), n_parts)

    return pack


def _pack_pairs(n_parts: int, contexts: np.ndarray | None):
    """Pairs counted like words, of all tokens or of those given."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, parts = batch.column(0).to_pylist(), []
            for start, end in blocks(texts):
                tokens, _ = tokens_of(texts[start:end])
                known = np.ones(len(tokens), bool) if contexts is None else np.isin(tokens, contexts)
                parts.append(np.unique(pairs_of(tokens, known), return_counts=True))
            if parts:
                yield packed(*summed(parts), n_parts)

    return pack


def _merge_part(part: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    grams, n = (np.frombuffer(b"".join(rows[c].to_pylist()), t) for c, t in (("grams", np.uint64), ("counts", np.int64)))
    grams, n = summed([(grams, n)])
    level = levels_of(n)
    return pa.table({
        "part": pa.array([part[0].as_py()], pa.int32()), "grams": pa.array([grams.tobytes()], pa.binary()),
        "levels": pa.array([level.astype(np.uint8).tobytes()], pa.binary()), "entries": pa.array([int(level.sum())], pa.int64()),
    })


def place_of(grams: np.ndarray, n_parts: int, per_part: int) -> np.ndarray:
    """Block of an n-gram: one of those of its part."""
    return block_of(grams, n_parts) * per_part + (mix(grams ^ np.uint64(0x6A09E667F3BCC909)) % np.uint64(per_part)).astype(np.int64)


def _fill_parts(n_parts: int, per_part: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, grams, levels in zip(*(batch.column(k).to_pylist() for k in range(3))):
                grams, n = np.frombuffer(grams, np.uint64), np.int64(1) << (np.frombuffer(levels, np.uint8).astype(np.int64) - 1)
                at = place_of(grams, n_parts, per_part)
                for block in range(part * per_part, (part + 1) * per_part):
                    own = at == block
                    yield from _fill_block((pa.scalar(block),), pa.table({"gram": grams[own].view(np.int64), "n": n[own]})).to_batches()

    return fill


def pairs_of(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring tokens that are both known; the end of a text is what the next begins after."""
    before = np.concatenate([[END], tokens[:-1]])
    both = known & np.concatenate([[True], known[:-1]])
    return pair_hash(before[both], tokens[both])


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * PAIR + b)


_OUT = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
    ("score", pa.float64()), ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())),
])
_OUT_DDL = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rare array<long>, times array<int>"


def _score(model, pieces: Pieces, n_parts: int, per_part: int, contexts: np.ndarray | None, weight: float):
    words, counts, total, distinct = "words", "counts", "total", "distinct"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        frequent = np.frombuffer(m[words], np.uint64)
        frequent_n = np.frombuffer(m[counts], np.int64)
        below = math.log10(m[total] + m[distinct] + 1)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start, end in blocks(texts, 4 << 20 if pieces.whole() is not None else 16 << 20):
                tokens, n = tokens_of(texts[start:end])
                owner = np.repeat(np.arange(len(n)), n)
                kinds, at = np.unique(tokens, return_inverse=True)
                # Exact counts of the frequent words.
                place = np.minimum(np.searchsorted(frequent, kinds), max(0, len(frequent) - 1))
                exact = frequent[place] == kinds if len(frequent) else np.zeros(len(kinds), bool)
                log_exact = np.where(exact, np.log10((frequent_n[place] if len(frequent) else np.zeros(len(kinds))) + 1.0) - below, 0.0)
                is_exact = exact[at]
                base = np.bincount(owner, log_exact[at], len(n))
                known = np.bincount(owner, is_exact, len(n)).astype(np.int64)
                # The model: probes for words and for pairs; the words before have their counts from the same probes.
                pairs, pair_at = np.unique(pair_hash(np.concatenate([[END], tokens[:-1]]), tokens), return_inverse=True)
                grams = np.concatenate([kinds, pairs])
                found = pieces.counts(grams, place_of(grams, n_parts, per_part))
                p = ((found[: len(kinds)] + 1.0) / (m[total] + m[distinct] + 1))[at]
                before = np.concatenate([[np.searchsorted(kinds, END)], at[:-1]])
                n_before = found[before]
                both = n_before > 0
                if contexts is not None:
                    chosen = np.isin(kinds, contexts)
                    both &= chosen[at] & chosen[before]
                share = np.minimum(1.0, found[len(kinds) :][pair_at[both]] / n_before[both])
                p[both] = weight * share + (1 - weight) * p[both]
                total_score = np.bincount(owner, np.log10(p), len(n))
                # Other words, once per document, for the exact join.
                rare_at = np.flatnonzero(~is_exact)
                code = np.unique(owner[rare_at].astype(np.int64) * len(kinds) + at[rare_at], return_counts=True)
                rare_owner, rare_kind, times = code[0] // len(kinds), code[0] % len(kinds), code[1]
                offsets = np.searchsorted(rare_owner, np.arange(len(n) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(len(n))), batch.column(0).slice(start, end - start), batch.column(1).slice(start, end - start),
                    pa.array(n), pa.array(known), pa.array(base), pa.array(total_score),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(kinds[rare_kind].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(times.astype(np.int32))),
                ], schema=_OUT)
                row += len(n)

    return score


def score_documents(
    df: DataFrame, held_out: Column, settings: Settings | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows where ``held_out`` is false; all rows are scored. ``base_score`` is exact: the
    sum over tokens of log10((c + 1) / (N + V + 1)). ``score`` is the filter's log10 probability: after a word of
    the training rows a mix of the pair's share and the word's smoothed count, else the latter. Null and empty texts are one
    end token. Without training rows N and V are 0. Repeated rows stay.

    Counts are pre-aggregated in the tasks; n-grams are summed in parts, as many as the training tokens ask for. The exact counts of the most frequent words go to every task (a
    fixed number), so no frequent word is shuffled; other words are joined with the table of all counts.
    Words are 64-bit hashes: two of the distinct words of a corpus share one only by chance. ``spark.checkpoint.dir`` is to
    be of a kind that pyarrow opens (file, hdfs, s3, gs). A filter beyond ``held_bytes`` is read piece by piece for every
    16 MB of a task's text: exact, but the reads grow with the distinct n-grams.
    """
    settings = settings or Settings()
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    training = rows.where("not held_out").select("text")
    words = store(
        training.mapInArrow(_count_words, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "word-counts"
    )
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"]
    top = words.orderBy(F.desc("n"), "gram").limit(settings.frequent).toPandas()
    order = np.argsort(top["gram"].to_numpy(np.int64).view(np.uint64))
    contexts = None if settings.contexts is None else top["gram"].to_numpy(np.int64)[: settings.contexts].view(np.uint64)
    n_parts = max(1, -(-total // settings.part_tokens))
    grams = store(
        training.mapInArrow(_pack_pairs(n_parts, contexts), _PACKED).union(words.mapInArrow(_pack_words(n_parts), _PACKED))
        .groupBy("part").applyInArrow(_merge_part, "part int, grams binary, levels binary, entries long"), "n-grams",
    )
    # As many blocks as the entries ask for.
    entries = grams.agg(F.sum("entries").alias("e")).first()["e"] or 0
    per_part = max(1, -(-entries * settings.bits_per_entry // (BLOCK_BITS * n_parts)))
    n_blocks = n_parts * per_part
    filled = grams.select("part", "grams", "levels").mapInArrow(_fill_parts(n_parts, per_part), "block int, raw binary")
    pieces = write_pieces(filled, n_blocks, settings)
    model = spark.sparkContext.broadcast({
        "words": top["gram"].to_numpy(np.int64)[order].tobytes(), "counts": top["n"].to_numpy(np.int64)[order].tobytes(),
        "total": total, "distinct": distinct,
    })
    scored = store(rows.mapInArrow(_score(model, pieces, n_parts, per_part, contexts, settings.weight), _OUT_DDL), "scored")
    rest = scored.select("row", F.inline(F.arrays_zip("rare", "times"))).join(words, F.col("rare") == F.col("gram"), "left")
    count = F.coalesce("n", F.lit(0))
    tail = rest.groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(count + 1) - F.log10(F.lit(total + distinct + 1)))).alias("tail"),
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more"),
    )
    return scored.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "score").join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("tail", F.lit(0.0))).alias("base_score"), "score",
    )
