"""SimHash near-dedup with an inverted index of fingerprint bytes by position and count filtering.

Fingerprints that differ in at most ``bits`` of 64 bits differ in at most as many of their 8 bytes, so they share at least
``8 - bits`` bytes position by position. The index lists fingerprints by the values at a few positions, chosen so that any two
with enough shared bytes meet in a list; there their shared positional bytes are tallied, pairs that reach the minimum are kept,
and the differing bits of those are counted. Every list gives only links that join what it has not joined yet.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postquarry.llm.common import components, store
from postquarry.session import broadcast_if_small, ship_package

SEED = 42
SLICE = 1 << 20
BYTES = 8
#: Fingerprints of a list that are compared in one task; longer lists are cut into parts, of which every two meet.
LIST = 8192
#: Mean length of a list beyond which lists are keyed by one more position.
MEAN = 64

_WHITE = b" \t\n\x0b\x0c\r"


def pieces(data: bytes) -> Iterator[bytes]:
    """Slices of about a megabyte that end at white space."""
    at = 0
    while at < len(data):
        end = at + SLICE
        while end < len(data) and data[end] not in _WHITE:
            found = [k for c in _WHITE if (k := data.find(c, end, end + SLICE)) >= 0]
            end = min(found, default=end + SLICE)
        yield data[at:end]
        at = end


def fingerprint(text: bytes | None, n: int = 4) -> int:
    """Bit by bit the majority of the hashes of all runs of ``n`` words, repeats included; without words 0."""
    sums, total, carry = np.zeros(64, np.int64), 0, []
    for part in pieces((text or b"").lower()):
        words = carry + part.split()
        if len(words) < n:
            carry = words
            continue
        joined = b" ".join(words)
        ends = list(itertools.accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        sums += _bit_sums([xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[n - 1 :])])
        total += len(words) - n + 1
        carry = words[len(words) - n + 1 :]
    if not total and carry:
        sums, total = _bit_sums([xxhash.xxh64_intdigest(b" ".join(carry), SEED)]), 1
    return int(np.packbits(2 * sums > total, bitorder="little").view("<u8")[0])


def _bit_sums(hashes: list[int]) -> np.ndarray:
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, BYTES)
    out = np.zeros(64, np.int64)
    for a in range(0, len(raw), 1 << 14):
        out += np.unpackbits(raw[a : a + (1 << 14)], axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return out


_PRINTS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])


def _prints(n: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), n) for t in batch.column(1).cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], schema=_PRINTS)

    return prints


def position_sets(width: int, shared: int) -> list[tuple[int, ...]]:
    """Sets of ``width`` positions, of which any ``shared`` positions hold at least one whole.

    Without a better construction all sets of the width. For 4 shared positions of 8 Turán's constructions give the
    fewest: two positions of one third; or three of one third, or two of a third and one of the next.
    """
    if width == 1:
        return [(k,) for k in range(BYTES - shared + 1)]
    third = lambda k: k // 3
    if shared == 4 and width == 2:
        return [s for s in itertools.combinations(range(BYTES), 2) if third(s[0]) == third(s[1])]
    if shared == 4 and width == 3:

        def chosen(s: tuple[int, ...]) -> bool:
            inside = [sum(third(k) == t for k in s) for t in range(3)]
            return 3 in inside or any(inside[t] == 2 and inside[(t + 1) % 3] == 1 for t in range(3))

        return [s for s in itertools.combinations(range(BYTES), 3) if chosen(s)]
    return list(itertools.combinations(range(BYTES), width))


_KEYED = pa.schema([("key", pa.int64()), ("print", pa.int64())])


def _index(sets: list[tuple[int, ...]]):
    """One row per fingerprint and list it stands in; a list's key is its positions' number and their bytes."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy()
            raw = prints.view(np.uint8).reshape(-1, BYTES).astype(np.int64)
            for number, positions in enumerate(sets):
                key = np.full(len(prints), number, np.int64)
                for k in positions:
                    key = key << 8 | raw[:, k]
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0)], schema=_KEYED)

    return index


class Links:
    """Joins rows of a buffer; gives for every row joined to a smaller one the row it leads to."""

    def __init__(self, size: int) -> None:
        self.to = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.to[a], self.to[b]
            apart = a != b
            a, b = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(self.to, b, a)
            while (self.to[self.to] != self.to).any():
                self.to = self.to[self.to]


def near(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    """Places of pairs that share enough positional bytes and differ in few enough bits."""
    differ = x ^ y
    tally = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(1, dtype=np.uint8)
    kept = np.flatnonzero(tally >= BYTES - bits)
    return kept[np.bitwise_count(differ[kept]) <= bits]


def list_links(key: np.ndarray, prints: np.ndarray, side: np.ndarray, two_sided: np.ndarray, bits: int) -> np.ndarray:
    """For every row the row of its list that links lead to. Rows are sorted by list, in a two-sided list by side."""
    links, size = Links(len(key)), len(key)
    one = np.flatnonzero(~two_sided)
    # All pairs of a list, by their distance in it; rows leave when their list ends.
    gap = 1
    while len(one := one[one + gap < size]) and len(one := one[key[one + gap] == key[one]]):
        hit = near(prints[one], prints[one + gap], bits)
        links.add(one[hit], one[hit] + gap)
        gap += 1
    if two_sided.any():
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        for a, b in zip(starts, [*starts[1:], size]):
            if two_sided[a]:
                middle = a + int(np.searchsorted(side[a:b], 1))
                for x in range(a, middle):
                    hit = near(np.full(b - middle, prints[x]), prints[middle:b], bits) + middle
                    links.add(np.full(len(hit), x), hit)
    return links.to


_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _meet(bits: int):
    """Rows (meeting, two_sided, side, print) come sorted; whole lists are compared, many short ones at once."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(rows: pa.Table) -> pa.RecordBatch:
            prints = rows.column(3).to_numpy().view(np.uint64)
            lists = np.unique(rows.column(0).to_pylist(), return_inverse=True)[1] if rows.num_rows else np.zeros(0, int)
            to = list_links(lists, prints, rows.column(2).to_numpy(), rows.column(1).to_numpy(), bits)
            moved = np.flatnonzero(to != np.arange(len(to)))
            signed = prints.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[to[moved]])], schema=_LINKS)

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            names = table.column(0).to_numpy()
            # The last list may go on in the next batch.
            last = int(np.flatnonzero(names != names[-1]).max(initial=-1)) + 1 if len(names) else 0
            if last:
                yield solve(table.slice(0, last))
                held = table.slice(last).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    return meet


def simhash_groups(
    df: DataFrame, bits: int = 4, n: int = 4, doc_id: str = "doc_id", text: str = "text", width: int | None = None, longest: int = LIST
) -> DataFrame:
    """One row per row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints are linked at ``bits`` (at most 6) or fewer differing bits; ``component_id`` is the smallest id that links
    reach. Texts without words have the fingerprint zero and are linked like all others. A null id takes no part and has a null
    component. Rows that share an id are judged each by its own text. Repeated rows stay.

    Equal fingerprints are one entry of the index, so copies cost nothing there. ``width``, the number of positions that key a
    list, follows the number of different fingerprints unless given; every choice finds the same links. A list of more than
    ``longest`` fingerprints is cut into parts and every two parts meet in a task: exact, but quadratic in the different
    fingerprints that share those bytes. A list hands on at most one link per fingerprint.
    """
    if not 0 <= bits <= 6:
        raise ValueError("bits is 0 to 6")
    spark = df.sparkSession
    ship_package(spark)
    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = store(texts.mapInArrow(_prints(n), "doc_id long, print long"), "simhash")
    entries = store(prints.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-entries")
    shared, count = BYTES - bits, entries.count()
    if width is None:
        width = next((w for w in range(1, shared) if count <= MEAN * 256**w), shared)
    keyed = entries.select("print").mapInArrow(_index(position_sets(width, shared)), "key long, print long")
    long_lists = store(
        keyed.groupBy("key").count().where(F.col("count") > longest).select("key", F.ceil(F.col("count") / longest).cast("int").alias("parts")),
        "simhash-long-lists",
    )
    if long_lists.isEmpty():
        placed = keyed.select("key", F.lit(0).alias("p"), F.lit(0).alias("q"), F.lit(0).alias("side"), "print")
    else:
        part = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
        placed = (
            keyed.join(broadcast_if_small(long_lists), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            .select("key", "print", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
            .select("key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
                    (F.col("part") > F.col("other")).cast("int").alias("side"), "print")
        )
    links = store(
        placed.select(F.xxhash64("key", "p", "q").alias("meeting"), (F.col("p") != F.col("q")).alias("two_sided"), "side", "print")
        .repartition("meeting").sortWithinPartitions("meeting", "side").mapInArrow(_meet(bits), "u long, v long"),
        "simhash-links",
    )
    linked = components(links)
    reached = entries.join(linked, entries["print"] == linked["id"], "left").select("print", "least", F.coalesce("component", "print").alias("root"))
    least = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    answers = reached.join(least, "root").select("print", "component_id")
    return prints.join(answers, "print", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
