"""Document fingerprints from prefix polynomial hashes.

The prefix array ``P[i] = sum((c + 1) * B**k for k < i) mod p`` answers the hash of any span with one
subtraction and one product. A fingerprint holds the hash of the whole text and the ``SIZE`` smallest
hashes of its spans of ``SPAN`` characters (a shorter text is one span), so equal texts have equal
fingerprints, and the shared part of two fingerprints estimates the Jaccard likeness of their spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postquarry.llm.common import bucket_of, range_bounds, shuffle_width
from postquarry.llm.words import mix
from postquarry.session import ship_package, small_table

#: Two primes below 2**31 and a base for each; together 62 bits.
PRIMES, BASES = (2147483647, 2147483629), (1000003, 8191 * 131)
SPAN, SIZE = 16, 64
_tables: dict[tuple[int, int], np.ndarray] = {}


def _table(base: int, p: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of a base, kept between calls."""
    have = _tables.get((base, p), np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), p)) % np.uint64(p)])
    _tables[base, p] = have if len(have) <= 1 << 22 else have[: 1 << 22]
    return have[:n]


class Prefix:
    """Prefix arrays of one text."""

    def __init__(self, text: str) -> None:
        self.text = text
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.sums = []
        for p, base in zip(PRIMES, BASES):
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(codes * _table(base, p, self.n) % np.uint64(p), out=sums[1:])
            self.sums.append(sums % np.uint64(p))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of spans; equal for equal spans, wherever they stand and in whatever text."""
        parts = []
        for sums, p, base in zip(self.sums, PRIMES, BASES):
            q = np.uint64(p)
            parts.append((sums[ends] + q - sums[starts]) % q * _table(pow(base, -1, p), p, self.n + 1)[starts] % q)
        return (parts[0] << np.uint64(31)) + parts[1]

    def span(self, start: int, end: int) -> int:
        """The same for one span, with plain numbers."""
        out = 0
        for sums, p, base in zip(self.sums, PRIMES, BASES):
            out = (out << 31) + (int(sums[end]) - int(sums[start])) * pow(base, -start, p) % p
        return out

    def windows(self, start: int, end: int) -> np.ndarray:
        """Hashes of all spans of SPAN characters within a range."""
        at = np.arange(start, max(start, end - SPAN + 1))
        return self.spans(at, at + SPAN)


def joined(a: Prefix, k: int, b: Prefix, m: int) -> tuple[int, int, np.ndarray]:
    """Hash, length and span hashes of ``a.text[:k] + b.text[:m]``: only spans across the seam are new."""
    whole = 0
    for x, y, p, base in zip(a.sums, b.sums, PRIMES, BASES):
        whole = (whole << 31) + (int(x[k]) + pow(base, k, p) * int(y[m])) % p
    if k + m < SPAN:
        return whole, k + m, np.array([whole] if k + m else [], np.uint64)
    seam = Prefix(a.text[max(0, k - SPAN + 1) : k] + b.text[: min(m, SPAN - 1)])
    return whole, k + m, np.concatenate([a.windows(0, k), seam.windows(0, seam.n), b.windows(0, m)])


def common_extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """Length of the longest equal spans that begin at ``i`` and ``j``, by binary search over hashes."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The SIZE smallest distinct mixed hashes, ascending, 48 bits each."""
    values = mix(hashes) >> np.uint64(16)
    if len(values) > 8 * SIZE:
        few = np.unique(np.partition(values, 4 * SIZE)[: 4 * SIZE])
        if len(few) >= SIZE:
            return few[:SIZE]
    return np.unique(values)[:SIZE]


def _print(whole: int, n: int, small: np.ndarray) -> str:
    return f"{whole:016x}{n:08x}" + small.astype(">u8").tobytes().hex()


def sketch(a: Prefix) -> tuple[str, np.ndarray]:
    whole = a.span(0, a.n)
    found = a.windows(0, a.n) if a.n >= SPAN else np.array([whole] if a.n else [], np.uint64)
    small = smallest(found)
    return _print(whole, a.n, small), small


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of the SIZE smallest of both that both hold; of two empty texts 1."""
    if not len(x) and not len(y):
        return 1.0
    union = np.union1d(x, y)[:SIZE]
    return float(np.isin(union, np.intersect1d(x, y)).mean())


def read_fingerprint(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint[24:]), ">u8").astype(np.uint64)


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_next", pa.int64()),
])
_OUT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_next long"
)


def _compare(doc: tuple, after: tuple) -> tuple:
    doc_id, a, (mark, small) = doc
    _, b, (_, next_small) = after
    k = a.n // 2
    m = min(k, b.n)
    whole, n, found = joined(a, a.n - k, b, m)
    edited = smallest(found)
    sha = hashlib.sha256((a.text[: a.n - k] + b.text[:m]).encode()).hexdigest()
    return (
        doc_id, a.n, sha, mark, _print(whole, n, edited), likeness(small, edited), likeness(small, next_small),
        common_extension(a, 0, b, 0),
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, own rows before the one that follows the range; one row is held back."""
    held = None
    for batch in batches:
        out = []
        for bucket, ahead, doc_id, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if ahead and (held is None or held[0] != bucket):
                continue
            a = Prefix(text)
            doc = (doc_id, a, sketch(a))
            if held is not None and held[0] == bucket:
                out.append(_compare(held[1], doc))
            held = None if ahead else (bucket, doc)
        for k in range(0, len(out), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[k : k + 1000]), _OUT)], schema=_OUT)


def fingerprint_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and the text whose second half the next document's beginning replaces.

    The next document is the one with the next smaller id (ties by text; a null id comes last); after
    the last comes the first, so a single document follows itself. Null text counts as empty; an empty
    text has an empty sketch, likeness 1 with another empty one and 0 with any other. Repeated rows stay.
    ``common_next`` is the length of the common beginning with the next document.

    Texts are dealt to ranges of ids once; each range also gets the first document of the range that
    follows, so neighbours meet in one task and a task holds two documents at a time.
    """
    spark = df.sparkSession
    ship_package(spark)
    bounds = range_bounds(df, doc_id, shuffle_width(spark))
    rows = df.select(
        bucket_of(F.col(doc_id), bounds).alias("bucket"), F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # One row per range: at most as many as there are partitions.
    heads = sorted(map(tuple, rows.groupBy("bucket").agg(F.max("doc_id")).collect()), reverse=True)
    ahead = [(head, heads[k - 1][0]) for k, (_, head) in enumerate(heads)]
    if ahead:
        table = small_table(spark, ahead, ["_head", "_to"]).select(F.col("_head").cast("long"), F.col("_to").cast("int"))
        placed = rows.join(F.broadcast(table), F.col("doc_id").eqNullSafe(F.col("_head")), "left")
    else:
        placed = rows.withColumn("_to", F.lit(None).cast("int"))
    twice = F.array_compact(F.array(
        F.struct("bucket", F.lit(0).alias("ahead")),
        F.when(F.col("_to").isNotNull(), F.struct(F.col("_to").alias("bucket"), F.lit(1).alias("ahead"))),
    ))
    return (
        placed.select(F.explode(twice).alias("p"), "doc_id", "text")
        .select("p.bucket", "p.ahead", "doc_id", "text")
        .repartitionById(len(bounds) + 1, "bucket")
        .sortWithinPartitions("bucket", "ahead", F.desc_nulls_last("doc_id"), "text")
        .mapInArrow(_walk, _OUT_DDL)
    )
