"""Ranked lexical search: accumulator-limited term-at-a-time evaluation.

Documents are turned into postings of the items' terms once. Every task then ranks its documents in blocks: the terms
of an item are taken from the rarest to the most common, each adding its exact share to the accumulators of the documents
that hold it. Once all remaining terms together cannot lift a new document to the k-th best partial score, no accumulator
is created any more, and the rest of the lists only updates the survivors. The best of all tasks are ranked at the end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.llm.common import free_name, shuffle_width, store
from postquarry.session import ship_package

#: Item text whose terms are looked for in one pass over the documents, in bytes.
PASS_BYTES = 16 << 20
#: Documents and postings that a task ranks at a time.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 15, 1 << 22
SLICE = 1 << 20

#: Bytes of terms as they are, A-Z lower-cased; all others are a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, about a megabyte of it at a time."""
    at, size = 0, len(text or b"")
    while at < size:
        part = text[at : at + SLICE].translate(_FOLD)
        at += SLICE
        while at < size and part[-1] != 0x20:  # up to the end of the last term
            more = text[at : at + SLICE].translate(_FOLD)
            cut = more.find(b" ")
            part += more if cut < 0 else more[: cut + 1]
            at += len(more) if cut < 0 else cut + 1
        yield part.split()


@dataclass
class Queries:
    """Items by number: their terms as numbers, rarest first once the weights are known."""

    terms: dict[bytes, int]
    items: list[np.ndarray]


_POSTINGS = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64())),
])


def _post(wanted: Broadcast):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = wanted.value
        for batch in batches:
            n, ends, terms, tf = [], [0], [], []
            for text in batch.column(1).cast(pa.binary()):
                found, size = {}, 0
                for part in terms_of(text.as_py()):
                    size += len(part)
                    for word, times in Counter(part).items():
                        if (k := known.get(word)) is not None:
                            found[k] = found.get(k, 0) + times
                n.append(size)
                terms += found.keys()
                tf += found.values()
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64())),
            ], schema=_POSTINGS)

    return post


class Block:
    """Inverted lists over some documents, with the exact share of every posting."""

    def __init__(self, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, tf: np.ndarray, weight: np.ndarray, docs: int, length: int) -> None:
        self.size = len(n)
        m = 50 + 50 * n * docs // max(1, length)
        doc = np.repeat(np.arange(self.size), np.diff(ends))
        share = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        order = np.argsort(terms, kind="stable")
        self.doc, self.share = doc[order], share[order]
        self.bounds = np.searchsorted(terms[order], np.arange(len(weight) + 1))
        self.most = np.zeros(len(weight), np.int64)
        held = np.flatnonzero(np.diff(self.bounds))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.share, self.bounds[held])

    def rank(self, terms: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that can be among the k best, their exact scores, and how many accumulators were made.

        ``terms`` come rarest first; ``known`` holds scores of other documents that compete.
        """
        score, live = np.zeros(self.size, np.int64), np.zeros(self.size, bool)
        rest = np.concatenate([np.cumsum(self.most[terms][::-1])[::-1], [0]])
        made, creating, floor = 0, True, int(known.min()) if len(known) >= k else -1
        for i, term in enumerate(terms.tolist()):
            a, b = self.bounds[term], self.bounds[term + 1]
            if a == b:
                continue
            if creating and made:
                held = score[live]
                if len(held) + len(known) >= k and rest[i] < held.max(initial=0):
                    scores = np.concatenate([held, known])
                    floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            # A new document gets no more than what remains; at equality its id could still put it first.
            creating = creating and rest[i] >= floor
            doc, share = self.doc[a:b], self.share[a:b]
            if creating:
                live[doc] = True
                made = 1
            else:
                kept = live[doc]
                doc, share = doc[kept], share[kept]
            score[doc] += share
        found = np.flatnonzero(score >= max(1, floor))
        return found, score[found], int(live.sum())


_BEST = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def best(ids: np.ndarray, nulls: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id, a null id last."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        among = np.flatnonzero(scores >= least)
        return among[np.lexsort((ids[among], nulls[among], -scores[among]))[:k]]
    return np.lexsort((ids, nulls, -scores))[:k]


def _rank(plan: Broadcast, k: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, docs, length = plan.value
        top: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        none = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

        def take(rows: pa.Table) -> None:
            rows = rows.combine_chunks()
            id_column, terms, tf = rows.column("doc_id"), rows.column("terms").combine_chunks(), rows.column("tf").combine_chunks()
            ids, nulls = id_column.fill_null(0).to_numpy(), id_column.is_null().to_numpy()
            ends = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))])
            block = Block(rows.column("n").to_numpy(), ends, terms.flatten().to_numpy(), tf.flatten().to_numpy(), weight, docs, length)
            for item, wanted in enumerate(items):
                had = top.get(item, none)
                found, scores, _ = block.rank(wanted, k, had[2])
                if len(found):
                    both = [np.concatenate(x) for x in zip(had, (ids[found], nulls[found], scores))]
                    at = best(*both, k)
                    top[item] = tuple(x[at] for x in both)

        held, docs_held, postings = [], 0, 0
        for batch in batches:
            held.append(batch)
            docs_held += batch.num_rows
            postings += len(batch.column(2).flatten())
            if docs_held >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                take(pa.Table.from_batches(held))
                held, docs_held, postings = [], 0, 0
        if docs_held:
            take(pa.Table.from_batches(held))
        for item, (ids, nulls, scores) in top.items():
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(ids), item, np.int32)), pa.array(ids, mask=nulls), pa.array(scores),
            ], schema=_BEST)

    return rank


def _one_pass(docs: DataFrame, items: DataFrame, item_id: str, k: int) -> DataFrame:
    """The k best documents of a bounded set of items (item_id, texts)."""
    spark = docs.sparkSession
    rows = items.collect()
    terms: dict[bytes, int] = {}
    numbered = []
    for row in rows:
        own = {word for text in row["texts"] for part in terms_of(text.encode()) for word in part}
        numbered.append(np.array(sorted(terms.setdefault(word, len(terms)) for word in own), np.int64))
    wanted = spark.sparkContext.broadcast(terms)
    postings = store(docs.mapInArrow(_post(wanted), "doc_id long, n long, terms array<int>, tf array<long>"), "postings")
    sums = postings.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    n_docs, length = sums["docs"], sums["length"] or 0
    # One row per term of the items: their number is bounded by the pass.
    df = np.zeros(len(terms), np.int64)
    for term, count in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = count
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for c in df.tolist()], np.int64)
    rarest_first = [t[np.lexsort((t, df[t]))] for t in numbered]
    plan = spark.sparkContext.broadcast((rarest_first, weight, n_docs, length))
    found = postings.where("size(terms) > 0").select("doc_id", "n", "terms", "tf").mapInArrow(_rank(plan, k), "item int, doc_id long, score long")
    names = spark.createDataFrame(
        [(number, row["item_id"]) for number, row in enumerate(rows)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Ranked in two steps, so that no task ranks what all the others have found for an item.
    first = Window.partitionBy("item", "_deal").orderBy(*order)
    last = Window.partitionBy("item").orderBy(*order)
    dealt = found.withColumn("_deal", F.pmod(F.xxhash64("doc_id"), F.lit(shuffle_width(spark))))
    kept = dealt.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).drop("rank", "_deal")
    ranked = kept.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "item").select(F.col("item_id").alias(item_id), "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """One row per item and found document: item_id, rank (from 1), doc_id, score.

    The ``k`` documents of the highest score above 0 for each item, equal scores by ascending doc_id, a null id last.
    Scores and term statistics cover all documents and whole texts; the result is exact. Null and empty texts hold no term.
    Rows that share an item id are one item with the terms of all of them, null ids too; an item without terms has no row.
    Repeated documents are ranked each.

    The items are a stated query set: their terms are looked for in passes over the documents, each for about ``pass_bytes``
    of item text, so what is broadcast is bounded (by one item, if that is larger). Postings hold the items' terms alone
    and are written to the shared folder; each task keeps the ``k`` best of an item.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    wanted = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("item_text"))
    size = wanted.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))
    part = free_name(wanted, "_pass")
    wanted = wanted.withColumn(part, F.pmod(F.xxhash64("item_id"), F.lit(passes)))
    out = None
    for number in range(passes):
        chosen = wanted.where(F.col(part) == number).groupBy("item_id").agg(F.collect_list("item_text").alias("texts"))
        found = _one_pass(texts, chosen, item_id, k)
        out = found if out is None else out.unionByName(found)
    return out
