"""Benchmark decontamination: exact windows of benchmark words in documents, by a prefix-filtered join.

The words of a window are ordered by how rare they are in the documents. A document can hold a window
only if it holds the window's rarest word, so only that necessary prefix is joined. Every hit says where
the window would have to begin; it must lie within the document (position and length bounds), and
then its words are compared one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postquarry.llm.common import lower_ascii, store

#: What is no word: ASCII characters other than letters and digits.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOWS_AT_ONCE = 50_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD), lambda w: w != "")


def windows_of(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(item, window): distinct runs of ``size`` words; a shorter item is one window, one without words none."""
    words = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return (
        words.where(F.size("w") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.lit(size)))).alias("window"))
        .distinct()
    )


def find_windows(
    docs: DataFrame, items: DataFrame, size: int = 10, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", windows_at_once: int = WINDOWS_AT_ONCE,
) -> DataFrame:
    """One row per document: its id, n_words, n_hit, n_items, items (sorted ids), contaminated.

    A word is hit if it lies in any occurrence of a window. Null and empty texts have no words. Rows with
    the same id and text are counted once and given back as often as they came; rows with the same id and
    other texts are judged apart. An item with a null id is called "null", repeated items count once by id.
    Without items nothing is hit.

    The documents are read once to count the benchmark's words in them and once per block of
    ``windows_at_once`` windows, which bounds what is broadcast. They are never shuffled: only counts,
    one marker per document and the hits are. A word that most documents share is joined only for
    windows that hold nothing rarer.
    """
    windows = store(
        windows_of(items, item_id, item_text, size).select("item", "window", F.xxhash64("window").alias("w_id")), "windows"
    )
    distinct = windows.groupBy("w_id", "window").agg(F.lit(1).alias("one")).drop("one")
    rows = docs.select(
        F.col(doc_id).alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t_id"), words_of(F.col(text)).alias("words")
    )
    n_blocks = -(-distinct.count() // windows_at_once)

    def block_of(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(max(1, n_blocks)))

    # How often the documents hold each word of the benchmark.
    vocabulary = distinct.select(F.explode("window").alias("word")).distinct()
    counts = [
        rows.select(F.explode("words").alias("word"))
        .join(F.broadcast(vocabulary.where(block_of(F.col("word")) == b)), "word").groupBy("word").agg(F.count("*").alias("n"))
        for b in range(n_blocks)
    ]
    held = distinct.select("w_id", "window", F.posexplode("window").alias("at", "word"))
    if counts:
        held = held.join(reduce(DataFrame.unionAll, counts), "word")
        full = F.count("*") == F.size("window")  # a word that no document holds rules its window out
    else:
        held, full = held.withColumn("n", F.lit(0)), F.lit(False)
    rarest = F.min(F.struct("n", "word", "at"))
    prefixes = store(
        held.groupBy("w_id", "window").agg(rarest.alias("r"), full.alias("full")).where("full")
        .select("w_id", "window", F.col("r.word").alias("word"), F.col("r.at").alias("at"), F.pmod(F.col("w_id"), F.lit(max(1, n_blocks))).alias("b")),
        "prefixes",
    )
    # The first element, null, marks the document itself.
    each = rows.select("doc", "t_id", "words", F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.col("words"))).alias("pos", "word"))

    def matches(b: int) -> DataFrame:
        # Words are counted from 1 by pos; a window begins ``at`` words before its rarest one.
        start = F.col("pos") - F.col("at")
        fits = (
            (F.col("word") == F.col("_word")) & (start >= 1) & (start + F.size("window") - 1 <= F.size("words"))
            & (F.slice("words", start, F.size("window")) == F.col("window"))
        )
        block = prefixes.where(F.col("b") == b).withColumnRenamed("word", "_word").drop("b")
        joined = each.join(F.broadcast(block), fits, "left")
        wanted = F.col("w_id").isNotNull() | (F.col("pos") == 0) if b == 0 else F.col("w_id").isNotNull()
        return joined.where(wanted).select(
            "doc", "t_id", F.size("words").alias("n_words"), "w_id",
            F.when(F.col("w_id").isNotNull(), F.struct(start.alias("start"), F.size("window").alias("n"))).alias("span"),
        )

    found = reduce(DataFrame.unionAll, [matches(b) for b in range(max(1, n_blocks))])
    per_doc = store(
        found.groupBy("doc", "t_id", "n_words").agg(
            F.count_if(F.col("span").isNull()).alias("copies"), F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("w_id").alias("w_ids"),
        ), "hits",
    )
    # Spans are sorted by start: each adds what lies beyond the furthest end so far.
    hit = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["n"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(a["end"], s["start"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    named = (
        per_doc.where(F.size("w_ids") > 0).select("doc", "t_id", F.explode("w_ids").alias("w_id"))
        .join(windows.select("w_id", "item"), "w_id")
        .groupBy("doc", "t_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select(F.col("doc").alias("_doc"), F.col("t_id").alias("_t_id"), "items")
    )
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return (
        per_doc.join(named, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("t_id") == F.col("_t_id")), "left")
        .select(
            F.col("doc").alias(doc_id), F.col("n_words").cast("long").alias("n_words"), hit.alias("n_hit"),
            F.size(items_of).cast("long").alias("n_items"), items_of.alias("items"), (F.size("spans") > 0).alias("contaminated"),
            F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"),
        ).drop("_copy")
    )


def digest_hits(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return found.select(
        doc_id, "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )
