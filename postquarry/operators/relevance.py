"""Word-list matches and nearest reference vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.session import BROADCAST_BYTES, broadcast_if_small, ship_package

WORD_BREAK = r"[^\p{L}\p{N}]+"
# A list up to this size is compared inside the row; beyond it words are joined.
INLINE_WORDS = 256
# Rows per side of one block of the blocked search.
BLOCK_ROWS = 20_000
# Cosines that are held at a time; sorting them takes some copies.
COSINE_BYTES = 4 << 20


def tokens(text: Column) -> Column:
    """Lower-case words of the whole text; an empty word may stand at either end."""
    return F.split(F.lower(text), WORD_BREAK)


def match_words(
    df: DataFrame,
    key_cols: list[str],
    text_col: str,
    words: list[str] | DataFrame,
    min_words: int = 2,
    word_col: str = "word",
) -> DataFrame:
    """Rows whose text holds at least ``min_words`` words of the list, and one in any case.

    Whole words, case ignored, each word counted once. Returns one row per matching row, also where rows share a key: the
    key columns, the sorted ``words`` and their number. A short Python list is intersected inside the
    row without any shuffle. A table is equi-joined on the word; its size is measured, and
    while it is small it is broadcast, so that only the hits are shuffled.
    """
    min_words = max(1, min_words)
    keyed = df.select(*key_cols, tokens(F.col(text_col)).alias("_tokens"))
    if not isinstance(words, DataFrame):
        listed = sorted({w.lower() for w in words} - {""})
        if len(listed) <= INLINE_WORDS:
            wanted = F.array(*[F.lit(w) for w in listed]).cast("array<string>")
            # One-element explode: the size filter stays above it and the match runs once.
            found = F.array(F.sort_array(F.array_intersect("_tokens", wanted)))
            hits = keyed.select(*key_cols, F.explode(found).alias("words"))
            return hits.where(F.size("words") >= min_words).withColumn("n_words", F.size("words"))
        words = df.sparkSession.createDataFrame([(w,) for w in listed], f"{word_col} STRING")
    wanted = broadcast_if_small(words.select(F.lower(word_col).alias("_word")).where("_word <> ''").distinct())
    # The join needs repeats removed first; array_intersect does that by itself. Hits are gathered by row, not by key.
    numbered = keyed.withColumn("_row", F.monotonically_increasing_id())
    hits = numbered.select("_row", *key_cols, F.explode(F.array_distinct("_tokens")).alias("_word")).join(wanted, "_word")
    grouped = hits.groupBy("_row", *key_cols).agg(F.sort_array(F.collect_list("_word")).alias("words")).drop("_row")
    return grouped.where(F.size("words") >= min_words).withColumn("n_words", F.size("words"))


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _top_k(posts: np.ndarray, refs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Column indexes and cosines of the k nearest references of every row.

    Cosines are rounded to 12 digits so that equal vectors tie; ties go to the lower
    index (references are sorted by id).
    """
    cosine = posts @ refs.T
    np.round(cosine, 12, out=cosine)
    k = min(k, refs.shape[0])
    picked = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    lowest = np.take_along_axis(cosine, picked, 1).min(axis=1)
    for row in np.flatnonzero((cosine >= lowest[:, None]).sum(axis=1) > k):
        picked[row] = np.argsort(-cosine[row], kind="stable")[:k]
    picked.sort(axis=1)
    values = np.take_along_axis(cosine, picked, 1)
    order = np.argsort(-values, axis=1, kind="stable")
    return np.take_along_axis(picked, order, 1), np.take_along_axis(values, order, 1)


NOBODY = pd.DataFrame({"key": [], "ref_id": [], "label": [], "cosine": [], "rank": []})


def _neighbours(keys: pd.Series, vectors: pd.Series, ids: np.ndarray, labels: np.ndarray, refs: np.ndarray, k: int) -> pd.DataFrame:
    """Long table of neighbours, a slice of rows at a time so the cosine block stays small."""
    step = max(1, COSINE_BYTES // (8 * max(1, refs.shape[0])))
    frames = []
    for start in range(0, len(keys), step):
        index, cosine = _top_k(_unit_rows(vectors.iloc[start:start + step]), refs, k)
        width = index.shape[1]
        flat = index.ravel()
        frames.append(pd.DataFrame({
            "key": np.repeat(keys.iloc[start:start + step].to_numpy(), width),
            "ref_id": ids[flat],
            "label": labels[flat],
            "cosine": cosine.ravel(),
            "rank": np.tile(np.arange(1, width + 1, dtype=np.int32), len(index)),
        }))
    return pd.concat(frames, ignore_index=True) if frames else NOBODY


def nearest(
    df: DataFrame,
    key_col: str,
    vec_col: str,
    refs: DataFrame,
    k: int = 3,
    ref_id: str = "ref_id",
    label: str = "label",
    ref_vec: str = "vec",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` nearest reference vectors by cosine: key, rank (1-based), ref_id, label, cosine.

    Exact. Rows and references without a vector are left out. The bytes of the reference set are measured first. A set within
    ``broadcast_bytes`` (as doubles) is sent to the executors and every batch of posts is compared
    with it in one matrix product, without a shuffle. A larger set is cut into blocks
    and so are the posts; every pair of blocks is one task that keeps ``k`` rows per
    post, and the best ``k`` over the blocks remain.
    """
    ship_package(df.sparkSession)
    refs = refs.select(F.col(ref_id).alias("ref_id"), F.col(label).alias("label"), F.col(ref_vec).cast("array<double>").alias("vec"))
    refs = refs.where("vec IS NOT NULL")
    posts = df.select(F.col(key_col).alias("key"), F.col(vec_col).cast("array<double>").alias("pv")).where("pv IS NOT NULL")
    key_type = posts.schema["key"].dataType.simpleString()
    id_type = refs.schema["ref_id"].dataType.simpleString()
    label_type = refs.schema["label"].dataType.simpleString()
    long_schema = f"key {key_type}, ref_id {id_type}, label {label_type}, cosine double, rank int"
    size = refs.agg(F.count("*").alias("rows"), F.sum(F.size("vec") * 8).alias("bytes")).first()

    if (size["bytes"] or 0) <= broadcast_bytes:
        table = refs.toPandas().sort_values("ref_id", kind="stable")
        sent = df.sparkSession.sparkContext.broadcast((
            table["ref_id"].to_numpy(), table["label"].to_numpy(),
            _unit_rows(table["vec"]) if len(table) else np.zeros((0, 1)),
        ))

        def against_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, labels, matrix = sent.value
            for batch in batches:
                if len(batch) and len(ids):
                    yield _neighbours(batch["key"], batch["pv"], ids, labels, matrix, k)

        # A batch has met every reference, so its ranks are final and nothing is shuffled.
        return posts.mapInPandas(against_all, long_schema).select(F.col("key").alias(key_col), "rank", "ref_id", "label", "cosine")
    else:
        blocks = max(1, -(-size["rows"] // block_rows))
        chunks = max(1, -(-posts.count() // block_rows))

        def block_of(col: str, n: int) -> Column:
            return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")

        def listed(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        left = posts.select("key", "pv", block_of("key", chunks).alias("chunk"), listed(blocks).alias("block"))
        right = refs.select("ref_id", "label", "vec", listed(chunks).alias("chunk"), block_of("ref_id", blocks).alias("block"))

        def pair_of_blocks(some_posts: pd.DataFrame, some_refs: pd.DataFrame) -> pd.DataFrame:
            if some_posts.empty or some_refs.empty:
                return NOBODY
            some_refs = some_refs.sort_values("ref_id", kind="stable")
            return _neighbours(
                some_posts["key"], some_posts["pv"],
                some_refs["ref_id"].to_numpy(), some_refs["label"].to_numpy(), _unit_rows(some_refs["vec"]), k,
            )

        found = (
            left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block"))
            .applyInPandas(pair_of_blocks, long_schema)
        )
    best = Window.partitionBy("key").orderBy(F.desc("cosine"), "ref_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select(F.col("key").alias(key_col), "rank", "ref_id", "label", "cosine")
    )


def labelled_keys(neighbours: DataFrame, key_col: str, label_value: str) -> DataFrame:
    """Keys with at least one neighbour of the label."""
    return (
        neighbours.groupBy(key_col).agg(F.max(F.col("label") == label_value).alias("_any")).where("_any").select(key_col)
    )


def drop_bots(df: DataFrame, neighbours: DataFrame, key_col: str, human: str = "h") -> DataFrame:
    """Drop the rows that have neighbours but none with the label ``human``.

    A row without a vector has no neighbours: nothing speaks against it and it stays.
    """
    bots = neighbours.groupBy(key_col).agg(F.max(F.col("label") == human).alias("_any")).where("not coalesce(_any, false)").select(key_col)
    return df.join(bots, key_col, "left_anti")


def reference_set(sets: dict[str, DataFrame], id_col: str = "ref_id") -> DataFrame:
    """Vectors of several labels in one table; the label is put before the id."""
    tables = [
        table.withColumn("label", F.lit(label)).withColumn(id_col, F.concat_ws("_", F.lit(label), F.col(id_col).cast("string")))
        for label, table in sets.items()
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result
