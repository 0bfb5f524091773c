"""Spelling variants grouped with a trie of letter-group counts.

A word's vector counts its code points by letter group. One edit changes it by at most one surplus and one deficit, so the
words near to a word lie in the trie of vectors on paths that spend a budget of one each. The first levels of the trie
deal words to tasks: a word is filed under its own path and asked for under every path its budget can reach. Below that a
task walks its part of the trie depth-first, with all words that ask there at once, and verifies the words of the leaves.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postquarry.llm.common import store
from postquarry.session import broadcast_if_small, ship_package

GROUPS = 16
#: Words under one path of the trie's levels that deal words to tasks.
PATH_WORDS = 1 << 14
#: Levels that may do so.
DEPTHS = (1, 2, 3, 4, 6, 8, 12, GROUPS)
#: Words times askers below which a node of the trie is searched as a leaf; words held in full width.
LEAF, WIDE = 1 << 12, 48
SLICE, HELD = 1 << 20, 400_000

_LETTERS = re.compile("[^a-zÀ-ÿ]")


def runs_of(text: str, least: int) -> Iterator[list[str]]:
    """Runs of ``least`` letters and more, A-Z lower-cased, about a megabyte of text at a time."""
    pattern, at = re.compile(f"[a-zÀ-ÿ]{{{least},}}"), 0
    text = text.encode().lower().decode()
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            edge = _LETTERS.search(text, end)
            end = edge.start() if edge else len(text)
        yield pattern.findall(text, at, end)
        at = end


_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _count(least: int, drop_every: int | None):
    """Words of a task; a run whose checksum with the id is divisible by ``drop_every`` lacks one letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}

        def give() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], schema=_COUNTS)
            found.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for runs in runs_of(text.as_py() or "", least):
                    for run, times in Counter(runs).items():
                        if drop_every:
                            h = zlib.crc32(run.encode(), start)
                            if h % drop_every == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                        if len(run) >= least:
                            found[run] = found.get(run, 0) + times
                    if len(found) > HELD:
                        yield give()
        yield give()

    return count


def word_counts(
    df: DataFrame, least: int = 6, min_count: int = 5, drop_every: int | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(word, n): lower-cased letter runs of ``least`` code points and ``min_count`` occurrences in all rows.

    Letters are A-Z (lower-cased), a-z and U+00C0 to U+00FF. With ``drop_every`` a run loses one letter where that divides the
    crc32 of ``<doc_id>:<run>`` (h), the one at h % length: a reproducible source of misspellings. A null id counts as empty
    text. Counts are combined in the tasks first.
    """
    ship_package(df.sparkSession)
    rows = df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return (
        rows.mapInArrow(_count(least, drop_every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


def vectors(words: list[bytes]) -> np.ndarray:
    """Code points of each word by group: the low four bits. Counts end at 255, which only lets more pairs be verified."""
    sizes = np.array([len(w) for w in words], np.int64)
    group = np.frombuffer(b"".join(words), np.uint8) % GROUPS
    at = np.repeat(np.arange(len(words)), sizes) * GROUPS + group
    return np.minimum(np.bincount(at, minlength=len(words) * GROUPS), 255).astype(np.uint8).reshape(-1, GROUPS)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group: words, sum and sum of squares of the counts."""
    for batch in batches:
        v = vectors([w.encode("latin-1") for w in batch.column(0).to_pylist()]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(GROUPS)), pa.array(np.full(GROUPS, len(v))), pa.array(v.sum(0)), pa.array((v * v).sum(0)),
        ], names=["level", "n", "s", "q"])


def _file(order: list[int]):
    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = vectors([w.encode("latin-1") for w in batch.column(0).to_pylist()])[:, order]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in v], pa.binary())], names=["word", "n", "path"])

    return file


def reach(path: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Paths that the rows of ``path`` can reach with a surplus and a deficit of one, themselves first; which rows can, and what is left of either."""
    depth = path.shape[1]
    for up in range(-1, depth):
        for down in range(-1, depth):
            if up == down and up >= 0:
                continue
            out, able = path.copy(), np.ones(len(path), bool)
            if up >= 0:
                able &= path[:, up] < 255
                out[:, up] += 1
            if down >= 0:
                able &= path[:, down] > 0
                out[:, down] -= 1
            yield out, np.flatnonzero(able), int(up < 0), int(down < 0)


_ASKS = pa.schema([
    ("path", pa.binary()), ("asks", pa.bool_()), ("word", pa.string()), ("n", pa.int64()), ("rest", pa.binary()),
    ("surplus", pa.int8()), ("deficit", pa.int8()),
])
_ASKS_DDL = "path binary, asks boolean, word string, n long, rest binary, surplus byte, deficit byte"


def _deal(depth: int):
    """A word under its own path, and as an asker under all paths that it can reach."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, GROUPS)
            rest = pa.array([r.tobytes() for r in v[:, depth:]], pa.binary())

            def rows(path: np.ndarray, asks: bool, surplus: int, deficit: int, kept: np.ndarray) -> pa.RecordBatch:
                size = len(kept)
                return pa.RecordBatch.from_arrays([
                    pa.array([r.tobytes() for r in path[kept]], pa.binary()), pa.array(np.full(size, asks)), batch.column(0).take(pa.array(kept)),
                    batch.column(1).take(pa.array(kept)), rest.take(pa.array(kept)),
                    pa.array(np.full(size, surplus, np.int8)), pa.array(np.full(size, deficit, np.int8)),
                ], schema=_ASKS)

            own = v[:, :depth]
            yield rows(own, False, 1, 1, np.arange(len(v)))
            for path, able, surplus, deficit in reach(own):
                yield rows(path, True, surplus, deficit, able)

    return deal


class Lexicon:
    """Words of a part of the trie, in the order of its paths."""

    def __init__(self, words: list[str], n: np.ndarray, rest: np.ndarray) -> None:
        order = np.lexsort(rest.T[::-1]) if rest.shape[1] else np.arange(len(words))
        self.words, self.n, self.rest = [words[k] for k in order], n[order], rest[order]
        self.rank = np.empty(len(words), np.int64)
        self.rank[sorted(range(len(words)), key=self.words.__getitem__)] = np.arange(len(words))
        self.codes = Codes(self.words, 0)

    def candidates(self, rest: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asker, word) pairs whose vectors differ by no more than the askers' budgets."""
        levels = self.rest.shape[1]

        def walk(low: int, high: int, level: int, who: np.ndarray, up: np.ndarray, down: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if level == levels or (high - low) * len(who) <= LEAF:
                step = max(1, LEAF * 16 // (high - low))
                for a in range(0, len(who), step):
                    part = slice(a, a + step)
                    differ = self.rest[low:high, level:][None].astype(np.int16) - rest[who[part], level:][:, None]
                    more, less = np.maximum(differ, 0).sum(2), np.maximum(-differ, 0).sum(2)
                    x, y = np.nonzero((more <= up[part, None]) & (less <= down[part, None]))
                    if len(x):
                        yield who[part][x], y + low
                return
            column = self.rest[low:high, level]
            edges = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), high - low]
            mine = rest[who, level].astype(np.int16)
            for a, b in zip(edges, edges[1:]):
                step = int(column[a]) - mine
                go = np.flatnonzero((step == 0) | ((step == 1) & (up > 0)) | ((step == -1) & (down > 0)))
                if len(go):
                    yield from walk(low + a, low + b, level + 1, who[go], up[go] - (step[go] == 1), down[go] - (step[go] == -1))

        if len(self.words) and len(rest):
            yield from walk(0, len(self.words), 0, np.arange(len(rest)), surplus.astype(np.int16), deficit.astype(np.int16))


class Codes:
    """Words as rows of code points from the left and from the right; longer words stay as they are."""

    def __init__(self, words: list[str], pad: int) -> None:
        self.words = words
        self.sizes = np.array([len(w) for w in words], np.int64)
        width = min(WIDE, int(self.sizes.max(initial=0))) + 1
        self.left = np.full((len(words), width), pad, np.uint8)
        self.right = np.full((len(words), width), pad, np.uint8)
        short = np.flatnonzero(self.sizes <= WIDE)
        sizes = self.sizes[short]
        flat = np.frombuffer(b"".join(words[k].encode("latin-1") for k in short.tolist()), np.uint8)
        row, column = np.repeat(short, sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.left[row, column] = flat
        self.right[row, np.repeat(sizes, sizes) - 1 - column] = flat


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point tells two words apart."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short = min(len(a), len(b))
    start = next((k for k in range(short) if a[k] != b[k]), short)
    return a[start + 1 :] == b[start + (len(a) == len(b)) :] if len(a) >= len(b) else a[start:] == b[start + 1 :]


def verified(a: Codes, x: np.ndarray, b: Codes, y: np.ndarray) -> np.ndarray:
    """Places of the pairs of rows of ``a`` and ``b`` that one edit tells apart. The two have different padding."""
    la, lb = a.sizes[x], b.sizes[y]
    longer = np.maximum(la, lb)
    fit = np.abs(la - lb) <= 1
    far = np.flatnonzero(fit & (longer > WIDE))
    out = [np.array([k for k in far.tolist() if one_edit(a.words[x[k]], b.words[y[k]])], np.int64)]
    kept = np.flatnonzero(fit & (longer <= WIDE))
    width = min(a.left.shape[1], b.left.shape[1])
    for at in np.array_split(kept, len(kept) // 100_000 + 1):
        # The column behind the last one is padding in either, so there always is a first difference.
        start = np.argmax(a.left[x[at], :width] != b.left[y[at], :width], 1)
        end = np.argmax(a.right[x[at], :width] != b.right[y[at], :width], 1)
        same = (la[at] == lb[at]) & (start >= la[at])
        out.append(at[(start + end >= longer[at] - 1) & ~same])
    return np.concatenate(out)


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _ask(lexicon: Lexicon, words: list[str], rest: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> pa.RecordBatch | None:
    """For every asker with near words under this path: their number, the largest count and the word that has it."""
    codes = Codes(words, 1)
    asker, word = [], []
    held_x, held_y, size = [], [], 0

    def settle() -> None:
        nonlocal size
        if held_x:
            x, y = np.concatenate(held_x), np.concatenate(held_y)
            ok = verified(codes, x, lexicon.codes, y)
            asker.append(x[ok])
            word.append(y[ok])
        held_x.clear()
        held_y.clear()
        size = 0

    for x, y in lexicon.candidates(rest, surplus, deficit):
        held_x.append(x)
        held_y.append(y)
        size += len(x)
        if size > 300_000:
            settle()
    settle()
    if not asker or not (x := np.concatenate(asker)).size:
        return None
    y = np.concatenate(word)
    order = np.lexsort((lexicon.rank[y], -lexicon.n[y], x))
    x, y = x[order], y[order]
    who, first, number = np.unique(x, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays([
        pa.array([words[k] for k in who.tolist()], pa.string()), pa.array(number.astype(np.int64)), pa.array(lexicon.n[y[first]]),
        pa.array([lexicon.words[k] for k in y[first].tolist()], pa.string()),
    ], schema=_NEAR)


def _search(depth: int):
    """Rows come sorted by place, the words before the askers; the words of one place are held, askers pass by in batches."""

    def matrix(cells: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(cells), np.uint8).reshape(len(cells), GROUPS - depth)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, filed, lexicon = None, [], None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            asks = batch.column(1).to_pylist()
            edges = [0]
            for _, same in itertools.groupby(zip(keys, asks)):
                edges.append(edges[-1] + sum(1 for _ in same))
            for a, b in itertools.pairwise(edges):
                rows = batch.slice(a, b - a)
                if keys[a] != place:
                    place, filed, lexicon = keys[a], [], None
                if not asks[a]:
                    filed.append(rows)
                    continue
                if filed and lexicon is None:
                    lexicon = Lexicon(
                        [w for f in filed for w in f.column(2).to_pylist()], np.concatenate([f.column(3).to_numpy() for f in filed]),
                        matrix([r for f in filed for r in f.column(4).to_pylist()]),
                    )
                if lexicon and (found := _ask(
                    lexicon, rows.column(2).to_pylist(), matrix(rows.column(4).to_pylist()), rows.column(5).to_numpy(), rows.column(6).to_numpy()
                )) is not None:
                    yield found

    return search


def near_words(vocabulary: DataFrame, path_words: int = PATH_WORDS) -> DataFrame:
    """(word, n_near, best_n, best): words with near words, how many, the most frequent and its count.

    ``vocabulary`` (word, n) holds distinct words and is read several times, so it should be stored. Levels of the trie
    follow the letter groups by their spread over the vocabulary. As many of them deal words to tasks as it takes to have no
    more than ``path_words`` words under one path (all, if even then there are more); askers of a path that many words can
    reach are cut into parts, each of which meets the words of the path.
    """
    spread = vocabulary.mapInArrow(_spread, "level long, n long, s long, q long").groupBy("level").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
    order = [r["level"] for r in sorted(spread, key=lambda r: (r["s"] ** 2 / max(1, r["n"]) - r["q"], r["level"]))] or list(range(GROUPS))
    filed = store(vocabulary.select("word", "n").mapInArrow(_file(order), "word string, n long, path binary"), "trie-words")
    depth = F.explode(F.array(*[F.lit(d) for d in DEPTHS]))
    most = filed.select("path", depth.alias("depth")).groupBy("depth", F.expr("substring(path, 1, depth)").alias("p")).count().groupBy("depth").agg(F.max("count").alias("m"))
    sizes = {r["depth"]: r["m"] for r in most.collect()}
    levels = next((d for d in DEPTHS if sizes.get(d, 0) <= path_words), GROUPS)
    dealt = store(filed.mapInArrow(_deal(levels), _ASKS_DDL), "trie-asks")
    # Askers of a path that many words reach are cut into parts; the words of the path go to each of them.
    crowded = store(
        dealt.where("asks").groupBy("path").count().where(F.col("count") > 8 * path_words)
        .select("path", F.ceil(F.col("count") / (8 * path_words)).cast("int").alias("parts")), "trie-crowded",
    )
    if crowded.isEmpty():
        placed = dealt.withColumnRenamed("path", "place")
    else:
        part = F.when(F.col("asks"), F.array(F.pmod(F.xxhash64("word"), F.col("parts")))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
        placed = (
            dealt.join(broadcast_if_small(crowded), "path", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("part", F.explode(part.cast("array<string>")))
            .withColumn("place", F.concat("path", F.encode("part", "utf-8")))
        )
    found = (
        placed.select("place", "asks", "word", "n", "rest", "surplus", "deficit")
        .repartition("place").sortWithinPartitions("place", "asks")
        .mapInArrow(_search(levels), "word string, n_near long, best_n long, best string")
    )
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("first")
    ).select("word", "n_near", (-F.col("first.m")).alias("best_n"), F.col("first.best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): where a chain of forms (word, form) ends. Chains have no rings, as counts grow along them.

    Each round doubles the part of every chain that is followed, so a chain of d forms takes about log2(d) rounds.
    """
    ways = store(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "form-ways")
    while ways.where("open").limit(1).count():
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = store(
            ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")),
            "form-ways",
        )
    return ways.select("word", "root")


def spelling_variants(words: DataFrame, factor: int = 5, path_words: int = PATH_WORDS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``words`` (word, n) holds distinct words of code points up to U+00FF (``word_counts``). Words are near if they differ by
    exactly one inserted, deleted or replaced code point; ``n_near`` counts them. ``form`` is the near word of the largest n
    (at a tie the first in code-point order) if that is at least ``factor`` times (2 or more) the word's own, else null; ``form_n`` is its n.
    ``root`` is where the chain of forms ends, the word itself without a form. An empty table gives none.
    """
    if factor < 2:
        raise ValueError("factor is 2 or more")
    ship_package(words.sparkSession)
    vocabulary = store(words.select("word", "n"), "vocabulary")
    near = near_words(vocabulary, path_words)
    good = F.col("best_n") >= factor * F.col("n")
    rows = store(
        vocabulary.join(near, "word", "left").select(
            "word", F.when(good, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best_n")).alias("form_n"),
        ), "word-forms",
    )
    roots = last_forms(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
