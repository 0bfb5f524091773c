"""N-gram Jaccard join: groups of documents whose shingle sets are linked by a high Jaccard likeness.

Two steps, both exact. First the documents are parted into families that no link leaves: sets that are
alike enough differ in few elements, so if hash space is cut into one class more than that, the two
agree on all their elements in one class (pigeonhole); documents that agree on a class of a size band
are joined into a family. A family too large for one task is parted again by other cuts of hash space, each of which
linked sets must survive together. Then every family is joined by set-relation skipping: its inverted lists are
ordered by set size, so the parts of a list that the length bound rules out are skipped as blocks that are never
read, and the overlaps of a set with all others are derived from those of the similar set before it, walking only
through the lists of the elements in which the two differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postquarry.llm.common import components, store
from postquarry.llm.words import blocks, hash_words, mix
from postquarry.session import broadcast_if_small, ship_package

#: Width of a size band: the largest size over the smallest.
BAND = 1.5
#: Shingles and sets of a part of a family; two parts meet in one task at a time.
PART_SHINGLES, PART_SETS = 1_000_000, 3_000
#: Further cuts go on as long as each leaves at most this share of the rows in families that are too large.
SHRINK = 0.75
#: Step between the part numbers of two levels of size; a level has fewer parts than that.
LEVEL = 1 << 24


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of all runs of ``n`` words; fewer words are one run, none an empty set."""
    words, counts = hash_words(texts)
    out, at = [], 0
    for c in counts.tolist():
        w = words[at : at + c]
        at += c
        m = min(n, c)
        if not m:
            out.append(w)
            continue
        h = np.full(c - m + 1, m, np.uint64)
        for k in range(m):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k : c - m + 1 + k])
        out.append(np.unique(h))
    return out


class Bands:
    """Size bands and, for each, how many classes hash space is cut into.

    A pair with percent * union <= 100 * intersection has sizes within that ratio and differs in at most
    (100 - percent) * (x + y) / (100 + percent) elements. A set shows itself in its own band and, if a
    partner may be larger than the band, in the next.
    """

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.tops = [1]

    def differ(self, x: int, y: int) -> int:
        return (x + y) * (100 - self.percent) // (100 + self.percent)

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, classes, most differences to a partner that is no larger than the band)."""
        largest = size * 100 // self.percent
        while self.tops[-1] < largest:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * BAND)))
        first, last = np.searchsorted(self.tops, size), np.searchsorted(self.tops, largest)
        out = []
        for band in range(int(first), int(last) + 1):
            top = self.tops[band]
            most = self.differ(top, top)
            out.append((band, most + 1 + (most // 5 + 2 if most else 0), self.differ(size, min(top, largest))))
        return out


def signatures(hashes: np.ndarray, bands: Bands, cut: int = 0) -> np.ndarray:
    """Keys of a set: one per band and class that holds two elements or more, the sum of its mixed hashes there.

    Every ``cut`` deals the elements to other classes.

    A set with more such classes than a partner can spoil by differing agrees with the partner on one of
    them, and the partner shows that class too, as it holds the same elements there. Single elements, which
    unlike sets often share, are left out therefore. A set with too few such classes shows those of one element
    as well, and one that is poor in both its smallest elements too (prefix filter): they find the partners
    that are as poor in classes.
    """
    out, n = [], len(hashes)
    if cut:
        hashes = np.sort(mix(hashes ^ np.uint64(cut * 0x9E3779B97F4A7C15 % (1 << 64))))
    mixed = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    for band, classes, most in bands.of(n):
        edges = (np.arange(1, classes) / classes * 2.0**64).astype(np.uint64)
        at = np.concatenate([[0], np.searchsorted(hashes, edges), [n]])
        filled = at[1:] > at[:-1]
        poor = filled.sum() <= most
        strong = at[1:] > at[:-1] + 1
        if strong.sum() > most:
            filled = strong
        seed = mix(np.arange(classes, dtype=np.uint64) + np.uint64(band << 32))
        out.append(mix(mixed[at[1:]] - mixed[at[:-1]] + seed)[filled])
        if poor:
            prefix = hashes[: n - -(-n * bands.percent // 100) + 1]
            out.append(mix(prefix + np.uint64((2 * band + 1) * 0x632BE59BD9B4E019 % (1 << 64))))
    return np.concatenate(out)


_SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
_KEYS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])


def set_sums(s: np.ndarray) -> tuple[int, int]:
    """Two sums that tell sets apart."""
    a, b = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(np.int64(a.astype(np.int64))), int(np.int64(b.astype(np.int64)))


def _sum_up(n: int):
    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column(1).to_pylist(), []
            for start, end in blocks(texts):
                rows += [(len(s), *set_sums(s)) for s in shingle_sets(texts[start:end], n)]
            if rows:
                sizes, a, b = (pa.array(c, pa.int64()) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column(0), sizes, a, b], schema=_SETS)

    return sum_up


def met_here(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine rows of a block: the smallest id alone keeps a key, each other id meets it once under a key of the two."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    least = docs[first][np.cumsum(first) - 1]
    apart = docs != least
    pairs = np.unique(np.stack([docs[apart], least[apart]], 1), axis=0)
    own = mix(mix(pairs[:, 0].astype(np.uint64)) + pairs[:, 1].astype(np.uint64) ^ np.uint64(0xC2B2AE3D27D4EB4F))
    return np.concatenate([keys[first], own, own]), np.concatenate([docs[first], pairs[:, 0], pairs[:, 1]])


def _sign(percent: int, n: int, cut: int = 0):
    """Rows (doc_id, text) or, within families, (doc_id, text, family)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            inside = batch.column(2).to_pylist() if batch.num_columns > 2 else [0] * len(ids)
            for start, end in blocks(texts):
                # Of copies within a block only the smallest id shows the set.
                shown: dict[tuple[int, int, int], tuple[int, np.ndarray]] = {}
                for doc, family, s in zip(ids[start:end], inside[start:end], shingle_sets(texts[start:end], n)):
                    if doc is not None and len(s):
                        sums = *set_sums(s), family
                        if sums not in shown or doc < shown[sums][0]:
                            shown[sums] = (doc, s)
                if shown:
                    keys = [signatures(s, bands, cut) for _, s in shown.values()]
                    sizes = [len(k) for k in keys]
                    families = np.repeat(np.array([f for _, _, f in shown], np.int64).view(np.uint64), sizes)
                    flat = np.concatenate(keys)
                    if cut:
                        flat = mix(flat + mix(families))
                    key, doc = met_here(flat, np.repeat(np.array([d for d, _ in shown.values()], np.int64), sizes))
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc)], schema=_KEYS)

    return sign


def _families(keyed: DataFrame) -> DataFrame:
    """(id, component) of ids that share keys (key, doc_id). Blocks of rows have been combined, as before an aggregation."""
    same_key = Window.partitionBy("key").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    return components(
        keyed.withColumn("least", F.first("doc_id").over(same_key)).where("doc_id <> least")
        .select(F.col("doc_id").alias("u"), F.col("least").alias("v"))
    )


def local_links(
    sets: list[np.ndarray], percent: int, weights: list[int], sides: list[int] | None = None, touched: list[int] | None = None
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links among sets: pairs that span each linked group, and the weight of the partners of every set.

    With ``sides`` only pairs of different sides count. ``touched`` receives how many list entries were read, and how many
    the walked lists hold.
    """
    order = sorted(range(len(sets)), key=lambda k: (sets[k][:6].tolist(), len(sets[k])))
    by_size = np.argsort([len(s) for s in sets], kind="stable")
    place = np.empty(len(sets), np.int64)
    place[by_size] = np.arange(len(sets))  # a set's position in every list it stands in
    sizes = np.array([len(sets[k]) for k in by_size])
    weight = np.asarray(weights)[by_size]
    side = None if sides is None else np.asarray(sides)[by_size]

    # Inverted lists of the elements that two sets or more hold, each in ascending position.
    _, code, often = np.unique(np.concatenate([sets[k] for k in by_size]), return_inverse=True, return_counts=True)
    code = code.astype(np.int32)
    by_code = np.argsort(code, kind="stable")
    lists = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[by_code]
    inner = [code[a:b] for a, b in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes))]
    inner = [np.sort(c[often[c] > 1]) for c in inner]

    parent = list(range(len(sets)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    # Positions of all lists in one ascending sequence, so that the blocks of a range are found in all lists at once.
    ascending = code[by_code].astype(np.int64)
    del by_code
    ascending *= len(sets)
    ascending += lists
    counted = np.zeros(2, np.int64)  # positions read, and those that the walked lists hold

    def walk(codes: np.ndarray, low: int, high: int) -> np.ndarray:
        """How many of the lists name each position from low up to high; what lies before and behind is skipped unread."""
        begin, end = (np.searchsorted(ascending, codes.astype(np.int64) * len(sets) + edge) for edge in (low, high))
        held = np.maximum(end - begin, 0)
        at = np.arange(held.sum()) + np.repeat(begin - np.cumsum(held) + held, held)
        counted[:] += len(at), often[codes].sum()
        return np.bincount(lists[at] - low, minlength=max(0, high - low))

    links, partners = [], np.zeros(len(sets), np.int64)
    before, overlap, low0, high0 = None, None, 0, 0
    for k in order:
        x = int(place[k])
        n = int(sizes[x])
        low, high = np.searchsorted(sizes, -(-n * percent // 100)), np.searchsorted(sizes, n * 100 // percent, "right")
        mine = inner[x]
        derived = False
        if before is not None:
            gone, new = np.setdiff1d(before, mine, True), np.setdiff1d(mine, before, True)
            derived = len(gone) + len(new) < len(mine)
        if derived:
            a, b = max(low, low0), min(high, high0)
            now = np.zeros(high - low, np.int64)
            if a < b:
                now[a - low : b - low] = overlap[a - low0 : b - low0] + walk(new, a, b) - walk(gone, a, b)
            # Sizes that the set before did not look at.
            for s, e in ((low, min(max(a, low), high)), (max(b, a), high)) if a < b else ((low, high),):
                if s < e:
                    now[s - low : e - low] = walk(mine, s, e)
        else:
            now = walk(mine, low, high)
        before, overlap, low0, high0 = mine, now, low, high
        near = 100 * now >= percent * (n + sizes[low:high] - now)
        near[x - low] = False
        if side is not None:
            near &= side[low:high] != side[x]
        hit = np.flatnonzero(near) + low
        partners[k] = weight[hit].sum()
        for y in hit.tolist():
            r, s = root(x), root(y)
            if r != s:
                parent[r] = s
                links.append((int(by_size[x]), int(by_size[y])))
    if touched is not None:
        touched += counted.tolist()
    return links, partners


_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])


def _join_families(percent: int, n: int):
    """Rows come sorted by group; one group is held at a time."""

    def solve(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        _, p, q = rows[0][0]
        links, partners = local_links(
            [r[3] for r in rows], percent, [r[4] for r in rows], [r[2] for r in rows] if p != q else None
        )
        return [(rows[a][1], rows[b][1], 0) for a, b in links] + [
            (r[1], None, int(c)) for r, c in zip(rows, partners) if c
        ]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []

        def give() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _LINKS)], schema=_LINKS)
            out.clear()
            return found

        for batch in batches:
            texts = batch.column(5).to_pylist()
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(3))))
            ids, sides, copies = (batch.column(c).to_pylist() for c in (3, 4, 6))
            for start, end in blocks(texts):
                for k, s in zip(range(start, end), shingle_sets(texts[start:end], n)):
                    if keys[k] != group:
                        out += solve(rows)
                        group, rows = keys[k], []
                        if len(out) > 10_000:
                            yield give()
                    rows.append((keys[k], ids[k], sides[k], s, copies[k]))
        out += solve(rows)
        if out:
            yield give()

    return join


def jaccard_groups(
    df: DataFrame, percent: int = 80, n: int = 5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, n_links.

    Documents with 100 * intersection >= percent * union of their sets of ``n``-word shingles are linked;
    ``component_id`` is the smallest id that links reach, ``n_links`` counts the other rows that are linked
    directly, copies among them. A document without words is linked with nothing. A null id takes no part and
    has a null component. Rows that share an id are one node. Repeated rows stay.

    Copies, within a block of rows or anywhere, are joined once: only the row with the smallest id of each
    distinct set enters a family's join, with the number of rows behind it. A family that further cuts do not make small
    enough for one task is dealt to parts by size and hash, and every two parts of like sizes meet in a task of their own: no
    pair that can be linked is left out.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is 50 to 100")
    ship_package(df.sparkSession)
    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = store(texts.mapInArrow(_sum_up(n), "doc_id long, n_shingles long, a long, b long"), "shingle-sets")
    # One node per distinct set.
    nodes = store(
        sets.where("doc_id is not null and n_shingles > 0").groupBy("a", "b", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")), "set-nodes",
    )
    families = _families(texts.mapInArrow(_sign(percent, n), "key long, doc_id long"))
    # Members that stand for a set.
    members = store(
        nodes.join(families, nodes["node"] == families["id"]).select("node", "a", "b", "n_shingles", "copies", F.col("component").alias("family")),
        "families",
    )
    # The text of a node: the rows with its id, of which the one with its set is kept.
    texts_of = lambda some: texts.join(broadcast_if_small(
        sets.join(some.select("a", "b", F.col("node").alias("doc_id")), ["a", "b", "doc_id"], "left_semi").select("doc_id").distinct()
    ), "doc_id").distinct()
    # Families that are too large are parted by further cuts, as long as that makes them smaller.
    fitting, cut, before = None, 0, None
    while True:
        sizes = members.groupBy("family").agg(F.sum("n_shingles").alias("s"), F.count("*").alias("m")).where("m > 1")
        sized = members.join(sizes, "family")
        large = F.greatest(F.ceil(F.col("s") / PART_SHINGLES), F.ceil(F.col("m") / PART_SETS)) > 1
        left = store(sized.where(large).drop("s", "m"), "large-families")
        fit = sized.where(~large).drop("s", "m")
        fitting = fit if fitting is None else fitting.unionByName(fit)
        count = left.count()
        if not count or (before is not None and count > SHRINK * before):
            break
        cut, before = cut + 1, count
        own = texts_of(left).join(left.select("node", "family"), F.col("doc_id") == F.col("node"))
        parted = _families(own.select("doc_id", "text", "family").mapInArrow(_sign(percent, n, cut), "key long, doc_id long"))
        members = store(
            left.drop("family").join(parted, left["node"] == parted["id"]).select(*left.drop("family").columns, F.col("component").alias("family")),
            "families",
        )
    members = store(fitting.unionByName(left), "families")
    # A family that fits one task is one part; others are cut by binary length of the size, then by hash.
    level = lambda size: F.length(F.bin(size))
    parts_of = lambda s, m: F.greatest(F.ceil(s / PART_SHINGLES), F.ceil(m / PART_SETS)).cast("int")
    cut = (
        members.groupBy("family", level(F.col("n_shingles")).alias("level")).agg(F.sum("n_shingles").alias("s"), F.count("*").alias("m"))
        .groupBy("family").agg(
            parts_of(F.sum("s"), F.sum("m")).alias("all"), F.sum("m").alias("m"),
            F.map_from_entries(F.collect_list(F.struct("level", parts_of(F.col("s"), F.col("m"))))).alias("parts"),
        ).where("m > 1").select("family", F.when(F.col("all") > 1, F.col("parts")).alias("parts"))
    )
    size = F.col("n_shingles")
    least, most = F.expr(f"(n_shingles * {percent} + 99) div 100"), F.expr(f"n_shingles * 100 div {percent}")
    placed = (
        members.join(cut, "family").withColumn("level", F.when(F.col("parts").isNull(), 0).otherwise(level(size)))
        # Levels that the sizes of linked sets can be in.
        .withColumn("levels", F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.array_distinct(F.array(level(least), level(size), level(most)))))
        .withColumn("parts", F.coalesce("parts", F.create_map(F.lit(0), F.lit(1))))
        .withColumn("levels", F.filter("levels", lambda at: F.map_contains_key("parts", at)))
        .withColumn("part", F.col("level") * LEVEL + F.pmod(F.xxhash64("node"), F.col("parts")[F.col("level")]).cast("int"))
        .withColumn("others", F.flatten(F.transform("levels", lambda at: F.transform(
            F.sequence(F.lit(0), F.col("parts")[at] - 1), lambda h: at * LEVEL + h))))
    )
    meetings = placed.select(
        "node", "copies", "family", "part", "a", "b", F.explode("others").alias("other")
    ).select(
        "node", "copies", "family", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
        (F.col("part") > F.col("other")).cast("int").alias("side"), "a", "b",
    )
    links = store(
        meetings.join(texts_of(members), F.col("node") == F.col("doc_id"))
        .select("family", "p", "q", F.col("node").alias("doc"), "side", "text", "copies")
        .repartition("family", "p", "q").sortWithinPartitions("family", "p", "q", "doc")
        .mapInArrow(_join_families(percent, n), "u long, v long, links long"),
        "links",
    )
    linked = components(links.select("u", "v"))
    counts = links.where("v is null").groupBy("u").agg(F.sum("links").alias("others"))
    answers = nodes.join(linked, nodes["node"] == linked["id"], "left").join(counts, nodes["node"] == counts["u"], "left").select(
        "a", "b", "n_shingles", F.coalesce("component", "node").alias("component"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return sets.join(answers, ["a", "b", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).alias("n_links"),
    )
