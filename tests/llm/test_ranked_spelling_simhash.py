from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import LONG, TEXTS, documents, nothing
from pyspark.sql import functions as F

from postquarry.llm import ranked_search, simhash, spelling

LETTERS = "[A-Za-zÀ-ÿ]+"
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ranked search


def ranked(docs, items, k):
    """Every document scored in full."""
    counts = [(d, Counter(re.findall(TERMS, low(t)))) for d, t in docs]
    held = [c for _, c in counts if c]
    n_docs, length = len(held), sum(c.total() for c in held)
    df = Counter(w for c in held for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in df}
    merged = {}
    for item, text in items:
        merged.setdefault(item, set()).update(re.findall(TERMS, low(text)))
    out = []
    for item, terms in merged.items():
        found = []
        for doc, c in counts:
            m = 50 + (50 * c.total() * n_docs) // max(1, length)
            score = sum(weight[w] * ((10**9 * c[w]) // (1000 * c[w] + 20 * m)) for w in terms if w in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def random_texts(seed, n, words=300):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    return [(k, " ".join(rng.choices(names, weights, k=rng.choice([0, 1, 5, 30, 200])))) for k in range(n)]


@pytest.mark.parametrize("pass_bytes", [1 << 20, 200])
def test_search_equals_full_scoring(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 64)
    docs = random_texts(1, 600) + [(7, "w1 w2 W3"), (None, "w1 w1 w250"), (601, None)]
    items = [(k, t) for k, t in random_texts(2, 25)] + [(3, "w299 w298"), (None, "w5 W6"), (99, "absent")]
    got = ranked_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"),
        k=10, pass_bytes=pass_bytes,
    )
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == ranked(docs, items, 10)


def test_blocks_stop_creating_accumulators_and_stay_exact():
    rng = np.random.default_rng(3)
    n_docs, n_terms = 4000, 12
    held = rng.random((n_docs, n_terms)) < np.linspace(0.01, 0.9, n_terms)
    doc, term = np.nonzero(held)
    tf = rng.integers(1, 4, len(doc))
    df = held.sum(0)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for c in df], np.int64)
    ends = np.concatenate([[0], np.cumsum(held.sum(1))])
    block = ranked_search.Block(np.full(n_docs, 50), ends, term, tf, weight, n_docs, 50 * n_docs)
    terms = np.argsort(df, kind="stable")
    found, scores, made = block.rank(terms, 10, np.zeros(0, np.int64))
    exact = np.zeros(n_docs, np.int64)
    np.add.at(exact, doc, weight[term] * (10**9 * tf // (1000 * tf + 20 * 100)))
    top = np.sort(exact)[::-1][:10]
    assert (np.sort(scores)[::-1][:10] == top).all() and (exact[found] == scores).all()
    assert set(np.flatnonzero(exact >= top[-1])) <= set(found.tolist())
    assert made < (exact > 0).sum() / 2  # most documents never get an accumulator
    # Better documents elsewhere stop it sooner.
    assert block.rank(terms, 10, np.full(10, int(top[0]) + 1))[2] < made


def test_search_edge_cases(spark):
    items = documents(spark).select(F.col("n").alias("item_id"), "text", "word", "doc_id")
    got = sorted((tuple(r) for r in ranked_search.search(documents(spark), items, k=4).collect()), key=str)
    assert got == ranked(TEXTS, [(k, t) for k, (_, t) in enumerate(TEXTS)], 4)
    assert ranked_search.search(nothing(spark), items).count() == 0
    assert ranked_search.search(documents(spark), items.limit(0)).count() == 0


def test_terms_cross_slices(monkeypatch):
    monkeypatch.setattr(ranked_search, "SLICE", 7)
    text = "Alpha b, gammagammagamma É9 _x" * 3
    assert [w.decode() for part in ranked_search.terms_of(text.encode()) for w in part] == re.findall(TERMS, low(text))


# spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(words, factor=5):
    out, forms = {}, {}
    for w, n in words.items():
        close = sorted(((-words[o], o) for o in words if near(w, o)))
        form = close[0][1] if close and -close[0][0] >= factor * n else None
        forms[w], out[w] = form, (form, n, len(close), words[form] if form else None)
    rows = []
    for w, (form, n, k, m) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, form, root, n, k, m))
    return sorted(rows)


def lexicon(seed, n):
    rng = random.Random(seed)
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(["on", "th", "e", "a", "é", "rs", "in"]) for _ in range(rng.randint(3, 6)))[:9]
        for v in (w, w[1:], w[:3] + rng.choice("aeiouéñ") + w[3:], w[:2] + "x" + w[3:]):
            words[v] = int(10 ** rng.uniform(0.7, 5))
    return words


@pytest.mark.parametrize("path_words", [1 << 14, 60, 2])
def test_variants_equal_all_pairs(spark, path_words):
    words = lexicon(path_words, 500) | {"z" * 400: 7, "z" * 401: 90, "z" * 300 + "y" + "z" * 100: 8, "y" * 300: 4}
    got = spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"), path_words=path_words)
    assert sorted(tuple(r) for r in got.collect()) == variants(words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_chains_of_forms_end_at_the_last(spark):
    words = {"aaaaaa" + "b" * k: 6**k for k in range(9)}
    got = {r.word: r.root for r in spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"aaaaaa" + "b" * 8}


def test_reach_is_all_of_the_budget():
    path = np.array([[0, 2, 255]], np.uint8)
    got = Counter((tuple(p[k].tolist()), s, d) for p, able, s, d in spelling.reach(path) for k in able)
    assert max(got.values()) == 1
    assert {p for p, _, _ in got} == {(0, 2, 255), (1, 2, 255), (0, 3, 255), (0, 1, 255), (0, 2, 254), (1, 1, 255), (1, 2, 254), (0, 3, 254)}


def test_word_counts_drop_letters_by_checksum(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 50)
    rows = [(k, " ".join(f"{a}{b}Word" for a in ("alpha", "béta", "x", "×÷Ø") for b in "ABCDEF") * 2) for k in range(60)] + [(None, "someWord " * 4), (1, None), (1, "")]
    want = Counter()
    for doc, text in rows:
        for run in re.findall(LETTERS, text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 5 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                want[run] += 1
    got = spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), drop_every=5).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if n >= 5}


def test_spelling_edge_cases(spark):
    want = Counter(low(r) for _, t in TEXTS for r in re.findall(LETTERS, t or "") if len(r) >= 6)
    words = {w: n for w, n in want.items() if n >= 2}
    got = spelling.spelling_variants(spelling.word_counts(documents(spark), min_count=2))
    assert sorted(tuple(r) for r in got.collect()) == variants(words)
    assert spelling.spelling_variants(spelling.word_counts(nothing(spark))).count() == 0


# simhash


def print_of(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    shingles = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, bits):
    """Component of every row (id, print) by comparing all."""
    parent = list(range(len(prints)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(prints)), 2):
        if None not in (prints[a][0], prints[b][0]) and (prints[a][1] ^ prints[b][1]).bit_count() <= bits:
            parent[root(a)] = root(b)
    least = {}
    for k, (doc, _) in enumerate(prints):
        if doc is not None:
            least[root(k)] = min(doc, least.get(root(k), doc))
    return [(doc, f"{p:016x}", None if doc is None else least[root(k)]) for k, (doc, p) in enumerate(prints)]


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_fingerprints(monkeypatch, piece):
    monkeypatch.setattr(simhash, "SLICE", piece)
    texts = ["", None, " \t\n", "one", "One two", "one two three four", "a b c d " * 30, "Straße ÉTÉ été x y z q r s", "w" * 200 + " a b c d", *(t for _, t in TEXTS if t != LONG)]
    for text in texts:
        assert simhash.fingerprint(None if text is None else text.encode()) == (print_of(text) if text else 0)


@pytest.mark.parametrize("shared", range(2, 9))
def test_any_shared_positions_meet(shared):
    for width in range(1, shared + 1):
        sets = simhash.position_sets(width, shared)
        for held in itertools.combinations(range(8), shared):
            assert any(set(s) <= set(held) for s in sets)


def test_fewest_position_sets():
    assert [len(simhash.position_sets(w, 4)) for w in (1, 2, 3, 4)] == [5, 7, 20, 70]


@pytest.mark.parametrize(("width", "longest", "bits"), [(None, 8192, 4), (1, 8192, 4), (1, 16, 4), (2, 10, 4), (3, 8192, 4), (4, 5, 4), (None, 7, 2), (None, 8192, 0), (1, 9, 6)])
def test_groups_equal_all_pairs(spark, monkeypatch, width, longest, bits):
    rng = random.Random(longest + bits)
    centres = [0, 1, (1 << 64) - 1] + [rng.getrandbits(64) for _ in range(40)]
    prints = [(k, rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 5])))) for k in range(400)]
    prints += [(None, 5), (3, 1 << 40), (3, 1 << 40), (3, prints[7][1])]

    def written(batches):
        """Fingerprints that stand in the texts."""
        import pyarrow

        for batch in batches:
            found = pyarrow.array([int(t) - (1 << 64) * (int(t) >> 63) for t in batch.column(1).to_pylist()], "int64")
            yield pyarrow.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "print"])

    monkeypatch.setattr(simhash, "_prints", lambda n: written)
    rows = spark.createDataFrame([(d, str(p)) for d, p in prints], "doc_id long, text string").repartition(3)
    got = simhash.simhash_groups(rows, bits=bits, width=width, longest=longest).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(groups(prints, bits), key=str)


def test_simhash_edge_cases(spark):
    got = simhash.simhash_groups(documents(spark)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(groups([(d, print_of(t)) for d, t in TEXTS], 4), key=str)
    assert simhash.simhash_groups(nothing(spark)).count() == 0
    with pytest.raises(ValueError):
        simhash.simhash_groups(documents(spark), bits=7)


def test_a_list_hands_on_few_links():
    rng = random.Random(5)
    prints = np.array(sorted({rng.getrandbits(6) << 20 for _ in range(500)}), np.uint64)
    to = simhash.list_links(np.zeros(len(prints), int), prints, np.zeros(len(prints), int), np.zeros(len(prints), bool), 4)
    assert (to[to] == to).all() and len(set(to.tolist())) == 1
