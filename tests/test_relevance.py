from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postquarry.operators import relevance as R
from postquarry.sources import files as S

TEXTS = [(1, "Forest and WATER, forest!"), (2, "forest only"), (3, "waterfall in the forests"), (4, "Fluß, Wälder; fluß"), (5, None), (6, "")]
WORDS = ["forest", "water", "Fluß", "wälder"]


@pytest.mark.parametrize("as_table", [False, True])
def test_words(spark, as_table):
    df = spark.createDataFrame(TEXTS, "id INT, text STRING")
    words = spark.createDataFrame([(w,) for w in [*WORDS, "Forest", ""]], "word STRING") if as_table else WORDS
    got = sorted((r["id"], r["words"], r["n_words"]) for r in R.match_words(df, ["id"], "text", words).collect())
    assert got == [(1, ["forest", "water"], 2), (4, ["fluß", "wälder"], 2)]
    assert sorted(r["id"] for r in R.match_words(df, ["id"], "text", words, 1).collect()) == [1, 2, 4]


def test_a_long_word_list_is_joined(spark):
    df = spark.createDataFrame(TEXTS, "id INT, text STRING")
    words = WORDS + [f"w{i}" for i in range(R.INLINE_WORDS)]
    assert sorted(r["id"] for r in R.match_words(df, ["id"], "text", words).collect()) == [1, 4]


def test_words_at_the_end_of_a_long_text_count(spark):
    df = spark.range(1).select("id", F.concat(F.repeat(F.lit("filler "), 200_000), F.lit("forest water")).alias("text"))
    assert R.match_words(df, ["id"], "text", WORDS).count() == 1


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    refs = rng.normal(size=(60, 6)).round(3)
    refs[31] = refs[7]  # equal vectors tie
    posts = rng.normal(size=(80, 6)).round(3)
    posts[0] = refs[7]
    ref_rows = [(f"{'h' if i % 4 == 0 else 'b'}_{i:02d}", "h" if i % 4 == 0 else "b", [float(x) for x in v]) for i, v in enumerate(refs)]
    post_rows = [(i, [float(x) for x in v]) for i, v in enumerate(posts)]
    return (
        ref_rows, post_rows,
        spark.createDataFrame(ref_rows, "ref_id STRING, label STRING, vec ARRAY<FLOAT>"),
        spark.createDataFrame(post_rows, "id INT, pv ARRAY<FLOAT>"),
    )


def brute_force(ref_rows, post_rows, k):
    want = set()
    for key, vector in post_rows:
        p = np.float64(np.float32(vector))
        scored = []
        for ref_id, label, ref in ref_rows:
            r = np.float64(np.float32(ref))
            scored.append((-round(float(p @ r / np.linalg.norm(p) / np.linalg.norm(r)), 12), ref_id, label))
        want |= {(key, rank + 1, s[1], s[2]) for rank, s in enumerate(sorted(scored)[:k])}
    return want


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "block_rows": 7}, {"broadcast_bytes": 0, "block_rows": 1000}])
def test_nearest_equals_brute_force(vectors, options):
    ref_rows, post_rows, refs, posts = vectors
    got = {(r["id"], r["rank"], r["ref_id"], r["label"]) for r in R.nearest(posts, "id", "pv", refs, 3, **options).collect()}
    assert got == brute_force(ref_rows, post_rows, 3)


def test_fewer_references_than_k(vectors):
    _, _, refs, posts = vectors
    assert R.nearest(posts.limit(2), "id", "pv", refs.limit(2), 3).count() == 4
    assert R.nearest(posts, "id", "pv", refs.limit(0), 3).count() == 0


def test_bots_have_no_human_neighbour(spark):
    sets = {
        "b": spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.8, 0.2])], "ref_id INT, vec ARRAY<DOUBLE>"),
        "h": spark.createDataFrame([(0, [0.0, 1.0])], "ref_id INT, vec ARRAY<DOUBLE>"),
    }
    refs = R.reference_set(sets)
    assert {r["ref_id"] for r in refs.collect()} == {"b_0", "b_1", "b_2", "h_0"}
    posts = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.1, 0.9])], "id INT, pv ARRAY<DOUBLE>")
    kept = R.drop_bots(posts, R.nearest(posts, "id", "pv", refs), "id")
    assert [r["id"] for r in kept.collect()] == [2]


def test_vector_files(spark, tmp_path):
    (tmp_path / "b.json").write_text("[[1.0, 2.0], [3.0, 4.0]]")
    got = sorted(map(tuple, S.read_vector_file(spark, str(tmp_path / "b.json"), "b").collect()))
    assert got == [("b_0", "b", [1.0, 2.0]), ("b_1", "b", [3.0, 4.0])]


def test_relevance_collection(spark, tmp_path):
    (tmp_path / "2022-02-en.jsonl").write_text(
        '[["repack-2022-02", "20220201", "en", "3"], {"id": 5, "text": "t"}, ["forest", "water"]]\n'
        '{"location": ["a", "b", "c", "1"], "post": {"id": 6}, "words": ["x"]}\n')
    got = S.read_relevance(spark, str(tmp_path)).collect()
    assert [r["words"] for r in got] == [["forest", "water"], ["x"]]
    assert got[0]["location"] == ["repack-2022-02", "20220201", "en", "3"] and '"id":5' in got[0]["post"].replace(" ", "")


def test_null_reference_vectors_are_left_out(spark, rows):
    posts = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "k int, v array<double>")
    refs = spark.createDataFrame([("a", "h", [1.0, 0.1]), ("b", "b", None), ("c", "b", [0.0, 1.0])], "ref_id string, label string, vec array<double>")
    got = R.nearest(posts, "k", "v", refs, k=2)
    assert [r[:3] for r in rows(got, "rank")] == [(1, 1, "a"), (1, 2, "c")]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("as_table", [False, True])
def test_a_row_without_a_hit_never_matches(spark, as_table):
    df = spark.createDataFrame([(1, "red sea"), (2, "blue"), (3, None)], "k INT, t STRING")
    words = spark.createDataFrame([("red",)], "word STRING") if as_table else ["red"]
    assert [tuple(r) for r in R.match_words(df, ["k"], "t", words, 0).collect()] == [(1, ["red"], 1)]


def test_rows_that_share_a_key_are_matched_each_for_short_and_long_lists(spark):
    rows = spark.createDataFrame([(1, "alpha beta"), (1, "gamma delta"), (2, "alpha gamma delta"), (3, "alpha beta"), (3, "alpha beta")], "id long, text string")
    words = ["alpha", "beta", "gamma", "delta"]
    for listed in (words, words + [f"w{k}" for k in range(400)], spark.createDataFrame([(w,) for w in words], "word string")):
        for least, want in ((3, [(2, 3)]), (2, [(1, 2), (1, 2), (2, 3), (3, 2), (3, 2)])):
            got = R.match_words(rows, ["id"], "text", listed, min_words=least)
            assert sorted((r["id"], r["n_words"]) for r in got.collect()) == want


def test_posts_without_a_vector_stay(spark):
    posts = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)], "id long, pv array<double>")
    refs = spark.createDataFrame([("a", "h", [1.0, 0.0]), ("b", "b", [0.0, 1.0])], "ref_id string, label string, vec array<double>")
    kept = R.drop_bots(posts, R.nearest(posts, "id", "pv", refs, k=1), "id")
    assert sorted(r["id"] for r in kept.collect()) == [1, 3]


def test_a_repeated_run_leaves_its_rows_once(spark, tmp_path):
    from postquarry.sinks import tables as K

    def rows(*ids):
        return spark.createDataFrame([([str(i)], f"post {i}", ["w"], "en" if i % 2 else "de", i) for i in ids], "location array<string>, post string, words array<string>, lang string, day int").withColumn(
            "ts", F.expr("timestamp_ntz'2022-01-30 00:00:00' + make_dt_interval(day)")).drop("day")

    path = str(tmp_path / "relevant")
    for run, found in (("a", rows(1, 2, 3)), ("b", rows(4, 5)), ("a", rows(1, 3))):
        K.write_relevant(found, path, "ts", run=run)
    assert sorted(r["post"] for r in S.read_relevance(spark, path).collect()) == ["post 1", "post 3", "post 4", "post 5"]


def test_cosines_are_held_a_few_rows_at_a_time():
    import tracemalloc

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    refs = rng.normal(size=(20_000, 8))
    refs /= np.linalg.norm(refs, axis=1, keepdims=True)
    posts = pd.Series(list(rng.normal(size=(600, 8))))
    tracemalloc.start()
    found = R._neighbours(pd.Series(range(600)), posts, np.arange(20_000), np.full(20_000, "h"), refs, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 1_800
    assert peak < 40 << 20
