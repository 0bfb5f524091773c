"""Random inputs against plain Python."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postquarry.operators import buckets as B
from postquarry.operators import filters as FL
from postquarry.operators import pick as PK
from postquarry.operators import stats as ST


@pytest.mark.parametrize("seed", [1, 2])
def test_positions_against_a_linear_search(spark, seed):
    """Very uneven buckets: one holds a third of all rows, many hold one."""
    rng = random.Random(seed)
    counts = [("en", b, n) for b, n in enumerate([500] + [rng.choice([1, 1, 2, 30]) for _ in range(200)])]
    rng.shuffle(counts)
    ordered = sorted(counts, key=lambda c: c[1])
    total = sum(n for _, _, n in counts)
    index = B.index_counts(spark.createDataFrame(counts, "lang STRING, bucket INT, n BIGINT"), "lang", ["bucket"])
    asked = [rng.randrange(-5, total + 5) for _ in range(400)] + [7] * 200
    want = []
    for position in asked:
        start = 0
        for _, bucket, n in ordered:
            if start <= position < start + n:
                want.append((position, bucket, position - start))
            start += n
    positions = spark.createDataFrame([("en", p) for p in asked], "lang STRING, position BIGINT")
    got = [(r["position"], r["bucket"], r["offset"]) for r in B.locate_positions(positions, index, stripe=rng.choice([3, 64, 1000])).collect()]
    assert sorted(got) == sorted(want)


def test_levels_against_counters(spark):
    rng = random.Random(3)
    rows = [("a" if rng.random() < 0.4 else f"a{rng.randrange(5)}", f"m{rng.randrange(4)}", rng.choice(["en", "de"]), rng.choice([None, "x"])) for _ in range(2000)]
    want = defaultdict(lambda: [0, 0])
    for archive, member, lang, reason in rows:
        for key in ((archive, member, lang), (archive, member, None), (archive, None, lang), (archive, None, None), (None, None, lang), (None, None, None)):
            want[key][0] += 1
            want[key][1] += reason is None
    df = spark.createDataFrame(rows, "archive STRING, member STRING, lang STRING, reject_reason STRING")
    got = {(r["archive"], r["member"], r["lang"]): [r["total"], r["accepted"]] for r in ST.hierarchy_counts(df, ["archive", "member"], reject_col="reject_reason").collect()}
    assert got == dict(want)


def test_first_k_against_sorting(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.4 else f"s{rng.randrange(9)}", rng.randrange(50), i) for i in range(3000)]
    want = set()
    groups = defaultdict(list)
    for slot, at, i in rows:
        groups[slot].append((at, i))
    for slot, members in groups.items():
        want |= {(slot, i, rank) for rank, (_, i) in enumerate(sorted(members)[:4])}
    df = spark.createDataFrame(rows, "slot STRING, at INT, id INT").repartition(7)
    assert {(r["slot"], r["id"], r["pos"]) for r in PK.first_k(df, ["slot"], ["at", "id"], 4, rank="pos").collect()} == want


def test_reasons_partition_the_rows(spark):
    df = spark.range(1000)
    rules = [("three", F.col("id") % 3 == 0), ("five", F.col("id") % 5 == 0), ("null", F.lit(None).cast("boolean"))]
    judged = FL.with_reject_reason(df, rules)
    got = {r["reason"]: r["n"] for r in FL.reject_counts(judged).collect()}
    assert got == {"three": 334, "five": 133, "accepted": 533}
    assert FL.accepted(judged).count() == 533
