"""Small tables with everything that real ones can hold."""

from __future__ import annotations

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LONG = " ".join(WORDS[k * k % 20] + str(k % 97) for k in range(40_000))
DDL = "doc_id long, text string, lang string, source string, word string, n int, key string, bucket int, _toxicity int, _hit int, _doc int, _place int"
TEXTS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "one TWO three four five six seven eight nine ten eleven twelve"),
    (3, ""), (4, None), (5, "   \n\t "), (6, "ÉTÉ İi ſK naïve   end"), (7, LONG), (8, LONG + " more"),
    (9, "idiot"), (9, "idiot"), (None, "one two three four five six seven eight nine ten eleven twelve"), (None, None),
    (10, "x"), (11, "x"), (12, "<|endoftext|> a  b \n c 's don't\t z"),
]


def documents(spark):
    rows = [(i, t, None, None if k % 3 == 0 else f"src{k % 4}", "w", k, "k", k, k, k, k, k) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DDL).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], DDL)
