from __future__ import annotations

import random
import re
import zlib

import numpy as np
from cases import WORDS, documents, nothing

import corpus_pipeline
from postquarry.llm.queries import TOKENIZER


def small_corpus(spark, folder):
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))
    docs = [[k, text(rng.randint(20, 80)), "en", f"src{k % 12}"] for k in range(240)]
    item = text(20)
    for k in range(0, 60, 2):
        docs[k][1] += " vrokalpha vrokbeta vrok" + rng.choice(WORDS)
    for k in (101, 103, 105):
        docs[k][1] = docs[61][1]
    docs[107][1] = docs[61][1] + " end"
    docs[111][1] += " " + " ".join(item.split()[3:15]) + " tail"
    docs.append([240, "", "en", None])
    docs.append([241, None, None, "src0"])
    ddl = "doc_id long, text string, lang string, source string"
    spark.createDataFrame([tuple(d) for d in docs], ddl).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k < 60 and k % 2 == 0)) for k in range(0, 240)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_pipeline_against_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer

    docs = small_corpus(spark, str(tmp_path))
    got = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()]
    gone = {*range(0, 60, 2), 101, 103, 105, 107, 111}
    assert {r[0] for r in got} == {d[0] for d in docs} - gone
    tokenizer, texts, start = Tokenizer.from_file(TOKENIZER), {d[0]: d[1] or "" for d in docs}, 0
    for doc, at, n, crc in got:
        ids = [*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 2]
        assert (at, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
    # The order is the mix: a source with a large share comes earlier than its ids alone would bring it.
    place = {r[0]: k for k, r in enumerate(got)}
    first = [place[d[0]] for d in docs if d[3] == "src0" and d[0] in place]
    other = [place[d[0]] for d in docs if d[3] == "src9" and d[0] in place]
    assert np.mean(first) <= np.mean(other)


def test_stages_keep_columns_and_take_odd_tables(spark, tmp_path):
    small_corpus(spark, str(tmp_path))
    for name, table in (("odd", documents(spark)), ("none", nothing(spark))):
        docs = table
        for k, (stage, run) in enumerate(corpus_pipeline.STAGES):
            out = run(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.dtypes == table.dtypes
            path = f"{tmp_path}/{name}-{k}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        assert name == "odd" or docs.count() == 0
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_clean_documents_stay(spark, tmp_path):
    docs = small_corpus(spark, str(tmp_path))
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d[0] for d in docs} - {101, 103, 105, 107}
    assert all(re.fullmatch(r"\w+", name) for name, _ in corpus_pipeline.STAGES)
