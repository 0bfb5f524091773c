"""The corpus pipeline: toxic documents out, one of every group of near copies, no benchmark passages,
sources mixed to their shares, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of the documents, whatever
these are besides doc_id, text and source. Rows that share an id stay or go together; rows with a null
id take no part in the search for copies. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postquarry.llm import decontaminate, jaccard, mixing, tokens, toxicity
from postquarry.llm.common import free_name, store
from postquarry.llm.queries import END_ID, REST_SHARE, SHARES, TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5, by a model of the labelled ones among them."""
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"), docs)
    name = free_name(docs, "_toxicity")
    return toxicity.score_texts(docs, model, name=name).where(F.col(name)["score"] < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by 0.8 of their five-word shingles, the one with the smallest id."""
    groups = jaccard.jaccard_groups(docs, percent=80, n=5)
    return docs.join(groups.where("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    found = decontaminate.find_windows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)
    name = free_name(docs, "_hit")
    hit = found.where("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents in the order of the mix: files in order, rows in order within each."""
    mixed = mixing.mix_sources(docs, SHARES, rest_share=REST_SHARE)
    doc, at = free_name(docs, "_doc"), free_name(docs, "_place")
    place = mixed.groupBy(F.col("doc_id").alias(doc)).agg(F.min("mix_offset").alias(at))
    return (
        docs.join(place, F.col("doc_id").eqNullSafe(F.col(doc))).repartitionByRange(at, "doc_id")
        .sortWithinPartitions(at, "doc_id", "text").select(*docs.columns)
    )


def stored_order(docs: DataFrame) -> Column:
    """Place of a row in a folder of Parquet files: number of the part, of the file within it, of the row."""
    name = F.col("_metadata.file_name")
    number = lambda pattern: F.coalesce(F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).cast("long"), F.lit(0))
    return F.shiftleft(number(r"^part-(\d+)"), 40) + F.shiftleft(number(r"-c(\d+)"), 32) + F.col("_metadata.row_index")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order in which the documents are stored (that of ids, if they come from no files)."""
    folder = tokens.token_folder(spark)
    stored = bool(docs.inputFiles())
    tokens.write_tokens(docs, TOKENIZER, END_ID, folder, order=stored_order(docs) if stored else None)
    return tokens.digest_tokens(spark, folder)


STAGES = [
    ("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("decontamination", drop_contaminated),
    ("mixing", mix), ("tokens", write_tokens),
]

#: Scores, groups and token ids of the stages are not expressible in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
