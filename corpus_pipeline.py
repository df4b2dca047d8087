"""The corpus pipeline: quality, near duplicates, personal data, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
kept; all but the last return the columns of documents. Stages keep rows of null
ids and any other columns. The last returns (doc_id, n_tokens, ids, ids_sha256,
decoded_sha256), a row for each document that the mix takes, as often as it does.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.bpe import bpe_decode, bpe_encode
from tidewright.llm.mixing import mixed
from tidewright.llm.ngram_join import ngram_jaccard_join
from tidewright.llm.pii import replace_pii
from tidewright.llm.quality import good_documents
from tidewright.llm.queries import PII_KEY
from tidewright.store import col, free_name, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the documents that are there."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, that of the least id; of rows of that id, those that are alike in id and text become one."""
    drop, again, mark = (free_name(x, docs.columns) for x in ("component_dropped", "id_repeated", "text_md5"))
    found = ngram_jaccard_join(docs.select("doc_id", "text"))
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias(drop)).distinct()
    kept = docs.join(gone, F.col("doc_id") == col(drop), "left_anti")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias(mark)).where(col(mark) > 1).select(F.col("doc_id").alias(again))
    if not repeated.limit(1).count():
        return kept.select(*[col(c) for c in docs.columns])
    several = F.col("doc_id") == col(again)
    ones = kept.join(repeated, several, "left_semi").withColumn(mark, F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-"))).dropDuplicates(["doc_id", mark])
    return kept.join(repeated, several, "left_anti").unionByName(ones.drop(mark)).select(*[col(c) for c in docs.columns])


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates stand in place of personal data; n_chars counts the new text."""
    out = replace_pii(docs, PII_KEY)
    found = col(out.columns[-1])
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(found > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[col(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe_decode(bpe_encode(docs, vocabulary), vocabulary)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("mixing", mixing),
    ("byte_level_bpe", byte_level_bpe),
]

#: Classifier, join and encoder can't be said in SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
