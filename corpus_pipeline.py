"""Corpus pipeline over ``documents``: each stage is one operator of ``barflow.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared checkpoint folder and reads them back as the
next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import jaccard, mixing, packing, queries, secret_scan, toxicity
from barflow.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon, learnt from the labels of ``sf_dir``, rejects go."""
    return toxicity.without_toxic(docs, queries.toxicity_lexicon(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of 5-shingle Jaccard links the document with the least id stays."""
    return jaccard.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; each secret in its text is masked."""
    return secret_scan.redact_texts(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn with probabilities that bring tokens to the target weights."""
    rows = docs.select(F.struct("*").alias("_document"), "doc_id", "source", "lang", "text")
    return mixing.mix_documents(rows).where("sampled").select("_document.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, queries.word_tokenizer())


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("secrets", mask_secrets),
          ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# The learnt lexicon, the components and the tokeniser are not expressible in SQL; tests use brute force.
ORACLE_SQL = None
