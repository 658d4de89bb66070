"""From raw documents to a training mix, in five stages; each reads what the one before wrote.

quality rules -> one document of each near-duplicate group -> repeated passages cut out -> documents with benchmark
items out -> words of each source taken to its target. All stages but the last return the columns of documents.

Defined results: a document of null or empty text, or of fewer than 20 words, goes in the first stage; a null language or source is
one of its own; of equal or similar texts the one of the least doc_id stays, of rows with one id the first by text, and ids that are
null come last; an empty table of documents gives no rows, an empty one of labels no rejections beyond the base rule, an empty
benchmark removes nothing; columns beyond those of documents are kept as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, ngramjoin, quality, suffixdedup
from tessera.llm.common import documents, shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixdedup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mixing),
]

#: The stages are not expressible in SQL; tests/llm holds the rows of run() on a small fixture against a brute-force version, words taken up to the random choice.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{shared_dir(spark)}/tessera-stage-{k}-{uuid.uuid4().hex}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
