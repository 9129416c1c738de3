"""The corpus pipeline: STAGES over ``documents``, each written as Parquet and read again as the next one's input.

1. quality rules: documents that the default policy rejects go;
2. exact dedup: one document of each group of equal texts stays;
3. near dedup by the n-gram Jaccard join: one document of each group of linked documents stays;
4. mixing: every document is emitted as often as its source's rate says;
5. BPE: token ids of every mixed document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sprout.llm import exact_dedup, mixing, ngram_join, quality_rules
from sprout.llm import queries as llm
from sprout.llm.common import documents, materialise


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return llm.bpe_digests(docs, with_ids=True)


STAGES = [("quality rules", rules), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed), ("bpe", tokens)]

# The last stage, BPE, has no SQL; tests hold the rows of run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{k + 1}")
    return docs
