"""Readers for the driver's parquet tables and shared query inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprout.sources.readers import spread

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


# Text tables whose rows carry CPU-heavy work (tokenising, cleaning) and their key.
TEXT_KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in TEXT_KEYS:
        df = spread(df, TEXT_KEYS[name])
    return df


# Text suffix appended per document to exercise rules the generated prose lacks (emoji, contractions, URLs,
# mentions, kept punctuation, numbers). The same SQL expression runs in Spark and in DuckDB; no row is dropped.
RULES_SUFFIX_SQL = (
    "CASE doc_id % 4 "
    "WHEN 0 THEN concat(' \U0001F602\U0001F602 I didn', chr(39), 't go!! see https://a.b/c') "
    "WHEN 1 THEN ' ❤️❤️ \U0001F60A wow... @joe_1 www.x.y 10,000 ten' "
    "WHEN 2 THEN ' !?! , ! couldn’t 1st \U0001F602 the \U0001F602 \U0001F6FF \U0001F602' "
    "ELSE '' END"
)
RULES_TEXT_SQL = f"concat(coalesce(text, ''), {RULES_SUFFIX_SQL})"


def documents_with_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents(doc_id, text) with the rules suffix appended (whole table)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.expr(RULES_TEXT_SQL).alias("text"))


# Short wellness sentences appended per document so the built-in lexicon labeller has something to find in the
# generated prose. Same expression in Spark and DuckDB; every document is kept.
WELLNESS_SUFFIX_SQL = (
    "CASE doc_id % 6 "
    "WHEN 0 THEN ' I went for a run and felt happy' "
    "WHEN 1 THEN ' stress about debt and bills, worried and drained' "
    "WHEN 2 THEN ' dinner with family and friends, then a movie' "
    "WHEN 3 THEN ' tired and sad, sick all week, lonely at work' "
    "WHEN 4 THEN ' got a bonus at my job! I will volunteer and pray' "
    "ELSE '' END"
)
WELLNESS_TEXT_SQL = f"concat(coalesce(text, ''), {WELLNESS_SUFFIX_SQL})"


def documents_with_wellness(spark, sf_dir: str):
    """documents(doc_id, source, text) with the wellness suffix appended (whole table)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "source", F.expr(WELLNESS_TEXT_SQL).alias("text"))
