"""The keys that an ingested table has already, as sorted runs in buckets.

A run is a set of keys (hex digests) written in one go, in folders by key prefix; the prefix is as long as needed for a bucket of
``BUCKET_KEYS`` keys. A batch looks its keys up in the buckets of their prefixes only, so what it reads grows with the batch
and not with what was ingested before. ``FAN`` runs of one level are merged into one of the next, so the number of runs and the
times a key is written again grow with the logarithm of the history.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprout.session import broadcast_below
from sprout.sources import snapshots

BUCKET_KEYS = 100_000
FAN = 8
MAX_PREFIX = 4  # hex digits: 65,536 buckets
KEY_BYTES = 96


def prefix_digits(n_keys: int, bucket_keys: int) -> int:
    return min(MAX_PREFIX, max(0, math.ceil(math.log(max(1, n_keys / bucket_keys), 16))))


def write_run(keys: DataFrame, table: str, n_keys: int, level: int, bucket_keys: int = BUCKET_KEYS) -> dict:
    """Writes keys (one column ``key``) as one run of the table; the entry for its manifest."""
    digits = prefix_digits(n_keys, bucket_keys)
    folder = snapshots.new_folder(table, "keys")
    bucket = F.concat(F.lit("b"), F.substring("key", 1, digits))
    keys.select("key", bucket.alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(
        f"{table}/{folder}")
    return {"folder": folder, "digits": digits, "keys": n_keys, "level": level}


def known(spark: SparkSession, table: str, runs: list[dict], keys: DataFrame) -> DataFrame | None:
    """Keys of the runs in the buckets that ``keys`` (one column ``key``) touch; None without runs."""
    out = None
    prefixes: dict[int, list[str]] = {}
    for run in runs:
        digits = run["digits"]
        if digits not in prefixes:  # at most 16^digits
            rows = keys.select(F.substring("key", 1, digits).alias("p")).distinct().collect()
            prefixes[digits] = [f"b{r['p']}" for r in rows]
        own = spark.read.schema("key string, bucket string").parquet(f"{table}/{run['folder']}")
        own = own.where(F.col("bucket").isin(prefixes[digits])).select("key") if prefixes[digits] else own.limit(0).select("key")
        out = own if out is None else out.unionByName(own)
    return out


def unseen(spark: SparkSession, table: str, runs: list[dict], rows: DataFrame, key_col: str) -> DataFrame:
    """Rows whose key no run has."""
    keys = rows.select(F.col(key_col).alias("key"))
    old = known(spark, table, runs, keys)
    if old is None:
        return rows
    # the batch's own keys are few beside the buckets: they go to the buckets first, and only hits come back
    hits = old.join(broadcast_below(keys, KEY_BYTES), "key", "left_semi")
    return rows.join(hits.withColumnRenamed("key", key_col), key_col, "left_anti")


def merged(spark: SparkSession, table: str, runs: list[dict], bucket_keys: int = BUCKET_KEYS, fan: int = FAN) -> list[dict]:
    """The runs after all due merges; a merge writes a new run and leaves the old folders to readers of older versions."""
    level = 0
    while level <= max((r["level"] for r in runs), default=-1):
        own = [r for r in runs if r["level"] == level]
        if len(own) >= fan:
            keys = reduce(DataFrame.unionByName, [spark.read.schema("key string, bucket string").parquet(f"{table}/{r['folder']}") for r in own])
            whole = write_run(keys.select("key"), table, sum(r["keys"] for r in own), level + 1, bucket_keys)
            runs = [r for r in runs if r["level"] != level] + [whole]
        level += 1
    return runs
