"""L3: a labeller whose answers are kept: resumable, retried, with bounded calls at a time.

Every request is addressed by the sha256 of its payload. The ledger is a table of committed waves (``snapshots``): digest, response,
error, attempts. A run looks up which payloads have no response yet, each once however many requests carry it, and calls the
labeller for these alone, wave by wave: a run that is killed loses the wave it was in, the next one calls only what is
missing, and a run after that calls nothing. Inside a task up to ``concurrency`` calls are made at a time by threads; a call that
raises is tried again after a pause that doubles, and is a reject (``error``) after ``attempts`` tries. Rejects are called
again by the next run.

The wave of a payload follows from its digest, so waves are alike in size; a request without a payload has no response. Requests
with equal payloads share a response.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprout.sources import snapshots

WAVE = 20_000  # payloads called between two commits, about
LEDGER = "digest string, response string, error string, attempts int"


def with_digest(requests: DataFrame) -> DataFrame:
    return requests.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries of the committed waves."""
    return snapshots.read_snapshot(spark, ledger, schema=LEDGER)


def answers(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per payload that was called: its response if there is one (of several the first by text), else its last error by text."""
    rows = entries(spark, ledger).groupBy("digest")
    return rows.agg(F.min("response").alias("response"), F.max("error").alias("error"), F.sum("attempts").alias("attempts")).withColumn(
        "error", F.when(F.col("response").isNull(), F.col("error")))


def missing(requests: DataFrame, ledger: str) -> DataFrame:
    """(digest, payload) without a response, each once."""
    spark = requests.sparkSession
    own = with_digest(requests.select("payload").where(F.col("payload").isNotNull())).groupBy("digest").agg(F.min("payload").alias("payload"))
    done = entries(spark, ledger).where(F.col("response").isNotNull()).select("digest")
    return own.join(done, "digest", "left_anti")


def _caller(labeler: Callable[[list[dict]], list[dict]], concurrency: int, attempts: int, pause: float):
    def call(payload: str) -> tuple[str | None, str | None, int]:
        records = json.loads(payload)["records"]
        for k in range(1, attempts + 1):
            try:
                return json.dumps({"items": labeler(records)}, ensure_ascii=False), None, k
            except Exception as e:  # noqa: BLE001 - user code: tried again, then a reject
                error = f"{type(e).__name__}: {e}"
            if k < attempts:
                time.sleep(pause * 2 ** (k - 1))
        return None, error, attempts

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for frame in frames:
                for at in range(0, len(frame), 16 * concurrency):  # answers leave the task as they come
                    part = frame.iloc[at:at + 16 * concurrency]
                    got = list(pool.map(call, part["payload"]))
                    yield pd.DataFrame({"digest": part["digest"].to_numpy(), "response": [g[0] for g in got], "error": [g[1] for g in got],
                                        "attempts": [g[2] for g in got]})

    return run


def label_missing(requests: DataFrame, labeler: Callable[[list[dict]], list[dict]], ledger: str, *, concurrency: int = 5, attempts: int = 3,
                  pause: float = 1.0, partitions: int | None = None, wave: int = WAVE) -> int:
    """Calls the labeller (records to items, as ``labeling.label_batches``) for every payload without a response; the number called.

    Calls in flight: ``partitions`` (tasks) times ``concurrency`` at most."""
    spark = requests.sparkSession
    draft = f"{ledger}/{snapshots.new_folder(ledger, 'draft')}"
    missing(requests, ledger).write.parquet(draft)  # what this run calls, fixed before the first call
    todo = spark.read.parquet(draft)
    n = todo.count()
    waves = -(-n // wave)
    if partitions is None:
        partitions = spark.sparkContext.defaultParallelism
    for k in range(waves):
        part = todo.where(F.pmod(F.xxhash64("digest"), F.lit(waves)) == k).repartition(partitions, "digest")
        called = part.mapInPandas(_caller(labeler, concurrency, attempts, pause), LEDGER)
        version, _ = snapshots.manifest(spark, ledger)
        snapshots.append(called, ledger, f"wave-{version + 1}")
    return n


def responses(requests: DataFrame, ledger: str, group_col: str = "source") -> DataFrame:
    """(group, batch_id, response, error) of every request, as ``labeling.validate_responses`` takes them."""
    own = with_digest(requests).select(group_col, "batch_id", "digest")
    return own.join(answers(requests.sparkSession, ledger).select("digest", "response", "error"), "digest", "left").drop("digest")
