"""Structured Streaming jobs (W1-W3): incremental ingestion with keep-first dedupe, stream scoring, per-user
daily score.

Each job writes to one target and keeps its checkpoint with it (``<target>/_checkpoint`` unless named), so calling a job
again on the same target goes on where the last call stopped: batch ids continue, files read already are not read
again, and a batch that was cut off rewrites its own folder. ``trigger(availableNow=True)`` drains what is there
and stops. Paths go through Hadoop's file systems, so a target may be any URI that Spark can write.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprout.operators import harmonize as hz
from sprout.operators import scoring as sc
from sprout.session import scratch_path
from sprout.sources import snapshots
from sprout.streaming import keys


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = snapshots.hadoop(spark, path)
    return fs.exists(p)


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet file source (schema taken from the data once; a folder or a single file)."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    fs, p = snapshots.hadoop(spark, path)
    if fs.getFileStatus(p).isFile():
        return r.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())
    return r.parquet(path)


def _run(writer, target: str, checkpoint: str | None) -> None:
    where = checkpoint or f"{target.rstrip('/')}/_checkpoint"
    writer.option("checkpointLocation", where).trigger(availableNow=True).start().awaitTermination()


def stream_ingest(spark: SparkSession, source: DataFrame, key_col: str, order_col: str, text_col: str = "text",
                  target: str | None = None, checkpoint: str | None = None, bucket_keys: int = keys.BUCKET_KEYS, fan: int = keys.FAN) -> str:
    """Keep-first de-duplicated ingestion. Each micro-batch is trimmed, de-duplicated inside itself (first
    by ``order_col``) and freed of the texts that earlier batches wrote, by a ledger of their sha256 keys of which only the
    buckets of the batch's own keys are read (``keys``). Data, keys and merges of a batch take effect together by one
    manifest (``snapshots``); a replayed batch that is committed already does nothing. Read with ``read_ingested``.

    No streaming state is kept (``dropDuplicates`` without event time would grow forever)."""
    target = target or scratch_path(spark, "ingest")
    columns = list(dict.fromkeys([key_col, order_col, text_col]))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        version, content = snapshots.manifest(spark, target)
        if str(batch_id) in content["batches"]:
            return
        cleaned = hz.dedupe_keep_first(hz.trim_nonempty(batch.select(*columns), text_col), text_col, [order_col])
        cleaned = cleaned.withColumn("text_key", F.sha2(text_col, 256))
        folder, runs = snapshots.new_folder(target, "data"), content.get("runs", [])
        if runs:  # written once, then looked up and filtered
            draft = snapshots.new_folder(target, "draft")
            cleaned.write.parquet(f"{target}/{draft}")
            cleaned = keys.unseen(spark, target, runs, spark.read.parquet(f"{target}/{draft}"), "text_key")
        cleaned.select(*columns, "text_key").write.parquet(f"{target}/{folder}")
        new = spark.read.parquet(f"{target}/{folder}").select(F.col("text_key").alias("key"))
        n = new.count()
        if n:
            runs = keys.merged(spark, target, [*runs, keys.write_run(new, target, n, 0, bucket_keys)], bucket_keys, fan)
        snapshots.commit(spark, target, version, {"batches": content["batches"] | {str(batch_id): folder}, "runs": runs})

    _run(source.writeStream.foreachBatch(write_batch), target, checkpoint)
    return target


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The committed rows of ``stream_ingest``."""
    return snapshots.read_snapshot(spark, target)


def stream_score(spark: SparkSession, scored: DataFrame, target: str | None = None, checkpoint: str | None = None) -> str:
    """Stateless scoring stream into a parquet sink (file sink + checkpoint = exactly-once output)."""
    target = target or scratch_path(spark, "scored")
    _run(scored.writeStream.format("parquet").option("path", target).outputMode("append"), target, checkpoint)
    return target


DAILY_FAN = 8


def stream_daily(spark: SparkSession, events: DataFrame, type_to_label: dict[str, str], user_col: str = "user_id",
                 target: str | None = None, checkpoint: str | None = None, fan: int = DAILY_FAN) -> str:
    """Per-user daily score. Every micro-batch writes its integer sums and counts per (user, day) as a run of level 0; ``fan``
    runs of a level are added up to one of the next, so few runs are alive. A manifest names the live ones (``snapshots``);
    ``read_daily`` adds them up.

    Sums of whole numbers can be added in any order, so a row counts whenever it comes: no watermark, no state, and
    a backfill of old days is merged like any other batch. Event types without a label go to the table ``<target>/rejects``."""
    target = target or scratch_path(spark, "daily")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        snapshots.append(sc.unmapped_events(batch, type_to_label), f"{target}/rejects", str(batch_id))
        version, content = snapshots.manifest(spark, target)
        if batch_id <= content.get("last", -1):
            return
        known = sc.daily_inputs(batch.where(F.col("event_type").isin(*type_to_label)), type_to_label, user_col)
        levels, runs = dict(content.get("levels", {})), dict(content["batches"])

        def add(parts: DataFrame, level: int) -> None:
            folder = snapshots.new_folder(target, "daily")
            parts.write.parquet(f"{target}/{folder}")
            runs[folder], levels[folder] = folder, level

        add(known.groupBy(user_col, "day").agg(*sc.daily_aggs()), 0)
        level = 0
        while len(own := [f for f in runs if levels[f] == level]) >= fan:
            add(_added(spark.read.parquet(*[f"{target}/{f}" for f in own]), user_col), level + 1)
            for f in own:
                del runs[f], levels[f]
            level += 1
        snapshots.commit(spark, target, version, {"batches": runs, "levels": levels, "last": batch_id})

    _run(events.writeStream.foreachBatch(write_batch), target, checkpoint)
    return target


def _added(parts: DataFrame, user_col: str) -> DataFrame:
    sums = [c for c in parts.columns if c.startswith(("__s", "__c"))]
    return parts.groupBy(user_col, "day").agg(*[F.sum(c).alias(c) for c in sums])


def read_daily(spark: SparkSession, target: str, user_col: str = "user_id") -> DataFrame:
    """(user, day, score) from the partial sums of all batches of ``stream_daily``."""
    return _added(snapshots.read_snapshot(spark, target), user_col).select(user_col, "day", sc.daily_score().alias("score"))


def stream_windows(spark: SparkSession, events: DataFrame, type_to_label: dict[str, str], user_col: str = "user_id",
                   delay: dt.timedelta = dt.timedelta(days=1), target: str | None = None, checkpoint: str | None = None) -> str:
    """W3 by event time: one tumbling window per user and day, open until the watermark (latest event time of all batches so far less
    ``delay``) passes its end, then emitted once as ``final`` and forgotten. Rows of a window that was over before their batch came,
    and rows without a time, are not dropped: their sums are emitted as ``late``. Days are those of the session's time zone.

    A batch writes its final, late and open sums to one folder (``kind=...``); its manifest (``snapshots``) has the watermark,
    too, so a replayed batch does nothing and a killed one leaves nothing. The open sums of the newest folder are the state, open windows
    only. Every step is a keyed sum with a partial aggregate, so a user of a third of all rows costs one row a task."""
    target = target or scratch_path(spark, "windows")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        version, content = snapshots.manifest(spark, target)
        if batch_id <= content.get("last", -1):
            return
        mark = content.get("watermark")
        known = sc.daily_inputs(batch.where(F.col("event_type").isin(*type_to_label)), type_to_label, user_col)
        draft = f"{target}/{snapshots.new_folder(target, 'draft')}"
        known.groupBy(user_col, "day").agg(*sc.daily_aggs(), F.max(F.unix_millis(F.col("ts").cast("timestamp"))).alias("latest")).write.parquet(draft)
        parts = spark.read.parquet(draft)
        latest = parts.agg(F.max("latest")).first()[0]
        ahead = max([m for m in (mark, latest and latest - int(delay.total_seconds() * 1000)) if m is not None], default=None)
        end = F.unix_millis(F.date_add("day", 1).cast("timestamp"))
        over = F.lit(False) if mark is None else end <= mark
        late = F.col("day").isNull() | over
        sums = parts.drop("latest")
        still = _added(_open_windows(spark, target, content, sums).unionByName(sums.where(~late)), user_col)
        done = F.lit(False) if ahead is None else end <= ahead
        out = still.withColumn("kind", F.when(done, "final").otherwise("open")).unionByName(sums.where(late).withColumn("kind", F.lit("late")))
        folder = snapshots.new_folder(target, "windows")
        out.write.partitionBy("kind").parquet(f"{target}/{folder}")
        snapshots.commit(spark, target, version, {"batches": content["batches"] | {str(batch_id): folder}, "last": batch_id, "watermark": ahead,
                                                  "open": folder, "schema": sums.schema.json()})

    _run(events.writeStream.foreachBatch(write_batch), target, checkpoint)
    return target


def _open_windows(spark: SparkSession, target: str, content: dict, like: DataFrame) -> DataFrame:
    if "open" not in content:
        return like.limit(0)
    schema = T.StructType([*like.schema.fields, T.StructField("kind", T.StringType())])
    return spark.read.schema(schema).parquet(f"{target}/{content['open']}").where("kind = 'open'").drop("kind")


def read_windows(spark: SparkSession, target: str, user_col: str = "user_id", kind: str | None = None) -> DataFrame:
    """(user, day, score) of the emitted windows, late rows added; of ``kind`` 'final' or 'late' alone; or of the windows that are
    'open' now."""
    rows = window_sums(spark, target)
    rows = rows.where(F.col("kind") != "open") if kind is None else rows.where(F.col("kind") == kind)
    return _added(rows, user_col).select(user_col, "day", sc.daily_score().alias("score"))


def window_sums(spark: SparkSession, target: str) -> DataFrame:
    """(user, day, sums and counts, kind) of all committed batches; of open windows the newest."""
    _, content = snapshots.manifest(spark, target)
    schema = T.StructType([*T.StructType.fromJson(json.loads(content["schema"])).fields, T.StructField("kind", T.StringType())])
    out = None
    for folder in content["batches"].values():  # one folder has kinds of its own
        own = spark.read.schema(schema).parquet(f"{target}/{folder}")
        own = own if folder == content["open"] else own.where("kind <> 'open'")
        out = own if out is None else out.unionByName(own)
    return out
