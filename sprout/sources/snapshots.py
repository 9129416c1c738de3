"""A table of appended batches that readers can trust.

Each batch is written to a folder of its own; it belongs to the table once a manifest names it. A manifest is one small JSON file per
version that lists everything alive (data folders by batch, and whatever its writer keeps), made by renaming a finished file into
place, so a reader sees the last version or the one before and never a half-written batch. A batch that was cut off leaves a
folder that no manifest names; running it again writes another, and a batch that is committed already is not written twice. One
writer at a time: a version that another writer has made meanwhile is an error.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifest"


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path or URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, table: str) -> list[int]:
    fs, p = hadoop(spark, f"{table}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit())


def manifest(spark: SparkSession, table: str) -> tuple[int, dict]:
    """(version, content) of the newest manifest; (-1, empty) of a table without one."""
    versions = _versions(spark, table)
    if not versions:
        return -1, {"batches": {}}
    fs, p = hadoop(spark, f"{table}/{MANIFESTS}/{versions[-1]:012d}.json")
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return versions[-1], json.loads(text)


def commit(spark: SparkSession, table: str, after: int, content: dict) -> int:
    """Makes ``content`` the manifest that follows version ``after``."""
    fs, folder = hadoop(spark, f"{table}/{MANIFESTS}")
    fs.mkdirs(folder)
    _, draft = hadoop(spark, f"{table}/{MANIFESTS}/_{uuid.uuid4().hex}")
    _, final = hadoop(spark, f"{table}/{MANIFESTS}/{after + 1:012d}.json")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {after + 1} of {table} was made by another writer")
    return after + 1


def new_folder(table: str, kind: str) -> str:
    """Name, inside the table, of a folder that no other attempt uses."""
    return f"{kind}/{uuid.uuid4().hex}"


def read_snapshot(spark: SparkSession, table: str, version: int | None = None, schema: str | None = None) -> DataFrame:
    """Rows of the committed batches, of the newest version or of an older one."""
    if version is None:
        _, content = manifest(spark, table)
    else:
        fs, p = hadoop(spark, f"{table}/{MANIFESTS}/{version:012d}.json")
        stream = fs.open(p)
        try:
            content = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
    folders = [f"{table}/{f}" for f in content["batches"].values()]
    if not folders:
        if schema is None:
            raise ValueError(f"{table} has no committed batch")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*folders)


def append(df: DataFrame, table: str, batch: str) -> bool:
    """Writes one batch and commits it; False if the batch is there already."""
    spark = df.sparkSession
    version, content = manifest(spark, table)
    if batch in content["batches"]:
        return False
    folder = new_folder(table, "data")
    df.write.parquet(f"{table}/{folder}")
    commit(spark, table, version, content | {"batches": content["batches"] | {batch: folder}})
    return True
