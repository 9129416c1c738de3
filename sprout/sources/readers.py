"""Sources (S1-S7, S12 helpers): format dispatch, CSV as strings, label-file folders, latest file, lines."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprout.functions.text import unicode_trim


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Give CPU-heavy row work at least one partition per core.

    Only small inputs (fewer planned splits than the cluster's parallelism, e.g. one parquet row group) are
    repartitioned, by hash of ``key``; large inputs already arrive in thousands of splits and are left alone,
    so no shuffle is added at scale.
    """
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= par:  # the planned splits of a scan; no job is run for them
        return df
    return df.repartition(par, key) if key else df.repartition(par)


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Dispatch on suffix (.csv / .parquet / .pq); other suffixes raise ``ValueError``."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext == ".csv":
        r = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        if schema is not None:
            return r.schema(schema).csv(path)
        return r.option("inferSchema", True).csv(path)
    if ext in (".parquet", ".pq"):
        return spark.read.parquet(path)
    raise ValueError(f"cannot read {path!r}: its suffix must be .csv, .parquet or .pq")


def _csv_reader(spark: SparkSession, multi_line: bool):
    """Header, doubled quotes. ``multi_line`` lets a quoted field hold line ends, but then one file is one task; turn it
    off for large files without such fields, which are then split."""
    return spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')


def read_csv_strings(spark: SparkSession, paths: list[str] | str, columns: list[str] | None = None,
                     multi_line: bool = True) -> DataFrame:
    """CSV with every column a string and no NA parsing: an empty field stays ''."""
    r = _csv_reader(spark, multi_line)
    if columns is not None:
        r = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = r.csv(paths)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def _first_line(spark: SparkSession, path: str) -> str:
    """Header line of one file through the Hadoop file system (reads only the first line)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return (line or "").lstrip("\ufeff")


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[tuple[str, int]]:
    """(path, modification time) of the files in ``folder`` with ``suffix``, sorted by file name."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.endswith(suffix) and not name.startswith((".", "_")):
            out.append((st.getPath().toString(), st.getModificationTime()))
    return sorted(out, key=lambda x: os.path.basename(x[0]))


def read_label_files(spark: SparkSession, folder: str, exclude: str | None = None,
                     multi_line: bool = True) -> list[DataFrame]:
    """Every ``*.csv`` of a folder sorted by name (minus ``exclude``), read as strings.

    Files are grouped by header so the plan holds one scan per distinct header, not one per file. Each frame
    carries ``_file_rank`` (position of the file in name order) and ``_pos`` (row order inside the file: a
    multi-line CSV file is one unsplit partition, so a monotonically increasing id follows file order).
    """
    files = [f for f, _ in list_files(spark, folder, ".csv") if os.path.basename(f) != exclude]
    if not files:
        raise ValueError(f"No CSV files found in {folder}")
    rank = {f: i for i, f in enumerate(files)}
    groups: dict[str, list[str]] = {}
    for f in files:
        groups.setdefault(_first_line(spark, f), []).append(f)
    # Spark names a file by its path with URI escapes (a space is %20); the table holds the same form.
    escaped = [(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f).toUri().getRawPath(), i) for f, i in rank.items()]
    ranks = spark.createDataFrame(escaped, "_path string, _file_rank int")
    frames = []
    for _, paths in sorted(groups.items(), key=lambda kv: min(rank[p] for p in kv[1])):
        df = _csv_reader(spark, multi_line).csv(paths)
        df = df.select(
            *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns],
            F.regexp_replace(F.col("_metadata.file_path"), F.lit("^[a-z0-9]+:(//[^/]*)?(?=/)"), F.lit("")).alias("_path"),
            F.monotonically_increasing_id().alias("_pos"),
        )
        # File list is bounded by the folder listing held on the driver above. A file without a rank is an error.
        df = df.join(F.broadcast(ranks), "_path", "left")
        no_rank = F.raise_error(F.concat(F.lit("file without a rank: "), F.col("_path")))
        df = df.withColumn("_file_rank", F.coalesce("_file_rank", no_rank.cast("int"))).drop("_path")
        frames.append(df)
    return frames


def latest_file(spark: SparkSession, folder: str, prefix: str = "processed_") -> str | None:
    """Newest ``<prefix>*`` entry by modification time (top-1 over file metadata, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    best = None
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(prefix) and name.endswith((".parquet", ".csv")):
            if best is None or st.getModificationTime() > best[1]:
                best = (st.getPath().toString(), st.getModificationTime())
    return best[0] if best else None


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One text per line, blank lines skipped."""
    df = spark.read.text(path)
    return df.where(F.length(unicode_trim(F.col("value"))) > 0).select(F.col("value").alias("text"))
