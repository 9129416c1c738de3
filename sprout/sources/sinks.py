"""Sinks (S8-S10) and the two file-to-file jobs built on them (combine a label folder, T18 dataset mode).

Every sink writes a partitioned directory (one file per task); nothing is coalesced to one writer.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from sprout.operators import cleaning as cl
from sprout.operators import harmonize as hz
from sprout.sources import readers as rd

FORMATS = ("parquet", "csv")


def processed_path(output_dir: str, input_path: str, fmt: str) -> str:
    """``<output_dir>/processed_<stem>.<fmt>`` for an input file or directory."""
    stem = os.path.splitext(os.path.basename(input_path.rstrip("/")))[0]
    return os.path.join(output_dir, f"processed_{stem}.{fmt}")


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Parquet, or CSV with a header (UTF-8); ``partition_by`` writes one folder per value."""
    if fmt not in FORMATS:
        raise ValueError(f"out_format must be one of {FORMATS}, got {fmt!r}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        # Texts are written as they are, with the white space at their ends.
        (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        w.parquet(path)
    return path


def write_named_files(df: DataFrame, folder: str, stem: str, fmt: str = "csv") -> list[str]:
    """One file per partition of ``df``, called ``<stem><n>.<fmt>`` inside ``folder``, numbered in partition order."""
    spark = df.sparkSession
    folder = folder.rstrip("/")
    parts = write_dataset(df, f"{folder}/_{stem.strip()}", fmt)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for n, (path, _) in enumerate(rd.list_files(spark, parts, f".{fmt}")):
        named = f"{folder}/{stem}{n:05d}.{fmt}"
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(named)):
            raise OSError(f"cannot move {path} to {named}")
        out.append(named)
    return out


def combine_folder(spark: SparkSession, folder: str, out_name: str = "combined_wellness.csv",
                   text_col: str = "text") -> str:
    """S5 + H1-H8 + S9: every ``*.csv`` label file of ``folder`` (except the output) -> one de-duplicated CSV
    dataset ``<folder>/<out_name>`` (a directory of part files)."""
    frames = rd.read_label_files(spark, folder, exclude=out_name)
    combined = hz.combine(frames, text_col).drop("_file_rank", "_pos")
    return write_dataset(combined, os.path.join(folder, out_name), "csv")


def preprocess_dataset(spark: SparkSession, input_path: str, output_dir: str, text_col: str = "text",
                       out_col: str = "cleaned_text", drop_cols: list[str] | None = None,
                       out_format: str = "parquet", schema=None, **clean_kwargs) -> str:
    """Read (S3) -> clean ``text_col`` (T1-T14) -> drop ``drop_cols`` (H9, H10; the raw text is always
    dropped) -> write ``processed_<stem>`` (S8). Returns the output path."""
    if out_format not in FORMATS:
        raise ValueError(f"out_format must be one of {FORMATS}, got {out_format!r}")
    df = rd.read_dataset(spark, input_path, schema)
    drop = {text_col, "Unnamed: 0", "_c0", *(drop_cols or [])}
    keep = [c for c in df.columns if c not in drop]
    out = cl.clean(df, text_col, out_col, keep, **clean_kwargs).select(out_col, *keep)
    return write_dataset(out, processed_path(output_dir, input_path, out_format), out_format)
