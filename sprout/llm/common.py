"""Small helpers that the operators share: positional column picking, word rules, scratch tables, size-checked sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sprout.session import scratch_path

# A word is a run of characters other than these white-space characters.
SPACE_CLASS = "\\x20\\x09-\\x0D"
WORD_PATTERN = f"[^{SPACE_CLASS}]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"  # the bytes that ``bytes.split()`` splits at

# A side is broadcast only if this many bytes (rows x a stated row width) are not exceeded; beyond, it is shuffled.
BROADCAST_BYTES = 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Select columns by exact name (``out=name``); the first of repeated names, whatever other columns are called.

    Names differing only in case, or equal names, are told apart by position, so extra columns never clash.
    """
    at = {}
    for i, name in enumerate(df.columns):
        at.setdefault(name, i)
    missing = [c for c in wanted.values() if c not in at]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    own = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return own.select(*[F.col(f"c{at[c]}").alias(out) for out, c in wanted.items()])


def numbered(df: DataFrame, **wanted: str) -> tuple[DataFrame, list[str]]:
    """All columns renamed c0, c1, ... plus copies of the wanted ones; the second value restores the names."""
    names = df.columns
    own = df.toDF(*[f"c{i}" for i in range(len(names))])
    copies = [F.col(f"c{names.index(c)}").alias(out) for out, c in wanted.items()]
    return own.select("*", *copies), names


def restored(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def sized_side(df: DataFrame, row_bytes: int, limit: int | None = None) -> DataFrame:
    """Mark a materialised side for broadcast if its rows x ``row_bytes`` are below the limit; else leave the
    join to a shuffle (the same rows either way)."""
    n = df.count()
    return F.broadcast(df) if n * row_bytes <= (BROADCAST_BYTES if limit is None else limit) else df


def crc_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id's decimal text, mod ``m``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(m))
