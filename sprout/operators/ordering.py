"""Exact consecutive row numbers without a single-task window.

``row_number().over(Window.partitionBy(g).orderBy(o))`` puts a whole group in one task; a source holding a
third of all rows would then run on one core. Here the rows are range-partitioned by ``(group, order)``, numbered
inside each partition, and shifted by the row counts of the earlier partitions of the same group (a small
table of at most partitions x groups-per-partition rows, broadcast behind a check of its size).

The rows themselves pass through the exchange, so none is joined back: null groups and null order values are kept (a
null group is a group, nulls sort first) and rows with equal keys each get a number of their own. The numbered
partitions are checkpointed to the shared folder before they are read twice: partition ids come from a sampled
range partitioner, and counts and rows must see the very same partitioning, also after an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sprout.session import broadcast_below, shared_dir


def consecutive_index(df: DataFrame, group_cols: list[str], order_cols: list[str], out_col: str = "idx",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 0-based position of the row inside its group in ``order_cols`` order.

    Ties are numbered in any order. Every row of ``df`` is returned once.
    """
    spark = df.sparkSession
    shared_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    tagged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = tagged.groupBy("__pid", *group_cols).agg(F.min("__mid").alias("__m0"), F.count(F.lit(1)).alias("__cnt"))
    frame = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    w = frame.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))
    offsets = offsets.select(F.col("__pid").alias("__opid"), "__m0", "__off",
                             *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group_cols)])
    same = F.col("__pid") == F.col("__opid")
    for i, g in enumerate(group_cols):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    numbered = tagged.join(broadcast_below(offsets.checkpoint(eager=True), 128), same)
    return numbered.select(*[F.col(c) for c in df.columns],
                           (F.col("__mid") - F.col("__m0") + F.col("__off")).alias(out_col))
