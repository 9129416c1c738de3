"""Exact consecutive numbering when one group holds a large share of the rows and spans several partitions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sprout.operators.ordering import consecutive_index


def test_hot_group_numbering_matches_row_number(spark):
    rows = [("hot", i * 7 % 1009) for i in range(600)] + [(f"g{g}", i) for g in range(12) for i in range(100)]
    df = spark.createDataFrame(rows, "grp string, pos int").repartition(5)
    got = consecutive_index(df, ["grp"], ["pos"], "idx", num_partitions=9)
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("grp").orderBy("pos")) - 1)
    j = got.join(want, ["grp", "pos"])
    assert j.count() == len(rows)
    assert j.where(F.col("idx") != F.col("want")).count() == 0
    # The hot group really was spread over several range partitions.
    parts = (df.select("grp", "pos").repartitionByRange(9, "grp", "pos")
             .where(F.col("grp") == "hot").select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_global_numbering_without_groups(spark):
    df = spark.createDataFrame([(i * 13 % 997,) for i in range(997)], "k int").repartition(4)
    got = consecutive_index(df, [], ["k"], "idx", num_partitions=6)
    assert got.where(F.col("idx") != F.col("k")).count() == 0
