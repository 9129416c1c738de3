"""Connected components of a link table by rounds of hooking, as equi-joins and partial aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprout.llm.common import materialise


def _via(rows: DataFrame, col: str, table: DataFrame) -> DataFrame:
    """Replace ids of a column by their entry (node -> up), where there is one."""
    t = table.select(F.col("node").alias("t_node"), F.col("up").alias("t_up"))
    return (rows.join(t, F.col(col) == F.col("t_node"), "left")
            .withColumn(col, F.coalesce("t_up", col)).drop("t_node", "t_up"))


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (doc, component): the smallest id reachable, for every id that has a link to another one.

    In each round every node with a smaller neighbour hooks to its smallest one; the forest is flattened by pointer
    jumping, links are rewritten to roots, and loops and repeats go. A node with very many links costs one row per map
    task in the aggregation. Every round is written to the shared folder.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "cc-links")
    labels = materialise(edges.select(F.col("a").alias("doc")).union(edges.select("b")).distinct()
                         .withColumn("component", F.col("doc")), "cc-labels")
    while edges.limit(1).count():
        forest = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")), "cc-forest")
        while True:
            above = forest.select(F.col("node").alias("t_node"), F.col("up").alias("t_up"))
            jumped = materialise(forest.join(above, F.col("up") == F.col("t_node"), "left")
                                 .select("node", F.coalesce("t_up", "up").alias("up"), F.col("t_up").isNotNull().alias("moved")), "cc-forest")
            forest = jumped.select("node", "up")
            if not jumped.filter("moved").limit(1).count():
                break
        edges = materialise(_via(_via(edges, "a", forest), "b", forest)
                            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                            .filter("a <> b").distinct(), "cc-links")
        labels = materialise(_via(labels, "component", forest), "cc-labels")
    return labels
