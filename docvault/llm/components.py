"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import stored, tasks_for

#: Edges that one task of a round contracts, where there are many.
EDGES = 100_000


def contracted(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction: every node's neighbours are joined to the least node among them and it.

    The large one moves the neighbours above the node, the small one those below it. The least
    neighbour is found by an aggregation with partial results, and the join that hands it out
    is split by Spark where one node has very many edges.
    """
    if small:
        sides = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    else:
        sides = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
    least = sides.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    moved = sides.join(least, "node")
    if small:
        links = moved.select(F.col("other").alias("b"), F.col("least").alias("a")).unionAll(
            least.select(F.col("node").alias("b"), F.col("least").alias("a"))
        )
    else:
        links = moved.where(F.col("other") > F.col("node")).select(
            F.col("other").alias("b"), F.col("least").alias("a")
        )
    return links.where("a <> b").select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node, component` for every node of `edges(a, b)`; the component is its least node.

    Contracts until the edges are stars around the least nodes; the number of rounds grows with
    the logarithm of the longest path. Each round is stored in the shared scratch folder, in tasks
    that go by the number of edges, which no round raises.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    tasks = tasks_for(edges.sparkSession, edges.count(), EDGES)
    while True:
        # Stars: no node is both a centre and a leaf, and no leaf has two centres.
        leaves = edges.groupBy("b").agg(F.count("a").alias("n"))
        centres = edges.select(F.col("a").alias("b")).distinct()
        tangled = leaves.join(centres.withColumn("centre", F.lit(True)), "b", "left")
        if tangled.where("n > 1 OR centre").coalesce(tasks).isEmpty():
            break
        large = stored(contracted(edges, small=False), "large-star", tasks)
        edges = stored(contracted(large, small=True), "small-star", tasks)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
