"""Connected components of an edge table, by alternating large and small stars.

Each round replaces the edges by edges to the least neighbour. The neighbourhood of a
vertex is only ever reduced to its minimum (partial aggregation) and joined back, so a
vertex with very many neighbours is never gathered in one place. Rounds are written
tables; the driver sees of each whether all components are stars.
"""

from pyspark.sql import functions as F

from paperloom.llm.runtime import written


def _star(edges, large):
    """Each vertex sends its neighbours, larger or not larger ones, to the least of all."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lower = both.where("b < a") if not large else both
    least = lower.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    if large:
        found = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        found = lower.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        found = found.union(least.select("a", F.col("m").alias("b")))
    return found.where("a <> b").distinct()


def _unfinished(edges):
    """Whether any vertex has two parents, or a parent and a child: then these are no stars yet."""
    ends = edges.select(F.col("a").alias("vertex"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
    ends = ends.union(edges.select(F.col("b").alias("vertex"), F.lit(0), F.lit(1)))
    seen = ends.groupBy("vertex").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return not seen.where("child + parent > 1 and child > 0").isEmpty()


def connected(edges):
    """(vertex, root) for every vertex with an edge; the root is the least vertex reachable.

    `edges` has two long columns a and b; direction, repeats and loops do not matter.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while _unfinished(edges):
        edges = written(_star(_star(edges, large=True), large=False))
    found = edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return found.union(edges.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
