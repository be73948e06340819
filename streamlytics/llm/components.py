"""Connected components of links held in a table, by contraction, without a driver copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for each end of ``links`` (a, b: long, not null); root is a node of the
    component, the same for all of it. Each round points every node to its least neighbour,
    or itself, follows that pointer once more, and contracts the links to what the ends
    point to; the rounds end when no link is left, after a number that grows with the
    logarithm of a component's size."""
    links = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = nodes.withColumn("root", F.col("node"))
    while not links.isEmpty():
        ends = links.union(links.select("b", "a"))
        step = ends.groupBy(F.col("a").alias("u")).agg(F.least(F.col("u"), F.min("b")).alias("to"))
        hop = step.select(F.col("u").alias("v"), F.col("to").alias("next"))
        step = written(step.join(hop, F.col("to") == F.col("v")).select("u", F.col("next").alias("to")), "pointers")
        right = step.select(F.col("u").alias("u2"), F.col("to").alias("to2"))
        links = written(links.join(step, F.col("a") == F.col("u")).join(right, F.col("b") == F.col("u2"))
                        .select(F.col("to").alias("a"), F.col("to2").alias("b")).filter("a <> b").distinct(), "links")
        found = found.join(step, F.col("root") == F.col("u"), "left").select("node", F.coalesce("to", "root").alias("root"))
    return found
