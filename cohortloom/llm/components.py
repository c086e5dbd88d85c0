"""Groups of rows that are linked, directly or over others."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom.session import settle


def component_roots(links: DataFrame) -> DataFrame:
    """``node, root`` for the nodes that have links: nodes that links lead to from one another share a root, one of
    them. ``links``: longs ``a, b``, in either direction, repeats allowed.

    Each round every node joins its smallest neighbour, the links are rewritten to what their ends joined, and links
    within one group go. A node that is not the smallest around disappears, so the links at least halve on chains
    and vanish at once on stars. All steps are joins of written tables; nothing is collected but one count a round.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    open_links = settle(both.where("a != b").distinct())
    roots = settle(open_links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
    while not open_links.isEmpty():
        near = open_links.groupBy("a").agg(F.min("b").alias("low"))
        joins = settle(near.select(F.col("a").alias("from"), F.least("a", "low").alias("to")))
        # Two steps at once: where one's smallest neighbour has itself joined another.
        onward = joins.select(F.col("from").alias("to"), F.col("to").alias("further"))
        joins = settle(joins.join(onward, "to", "left").select("from", F.coalesce("further", "to").alias("to")))

        def moved(df: DataFrame, column: str) -> DataFrame:
            to = joins.select(F.col("from").alias(column), F.col("to").alias("moved"))
            out = df.join(to, column, "left")
            return out.withColumn(column, F.coalesce("moved", column)).drop("moved")

        roots = settle(moved(roots, "root"))
        open_links = settle(moved(moved(open_links, "a"), "b").where("a != b").distinct())
    return roots
