"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discarded, stored

LINKS = 1 << 18   # links that one task contracts at least, so that few links don't make many small files


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node that has a link.

    Alternates two contractions until every node hangs on one smaller node that hangs on none: every node hangs its larger
    neighbours, then its smaller ones, on the smallest node it sees. Each step is a minimum by node, computed
    partly before the shuffle, and one join, which Spark splits where a node has very many links.
    Every step is stored, so a lost executor costs one step. Loops and repeated links are fine;
    a link with a null end is none.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(), "links")
    while True:
        tasks = 1 + edges.count() // LINKS
        # Every node and the smallest of itself and its neighbours; a node that hangs on another should have no other link.
        ends = edges.select(F.inline(F.array(
            F.struct(F.col("u").alias("n"), F.col("v").alias("m"), F.lit(1).alias("up")),
            F.struct(F.col("v").alias("n"), F.col("v").alias("m"), F.lit(0).alias("up")))))
        smallest = stored(ends.groupBy("n").agg(
            F.min("m").alias("m"), ((F.max("up") == 1) & (F.count("*") > 1)).alias("moves")).coalesce(tasks), "smallest")
        if smallest.filter("moves").isEmpty():
            return smallest.select(F.col("n").alias("node"), F.col("m").alias("component"))
        # Larger neighbours move there.
        large = stored(edges.join(smallest, edges["v"] == smallest["n"]).select("u", F.col("m").alias("v")), "links")
        # Smaller neighbours, and the node itself, move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        hung = joined.select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))))
        older, edges = [edges, smallest, large], stored(hung.filter("u != v").distinct().coalesce(tasks), "links")
        for table in older:
            discarded(table)
