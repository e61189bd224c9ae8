"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.storage import stash


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (id, component_id) of every id that has a link; component_id is the smallest id reachable.

    Each step only groups links by an end and keeps one row per link, so a hub with very many links is combined inside
    the tasks before the shuffle, and adaptive execution can split it in the join. Steps are written to the shared folder. Their
    number grows with the logarithm of the longest chain; links that already are stars to their smallest id need one.
    NULL ends and self-links are dropped, repeated links count once.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).distinct()
    edges, mark = _written(edges)
    while True:
        # large star: neighbours above u go to u's smallest neighbour
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u's smaller neighbours, and u, go to the smallest of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        lower = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, found = _written(lower.union(least.select("u", F.col("m").alias("v"))).distinct())
        if found == mark:
            break
        mark = found
    roots = edges.groupBy("u").agg(F.min("v").alias("component_id"))
    return roots.select(F.col("u").alias("id"), "component_id").union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    )


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = stash(edges, "components")
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return edges, tuple(row)
