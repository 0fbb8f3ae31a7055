"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import stored


def _linked_to_least(edges: DataFrame, both: bool) -> DataFrame:
    """Links the neighbours of each u to the least of them and u: the larger ones (both) or the smaller ones."""
    around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    linked = around.join(least, "u")
    if both:
        new = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return new.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(sums)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id of ``links``; the component is its least id.

    Links may repeat, be loops or hold NULLs (ignored).  Each round is stored, so lost executors cost one round; rounds
    grow with the logarithm of the longest path.  No links give no rows.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    edges = pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    before = _state(edges)
    while before[0]:
        edges = stored(_linked_to_least(_linked_to_least(edges, True), False), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
