"""Connected components of a link table as Spark joins (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmetrics.llm.store import drop, keep


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a row per link, any direction).

    Each step replaces links by links to the smallest neighbour, until every node of a component
    is linked to its smallest node alone. Steps are ~log(longest path). A node with very many links
    costs no more than its links: minima combine on the map side, joins are sort-merge joins that
    adaptive execution splits. Only a row count and a checksum reach the driver.
    """
    pair = links.where(F.col(a) != F.col(b))
    now = keep(pair.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = keep(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .where("u != v").distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after = keep(small.select("e.u", "e.v").where("u != v").distinct(), "links")
        drop(now, large)
        new = _state(after)
        now, done, state = after, new == state, new
        if done:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
