"""Connected components by repeated stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.sources.staging import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component_id) of every node of ``links``; the id is the smallest node reachable.

    Alternates large stars (each neighbour above a node moves to the smallest
    node around) and small stars (each neighbour below does), until nothing
    moves. Rows per round stay at the number of links; a hub's neighbours are
    only joined with the hub's minimum, never with one another. Null ends and
    loops count as no link; an empty table gives an empty result.
    """
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        if large:
            lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            return both.join(lowest, "u").where("v > u").selectExpr("v as u", "m as v").where("u != v").distinct()
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(lowest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        return moved.where("u != v").distinct()

    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u != v")
        .distinct()
    )
    edges = stage(edges, "links")
    before = None
    while True:
        print_of = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if print_of == before or not print_of[0]:
            break
        before = print_of
        edges = stage(star(star(edges, True), False), "links")
    return (
        edges.selectExpr("u as node", "v as component_id")
        .union(edges.selectExpr("v as node", "v as component_id"))
        .distinct()
    )
