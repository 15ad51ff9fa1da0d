"""Connected components of a table of links, by stars.

Each round replaces the links of every node by links to the smallest node it knows (first for the
larger neighbours, then for the smaller ones). The number of links never grows and a few rounds
leave one star per component. Rounds end when the links stay the same; each is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.shared import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _towards_smallest(links: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Links of each u to m, the smallest of u and its neighbours, for u and each neighbour."""
    smallest = stored(neighbours.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "smallest")
    return links.join(smallest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node of its component."""
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(links, "links")
    state = _state(links)
    while True:
        both = links.selectExpr("a u", "b v").unionByName(links.selectExpr("b u", "a v"))
        large = stored(_towards_smallest(both.filter("v > u"), both).distinct(), "large-star")
        down = large.selectExpr("a u", "b v")
        small = _towards_smallest(down, down).unionByName(
            down.groupBy("u").agg(F.min("v").alias("b")).selectExpr("u a", "b")
        )
        links = stored(small.distinct(), "small-star")
        before, state = state, _state(links)
        if state == before:
            roots = links.select("b").distinct()
            return links.selectExpr("a node", "b root").unionByName(roots.selectExpr("b node", "b root"))
