"""Records that are one thing because they are linked, directly or over others.

Links of the strongest kind are followed first; what they join is one node for the next kind. So a group knows the
weakest kind of link it needs to hold together, and links that only confirm what stronger ones joined do not weaken it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.operators.joins import left_join_spread
from plumbline.sources.raw import materialise


def _stars(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node it is connected with.

    Two steps alternate until nothing changes: the larger neighbours of a node, then its smaller ones, are linked to
    the smallest node it knows. A round never makes more links than there were, and links of a long chain halve from
    round to round. Every round is written, so a lost executor costs that round at most.
    """
    def hooked(neighbours: DataFrame, move: DataFrame) -> DataFrame:
        least = neighbours.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        return move.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "links")
    state = mark(edges)
    while state[0]:
        both = edges.selectExpr("a as u", "b as v").unionByName(edges.selectExpr("b as u", "a as v"))
        large = materialise(hooked(both, both.filter("v > u")).distinct(), "links_large")
        down = large.selectExpr("a as u", "b as v")
        least = down.groupBy("u").agg(F.min("v").alias("v")).selectExpr("u as a", "v as b")
        edges = materialise(hooked(down, down).unionByName(least).distinct(), "links_small")
        before, state = state, mark(edges)
        if state == before:
            break
    return edges.selectExpr("a as node", "b as root")


def linked_groups(records: DataFrame, name: str, identifiers: list[tuple[str, float]]) -> DataFrame:
    """Add group_key, the smallest `name` of the group; group_confidence, that of the weakest kind of link the group
    needs; and group_size.

    identifiers: (column, confidence), strongest first; records with the same value in it are linked, a null links
    nothing. A record linked to none is a group of its own with confidence 1. `name` is unique and not null.
    """
    state = records.withColumns({"__root": F.col(name), "__conf": F.lit(1.0)})
    for column, confidence in identifiers:
        state = materialise(state, "linked_records")
        # the smallest node of each value stands for it: as many links as records, however many share a value
        hubs = state.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("__value")).agg(F.min("__root").alias("__hub"))
        links = state.filter(F.col(column).isNotNull()).join(hubs, F.col(column) == F.col("__value")).select(F.col("__root").alias("a"), F.col("__hub").alias("b"))
        roots = materialise(_stars(links), "link_roots")
        # the root itself is no node of the table, but its confidence falls with the others'
        joined = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).select(F.col("node").alias("__node"), F.col("root").alias("__new"))
        state = left_join_spread(state, joined, ["__root"], ["__node"]).withColumns({
            "__conf": F.when(F.col("__new").isNotNull(), F.lit(confidence)).otherwise(F.col("__conf")),
            "__root": F.coalesce("__new", "__root"),
        }).drop("__new")
    state = materialise(state, "linked_records")
    sizes = state.groupBy(F.col("__root").alias("__r")).agg(F.count("*").alias("group_size"), F.min("__conf").alias("group_confidence"))
    out = left_join_spread(state, sizes, ["__root"], ["__r"])
    return out.withColumnRenamed("__root", "group_key").drop("__conf")
