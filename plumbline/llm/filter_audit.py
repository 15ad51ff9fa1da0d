"""How filters interact: what each of them removes in every order they can be applied in.

A document's failures of all filters are a mask. Of a part (a language, say) the documents are counted by mask
in Spark; a decision diagram holds these counts. A level of the diagram is a filter, a node has an edge for
passing and one for failing it, a leaf the documents counted. Nodes with the same level and children are one
node; where nothing fails or passes the edge goes to the empty leaf. A node's weight is what lies below it.

An order of the filters is an order of the levels. All orders are met by swapping two neighbouring levels at a
time, which remakes the nodes of these two levels only. In each order the path of those that pass everything
tells the steps: the failing edge at a level leads to what that step removes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.shared import stored, text_of, words_of

FILTERS = "ABCDE"
SYMBOLS = r"[#$%&*|]"
EMPTY = 0


class Diagram:
    """Of counts by mask; a count is a tuple of numbers (documents, good, toxic). Bit i of a mask: filter i fails."""

    def __init__(self, filters: str, counts: dict[int, tuple[int, ...]]):
        self.order, self.nodes, self.known = list(filters), [None], {}
        self.width = len(next(iter(counts.values()), (0, 0, 0)))
        self.weights = [(0,) * self.width]
        level = [self._leaf(counts.get(mask)) for mask in range(1 << len(filters))]
        for bit in reversed(range(len(filters))):  # the last level first: masks that differ in its bit only
            level = [self._node(filters[bit], level[m], level[m | 1 << bit]) for m in range(1 << bit)]
        self.root = level[0]

    def _add(self, key: tuple, weight: tuple[int, ...]) -> int:
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.nodes)
            self.nodes.append(key)
            self.weights.append(weight)
        return at

    def _leaf(self, counts: tuple[int, ...] | None) -> int:
        return self._add(("leaf", *counts), tuple(counts)) if counts and any(counts) else EMPTY

    def _node(self, name: str, passed: int, failed: int) -> int:
        if passed == failed == EMPTY:
            return EMPTY
        return self._add((name, passed, failed), tuple(a + b for a, b in zip(self.weights[passed], self.weights[failed])))

    def edges(self, node: int) -> tuple[int, int]:
        """The nodes for passing and failing."""
        return self.nodes[node][1:] if node != EMPTY else (EMPTY, EMPTY)

    def swap(self, at: int) -> None:
        """Exchange the levels at and at + 1; levels above are remade, those below stay."""
        upper, lower = self.order[at], self.order[at + 1]
        done: dict[int, int] = {}

        def remade(node: int, depth: int) -> int:
            if node == EMPTY:
                return EMPTY
            if node not in done:
                passed, failed = self.edges(node)
                if depth < at:
                    done[node] = self._node(self.order[depth], remade(passed, depth + 1), remade(failed, depth + 1))
                else:
                    (a, b), (c, d) = self.edges(passed), self.edges(failed)
                    done[node] = self._node(lower, self._node(upper, a, c), self._node(upper, b, d))
            return done[node]

        self.root = remade(self.root, 0)
        self.order[at], self.order[at + 1] = lower, upper

    def failing(self) -> dict[str, int]:
        """Documents failing each filter, whatever else they fail."""
        totals, level = dict.fromkeys(self.order, 0), {self.root: 1}
        for name in self.order:
            below: dict[int, int] = {}
            for node, paths in level.items():
                passed, failed = self.edges(node)
                totals[name] += paths * self.weights[failed][0]
                for child in (passed, failed):
                    below[child] = below.get(child, 0) + paths
            level = below
        return totals

    def steps(self) -> Iterator[tuple]:
        """(filter, kept, removed here, failing only it) at each level of the path that passes everything."""
        node = self.root
        for i, name in enumerate(self.order):
            passed, failed = self.edges(node)
            only = failed
            for _ in self.order[i + 1 :]:
                only = self.edges(only)[0]
            yield name, self.weights[passed], self.weights[failed], self.weights[only][0]
            node = passed


def neighbour_swaps(n: int) -> Iterator[int]:
    """Places to swap with the next, so that all orders of n are met one after another, each once."""
    order, heading = list(range(n)), [-1] * n
    while True:
        free = [i for i in range(n) if 0 <= i + heading[order[i]] < n and order[i] > order[i + heading[order[i]]]]
        if not free:
            return
        i = max(free, key=lambda i: order[i])
        x, j = order[i], i + heading[order[i]]
        order[i], order[j] = order[j], order[i]
        heading = [-h if k > x else h for k, h in enumerate(heading)]
        yield min(i, j)


def all_orders(filters: str, counts: dict[int, tuple[int, int, int]]) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), sorted."""
    diagram = Diagram(filters, counts)
    failing, rows, share = diagram.failing(), [], dict.fromkeys(filters, 0)

    def note() -> None:
        order = "".join(diagram.order)
        for step, (name, kept, removed, only) in enumerate(diagram.steps(), 1):
            share[name] += removed[0]
            rows.append((order, step, kept[0], removed[0], failing[name] - removed[0], only, removed[1], removed[2]))

    note()
    for at in neighbour_swaps(len(filters)):
        diagram.swap(at)
        note()
    assert len(rows) == factorial(len(filters)) * len(filters)
    return sorted((*r, share[r[0][r[1] - 1]]) for r in rows)


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask, first) of each row: the failures of filters A to D; whether the row's id is the smallest of
    its text's, which filter E keeps. A null id is no id: it is not smaller than others, nor are others than it."""
    text = text_of(text_col)
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"), words_of(text).alias("words"),
    )
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    fails = [
        F.size("words") < 200,
        100 * F.size(F.array_distinct("words")) < 50 * F.size("words"),
        100 * capitals > 3 * F.length("text"),
        F.col("text").rlike(SYMBOLS),
    ]
    mask = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails[1:], 1)), fails[0].cast("int"))
    rows = stored(own.select("doc_id", "part", "sha", mask.alias("mask")), "failure-masks")
    # one id per text, found before the shuffle for the most part; joined by the id, so copies do not meet in one task
    firsts = rows.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null").withColumn("first", F.lit(True))
    marked = rows.join(firsts, ["doc_id", "sha"], "left")
    return marked.select("doc_id", "part", "mask", F.coalesce("first", F.col("doc_id").isNull()).alias("first"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): a table of at most 32 rows a part, whatever the number of documents."""
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = rows.join(marks, "doc_id", "left")
    mask = F.col("mask") + F.when(F.col("first"), 0).otherwise(1 << 4)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return known.groupBy("part", mask.alias("mask")).agg(F.count("*").alias("n"), total("good"), total("toxic"))


OUT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters A to E, and step: what the step keeps and removes.

    redundant counts documents of the part that fail the step's filter and were removed earlier, unique_fails those
    that fail this filter alone; good_lost and toxic_lost those removed here with a label quality=1 or toxic=1 (any
    label row of the id); shapley is what the filter removes summed over all orders.

    A null text is empty, a null part the empty string. A row with a null id is never another's copy and has no
    label. Repeated rows count each, and none is the other's copy, since no id is smaller. An empty table gives an
    empty result; without labels nothing good or toxic is lost. Columns other than those named are not read.
    """

    def audited(group: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(group["mask"], group["n"], group["good"], group["toxic"])}
        part = group["part"].iloc[0]
        return pd.DataFrame([(part, *row) for row in all_orders(FILTERS, counts)], columns=[c.split()[0] for c in OUT.split(", ")])

    return mask_counts(failure_masks(docs, id_col, text_col, part_col), labels).groupBy("part").applyInPandas(audited, OUT)
