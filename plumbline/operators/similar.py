"""Texts within an edit distance that grows with their length, by an inverted index of character pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPARE = 1e-9


def grams(text: str) -> Column:
    """The pairs of neighbouring characters of a text with a mark before and after it, in order: length + 1."""
    marked = F.concat(F.lit("\u0001"), F.col(text), F.lit("\u0001"))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(marked, i, F.lit(2)))


def _edits(length: Column, floor: float) -> Column:
    return F.floor(length * F.lit(1.0 - floor) + F.lit(SPARE))


def _entries(texts: DataFrame, text: str, counts: DataFrame, block: list[str], floor: float, need: int) -> DataFrame:
    """(block, text, gram, size, place, rank): the grams of a text that may meet those of another, rarest first."""
    spread = texts.select(*block, text, F.posexplode(grams(text)).alias("place", "gram"))
    known = spread.join(counts, [*block, "gram"], "left")
    # a gram that no name has takes its rank and meets nothing
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "gram", "place")))
    size = F.length(text)
    # the partner may be longer, by the edits that its own length allows
    most = 2 * _edits(size / F.lit(floor), floor) + need
    listed = known.groupBy(*block, text).agg(order.alias("g")).select(
        *block, text, size.alias("size"), F.posexplode(F.slice("g", F.lit(1), most.cast("int"))).alias("rank", "g"))
    return listed.filter("g.names > 0").select(*block, text, "size", "rank", "g.gram", "g.place")


def similar_pairs(
    texts: DataFrame, text: str, names: DataFrame, name: str, block: list[str] = (), floor: float = 0.65, need: int = 2,
) -> DataFrame:
    """(block, text, name, score) for every text and name of a block with 1 - edits / longer length >= floor.

    Both tables hold distinct texts that are not empty. With k edits two texts keep all but 2 k of the longer one's
    grams, each moved by at most k. Grams are ordered by how many names of the block have them. The first `need` of
    those kept stand among the first 2 k + need of either text, so two texts meet by rare grams only (prefix filter),
    at near places (position filter), and are compared when `need` of them meet (count filter). All three are exact
    from a floor of one half on. A null block meets nothing. No text is compared for a frequent gram alone.
    """
    if not 0.5 <= floor <= 1:
        raise ValueError("below a floor of one half, texts need not have a pair of characters in common")
    block = list(block)
    counts = names.select(*block, name, F.explode(F.array_distinct(grams(name))).alias("gram")).groupBy(*block, "gram").agg(
        F.count("*").alias("names"))
    left = _entries(texts, text, counts, block, floor, need)
    right = _entries(names, name, counts, block, floor, need).withColumnsRenamed(
        {"size": "r_size", "rank": "r_rank", "place": "r_place"})
    longer = F.greatest("size", "r_size")
    k = _edits(longer, floor)
    met = left.join(right, [*block, "gram"]).filter(
        (F.abs(F.col("size") - F.col("r_size")) <= k) & (F.abs(F.col("place") - F.col("r_place")) <= k)
        & (F.col("rank") < 2 * k + need) & (F.col("r_rank") < 2 * k + need))
    pairs = met.groupBy(*block, text, name).agg(
        F.count("*").alias("meets"), F.first(longer).alias("longer"), F.first(k.cast("int")).alias("k"))
    asked = F.least(F.lit(need), F.col("longer") + 1 - 2 * F.col("k"))
    edits = F.expr(f"levenshtein(`{text}`, `{name}`, k)")
    scored = pairs.filter(F.col("meets") >= asked).withColumn("edits", edits).filter("edits >= 0")
    return scored.select(*block, text, name, (F.lit(1.0) - F.col("edits") / F.col("longer")).alias("score")).filter(
        F.col("score") >= F.lit(floor))
