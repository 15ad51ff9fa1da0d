"""Text against catalogue: product master and listing matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import vocab
from plumbline.functions.exprs import bucket
from plumbline.functions.keys import surrogate_key
from plumbline.functions.text import edit_similarity, token_sorted, tokens
from plumbline.operators.joins import left_join_spread
from plumbline.operators.quality import Rule, add_anomaly_columns, flag
from plumbline.operators.similar import similar_pairs


def best_match(
    texts: DataFrame,
    text: str,
    catalogue: DataFrame,
    name: str,
    block: list[str] = (),
    floor: float = vocab.REVIEW_FROM,
) -> DataFrame:
    """For every row the catalogue name most like its text, and the score from 0 to 1.

    A candidate lies in the same block and shares a word with the text. Each distinct text is
    scored once however many rows carry it, an equal name is found by an equi-join, and what is left
    meets candidates by rare pairs of characters (`similar_pairs`), not by shared words. The score is
    null below the floor. Of equally good names the alphabetically first wins.
    """
    block = list(block)
    rows = texts.withColumn("__norm", token_sorted(text))
    wanted = rows.select(*block, "__norm").filter("__norm <> ''").distinct()
    names = (
        catalogue.select(*block, F.col(name).alias("__name"), token_sorted(name).alias("__cat"))
        .filter("__cat <> ''")
        .groupBy(*block, "__cat")
        .agg(F.min("__name").alias("__name"))
    )
    equal = wanted.join(names, (
        (F.col("__norm") == F.col("__cat")) if not block else
        [wanted["__norm"] == names["__cat"], *[wanted[b] == names[b] for b in block]]
    ), "left").select(*[wanted[b] for b in block], "__norm", "__name")
    done = equal.filter("__name is not null").select(
        *block, "__norm", F.col("__name").alias("match_name"), F.lit(1.0).alias("match_score")
    )
    todo = equal.filter("__name is null").select(*block, "__norm")
    found = (
        similar_pairs(todo, "__norm", names, "__cat", block, floor)
        .filter(F.arrays_overlap(tokens("__norm"), tokens("__cat")))
        .join(names, [*block, "__cat"])
        .withColumnRenamed("score", "__score")
        .groupBy(*block, "__norm")
        # the smallest name among the best: order by score down, then name up
        .agg(F.min(F.struct((-F.col("__score")).alias("s"), F.col("__name").alias("n"))).alias("m"))
        .select(*block, "__norm", F.col("m.n").alias("match_name"), (-F.col("m.s")).alias("match_score"))
    )
    scored = done.unionByName(found)
    keys = [*block, "__norm"]
    names_of = {k: f"__key{i}" for i, k in enumerate(keys)}
    return left_join_spread(rows, scored.withColumnsRenamed(names_of), keys, list(names_of.values())).drop("__norm")


def match_tier(score: Column) -> Column:
    steps = [(vocab.MATCHED_FROM, "MATCHED"), (vocab.REVIEW_FROM, "MANUAL_REVIEW")]
    return F.when(score.isNull(), "UNMATCHED").otherwise(bucket(score, steps, "UNMATCHED"))


def product_master(
    listings: DataFrame, catalogue: DataFrame, mismatch_below: float = 0.5
) -> DataFrame:
    """One row per seller listing, linked to a product where a pass finds one.

    Pass 1 joins on the SKU; pass 2 scores the title within the category; the rest stays unlinked.
    The catalogue name wins, and a listing whose title hardly resembles it is flagged.
    """
    cat = catalogue.select(
        F.col("sku"), F.col("product_name"), F.col("list_price"), F.col("cogs")
    )
    by_sku = left_join_spread(listings, cat.withColumn("__sku", F.col("sku")), ["catalogue_sku_ref"], ["__sku"])
    exact = by_sku.filter("sku is not null").select(
        "listing_id", "seller_product_title", "catalogue_sku_ref", "sku", "product_name",
        "list_price", "cogs", F.lit(1.0).alias("match_confidence"), F.lit(1).alias("match_pass"),
    )
    rest = by_sku.filter("sku is null").select(*listings.columns)
    # one catalogue row stands for every name within a category
    named = catalogue.groupBy("category", "product_name").agg(
        F.min_by(F.struct("sku", "list_price", "cogs"), "sku").alias("p")
    )
    scored = best_match(rest, "seller_product_title", catalogue, "product_name", ["category"])
    fuzzy = scored.join(
        named.select("category", F.col("product_name").alias("match_name"), "p"),
        ["category", "match_name"],
        "left",
    ).select(
        "listing_id", "seller_product_title", "catalogue_sku_ref",
        F.col("p.sku").alias("sku"),
        F.col("match_name").alias("product_name"),
        F.col("p.list_price").alias("list_price"), F.col("p.cogs").alias("cogs"),
        F.coalesce("match_score", F.lit(0.0)).alias("match_confidence"),
        F.when(F.col("match_score").isNotNull(), 2).otherwise(0).alias("match_pass"),
    )
    likeness = edit_similarity(token_sorted("seller_product_title"), token_sorted("product_name"))
    sku_pass = F.col("match_pass") == 1
    score = F.col("match_confidence")
    df = add_anomaly_columns(exact.unionByName(fuzzy)).withColumns({
        "canonical_product_key": F.when(F.col("sku").isNotNull(), surrogate_key("sku")),
        "requires_manual_review": (F.col("match_pass") == 2) & (score < vocab.MATCHED_FROM),
    })
    return flag(df, [
        Rule("SKU_PRODUCT_MISMATCH", sku_pass & (likeness < mismatch_below)),
        Rule("PRODUCT_NAME_CONFLICT",
             sku_pass & (likeness >= mismatch_below) & (likeness < 1.0)),
        Rule("SKU_NOT_IN_CATALOGUE", F.col("catalogue_sku_ref").isNotNull() & ~sku_pass),
        Rule("PRODUCT_FUZZY_MATCH", F.col("match_pass") == 2),
        Rule("FUZZY_MATCH_LOW_CONF", F.col("match_pass") == 0),
    ])
