"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed number of characters. The distinct blocks of the
corpus are sorted and numbered: a block's number is its name, equal blocks have equal names and
different blocks never do. Adjacent names are then paired, the distinct pairs sorted and numbered
in turn, and so on until a document is one integer. Texts are equal exactly when they end at the
same level with the same integer; no hash stands for a text.

Blocks cross the network once, as distinct texts to be sorted. To look up a block's name a document
carries two 64-bit hashes of it instead of the block; that no two distinct blocks share both is
checked after the names are made, and other seeds are taken if they do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.shared import SPACES, stored, text_of

NONE = -1  # the partner of an odd last name


def normalised(text: str) -> Column:
    return F.regexp_replace(text_of(text), SPACES, " ")


def _blocks(text: Column, size: int) -> Column:
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(cut)


def _key(block: Column, seed: int) -> list[Column]:
    """Two independent hashes: the leading literal seeds the hash of the block."""
    return [F.xxhash64(F.lit(2 * seed + i), block).alias(f"key{i}") for i in (0, 1)]


def _numbered(names: DataFrame, *by: str) -> DataFrame:
    """Distinct rows sorted and numbered. The numbers follow the sort, so a task that runs again
    gives the same ones; they are distinct across partitions."""
    return names.distinct().sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def block_names(docs: DataFrame, text: Column, size: int) -> tuple[DataFrame, int]:
    """(key0, key1, name) of every distinct block, and the seed that keeps the keys apart."""
    blocks = docs.select(F.explode(_blocks(text, size)).alias("block"))
    for seed in range(100):
        named = stored(_numbered(blocks, "block").select(*_key(F.col("block"), seed), "name"), "block-names")
        shared = named.groupBy("key0", "key1").count().filter("count > 1")
        if shared.isEmpty():
            return named, seed
    raise RuntimeError("no seed keeps the block keys apart")


def text_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 1024) -> DataFrame:
    """(row, doc_id, text_sha256, level, name): level and name are equal exactly for equal texts."""
    text = normalised(text_col)
    names, seed = block_names(docs, text, block_chars)
    keyed = F.transform(_blocks(text, block_chars), lambda b: F.struct(*_key(b, seed)))
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.sha2(text, 256).alias("text_sha256"),
            keyed.alias("keys"),
        ),
        "block-keys",
    )
    longest = rows.agg(F.max(F.size("keys"))).first()[0] or 0
    cur = stored(
        rows.select("row", F.size("keys").cast("long").alias("n"), F.posexplode("keys"))
        .select("row", "n", F.col("pos").cast("long"), "col.key0", "col.key1")
        .join(names, ["key0", "key1"])
        .select("row", "n", "pos", "name"),
        "names-0",
    )
    level, found = 0, cur.filter("n = 1").select("row", F.lit(0).alias("level"), "name")
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        odd = F.col("pos") % 2 == 1
        pairs = stored(
            cur.filter("n > 1")
            .groupBy("row", ((F.col("n") + 1) / 2).cast("long").alias("n"), F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.max(F.when(~odd, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(NONE)).alias("right"),
            ),
            f"pairs-{level}",
        )
        names = stored(_numbered(pairs.select("left", "right"), "left", "right"), f"pair-names-{level}")
        cur = stored(pairs.join(names, ["left", "right"]).select("row", "n", "pos", "name"), f"names-{level}")
        found = found.unionByName(cur.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
    return rows.drop("keys").join(found, "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 1024) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, level, name.

    Texts are equal when equal after each run of ASCII white space became one space. Of equal texts
    the row with the smallest id stays. A null text is empty; empty texts are equal to each other. A
    null id loses to any other; of rows with the same id and text the first read stays. An empty
    table gives an empty result. Columns other than the two named are not read.

    Scale: a hot text is one name, counted by partial aggregates. The joins to names read written
    tables on both sides, so that adaptive execution can split a hot name.
    """
    ids = stored(text_identities(docs, id_col, text_col, block_chars), "identities")
    same_id = ids.groupBy("level", "name", "doc_id").agg(F.count("*").alias("n"), F.min("row").alias("row"))
    groups = stored(
        same_id.groupBy("level", "name").agg(
            F.min("doc_id").alias("keep_id"),
            F.sum("n").alias("group_size"),
            F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("keep_row"),
        ),
        "groups",
    )
    return ids.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "level", "name"
    )
