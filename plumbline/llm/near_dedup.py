"""Near-copies by the exact Jaccard similarity of their shingles.

Two documents are linked when the sets of their five-word shingles are at least 0.8 alike. No pair is missed:
with the shingles of all sets in one order, two sets that are alike share one of their first n - ceil(0.8 n) + 1
(prefix filter). The order has shingles last that are frequent in a sample of the documents, so that a common
passage brings together only documents that consist of it; any order is right, the sample decides only the cost.

Documents with the same set are one node. The documents that share a shingle are first tested against the
smallest of them only, which joins large groups of near-copies without all their pairs. Then the remaining pairs
are tested whose ends are not yet in one component. Every link is verified on the whole sets, but first a sketch
of each set tells most pairs that cannot be alike, so that only the texts of the others are moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.graph import components
from plumbline.llm.shared import scratch, stored, text_of, with_places

SHINGLE = 5
#: Least similarity of linked documents, in percent.
PERCENT = 80
#: Documents counted, about, to find frequent shingles; frequent ones at most and the fewest documents of one.
SAMPLE = 8000
FREQUENT = 200_000
LEAST = 4


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; words are told as in simhash.fingerprint. A text of fewer
    words is one shingle, one without words too."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    whole, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= size:
        return np.frombuffer(digest(whole, 42), dtype=">u8").astype(np.uint64).view(np.int64)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [*(s - 1 for s in starts[size:]), len(whole)]
    raw = b"".join([digest(whole[a:b], 42) for a, b in zip(starts, ends)])
    return np.unique(np.frombuffer(raw, dtype=">u8").astype(np.uint64).view(np.int64))


def prefix(found: np.ndarray, frequent: np.ndarray, rank: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The shingles of which two sets that are alike share one. frequent: sorted; rank: their places in the order."""
    n = len(found)
    least = n - -(-percent * n // 100) + 1
    if not len(frequent):
        return found[:least]
    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
    place = np.where(frequent[at] == found, rank[at], -1)
    return found[np.lexsort((found, place))[:least]]


def sketch(found: np.ndarray) -> np.ndarray:
    """For each of some bits, a power of two of 2 to 4 for a shingle (64 at least), whether the shingles that fall on it
    are odd in number. Two sets differ in as many shingles at least as their sketches in bits."""
    bits = 64
    while bits < 2 * len(found):
        bits *= 2
    odd = np.bincount((found.view(np.uint64) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """In how many shingles the sets of two sketches differ at least; the longer sketch is folded to the shorter."""
    bits = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(s.reshape(-1, bits), axis=0) for s in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def hopeful(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may be alike by the sketches of nodes (node, n, sketch)."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            x, y = ([np.frombuffer(s, dtype=np.uint64) for s in batch.column(k).to_pylist()] for k in (4, 5))
            differ = np.array([least_difference(u, v) for u, v in zip(x, y)], dtype=np.int64)
            # both <= (n - differ) / 2, and alike is both * (100 + percent) >= percent * n
            may = (n - differ) * (100 + percent) >= 2 * percent * n
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(may, pa.bool_()))

    own = nodes.select("node", "n", "sketch")
    met = pairs.join(own.toDF("a", "n_a", "x"), "a").join(own.toDF("b", "n_b", "y"), "b").select("a", "b", "n_a", "n_b", "x", "y")
    return stored(met.mapInArrow(kept, "a long, b long"), "hopeful-pairs")


def frequent_shingles(rows: DataFrame, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample, sorted, and their places from rare to frequent."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t, size))], names=["s"])

    some = F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < int(min(1.0, SAMPLE / max(rows.count(), 1)) * 1_000_000)
    counts = rows.filter(some).select(text_of(text)).mapInArrow(each, "s long").groupBy("s").count().filter(F.col("count") >= LEAST)
    found = counts.orderBy(F.desc("count"), "s").limit(FREQUENT).toArrow()
    values = found.column("s").to_numpy()
    by_value = np.argsort(values)
    return values[by_value], (len(values) - 1 - np.arange(len(values)))[by_value]


def alike(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], size: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) those that are alike; texts gives (node, text), one text for each of a table of nodes."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = shingles(x, size), shingles(y, size)
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(same, pa.bool_()))

    with scratch(pairs.sparkSession):
        own = stored(texts(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "candidate-texts")
        met = pairs.join(own.toDF("b", "y"), "b").join(own.toDF("a", "x"), "a").select("a", "b", "x", "y")
        return stored(met.mapInArrow(verified, "a long, b long"), "alike", outer=True)


def near_links(nodes: DataFrame, texts: Callable[[DataFrame], DataFrame], size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(a, b) whose components are those of all nodes (node, n, prefix, sketch) that are alike."""
    keys = nodes.select("node", "n", F.explode("prefix").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("size")).filter("size > 1").drop("size")
    keys = stored(keys.join(stored(hubs, "hubs"), "key"), "shared-keys")
    sizes = nodes.select(F.col("node").alias("hub"), F.col("n").alias("hub_n"))
    stars = keys.filter("node <> hub").select("hub", "node", "n").distinct().join(sizes, "hub")
    near = lambda x, y: (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)
    stars = stored(stars.filter(near("n", "hub_n")).select(F.col("hub").alias("a"), F.col("node").alias("b")), "stars")
    first = alike(hopeful(stars, nodes, percent), texts, size, percent)
    roots = stored(components(first), "star-roots")
    rooted = keys.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "rooted-keys")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    rooted = stored(rooted.join(stored(mixed, "mixed-keys"), "key", "left_semi"), "open-keys")
    a, b = rooted.alias("a"), rooted.alias("b")
    met = (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    rest = a.join(b, met & near("a.n", "b.n")).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    rest = stored(rest.join(stars, ["a", "b"], "left_anti"), "open-pairs")
    return first.unionByName(alike(hopeful(rest, nodes, percent), texts, size, percent))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The input rows, all columns, that stay: of documents linked to one another, directly or over others, the
    row with the smallest id, and of rows with that id the first by its place in the files. A null text is empty; texts without words
    are copies of one another. A null id comes after all others. An empty table gives an empty result."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    rows = with_places(docs).withColumn("row", F.struct("file", "at"))
    frequent, rank = frequent_shingles(rows, text, size)

    def in_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            found = [shingles(t, size) for t in b.column(1).to_pylist()]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in found], dtype=np.uint64).view(np.int64)
            firsts = [prefix(s, frequent, rank, percent) for s in found]
            n = pa.array([len(s) for s in found], pa.int64())
            sketches = pa.array([sketch(s).tobytes() for s in found], pa.binary())
            columns = [b.column(0), pa.array(node), n, pa.array(firsts, pa.list_(pa.int64())), sketches]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "node", "n", "prefix", "sketch"])

    with scratch(docs.sparkSession):
        found = "row struct<file: long, at: long>, node long, n long, prefix array<long>, sketch binary"
        sets = stored(rows.select("row", text_of(text)).mapInArrow(in_sets, found), "shingle-prefixes")
        nodes = sets.groupBy("node").agg(F.min("row").alias("row"), *[F.first(c).alias(c) for c in ("n", "prefix", "sketch")])
        nodes = stored(nodes, "nodes")

        def texts(wanted: DataFrame) -> DataFrame:
            # the rows of the few nodes are written first: where they are as few as Spark can tell, no other text is moved
            some = stored(nodes.select("node", "row").join(wanted, "node", "left_semi"), "wanted-rows")
            return rows.select("row", text_of(text).alias("text")).join(some, "row").select("node", "text")

        roots = stored(components(near_links(nodes, texts, size, percent)), "near-roots")
        ids = sets.select("row", "node").join(roots, "node", "left").select("row", F.coalesce("root", "node").alias("root"))
        ids = ids.join(rows.select("row", F.col(doc_id).alias("doc_id")), "row")
        first = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("row").alias("r"))
        keep = stored(ids.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.r").alias("row")), "kept-rows", outer=True)
    # a sorted join at every size, so that small and large tables are worked alike
    return rows.join(keep.hint("merge"), "row", "left_semi").select(*names).toDF(*docs.columns)
