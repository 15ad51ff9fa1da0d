"""Near-duplicates by SimHash and the generalised pigeonhole principle.

Fingerprints within a few differing bits are found without comparing all pairs. Bits that vary
together are put into the same partition of the 64. Each partition gets a threshold of its own; if
the thresholds sum to (bits allowed - partitions + 1), two linked fingerprints agree on at least one
partition within its threshold (a threshold of -1 leaves the partition out). Dynamic programming
chooses the thresholds with the fewest candidates, estimated from counts over all fingerprints.
Fingerprints are probed on each partition, and every candidate is verified on all 64 bits.

A value that many fingerprints share is a hot bucket. It is divided again by the same principle over
the bits left, until no bucket is above a fixed size; so no bucket is joined as all its pairs and none
is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.graph import components
from plumbline.llm.shared import stored, text_of, with_places

BITS = 64
#: Members of a bucket that are compared pair by pair at most.
BUCKET = 256


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The majority bits of the shingles' hashes, as a signed 64-bit number; 0 without words."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        return _signed(xxhash.xxh64_intdigest(whole, 42))
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [*(s - 1 for s in starts[shingle:]), len(whole)]
    digest = xxhash.xxh64_digest
    ones, n, block = np.zeros(BITS, dtype=np.int64), len(ends), 1 << 16
    for i in range(0, n, block):  # a long text in parts, so the unpacked bits stay small
        raw = b"".join([digest(whole[a:b], 42) for a, b in zip(starts[i : i + block], ends[i : i + block])])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprint_of(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def many(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return many(text)


def bit_statistics(fingerprints: DataFrame) -> tuple[int, np.ndarray]:
    """Their number and how many have both bits set, for every pair of bits: a fixed 64 x 64."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for b in batches:
            raw = b.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        i, j = np.indices((BITS, BITS))
        counts = np.append(both.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i.ravel(), -1)), pa.array(np.append(j.ravel(), -1)), pa.array(counts)], names=["i", "j", "n"])

    rows = fingerprints.mapInArrow(partial, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    found = {(r.i, r.j): r.n for r in rows}
    total = found.pop((-1, -1), 0)
    return total, np.array([[found.get((i, j), 0) for j in range(BITS)] for i in range(BITS)], dtype=float)


def partitions(n: int, both: np.ndarray, parts: int) -> list[int]:
    """Masks of bits that vary together: each partition grows by the bit most correlated with it."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    like = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, masks = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda b: like[b, free].sum())]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: (like[b, group].mean(), -b)))
            free.remove(group[-1])
        masks.append(sum(1 << b for b in group))
    return masks


def thresholds(cost: list[list[float]], allowed: int) -> tuple[float, list[int]]:
    """The cheapest thresholds from -1 up with the sum the principle needs. cost[i][t + 1] is that of
    threshold t on partition i."""
    total = allowed - len(cost) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, chosen) in best.items():
            for t in range(-1, allowed + 1):
                found = (c + row[t + 1], [*chosen, t])
                if s + t not in new or found < new[s + t]:
                    new[s + t] = found
        best = new
    return best[total]


def plan(nodes: DataFrame, allowed: int, choices: tuple[int, ...] = (2, 3, 4)) -> list[tuple[int, int]]:
    """(mask, threshold) of the partitions to probe, the cheapest over several numbers of them.

    The pairs that agree on a partition are counted over all fingerprints. The pairs within t bits
    on it follow from how often each of its bits differs in a pair. A probe costs as a candidate.
    """
    n, both = bit_statistics(nodes.select("fp"))
    p = both.diagonal() / max(n, 1)
    masks = {m: partitions(n, both, m) for m in choices if m <= allowed + 2}
    every = sorted({x for group in masks.values() for x in group})
    fp = F.col("fp")
    values = nodes.select(F.explode(F.array(*[F.struct(F.lit(_signed(x)).alias("mask"), fp.bitwiseAND(F.lit(_signed(x))).alias("value")) for x in every])).alias("s"))
    counts = values.groupBy("s.mask", "s.value").count()
    pairs = {r[0]: float(r[1]) for r in counts.groupBy("mask").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)).collect()}

    def cost(mask: int) -> list[float]:
        odds = [2 * q * (1 - q) / max(1 - 2 * q * (1 - q), 1e-9) for b, q in enumerate(p) if mask >> b & 1]
        ways = [1.0] + [0.0] * allowed  # elementary symmetric sums: exactly k bits differ against none
        for o in odds:
            for k in range(allowed, 0, -1):
                ways[k] += ways[k - 1] * o
        probes = np.cumsum([len(list(combinations(range(len(odds)), k))) for k in range(allowed + 1)])
        return [0.0] + [pairs.get(_signed(mask), 0.0) * sum(ways[: t + 1]) + n * float(probes[t]) for t in range(allowed + 1)]

    best = min((thresholds([cost(x) for x in group], allowed) + (group,) for group in masks.values()), key=lambda b: b[0])
    return [(mask, t) for mask, t in zip(best[2], best[1]) if t >= 0]


def _finer(mask: int, allowed: int) -> list[int]:
    """The mask joined with each of the parts of the other bits, of which one must agree."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << b for b in free[k :: allowed + 1]) for k in range(allowed + 1)]


def links(nodes: DataFrame, allowed: int = 2, bucket: int = BUCKET) -> DataFrame:
    """All (a, b) of distinct fingerprints that differ in at most `allowed` bits, each at least once."""
    fp, probes, found = F.col("fp"), [], None
    for mask, t in plan(nodes, allowed):
        bits = [1 << b for b in range(BITS) if mask >> b & 1]
        flips = [_signed(sum(c)) for k in range(t + 1) for c in combinations(bits, k)]
        value = lambda flip, m=mask: fp.bitwiseXOR(F.lit(flip)).bitwiseAND(F.lit(_signed(m)))
        exact = nodes.select(F.lit(_signed(mask)).alias("mask"), value(0).alias("value"), "fp", F.lit(True).alias("own"))
        probes.append(exact)
        if t:
            near = nodes.select(F.lit(_signed(mask)).alias("mask"), F.explode(F.array(*map(value, flips[1:]))).alias("value"), "fp", F.lit(False).alias("own"))
            probes.append(near)
    rows = probes[0]
    for more in probes[1:]:
        rows = rows.unionByName(more)
    while True:
        rows = stored(rows, "probes")
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("size")).filter("size > 1")
        sizes = stored(sizes, "bucket-sizes")
        met = rows.join(sizes, ["mask", "value"])
        cold = stored(met.filter(F.col("size") <= bucket).drop("size"), "buckets")
        a, b = cold.alias("a"), cold.alias("b")
        close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= allowed
        pairs = a.join(
            b,
            (F.col("a.mask") == F.col("b.mask")) & (F.col("a.value") == F.col("b.value"))
            & F.col("b.own") & (F.col("a.fp") < F.col("b.fp")) & close,
        ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
        found = pairs if found is None else found.unionByName(pairs)
        hot = met.filter(F.col("size") > bucket)
        coarse = [r[0] for r in sizes.filter(F.col("size") > bucket).select("mask").distinct().collect()]
        if not coarse:
            return found
        finer = F.create_map(*[x for m in coarse for x in (F.lit(m), F.array(*[F.lit(_signed(f)) for f in _finer(m % (1 << 64), allowed)]))])
        rows = hot.withColumn("next", F.explode(finer[F.col("mask")])).select(
            F.col("next").alias("mask"),
            F.col("value").bitwiseOR(fp.bitwiseAND(F.col("next")).bitwiseAND(F.bitwise_not("mask"))).alias("value"),
            "fp", "own",
        )


def fingerprint_components(rows: DataFrame, allowed: int = 2) -> DataFrame:
    """(fp, root, component_id) of every fingerprint in rows (doc_id, fp); root names the component."""
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    roots = stored(components(links(nodes, allowed)), "roots")
    joined = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    joined = stored(joined, "rooted")
    smallest = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return stored(joined.join(smallest, "root").select("fp", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, allowed: int = 2) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id that can be reached over links. Equal fingerprints link. A null
    text is empty; a text without words has fingerprint zero and links like any other. A null id
    reaches and is reached but is never the smallest; a component of null ids has a null id. An empty
    table gives an empty result. Columns other than the two named are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), fingerprint_of(text_of(text_col), shingle).alias("fp"))
    rows = stored(own, "document-fingerprints")
    return rows.join(fingerprint_components(rows, allowed), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, allowed: int = 2) -> DataFrame:
    """The input rows, all columns, that stay: of each component the row with the smallest id, and of
    rows with that id the first by its place in the files."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    placed = with_places(docs)
    doc_id, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    keyed = placed.select("file", "at", F.col(doc_id).alias("doc_id"), fingerprint_of(text_of(text), shingle).alias("fp"))
    keyed = stored(keyed, "document-fingerprints")
    ids = keyed.join(fingerprint_components(keyed, allowed), "fp")
    first = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), "file", "at")
    keep = stored(ids.groupBy("root").agg(F.min(first).alias("first")).select("first.file", "first.at"), "kept-rows")
    # a sorted join at every size, so that small and large tables are worked alike
    return placed.join(keep.hint("merge"), ["file", "at"], "left_semi").select(*names).toDF(*docs.columns)
