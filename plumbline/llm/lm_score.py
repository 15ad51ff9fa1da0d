"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

A document is scored by the counts of all other documents: its own are taken off, else every n-gram
would have been seen. S(w | context) is c(context w) / c(context) where the n-gram was seen, else
alpha times the score with the context one word shorter; a word seen nowhere else has alpha / N.

Counts are a table of n-grams partitioned by hash and joined to the n-grams of the documents:

1. Documents are read in blocks. A block is exploded into n-grams of each order, equal ones are counted
   in the block, and the sorted hashes go out by hash range (a shard).
2. A shard adds the counts of its n-grams over all blocks, and joins the totals back to each block's.
3. A block's documents meet its totals; each word is scored and the scores are summed per document.

A frequent n-gram is one entry per block, so no key is hot, and a shard holds a range of hashes, of which
there are as many as one asks for. Rows carry arrays, compressed, instead of one n-gram each: an n-gram
costs about six bytes on the way. An n-gram stands as a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.shared import text_of

ORDER = 3
ALPHA = 0.4
BLOCK_WORDS = 2_000_000


def _packed(values: np.ndarray) -> bytes:
    """Compressed, byte plane by byte plane: the upper bytes of small numbers are runs of zeros."""
    import zstandard

    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _gaps(sorted_keys: np.ndarray) -> bytes:
    return _packed(np.diff(sorted_keys, prepend=np.uint64(0)))


def _from_gaps(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Block:
    """Documents whose words are hashes, in one array."""

    def __init__(self, sizes: np.ndarray, hashes: np.ndarray, order: int):
        self.sizes, self.words = sizes, hashes
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.order = order

    def ngrams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, whether an n-gram of one document ends at each word, its key). The empty n-gram, one
        per word, stands for the number of words."""
        every = np.ones(len(self.words), dtype=bool)
        yield 0, every, np.zeros(len(self.words), dtype=np.uint64)
        key = _mixed(self.words)
        yield 1, every, key
        for n in range(2, self.order + 1):
            longer = np.zeros_like(key)
            longer[1:] = _mixed(key[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.words[1:] + np.uint64(n))
            key = longer
            whole = np.zeros(len(key), dtype=bool)
            whole[n - 1 :] = self.doc[n - 1 :] == self.doc[: len(key) - n + 1]
            yield n, whole, key

    def check(self) -> int:
        return int(self.words.sum(dtype=np.uint64).view(np.int64)) if len(self.words) else 0


def _blocks(batches: Iterator[pa.RecordBatch], order: int, size: int) -> Iterator[tuple[int, list, Block]]:
    number, ids, words, held = TaskContext.get().partitionId() << 33, [], [], 0
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            ids.append(doc_id)
            words.append(word_hashes(text.as_py()))
            held += len(words[-1])
            if held >= size:
                yield number, ids, Block(np.array([len(w) for w in words]), np.concatenate(words), order)
                number, ids, words, held = number + 1, [], [], 0
    if ids:
        yield number, ids, Block(np.array([len(w) for w in words]), np.concatenate(words), order)


def _exploded(order: int, size: int, shards: int):
    """Rows of (shard, block, n, keys, counts) of each block's distinct n-grams."""
    edges = np.array([(i << 64) // shards for i in range(1, shards)], dtype=np.uint64)

    def run(batches):
        for number, _, block in _blocks(batches, order, size):
            for n, whole, key in block.ngrams():
                keys, counts = np.unique(key[whole], return_counts=True)
                cuts = [0, *np.searchsorted(keys, edges), len(keys)]
                rows = [(s, a, z) for s, (a, z) in enumerate(zip(cuts, cuts[1:])) if z > a]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([s for s, _, _ in rows], pa.int32()), pa.array([number] * len(rows)), pa.array([n] * len(rows), pa.int32()),
                            pa.array([_gaps(keys[a:z]) for _, a, z in rows], pa.binary()), pa.array([_packed(counts[a:z]) for _, a, z in rows], pa.binary()),
                        ],
                        names=["shard", "block", "n", "keys", "counts"],
                    )

    return run


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    """The totals of a shard's n-grams, for each block in the order of its keys."""
    out = []
    for n, part in rows.groupby("n"):
        keys = [_from_gaps(k) for k in part["keys"]]
        counts = np.concatenate([_unpacked(c) for c in part["counts"]])
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(len(found), dtype=np.uint64)
        np.add.at(totals, place, counts)
        ends = np.cumsum([len(k) for k in keys])
        for shard, block, own in zip(part["shard"], part["block"], np.split(place, ends[:-1])):
            out.append((block, shard, n, _packed(totals[own])))
    return pd.DataFrame(out, columns=["block", "shard", "n", "totals"])


def _contents(order: int, size: int):
    """One row per block: its document ids, sizes, words as numbers, and their hashes."""

    def run(batches):
        for number, ids, block in _blocks(batches, order, size):
            vocabulary, place = np.unique(block.words, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), pa.array([block.check()]), pa.array([ids], pa.list_(pa.int64())),
                    pa.array([_packed(block.sizes)], pa.binary()), pa.array([_gaps(vocabulary)], pa.binary()), pa.array([_packed(place)], pa.binary()),
                ],
                names=["block", "check", "ids", "sizes", "vocabulary", "words"],
            )

    return run


def score_block(block: Block, totals: dict[int, np.ndarray], alpha: float) -> np.ndarray:
    """The sum of the logarithms of each document's word scores. totals: by n, of the block's
    distinct n-grams in key order."""
    size = len(block.words)
    counts = []  # by n: of the n-gram that ends at each word, in all other documents
    for n, whole, key in block.ngrams():
        distinct, place = np.unique(key[whole], return_inverse=True)
        if len(distinct) != len(totals.get(n, ())):
            raise RuntimeError("the documents of a block changed between two reads")
        pair = block.doc[whole] * max(len(distinct), 1) + place
        _, at, own = np.unique(pair, return_inverse=True, return_counts=True)
        seen = np.zeros(size)
        seen[whole] = totals[n][place] - own[at] if len(place) else 0
        counts.append((whole, seen))
    rest = np.maximum(counts[0][1], 1)
    score = np.where(counts[1][1] > 0, counts[1][1], alpha) / rest
    for n in range(2, block.order + 1):
        whole, seen = counts[n]
        context = np.append(1.0, counts[n - 1][1][:-1]) if size else np.zeros(0)
        score = np.where(seen > 0, seen / np.maximum(context, 1), np.where(whole, alpha * score, score))
    return np.bincount(block.doc, weights=np.log(score), minlength=len(block.sizes))


def _scored(order: int, alpha: float):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        block = Block(_unpacked(row["sizes"]).astype(np.int64), _from_gaps(row["vocabulary"])[_unpacked(row["words"]).astype(np.int64)], order)
        if block.check() != row["check"]:
            raise RuntimeError("a block's words do not match its checksum")
        right = right.sort_values("shard")
        totals = {n: np.concatenate([_unpacked(t) for t in part["totals"]]).astype(float) for n, part in right.groupby("n")}
        if not len(block.words):
            totals = {n: np.zeros(0) for n in range(order + 1)}
        for n in range(2, order + 1):
            totals.setdefault(n, np.zeros(0))
        logs = score_block(block, totals, alpha)
        ids = pd.array([None if i is None or i != i else int(i) for i in row["ids"]], dtype="Int64")
        return pd.DataFrame({"doc_id": ids, "n_words": block.sizes, "log_score": logs})

    return run


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA, block_words: int = BLOCK_WORDS, shards: int | None = None
) -> DataFrame:
    """One row per input row: doc_id, n_words, log_score, mean_log_score.

    Words are `[^\\x20\\x09-\\x0D]+` in lower-case A-Z. A document's first words have shorter contexts.
    A null or empty text has no words, log_score 0 and a null mean. Each row is a document: repeated
    rows see each other's counts, and null ids are passed on. With one document alone N is 1. An empty
    table gives an empty result. Columns other than the two named are not read.

    docs is read twice and must give the same rows in the same partitions, as a table does; a
    difference is found and stops the job. shards: hash ranges, by default four per shuffle partition.
    """
    spark = docs.sparkSession
    shards = shards or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    parts = own.mapInArrow(_exploded(order, block_words, shards), "shard int, block long, n int, keys binary, counts binary")
    totals = parts.groupBy("shard").applyInPandas(_add_up, "block long, shard int, n int, totals binary")
    contents = own.mapInArrow(
        _contents(order, block_words), "block long, check long, ids array<long>, sizes binary, vocabulary binary, words binary"
    )
    scored = (
        contents.groupBy("block").cogroup(totals.groupBy("block"))
        .applyInPandas(_scored(order, alpha), "doc_id long, n_words long, log_score double")
    )
    return scored.withColumn("mean_log_score", F.try_divide("log_score", F.col("n_words").cast("double")))
