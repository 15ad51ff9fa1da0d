"""The best documents for each item by term weights, found in tries of restricted term vectors.

A document's vector is restricted to the terms of the items. Spark counts, over all documents, how many hold a term
and how long the documents are; the vectors are written and searched task by task.

For an item, a task puts its documents into a trie: a document is the path of those of the item's terms it holds,
the terms most frequent in the corpus first, so documents share the upper parts of their paths. A subtree lies in
consecutive documents when they are sorted by their paths. The largest tf of every term and the smallest m in a
subtree bound every score below it. The trie is searched depth first, the more promising branch first; a branch whose bound
is below the worst of the best documents so far is not entered, and small subtrees are scored document by document.
The best of all tasks are ranked again.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.shared import stored, text_of

#: Best documents of an item.
TOP = 10
#: Items searched for in one pass over the vectors; so many items and their terms are sent to every task.
ITEMS = 1000
#: Documents and terms of vectors in a trie at most, for bounded memory.
TRIE_DOCS, TRIE_TERMS = 1 << 14, 1 << 22
#: Documents of a subtree that are scored one by one.
LEAF = 128
#: Groups of tasks whose best documents are first ranked among themselves.
GROUPS = 256
#: By byte: what terms are made of, A-Z in lower case; all else is a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The maximal runs of digits, letters and characters beyond ASCII, in UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(TERM_BYTES).split()


@dataclass(frozen=True)
class Item:
    """terms: ids, the most frequent first; weights: each times its occurrences in the item."""

    item_id: int | None
    terms: np.ndarray
    weights: np.ndarray


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Best:
    """The best documents of one item so far: highest score, then smallest id, null ids last."""

    def __init__(self, top: int):
        self.top, self.scores, self.ids, self.null = top, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A score below this is not among the best."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = scores >= self.least
        if good.any():
            s, i, n = (np.concatenate(x) for x in ((self.scores, scores[good]), (self.ids, ids[good]), (self.null, null[good])))
            best = np.lexsort((i, n, -s))[: self.top]
            self.scores, self.ids, self.null = s[best], i[best], n[best]


def search(tf: np.ndarray, m: np.ndarray, ids: np.ndarray, null: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Search one trie; tf has a row per document and a column per term. Paths part by the terms of most weight first,
    so that what lacks them has a low bound. Returns the number of documents scored."""
    heavy = np.argsort(-weights, kind="stable")
    tf, weights = tf[:, heavy], weights[heavy]
    paths = np.packbits(tf > 0, axis=1)
    keys = np.ascontiguousarray(paths).view(f"S{paths.shape[1]}").ravel()
    order = np.argsort(keys, kind="stable")[::-1]
    tf, m, ids, null, paths = tf[order], m[order], ids[order], null[order], paths[order]
    columns = 8 * paths.shape[1]

    def node(lo: int, hi: int) -> tuple:
        most = tf[lo:hi].max(axis=0)
        return int(weights @ saturation(most, m[lo:hi].min())), lo, hi

    scored, todo = 0, [node(0, len(m))] if len(m) else []
    while todo:
        bound, lo, hi = todo.pop()
        if bound < best.least:
            continue
        differ = int.from_bytes(paths[lo].tobytes()) ^ int.from_bytes(paths[hi - 1].tobytes())
        if hi - lo <= LEAF or not differ:
            best.add(saturation(tf[lo:hi], m[lo:hi, None]) @ weights, ids[lo:hi], null[lo:hi])
            scored += hi - lo
            continue
        # the first term on which the paths part: those that hold it come first
        middle = lo + int(np.count_nonzero(tf[lo:hi, columns - differ.bit_length()]))
        todo.extend(sorted((node(lo, middle), node(middle, hi))))
    return scored


class Searcher:
    """Items and the best documents found for them in the tries of one task."""

    def __init__(self, items: list[Item], n_docs: int, n_terms: int, top: int):
        self.items, self.n_docs, self.n_terms = items, n_docs, n_terms
        self.best = [Best(top) for _ in items]

    def add(self, ids: pa.Array, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Documents with their vectors one after another."""
        doc = np.repeat(np.arange(len(n)), sizes)
        by_term = np.argsort(term, kind="stable")
        term, tf, doc = term[by_term], tf[by_term], doc[by_term]
        m = 100 - 75 + (75 * n * self.n_docs) // self.n_terms
        null, ids = np.asarray(ids.is_null()), np.asarray(ids.fill_null(0))
        for item, best in zip(self.items, self.best):
            starts, ends = np.searchsorted(term, item.terms), np.searchsorted(term, item.terms, "right")
            holds = np.zeros(len(n), dtype=bool)
            for a, b in zip(starts, ends):
                holds[doc[a:b]] = True
            held = np.flatnonzero(holds)
            if not len(held):
                continue
            place = np.cumsum(holds) - 1
            table = np.zeros((len(held), len(item.terms)), dtype=np.int64)
            for k, (a, b) in enumerate(zip(starts, ends)):
                table[place[doc[a:b]], k] = tf[a:b]
            search(table, m[held], ids[held], null[held], item.weights, best)

    def rows(self, task: int) -> pa.RecordBatch:
        own = [(item.item_id, task, None if null else int(i), int(s)) for item, best in zip(self.items, self.best) for s, i, null in zip(best.scores, best.ids, best.null)]
        columns = zip(*own) if own else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["item_id", "task", "doc_id", "score"])


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of every row; n counts all its terms, the vector has those of the vocabulary."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sizes, term, tf = [], [0], [], []
            for text in b.column(1):
                found = terms(text.as_py())
                counts = Counter([vocabulary[t] for t in found if t in vocabulary])
                n.append(len(found))
                term.extend(counts.keys())
                tf.extend(counts.values())
                sizes.append(len(term))
            offsets = pa.array(sizes, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((term, pa.int32()), (tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return own.mapInArrow(vectors, "doc_id long, n long, terms array<int>, tfs array<long>")


def _items(rows: list, df: dict[int, int], vocabulary: dict[bytes, int], n_docs: int) -> list[Item]:
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    found = []
    for r in rows:
        counts = Counter(t for x in terms(r["text"]) if (t := vocabulary[x]) in df)
        order = sorted(counts, key=lambda t: (-df[t], t))
        weights = np.array([counts[t] * weight[t] for t in order], dtype=np.int64)
        found.append(Item(r["item_id"], np.array(order, dtype=np.int64), weights))
    return found


def _searched(docs: DataFrame, rows: list, top: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, task, doc_id, score): each task's best for a block of items."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for r in rows for t in terms(r["text"])}))}
    vectors = stored(restricted_vectors(docs, vocabulary, id_col, text_col), "term-vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r[0]: r[1] for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # at most the block's terms
    items = _items(rows, df, vocabulary, n_docs)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher, held, size = Searcher(items, n_docs, n_terms, top), [], [0, 0]

        def flush() -> None:
            if held:
                b = pa.concat_batches(held)
                lists = b.column(2)
                searcher.add(b.column(0), b.column(1).to_numpy(), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), b.column(3).flatten().to_numpy())
                held.clear()
                size[:] = 0, 0

        for b in batches:
            held.append(b)
            size[0] += b.num_rows
            size[1] += len(b.column(2).flatten())
            if size[0] >= TRIE_DOCS or size[1] >= TRIE_TERMS:
                flush()
        flush()
        yield searcher.rows(TaskContext.get().partitionId())

    return vectors.filter(F.size("terms") > 0).mapInArrow(best, "item_id long, task long, doc_id long, score long")


def lexical_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, items_per_pass: int = ITEMS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best of all documents for each item with a score above 0.

    items has item_id and text. Of rows with one item_id the smallest text is the item; a null item_id is an id of
    its own. A null text has no terms: such an item, like one with no term in any document, has no row; such a
    document counts for nothing. Repeated documents are ranked each for itself. Equal scores rank by ascending
    doc_id, null ids last. An empty table on either side gives an empty result. Columns other than those named are
    not read.

    Items go to the driver in blocks of about `items_per_pass`; each block reads the documents once.
    """
    queries = stored(items.groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min(text_of("text")).alias("text")), "items")
    blocks = -(-queries.count() // items_per_pass)
    found = None
    for k in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        part = _searched(docs, rows, top, id_col, text_col)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    near = Window.partitionBy("item_id", "group").orderBy(*order)
    few = found.withColumn("group", F.pmod("task", F.lit(GROUPS))).withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= top)
    ranked = few.drop("group", "rank").withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
