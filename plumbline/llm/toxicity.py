"""Toxicity by a chain of linear classifiers.

The categories have an order. The model of a category sees a document's words and the probabilities
of the categories before it. While training, those probabilities come from models that did not see
the document (out of fold), so that a later model learns how far an earlier one can be trusted. The
models are logistic: a sparse fit chooses the words, an almost unpenalised fit then weighs them.

They are trained on a bounded sample of labelled documents (Training.sample) and applied to all. The sample is
filled per class, half of it with toxic documents if there are as many, and its classes weigh in the last fit what
they weigh among all labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.shared import stored, text_of

# Words that mark a category of a document labelled toxic. The labels name no
# category, so a category holds for a toxic document with one of its words.
CATEGORIES = {
    "insult": ["clown", "dumb", "fool", "idiot", "imbecile", "jerk", "loser", "moron", "stupid"],
    "contempt": ["disgusting", "pathetic", "useless", "worthless"],
    "dehumanising": ["filth", "garbage", "parasite", "scum", "trash", "vermin"],
}
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Training:
    """sample: labelled documents trained on at most, of each class those with the smallest hash of their id.
    features: words at most, those that go most with the label among the words of at least min_docs documents."""

    sample: int = 6000
    features: int = 4096
    min_docs: int = 5
    folds: int = 4
    sparsity: float = 0.004
    ridge: float = 2e-5
    threshold: float = 0.5
    categories: dict = field(default_factory=lambda: CATEGORIES)


def words(text: str | None) -> set[str]:
    return set(LETTERS.findall((text or "").lower()))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, more: np.ndarray, y: np.ndarray, use: np.ndarray, sparsity: float, ridge: float, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights of the columns of x and then of `more`, and the intercept, from the rows in use.

    Columns of x that go with y by less than three standard errors are left out first, so that a text
    is toxic for the words it has and not for those it lacks. Of the rest an L1 fit chooses, and a nearly unpenalised fit weighs what it chose.
    weight: of each row, in the last fit only; the choice of words does not depend on how many of a class were sampled.
    The columns of `more` are few and stay in both. One class only gives no weights and its smoothed rate.
    """
    n, d = int(use.sum()), x.shape[1]
    weights, part = np.zeros(d + more.shape[1]), y[use]
    rate = (part.sum() + 0.5) / (n + 1)
    start = float(np.log(rate / (1 - rate)))
    if not n or part.min() == part.max():
        return weights, start
    heavy = np.ones(n) if weight is None else weight[use] / weight[use].mean()
    share = (heavy * part).mean()  # of the class among all labels
    one, off = use.astype(np.float32), np.where(use, y - part.mean(), 0).astype(np.float32)
    mean = x.T @ one / n  # of 0/1 columns, so it gives their spread too
    noise = np.sqrt(mean * (1 - mean) * rate * (1 - rate) / n + 1e-12)
    chosen = np.flatnonzero(x.T @ off / n > 3 * noise)
    chosen = np.r_[chosen, np.arange(d, len(weights))]
    z = np.c_[x[:, chosen[chosen < d]], more][use].astype(float)
    w, b = np.zeros(len(chosen)), start
    # a word's pull is bounded by the rate of the class, so the penalty shrinks with a rate below a tenth
    penalty = np.where(chosen < d, sparsity * min(1.0, 10 * rate), 0.0)
    rise = 4 / (np.linalg.norm(z.T @ z, "fro") / n + 1)
    v, c, t = w, b, 1.0
    for _ in range(150):  # accelerated proximal gradient
        r = _sigmoid(z @ v + c) - part
        new = v - rise * (z.T @ r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rise * penalty, 0)
        new_b, new_t = c - rise * r.mean(), (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new + (t - 1) / new_t * (new - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new, new_b, new_t
    z, chosen = np.c_[z[:, w != 0], np.ones(n)], chosen[w != 0]
    ridge *= min(1.0, share / part.mean())  # a class that weighs little must not be outweighed by the penalty
    w, pull = np.append(np.zeros(len(chosen)), np.log(share / (1 - share))), np.append(np.full(len(chosen), ridge), 1e-6)
    for _ in range(30):  # Newton's method with bounded steps
        p = _sigmoid(z @ w)
        hessian = (z.T * (heavy * p * (1 - p))) @ z / n + np.diag(pull)
        step = np.linalg.solve(hessian, z.T @ (heavy * (p - part)) / n + pull * w)
        w = w - step * min(1.0, 1.0 / max(np.abs(step).max(), 1e-9))
    weights[chosen] = w[:-1]
    return weights, float(w[-1])


def fit_chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray, how: Training, weight: np.ndarray | None = None) -> list[tuple[np.ndarray, float]]:
    """One model per column of y. Model k has the columns of x and then one per earlier category."""
    models, earlier = [], np.zeros((len(x), 0))
    for k in range(y.shape[1]):
        models.append(fit_logistic(x, earlier, y[:, k], fold >= 0, how.sparsity, how.ridge, weight))
        held_out = np.zeros(len(x))
        for f in range(how.folds):
            w, b = fit_logistic(x, earlier, y[:, k], fold != f, how.sparsity, how.ridge, weight)
            out = fold == f
            held_out[out] = _sigmoid(x[out] @ w[: x.shape[1]] + earlier[out] @ w[x.shape[1] :] + b)
        earlier = np.c_[earlier, held_out]
    return models


def apply_chain(x: np.ndarray, models: list[tuple[np.ndarray, float]]) -> np.ndarray:
    p = np.zeros((len(x), 0))
    for w, b in models:
        d = x.shape[1]
        p = np.c_[p, _sigmoid(x @ w[:d] + p @ w[d:] + b)]
    return p


@dataclass(frozen=True)
class Chain:
    names: list[str]
    vocabulary: dict[str, int]
    models: list[tuple[np.ndarray, float]]

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.vocabulary)), dtype=np.float32)
        known = self.vocabulary.keys()
        for row, text in zip(x, texts):
            row[[self.vocabulary[w] for w in known & words(text)]] = 1
        return apply_chain(x, self.models)


def per_class(rows: DataFrame, bound: int, *order: Column) -> tuple[DataFrame, dict[bool, float]]:
    """At most `bound` of the labelled rows, up to half of them toxic and as many more as the other class leaves
    free, and how many rows each row of a class stands for."""
    toxic = F.col("toxic") > 0
    counts = {r.t: r.n for r in rows.groupBy(toxic.alias("t")).agg(F.count("*").alias("n")).collect()}
    n1, n0 = counts.get(True, 0), counts.get(False, 0)
    take1 = min(n1, max(bound // 2, bound - n0))
    take0 = min(n0, bound - take1)
    if n1 + n0 <= bound:
        return rows, {True: 1.0, False: 1.0}
    taken = rows.filter(toxic).orderBy(*order).limit(take1).unionByName(rows.filter(~toxic).orderBy(*order).limit(take0))
    return taken, {True: n1 / max(take1, 1), False: n0 / max(take0, 1)}


def train(docs: DataFrame, labels: DataFrame, how: Training = Training(), id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """The chain over the categories and, last, the label itself ("toxic").

    Labels that are null are not used; a document labelled twice counts as toxic if one label says so.
    Without labelled documents every model gives the rate one half.
    """
    names = [*how.categories, "toxic"]
    label = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    # ids that have a document come first into the sample, so it fills where some have none
    own = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    present = label.join(own.select("doc_id").distinct(), "doc_id", "left_semi")
    sample, stands_for = per_class(stored(present, "labelled"), how.sample, order, F.col("doc_id"))

    def in_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(words(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "toxic", "words"])

    chosen = stored(own.join(F.broadcast(sample), "doc_id").select("doc_id", "text", F.col("toxic").cast("long")).mapInArrow(in_words, "doc_id long, toxic long, words array<string>"), "training")
    common = chosen.select("toxic", F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n"), F.count_if(F.col("toxic") > 0).alias("t"))
    sizes = {r.t: r.n for r in chosen.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    both = F.col("n") / max(n1 + n0, 1)
    apart = F.col("t") / max(n1, 1) - (F.col("n") - F.col("t")) / max(n0, 1)
    goes_with = F.coalesce(F.try_divide(apart, F.sqrt(both * (1 - both))), F.lit(0.0))
    best = common.filter(F.col("n") >= how.min_docs).orderBy(F.desc(goes_with), F.desc("n"), "w").limit(how.features)
    vocabulary = {r.w: i for i, r in enumerate(best.select("w").collect())}
    groups = [set(g) for g in how.categories.values()]

    def in_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3).to_pylist()
            places = [[vocabulary[w] for w in ws if w in vocabulary] for ws in lists]
            marks = [[not g.isdisjoint(ws) for g in groups] for ws in lists]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(places, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.bool_()))],
                names=["doc_id", "toxic", "copy", "places", "marks"],
            )

    # Training.sample rows of small numbers
    found = chosen.select("doc_id", "toxic", F.xxhash64("words").alias("copy"), "words").mapInArrow(
        in_numbers, "doc_id long, toxic long, copy long, places array<int>, marks array<boolean>"
    ).toArrow().to_pandas().sort_values(["doc_id", "copy"]).drop_duplicates("copy")  # copies count once
    if not len(found):
        return Chain(names, {}, [(np.zeros(k), 0.0) for k in range(len(names))])
    x = np.zeros((len(found), len(vocabulary)), dtype=np.float32)
    for row, places in zip(x, found["places"]):
        row[places] = 1
    toxic = found["toxic"].to_numpy() > 0
    y = np.c_[np.array(found["marks"].tolist(), dtype=bool).reshape(len(found), len(groups)) & toxic[:, None], toxic].astype(float)
    fold = np.array([(int(i) * 2654435761 >> 7) % how.folds for i in found["doc_id"]])
    models = fit_chain(x, y, fold, how, np.where(toxic, stands_for[True], stands_for[False]))
    used = np.flatnonzero(np.any([w[: len(vocabulary)] != 0 for w, _ in models], axis=0))
    small = [(np.r_[w[used], w[len(vocabulary) :]], b) for w, b in models]
    by_place = list(vocabulary)
    return Chain(names, {by_place[j]: i for i, j in enumerate(used)}, small)


def toxicity_of(text: Column, chain: Chain) -> Column:
    """A struct with the probability of each category."""
    @F.pandas_udf(", ".join(f"p_{n} double" for n in chain.names))
    def score(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(chain.probabilities(list(texts)), columns=[f"p_{n}" for n in chain.names])

    return score(text)


def toxicity(
    docs: DataFrame, labels: DataFrame, how: Training = Training(), id_col: str = "doc_id", text_col: str = "text", training_docs: DataFrame | None = None
) -> DataFrame:
    """One row per input row: doc_id, p_<category> of each category, p_toxic, toxic, kept.

    A null or empty text has the intercepts' probabilities. Repeated rows are scored one by one; a
    null id is scored too. An empty table gives an empty result. Columns not named are not read.
    """
    chain = train(docs if training_docs is None else training_docs, labels, how, id_col, text_col)
    own = docs.select(F.col(id_col).alias("doc_id"), toxicity_of(text_of(text_col), chain).alias("p"))
    toxic = F.col("p.p_toxic") > how.threshold
    return own.select("doc_id", "p.*", toxic.alias("toxic"), (~toxic).alias("kept"))


def without_toxic(docs: DataFrame, labels: DataFrame, how: Training = Training(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, that are not toxic."""
    chain = train(docs, labels, how, id_col, text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    scored = own.withColumn("p", toxicity_of(text_of(names[docs.columns.index(text_col)]), chain))
    return scored.filter(F.col("p.p_toxic") <= how.threshold).select(*names).toDF(*docs.columns)
