import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import lexical_search
from plumbline.llm.lexical_search import Best, saturation, search, terms

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCHEMA = "doc_id long, text string, score string, item_id string"


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(TERM, text or "")]


def brute(docs, items, top=10):
    """Every score of every document, from the definition."""
    vectors = [(i, Counter(words(t))) for i, t, *_ in docs]
    held = [(i, c) for i, c in vectors if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    chosen = {}
    for item, text in items:
        chosen[item] = min(chosen.get(item, text or ""), text or "")
    for item, text in chosen.items():
        found = []
        for i, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in words(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed, n):
    rnd = random.Random(seed)
    word = lambda: f"{rnd.choice('abcdé')}{min(int(rnd.expovariate(0.1)), 60)}"
    docs = [(i, " ".join(word().upper() if rnd.random() < 0.1 else word() for _ in range(rnd.choice([0, 1, 5, 40])))) for i in range(n)]
    docs += [(n + i, docs[7][1] + " a1 a1") for i in range(300)]  # more copies than a leaf holds
    docs += [(None, docs[9][1]), (None, "a1-b2_c3"), (3, docs[3][1]), (n + 999, None), (n + 998, " .,\n"), (n + 997, "a0 ÀÉ b1 " * 30_000)]
    items = [(k, " ".join(word() for _ in range(rnd.choice([1, 6, 90])))) for k in range(12)] + [(12, None), (13, "-"), (14, "unseen"), (5, "a1 a1 b0"), (None, "c1 c2")]
    return docs, items


@pytest.fixture(params=[2, 128])
def leaf(request, monkeypatch):
    monkeypatch.setattr(lexical_search, "LEAF", request.param)


def test_against_every_document(spark, leaf):
    docs, items = corpus(1, 400)
    df = spark.createDataFrame([(*d, "s", "t") for d in docs], SCHEMA).repartition(5)
    queries = spark.createDataFrame([(*q, 1) for q in items], "item_id long, text string, rank int")
    got = lexical_search.lexical_search(df, queries)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute(docs, items)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    blocks = lexical_search.lexical_search(df, queries, top=3, items_per_pass=4)
    assert sorted(map(tuple, blocks.collect()), key=repr) == brute(docs, items, 3)
    assert lexical_search.lexical_search(df.limit(0), queries).collect() == lexical_search.lexical_search(df, queries.limit(0)).collect() == []


def test_small_tries(spark, leaf, monkeypatch):
    monkeypatch.setattr(lexical_search, "TRIE_DOCS", 1)
    docs, items = corpus(2, 120)
    df = spark.createDataFrame([(*d, "s", "t") for d in docs], SCHEMA)
    got = lexical_search.lexical_search(df, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_branches_are_left_out():
    rnd = np.random.default_rng(3)
    tf = (rnd.random((20_000, 30)) < np.linspace(0.6, 0.01, 30)) * rnd.integers(1, 5, (20_000, 30))
    tf[123] = 4
    m, weights = rnd.integers(25, 400, 20_000), np.linspace(100, 6000, 30).astype(np.int64)
    best = Best(10)
    scored = search(tf, m, np.arange(20_000), np.zeros(20_000, bool), weights, best)
    every = saturation(tf, m[:, None]) @ weights
    assert best.scores.tolist() == sorted(every.tolist(), reverse=True)[:10] and best.ids[0] == 123
    assert scored < 15_000


def test_terms():
    for t in (None, "", "Ab-cD_e1\x7fÉÀ ñ\x00x", "a'b  C", "İ ß 中文"):
        assert [w.decode() for w in terms(t)] == words(t)
