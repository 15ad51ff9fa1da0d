import math
from collections import Counter

import pytest

from plumbline.llm.lm_score import lm_scores


def brute(rows, order, alpha=0.4):
    docs = [(t or "").encode().lower().split() for _, t in rows]
    grams = [[Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) for n in range(1, order + 1)] for w in docs]
    total = [sum((g[n] for g in grams), Counter()) for n in range(order)]
    out = []
    for (doc_id, _), words, own in zip(rows, docs, grams):
        rest = max(sum(map(len, docs)) - len(words), 1)
        seen = lambda g: total[len(g) - 1][g] - own[len(g) - 1][g]

        def score(g):
            if len(g) == 1:
                return (seen(g) or alpha) / rest
            return seen(g) / seen(g[:-1]) if seen(g) else alpha * score(g[1:])

        logs = [math.log(score(tuple(words[max(0, i - order + 1) : i + 1]))) for i in range(len(words))]
        out.append((doc_id, len(words), sum(logs)))
    return out


@pytest.mark.parametrize("order, block, shards", [(1, 10, 3), (2, 7, 1), (3, 20, 5), (4, 10**6, 2)])
def test_against_brute_force(spark, order, block, shards):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(25).collect()]
    rows = [(i, " ".join(t.split()[:60])) for i, t in rows] + [(900, None), (901, " \n"), (902, "THE the"), (902, "THE the"), (None, "a b c a b c")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, block string").coalesce(2)
    got = sorted(((r.doc_id, r.n_words, r.log_score) for r in lm_scores(df, order=order, block_words=block, shards=shards).collect()), key=repr)
    want = sorted(brute(rows, order), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_alone_and_empty(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = lm_scores(df).first()
    assert r.log_score == pytest.approx(math.log(0.4) + math.log(0.4 * 0.4)) and r.mean_log_score == pytest.approx(r.log_score / 2)
    assert lm_scores(df.limit(0)).count() == 0
    nothing = lm_scores(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert [(r.n_words, r.log_score, r.mean_log_score) for r in nothing] == [(0, 0.0, None)] * 2
