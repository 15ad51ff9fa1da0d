import random

import corpus_pipeline
from plumbline.llm import near_dedup
from plumbline.llm.near_dedup import least_difference, prefix, shingles, sketch, without_near_copies
from plumbline.llm.simhash import fingerprint
import numpy as np

SCHEMA = "doc_id long, text string, row string, root string"


def sets(text, size=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) > size else {tuple(w)}


def kept(rows):
    """Ids kept, by brute force over all pairs."""
    own = [sets(r[1]) for r in rows]
    label = list(range(len(rows)))
    for _ in rows:
        new = [min(label[j] for j in range(len(rows)) if 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j])) for i in range(len(rows))]
        if new == label:
            break
        label = new
    groups = {}
    for r, c in zip(rows, label):
        groups.setdefault(c, []).append(r[0])
    return sorted((min((d for d in ds if d is not None), default=None) for ds in groups.values()), key=repr)


def documents(seed=1):
    """Groups of near-copies around the threshold, behind one passage that all share."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    passage, out = [word() for _ in range(30)], [None, "", " \t", "One", "one", "a b c d e", "a b c d e f", "A b c  d e f"]
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([12, 60, 200]))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 40))):
                copy[rnd.randrange(len(copy))] = word()
            out.append(" ".join(passage + copy if rnd.random() < 0.5 else copy))
    rnd.shuffle(out)
    return [(i, t, "a", "b") for i, t in enumerate(out)] + [(None, "all alone here", "a", "b"), (3, out[3], "a", "b")]


def test_against_all_pairs(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA)
    got = without_near_copies(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id for r in got.collect()), key=repr) == kept(rows)
    assert without_near_copies(df.limit(0)).count() == 0


def test_stage_drops_what_two_bits_miss(spark):
    base = [f"w{i}" for i in range(300)]
    copies = [" ".join(f"q{k}" if k and i in (40 * k, 40 * k + 20) else w for i, w in enumerate(base)) for k in range(5)]
    assert max(bin((fingerprint(copies[0]) ^ fingerprint(c)) % (1 << 64)).count("1") for c in copies) > 2
    df = spark.createDataFrame([(i, c) for i, c in enumerate(copies)] + [(9, "something else")], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, df, "").collect()) == [0, 9]


def test_any_order_keeps_a_shared_shingle():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        n = int(rnd.integers(1, 60))
        x = rnd.choice(400, n, replace=False)
        y = np.unique(np.r_[x[rnd.random(n) > 0.08], rnd.integers(0, 400, int(rnd.integers(0, 6)))])
        x = np.sort(x)
        frequent = np.sort(rnd.choice(400, 100, replace=False))
        rank = rnd.permutation(100)
        both = len(np.intersect1d(x, y))
        if len(y) and 5 * both >= 4 * (len(x) + len(y) - both):
            assert np.intersect1d(prefix(x, frequent, rank), prefix(y, frequent, rank)).size
    assert len(shingles("a b c d e f")) == 2 and len(shingles("")) == 1


def test_stage_drops_what_simhash_links(spark, monkeypatch):
    """The named method by itself: of fingerprints that link the smallest id stays; texts without words link."""
    monkeypatch.setattr(corpus_pipeline, "without_near_copies", lambda docs: docs)
    base = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(3, base), (1, base.upper()), (9, "something else"), (12, None), (11, " ")], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, df, "").collect()) == [1, 9, 11]


def test_sketches_differ_no_more_than_their_sets():
    rnd = np.random.default_rng(5)
    for _ in range(300):
        x = np.unique(rnd.integers(-(1 << 62), 1 << 62, int(rnd.integers(1, 400))))
        y = np.unique(np.r_[x[rnd.random(len(x)) > rnd.random() / 2], rnd.integers(-(1 << 62), 1 << 62, int(rnd.integers(1, 90)))])
        least = least_difference(sketch(x), sketch(y))
        assert least <= len(np.setxor1d(x, y)) and least_difference(sketch(x), sketch(x)) == 0
    apart = [sketch(rnd.integers(-(1 << 62), 1 << 62, 300)) for _ in range(2)]
    assert least_difference(*apart) > 200


def test_texts_of_documents_far_apart_are_not_fetched(spark, monkeypatch):
    """Documents that share a passage among their first shingles, but not much more."""
    rnd, met = random.Random(6), []
    real = near_dedup.alike
    monkeypatch.setattr(near_dedup, "alike", lambda pairs, *more: met.append(pairs.count()) or real(pairs, *more))
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([*passage, *(f"w{rnd.randrange(9999)}" for _ in range(60))])) for i in range(60)]
    df = spark.createDataFrame([*rows, (90, rows[0][1] + " end")], "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "LEAST", 10_000)  # no shingle counts as frequent
    assert sorted(r.doc_id for r in without_near_copies(df).collect()) == list(range(60))
    assert sum(met) <= 2
