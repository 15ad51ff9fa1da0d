import itertools
import random

import numpy as np
import xxhash

from plumbline.llm.simhash import fingerprint, links, near_duplicates, one_of_each, partitions, thresholds


def slow_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


TEXTS = [None, "", " \t", "One", "one", "one two", "a b c", "A  B\nC", "É é ß", "a b c d e f g " * 40, "x y z w " * 5 + "tail"]


def test_fingerprint():
    for t in TEXTS:
        assert fingerprint(t) % (1 << 64) == slow_fingerprint(t)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c') h").first().h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def crowd(n=400, seed=4):
    """Fingerprints in tight groups, so that buckets are hot and many pairs are just in or out."""
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        x = rnd.choice(centres)
        for b in rnd.sample(range(64), rnd.randint(0, 4)):
            x ^= 1 << b
        out.add(x)
    return [x - (1 << 64) if x >> 63 else x for x in out]


def test_links_lose_no_pair(spark):
    fps = crowd()
    want = {(a, b) for a, b in itertools.product(fps, fps) if a < b and bin((a ^ b) % (1 << 64)).count("1") <= 2}
    nodes = spark.createDataFrame([(x,) for x in fps], "fp long")
    for bucket in (256, 8):
        assert {(r.a, r.b) for r in links(nodes, bucket=bucket).collect()} == want


def test_thresholds_are_the_cheapest():
    rnd = random.Random(1)
    for parts in (2, 3, 4):
        cost = [[0.0, *sorted(rnd.random() for _ in range(3))] for _ in range(parts)]
        total, chosen = thresholds(cost, 2)
        every = [t for t in itertools.product(range(-1, 3), repeat=parts) if sum(t) == 2 - parts + 1]
        assert sum(chosen) == 2 - parts + 1
        assert abs(total - min(sum(c[t + 1] for c, t in zip(cost, ts)) for ts in every)) < 1e-12


def test_correlated_bits_share_a_partition():
    x = np.random.default_rng(0).integers(0, 2, (500, 64))
    x[:, 40] = x[:, 3]
    masks = partitions(500, (x.T @ x).astype(float), 3)
    assert sum(masks) == (1 << 64) - 1
    assert any(m >> 3 & 1 and m >> 40 & 1 for m in masks)


SCHEMA = "doc_id long, text string, fp string, row string, component_id string"


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(300))
    texts = [*TEXTS, base, base, base.upper(), base + " more", base.replace("w7 ", "q7 ")]
    rows = [(i, t, "a", "b", "c") for i, t in enumerate(texts)] + [(None, "", "a", "b", "c"), (None, "lone words here", "a", "b", "c"), (3, "one", "a", "b", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = near_duplicates(df).collect()
    fps = [slow_fingerprint(r[1]) for r in rows]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if bin(fps[i] ^ fps[j]).count("1") <= 2) for i in range(len(rows))]
    groups = {}
    for (d, *_), c in zip(rows, label):
        groups.setdefault(c, []).append(d)
    low = {c: min((d for d in ds if d is not None), default=None) for c, ds in groups.items()}
    want = sorted(((r[0], f"{f:016x}", low[c]) for r, f, c in zip(rows, fps, label)), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(low.values(), key=repr)
    assert near_duplicates(df.limit(0)).count() == 0 and one_of_each(df.limit(0)).count() == 0
