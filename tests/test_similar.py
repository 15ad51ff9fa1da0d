import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from plumbline.operators.aggregates import grouped_median, grouped_quantiles
from plumbline.operators.similar import similar_pairs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rnd, s, n):
    for _ in range(n):
        i = rnd.randrange(len(s) + 1)
        s = rnd.choice([s[:i] + rnd.choice("abé ") + s[i:], s[:i] + s[i + 1 :], s[:i] + rnd.choice("abcd") + s[i + 1 :]])
    return s


@pytest.mark.parametrize("floor, need", [(0.5, 1), (0.65, 2), (0.65, 4), (0.9, 2), (1.0, 2)])
def test_similar_pairs_are_those_of_all_pairs(spark, floor, need):
    rnd = random.Random(int(floor * 100) + need)
    names = {"".join(rnd.choice("abcd é") for _ in range(rnd.randint(1, 24))) for _ in range(60)} | {"a", "aaaa", "aaaaaaab", "\u0001", "日本語"}
    texts = {changed(rnd, s, rnd.randint(0, 6)) for s in sorted(names) for _ in range(3)} - {""}
    lrows = [("x" if i % 3 else None if i % 2 else "y", t) for i, t in enumerate(sorted(texts))]
    rrows = [(b, n) for n in sorted(names) for b in ("x", "y", None)]
    want = {(b, t, n) for b, t in lrows for c, n in rrows if b and b == c and 1.0 - distance(t, n) / max(len(t), len(n)) >= floor}
    got = similar_pairs(
        spark.createDataFrame(lrows, "b string, t string"), "t", spark.createDataFrame(rrows, "b string, n string"), "n", ["b"], floor, need).collect()
    assert len(got) == len(want) and {(r.b, r.t, r.n) for r in got} == want
    assert all(r.score == 1.0 - distance(r.t, r.n) / max(len(r.t), len(r.n)) for r in got)


def test_similar_pairs_of_empty_tables_and_low_floors(spark):
    none = spark.createDataFrame([], "t string")
    one = spark.createDataFrame([("ab",)], "n string")
    assert similar_pairs(none, "t", one, "n").count() == 0
    assert similar_pairs(one, "n", none, "t").count() == 0
    with pytest.raises(ValueError):
        similar_pairs(none, "t", one, "n", floor=0.4)


@pytest.mark.parametrize("ranges", [2, 5, 256])
def test_quantiles_against_sorted_values(spark, ranges):
    rnd = random.Random(ranges)
    data = {
        "one": [7.0], "ties": [3.0] * 50 + [1.0] * 20, "wide": [rnd.uniform(-1e9, 1e9) for _ in range(400)],
        "hot": [float(rnd.choice([0, 0, 0, 1, rnd.randint(2, 90)])) for _ in range(900)], None: [2.0, 4.0],
    }
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("none", None), ("one", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    asked = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r.k: r for r in grouped_quantiles(df, "k", F.col("v"), asked, ranges).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        for name, q in asked.items():
            assert got[k][name] == sorted(vs)[max(1, math.ceil(round(q * len(vs), 6))) - 1]
    medians = {r.k: r.m for r in grouped_median(df, "k", F.col("v"), "m", ranges).collect()}
    assert medians == {k: statistics.median(vs) for k, vs in data.items()}
    assert grouped_median(df.limit(0), "k", F.col("v"), "m").count() == 0
