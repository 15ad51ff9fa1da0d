import random
import re
from collections import defaultdict
from itertools import permutations

from plumbline.llm.filter_audit import Diagram, all_orders, filter_audit, neighbour_swaps

SCHEMA = "doc_id long, text string, lang string, mask string, n string"


def by_hand(filters, counts):
    """The rows of all orders, straight from their definition."""
    removed_by, out = defaultdict(int), {}
    for order in map("".join, permutations(filters)):
        for step, name in enumerate(order, 1):
            row = defaultdict(int)
            for mask, (n, good, toxic) in counts.items():
                fails = {f for i, f in enumerate(filters) if mask >> i & 1}
                earlier = fails & set(order[: step - 1])
                row["kept"] += n * (not fails & set(order[:step]))
                row["removed"] += n * (name in fails and not earlier)
                row["redundant"] += n * (name in fails and bool(earlier))
                row["unique"] += n * (fails == {name})
                row["good"] += good * (name in fails and not earlier)
                row["toxic"] += toxic * (name in fails and not earlier)
            removed_by[name] += row["removed"]
            out[order, step] = tuple(row[k] for k in ("kept", "removed", "redundant", "unique", "good", "toxic"))
    return [(o, s, *r, removed_by[o[s - 1]]) for (o, s), r in sorted(out.items())]


def test_swaps_meet_every_order():
    for n in (1, 2, 3, 5):
        order, met = list(range(n)), {tuple(range(n))}
        for at in neighbour_swaps(n):
            order[at], order[at + 1] = order[at + 1], order[at]
            assert tuple(order) not in met
            met.add(tuple(order))
        assert len(met) == len(list(permutations(range(n))))


def test_orders_by_hand():
    rnd = random.Random(1)
    for filters in ("A", "AB", "ABC", "ABCDE"):
        for density in (0.1, 0.5, 1):
            masks = [m for m in range(1 << len(filters)) if rnd.random() < density]
            counts = {m: (n := rnd.randint(1, 9), rnd.randint(0, n), rnd.randint(0, n)) for m in masks}
            assert all_orders(filters, counts) == by_hand(filters, counts)


def test_equal_nodes_are_one():
    same = {m: (7, 1, 0) for m in range(32)}
    assert len(Diagram("ABCDE", same).nodes) == 1 + 1 + 5  # the empty leaf, the leaf, a node per level
    assert Diagram("ABCDE", {}).root == 0


def brute(rows, labels):
    ids = defaultdict(list)
    for i, t, *_ in rows:
        ids[t or ""].append(i)
    parts = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
    for i, text, lang, *_ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)),
            i is not None and any(j is not None and j < i for j in ids[t]),
        ]
        cell = parts[lang or ""][sum(f << k for k, f in enumerate(fails))]
        cell[0] += 1
        cell[1] += any(d == i and q == 1 for d, q, _ in labels if i is not None)
        cell[2] += any(d == i and x == 1 for d, _, x in labels if i is not None)
    return sorted((part, *row) for part, counts in parts.items() for row in by_hand("ABCDE", {m: tuple(c) for m, c in counts.items()}))


def test_frame(spark):
    rnd = random.Random(2)
    word = lambda: rnd.choice(["alpha", "Beta", "x#", "γδ", f"w{rnd.randrange(400)}"])
    pool = [None, "", " \t\n", "A B C", "a\x0bb\x1cc"] + [" ".join(word() for _ in range(rnd.choice([3, 150, 260, 300]))) for _ in range(20)]
    rows = [(rnd.choice([None, *range(60)]), rnd.choice(pool), rnd.choice(["en", "de", None, ""]), "m", "n") for _ in range(150)]
    rows += [(100 + i, pool[6], "en", None, None) for i in range(200)] + [(100, pool[6], "de", None, None), (500, "y " * 200_000 + "Z", "fr", None, None)]
    labels = [(rnd.randrange(130), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(90)] + [(None, 1, 1)]
    df, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit(df, marks)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == brute(rows, labels)
    assert filter_audit(df.limit(0), marks).collect() == []
    unlabelled = filter_audit(df, marks.limit(0)).collect()
    assert len(unlabelled) == 4 * 600 and not any(r.good_lost or r.toxic_lost for r in unlabelled)
