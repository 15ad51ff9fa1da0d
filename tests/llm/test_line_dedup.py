import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import line_dedup
from plumbline.llm.line_dedup import characters, differing, may_be_within, wide_within, within, without_duplicate_lines

OUTER = " \t\r\x0b\x0c"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def brute(rows, t, least):
    lines = {}
    for at, (i, text, *_) in enumerate(rows):
        for pos, line in enumerate((text or "").split("\n")):
            if line.strip(OUTER):
                lines.setdefault(line.strip(OUTER), []).append((i is None, i or 0, at, pos))
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    long = [x for x in lines if len(x) >= least]
    for n, a in enumerate(long):
        for b in long[n + 1 :]:
            if abs(len(a) - len(b)) <= t and edits(a, b) <= t:
                parent[find(a)] = find(b)
    first = {}
    for x in lines:
        first[find(x)] = min(first.get(find(x), (9,)), *lines[x])
    out = []
    for at, (i, text, *_) in enumerate(rows):
        if text is not None:
            text = "\n".join(x for pos, x in enumerate(text.split("\n")) if not x.strip(OUTER) or first[find(x.strip(OUTER))] == (i is None, i or 0, at, pos))
        out.append((i, text))
    return sorted(out, key=repr)


def mutated(s, rnd):
    s = list(s)
    for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
        p = rnd.randrange(len(s) + 1)
        kind = rnd.choice("rip")
        if kind == "i":
            s.insert(p, rnd.choice("abcdeé"))
        elif p < len(s):
            s[p : p + 1] = rnd.choice("abcde") if kind == "r" else ""
    return "".join(s)


@pytest.mark.parametrize("t, bucket", [(1, 256), (1, 2), (2, 256), (2, 2)])
def test_against_brute_force(spark, t, bucket):
    rnd = random.Random(t)
    base = ["".join(rnd.choice("abcde é") for _ in range(rnd.randint(5, 18))).strip() for _ in range(25)] + ["same line here"]
    rows = [(i, "\n".join(mutated(rnd.choice(base), rnd) for _ in range(rnd.randint(0, 6))), "x", "y") for i in range(50)]
    rows += [(100, None, "x", "y"), (None, f"{base[0]}\n  \n{base[1]}", "x", "y"), (101, "", "x", "y"), (7, rows[7][1], "x", "y"), (102, " same line here\t\n\nsame line here", "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, line string, h0 string").coalesce(1)
    got = without_duplicate_lines(df, threshold=t, min_chars=6, bucket=bucket)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows, t, 6)


@pytest.mark.parametrize("t", [1, 2, 3])
def test_bit_parallel_distance(spark, t):
    rnd = random.Random(9)
    pairs = []
    for _ in range(300):
        a = "".join(rnd.choice("abé𝒳") for _ in range(rnd.randint(0, 12)))
        b = mutated(a, rnd) if rnd.random() < 0.8 else a[::-1]
        pairs.append((min(a, b, key=len), max(a, b, key=len)) if len(a) != len(b) else (a, b))
    df = spark.createDataFrame(pairs, "a string, b string").withColumns({"x": characters(F.col("a")), "y": characters(F.col("b"))})
    df = df.select("a", "b", within(F.col("x"), F.col("y"), t).alias("w"))
    for r in df.collect():
        assert r.w == (edits(r.a, r.b) <= t), (r.a, r.b)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert without_duplicate_lines(df, counts=True).count() == 0


@pytest.mark.parametrize("bucket", [256, 8])
def test_edits_grow_with_length(spark, bucket):
    rnd, steps = random.Random(5), ((6, 1), (14, 2), (22, 3))
    base = ["".join(rnd.choice("abcde") for _ in range(n)) for n in (6, 8, 12, 13, 14, 15, 16, 20, 21, 22, 23, 24, 30)]
    rows = [(i, "\n".join(mutated(b, rnd) for b in base)) for i in range(8)]
    got = without_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), threshold=steps, bucket=bucket)
    parent = {x: x for _, t in rows for x in t.split("\n")}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            n = min(len(a), len(b))
            if edits(a, b) <= max([t for least, t in steps if n >= least], default=0):
                parent[find(a)] = find(b)
    seen, want = set(), []
    for i, text in rows:
        left = []
        for x in text.split("\n"):
            if find(x) not in seen:
                seen.add(find(x))
                left.append(x)
        want.append((i, "\n".join(left)))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == want


def test_long_lines_within_three_edits_are_one(spark):
    line = " ".join(f"word{i}" for i in range(100))
    rows = [(1, line), (2, line.replace("word7 ", "Word7 ").replace("word50", "ward50").replace("word90", "worn90"))]
    got = without_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, line), (2, "")]


def test_pairs_lose_no_edits_before_the_distance(spark):
    """What is filtered before the distance is not within, and cutting common ends keeps the distance."""
    rnd = random.Random(11)
    rows = []
    for _ in range(300):
        a = "".join(rnd.choice("abé𝒳c") for _ in range(rnd.randint(1, 80)))
        b = mutated(mutated(a, rnd), rnd) if rnd.random() < 0.9 else a + a
        rows.append((min(a, b, key=len), max(a, b, key=len)))
    df = spark.createDataFrame(rows, "s string, l string").withColumns({"x": F.col("s"), "y": F.col("l")})
    df = df.withColumns({"s_wide": F.encode("s", "UTF-32"), "l_wide": F.encode("l", "UTF-32")})
    df = df.withColumns({f"may{t}": may_be_within(t) for t in (1, 2, 3)})
    for r in differing(df.drop("s_wide", "l_wide")).collect():
        d = edits(r.x, r.y)
        assert all(r[f"may{t}"] or d > t for t in (1, 2, 3)) and edits(r.s, r.l) == d and len(r.s) <= len(r.l)
        assert not r.s or (r.s[0] != r.l[0] and r.s[-1] != r.l[-1])


@pytest.mark.parametrize("t", [1, 2, 3])
def test_distance_by_diagonals(spark, t):
    """Long common runs, edits at the begin, the end and beside one another, empty texts."""
    rnd = random.Random(t)
    pairs = [("", ""), ("", "a"), ("a" * 70_000, "a" * 69_999 + "b"), ("ab" * 40, "ba" * 40), ("x" * 200 + "abc", "x" * 200)]
    for _ in range(200):
        a = "".join(rnd.choice("abé𝒳") for _ in range(rnd.randint(0, 60)))
        pairs.append((a, mutated(mutated(a, rnd), rnd)))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.encode("a", "UTF-32").alias("x"), F.encode("b", "UTF-32").alias("y"))
    for r in df.select("a", "b", wide_within("x", "y", t).alias("w")).collect():
        assert r.w == ((edits(r.a, r.b) if len(r.a) < 1000 else 1) <= t), (r.a, r.b)


def test_lines_far_apart_are_not_paired(spark, monkeypatch):
    """Near lines that share most of their text but differ by more than the edits: few texts are fetched in pairs."""
    rnd, made = random.Random(4), []
    real = line_dedup.verified
    monkeypatch.setattr(line_dedup, "verified", lambda pairs, *more: made.append(pairs.count()) or real(pairs, *more))
    common = " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(12))
    lines = [common + " " + "".join(rnd.choice("klmnopqrst") for _ in range(12)) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in without_duplicate_lines(df).collect()) == list(enumerate(lines))
    assert made[1] < 1000  # 120 * 119 / 2 pairs share a bucket


def test_a_line_often_repeated_meets_its_neighbour(spark):
    line = "the same line of text again and again"
    rows = [(i, line) for i in range(40)] + [(50, line + "s"), (51, line[1:]), (52, "another line of text altogether")]
    got = without_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"), bucket=8)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(0, line), *((i, "") for i in range(1, 40)), (50, ""), (51, ""), rows[-1]]
