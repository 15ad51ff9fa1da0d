"""Duplicate lines over a corpus, exact and within an edit distance, from built-in functions only.

Two lines within t edits: cut one into t + 1 segments, and at least one segment stands unchanged in the
other, moved by no more than the edits before it. So every line is put into an index by its length and
each of its segments, and looks up its own substrings of the lengths, places and shifts that a match
allows. The edits allowed grow with the length of the shorter line. A pair found is verified by a bit-parallel
edit distance on the band of 2 t + 1 diagonals.

A bucket of the index with many lines (a template, say) is not joined: the matching segment is cut out of
its lines and the rest, which must be within t edits too, is partitioned again under the bucket's key. This
repeats until buckets are small or rests are within t edits by their length, and leaves out no pair.

Lines are written once, as they are read; entries are made from them where they are used and travel as hashes.
Texts are fetched for the lines of candidate pairs only, and for the documents once, when the dropped lines are
taken out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.graph import components
from plumbline.llm.shared import scratch, stored, with_places

#: (characters of the shorter line from which on, edits allowed).
THRESHOLDS = ((25, 1), (150, 2), (500, 3))
#: Lines of a bucket joined pair by pair at most.
BUCKET = 256
#: Frequent characters that are counted to rule out pairs, and the lines they are found in.
COUNTED, SAMPLE = 36, 1000
OUTER = " \t\r\x0b\x0c"


def _lines(rows: DataFrame) -> DataFrame:
    """(file, at, id, pos, h0, h1, line) of each line with a word, without its outer white space."""
    split = rows.select("file", "at", "id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
    trimmed = split.select("file", "at", "id", "pos", F.btrim("raw", F.lit(OUTER)).alias("line")).filter("line <> ''")
    return trimmed.select("*", F.xxhash64("line").alias("h0"), F.xxhash64(F.lit(1), "line").alias("h1"))


def _probes(t: int, least: int, own: bool) -> list[Column]:
    """For t edits: which segment, how much shorter a line it looks up, and by how much the segment is moved."""
    moves = [(i, gap, shift) for gap in range(t + 1) for i in range(t + 1) for shift in range(max(-i, gap - (t - i)), min(i, gap + (t - i)) + 1)]
    names = ("t", "least", "i", "less", "shift")
    return [F.struct(*[F.lit(x).alias(n) for n, x in zip(names, (t, least, *m))]) for m in moves if not own or m[1] == m[2] == 0]


def _banded(thresholds: tuple, own: bool) -> Column:
    """The probes of a line's band; near its end also those of the next, whose shorter lines it may be linked to."""
    length, bands = F.col("length"), None
    for n, (shortest, t) in reversed(list(enumerate(thresholds))):
        here = _probes(t, shortest, own)
        if n + 1 == len(thresholds):
            bands = F.when(length >= shortest, F.array(*here))
        else:
            upto, next_ = thresholds[n + 1]
            both = F.array(*here, *_probes(next_, upto, own))
            bands = F.when((length >= upto + t), bands).when(length >= upto, both).when(length >= shortest, F.array(*here))
    return bands


def _entries(rows: DataFrame, probes: Column) -> DataFrame:
    """The index and look-up entries (key, probe) of lines (seed, id, text, own, gap), with id and text.

    own rows are in the index and look up too; the others look up lines that are `gap` shorter. probe holds the probe's
    numbers in one, so that an entry is small when it is moved; `_place` finds its segment again.

    Segments, gaps and shifts are fixed tables by which every line is multiplied, so that one small expression makes
    all entries. Characters are of one width, so that a segment is found by its place.
    """
    met = rows.withColumns({"length": F.length("text"), "wide": F.encode("text", "UTF-32")})
    met = met.withColumn("p", F.explode(probes)).select("seed", "id", "text", "own", "gap", "length", "wide", "p.*")
    met = _place(met).filter("indexed >= least and start >= 0 and start + size <= length")
    found = F.xxhash64("seed", "t", "i", "indexed", F.expr("substring(wide, 4 * start + 1, 4 * size)"))
    probe = F.expr("t + 256L * (i + 256L * (less + 256L * (shift + t + 256L * if(own and less = 0 and shift = 0, 1, 0))))")
    return met.select(found.alias("key"), probe.alias("probe"), "id", "text")


def _place(met: DataFrame) -> DataFrame:
    """With the segment's start and size, from a line's length and the probe."""
    # of the line looked up: its length, that of a short segment, and how many are short
    met = met.withColumn("indexed", F.expr("length - less"))
    met = met.withColumns({"base": F.expr("cast(indexed div (t + 1) as int)"), "plain": F.expr("t + 1 - indexed % (t + 1)")})
    return met.withColumns({"size": F.expr("base + if(i >= plain, 1, 0)"), "start": F.expr("base * i + greatest(0, i - plain) + shift")})


#: Of an entry's probe: the edits, and whether the entry is in the index.
EDITS, OWN = "cast(probe & 255 as int) t", "probe >= 4294967296 own"


def _unpacked(entries: DataFrame) -> DataFrame:
    numbers = [f"cast(shiftright(probe, {8 * k}) & 255 as int) {name}" for k, name in enumerate(("t", "i", "less", "moved"))]
    return entries.selectExpr("*", *numbers, OWN).withColumn("shift", F.expr("moved - t"))


def _with_ids(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """The lines (id, h1, text) whose id is among the ids. A shuffled join at every size, so that small and large tables
    are worked alike."""
    met = lines.join(ids.hint("shuffle_hash"), lines.h0 == ids.id, "left_semi")
    return stored(met.select(F.col("h0").alias("id"), "h1", F.col("line").alias("text")).distinct(), "line-texts")


def _met(own: DataFrame, every: DataFrame) -> DataFrame:
    """The entries whose key is in the index for another line, with n, the lines in the index under the key (equal ones
    too), lo, the smallest of them, and whether it is alone. As many rows as entries at most, however many lines share a key. The entry of a line that is
    in the index alone is left out, even when others look it up: it is lo."""
    keys = own.filter("probe >= 4294967296").groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
    met = every.join(keys.hint("shuffle_hash"), "key").filter("not (lo = hi and id = lo)")
    return stored(met.withColumn("alone", F.expr("lo = hi")).drop("hi"), "shared-entries")


def buckets(lines: DataFrame, thresholds: tuple, bucket: int) -> tuple[DataFrame, DataFrame]:
    """(key, t, own, id): lines under one key, of which those that are own and any other may be within t edits. All
    pairs that are within share a key. A key has at most `bucket` own lines, or they are all linked. With it the lines'
    (id, h1, text)."""
    first = lines.select(F.lit(0).cast("long").alias("seed"), F.col("h0").alias("id"), F.col("line").alias("text"), F.lit(True).alias("own"), F.lit(0).alias("gap"))
    own, every = _entries(first, _banded(thresholds, own=True)), _entries(first, _banded(thresholds, own=False))
    met, found = _met(own, every.drop("text")), []
    texts = _with_ids(lines, met.select("id").union(met.filter("alone").select("lo")).distinct())
    again = reduce(lambda c, b: c.when(F.col("edits") == b[1], F.array(*_probes(b[1], 0, own=False))), thresholds, F.when(F.lit(False), None))
    while True:
        # equal lines have equal entries, so a line repeated may count as a bucket of many lines, but not alone
        found.append(met.filter(F.col("alone") | (F.col("n") <= bucket)).selectExpr("key", EDITS, OWN, "id").distinct())
        found.append(met.filter("alone").selectExpr("key", EDITS, "true own", "lo id").distinct())
        rows = met.filter(~F.col("alone") & (F.col("n") > bucket)).drop("n", "lo", "alone").distinct()
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, found), texts
        if "text" not in rows.columns:  # deeper down, entries carry what is left of their text
            rows = rows.join(texts.select("id", "text"), "id")
        # every matched segment has a character at least, so the rests get shorter until they are within t
        rows = _place(_unpacked(rows.withColumn("length", F.length("text"))))
        rest = F.concat(F.expr("substring(text, 1, start)"), F.expr("substring(text, start + size + 1)"))
        deep = stored(rows.select(F.col("key").alias("seed"), F.col("t").alias("edits"), "id", rest.alias("text"), "own", F.col("less").alias("gap")).distinct(), "rests")
        # lines of the index had the same places cut out: when t characters are left, they differ in these only
        left = F.length("text") - F.when(F.col("own"), 0).otherwise(F.col("gap"))  # of the lines looked up
        short = deep.filter(left <= F.col("edits"))
        found.append(short.select(F.xxhash64("seed", F.lit("rest")).alias("key"), F.col("edits").alias("t"), "own", "id").distinct())
        # an entry looks up the gap it came with
        probes = F.filter(again, lambda p: p["less"] == F.col("gap"))
        rows = stored(_entries(deep.filter(left > F.col("edits")), probes).distinct(), "segment-keys")
        met = _met(rows, rows)


def _wide(name: str) -> Column:
    """Characters of one width: a part is found by its place, without counting from the begin."""
    return F.encode(name, "UTF-32").alias(f"{name}_wide")


def may_be_within(t: int) -> Column:
    """Whether s and l, the shorter and the longer text, can be within t edits, from s_wide and l_wide: of 16 t segments
    of s, all but t stand in l, moved by t at most. It spares most pairs with too many edits the edit distance."""
    k, n = 16 * t, "(octet_length(s_wide) div 4)"
    start, end = f"({n} * i div {k})", f"({n} * (i + 1) div {k})"
    place = f"substring(l_wide, cast(4 * greatest(0, {start} - {t}) as int) + 1, cast(4 * ({end} - {start} + {2 * t}) as int))"
    held = f"contains({place}, substring(s_wide, cast(4 * {start} as int) + 1, cast(4 * ({end} - {start}) as int)))"
    return F.expr(f"size(filter(sequence(0, {k - 1}), i -> {held})) >= {k - t}")


def _shared(s: str, l: str) -> Column:
    """How many characters the texts of two wide columns have in common at their begin (up to 131071), by halving steps."""
    powers = ", ".join(str(1 << n) for n in reversed(range(17)))
    same = f"substring({s}, 4 * n + 1, 4 * p) = substring({l}, 4 * n + 1, 4 * p)"
    return F.expr(f"aggregate(array({powers}), 0, (n, p) -> if(4 * (n + p) <= least(octet_length({s}), octet_length({l})) and {same}, n + p, n))")


def differing(pairs: DataFrame) -> DataFrame:
    """The pairs with s and l cut to what is between their common begin and end: their edit distance stays. Each step
    is written: a column used by several others would be computed again in each."""
    for _ in range(2):
        pairs = stored(pairs.select("*", _wide("s"), _wide("l")), "wide-pairs").withColumn("n", _shared("s_wide", "l_wide")).drop("s_wide", "l_wide")
        pairs = stored(pairs, "shared-ends").withColumns({x: F.reverse(F.expr(f"substring({x}, n + 1)")) for x in ("s", "l")}).drop("n")
    return stored(pairs, "differing-pairs")


def characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _furthest(na: Column, nb: Column, t: int, equal: Callable[[Column, Column, Column], Column]) -> Column:
    """Whether two texts of na and nb characters are within t edits. equal(n, d, p): whether the p characters of the
    first from n on are those of the second from n + d on.

    Of every diagonal d it keeps how far a path of so many edits gets in the first text; behind an edit a path runs on
    over equal characters, found by halving steps instead of one by one.
    """
    nowhere, powers = F.lit(-(1 << 29)), F.array(*[F.lit(1 << k) for k in reversed(range(30))])

    def run(n: Column, d: Column) -> Column:
        return F.aggregate(powers, n, lambda n, p: F.when((n >= 0) & (n + d >= 0) & (n + p <= na) & (n + d + p <= nb) & equal(n, d, p), n + p).otherwise(n))

    def edited(r: Column, _: Column) -> Column:
        def best(d: Column) -> Column:
            before = [F.coalesce(F.get(r, d + (t + k)), nowhere) for k in (-1, 0, 1)]  # put in, replaced, left out
            return run(F.least(F.greatest(before[0], before[1] + 1, before[2] + 1), na, nb - d), d)

        return F.transform(diagonals, best)

    diagonals = F.array(*[F.lit(d) for d in range(-t, t + 1)])
    first = F.transform(diagonals, lambda d: run(F.when(d == 0, F.lit(0)).otherwise(nowhere), d))
    reached = F.aggregate(F.array(*[F.lit(e) for e in range(t)]), first, edited)
    return F.coalesce(F.get(reached, nb - na + t) >= na, F.lit(False))


def within(a: Column, b: Column, t: int) -> Column:
    """Whether the edit distance of two texts is at most t, from the columns of their characters, which must be columns
    of the table: each step looks into them."""
    return _furthest(F.size(a), F.size(b), t, lambda n, d, p: F.slice(a, n + 1, p) == F.slice(b, n + d + 1, p))


def wide_within(a: str, b: str, t: int) -> Column:
    """`within` from columns of characters of one width."""
    a, b = F.col(a), F.col(b)
    na, nb = (F.floor(F.octet_length(x) / 4).cast("int") for x in (a, b))
    return _furthest(na, nb, t, lambda n, d, p: a.substr(4 * n + 1, 4 * p) == b.substr(4 * (n + d) + 1, 4 * p))


def verified(pairs: DataFrame, texts: DataFrame, thresholds: tuple) -> DataFrame:
    """(a, b, t) of the pairs of ids that are within t edits; texts are (id, name, text)."""
    x, y = texts.toDF("a", "name_a", "text_a"), texts.toDF("b", "name_b", "text_b")
    met = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").filter("name_a <> name_b")
    swap = F.length("text_a") > F.length("text_b")
    met = met.select(
        "name_a", "name_b", "t", F.when(swap, F.col("text_b")).otherwise(F.col("text_a")).alias("s"),
        F.when(swap, F.col("text_a")).otherwise(F.col("text_b")).alias("l"),
    )
    # written: a column used by several others would be computed again in each
    wide = stored(met.select("name_a", "name_b", "t", _wide("s"), _wide("l")), "wide-pairs")
    close = [F.when(F.col("t") == t, F.when(may_be_within(t), wide_within("s_wide", "l_wide", t)).otherwise(False)) for _, t in thresholds]
    tested = stored(wide.select(F.col("name_a").alias("a"), F.col("name_b").alias("b"), F.coalesce(*close).alias("close")), "verified")
    return tested.filter("close").select("a", "b")


def _counted(texts: DataFrame) -> DataFrame:
    """(id, length, n0, n1, ..., others): how often the text of an id holds each of the most frequent characters of some
    of the texts, and all others; null for an id with several texts. Which characters are counted decides only how many pairs are ruled out."""
    texts = stored(texts, "open-texts")
    every = texts.limit(SAMPLE).select(F.explode(characters(F.col("text"))).alias("c"))
    common = [r.c for r in every.groupBy("c").count().orderBy(F.desc("count"), "c").limit(COUNTED).collect()]
    # without one of the characters a text is shorter by as many
    counts = [(F.length("text") - F.length(F.replace("text", F.lit(c), F.lit("")))).alias(f"n{k}") for k, c in enumerate(common or " ")]
    rows = texts.select("id", F.length("text").alias("length"), *counts)
    rows = rows.withColumn("others", reduce(Column.__sub__, map(F.col, rows.columns[2:]), F.col("length")))
    return rows.groupBy("id").agg(*[F.when(F.count("*") == 1, F.min(c)).alias(c) for c in rows.columns[1:]])


def linked_lines(lines: DataFrame, thresholds: tuple = THRESHOLDS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) of line names (both hashes) whose components are those of all lines within the edits their length allows;
    lines (h0, h1, line) may repeat.

    The lines of a key are first compared with the smallest of its index only, which joins groups of many near
    lines without all their pairs. Then those pairs are compared whose lines are not yet in one component.
    """
    met, texts = buckets(lines, thresholds, bucket)
    met = stored(met, "buckets")
    texts = stored(texts.select("id", F.concat(F.hex("id"), F.lit("-"), F.hex("h1")).alias("name"), "text"), "named-texts")
    heads = met.filter("own").groupBy("key").agg(F.min("id").alias("a"))
    stars = met.join(heads, "key").filter("a <> id").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b"), "t")
    stars = stored(stars.distinct(), "stars")
    first = verified(stars, texts, thresholds)
    roots = stored(components(first), "star-roots")
    named = texts.select("id", "name").join(roots, texts.name == roots.node, "left").select("id", F.coalesce("root", "name").alias("root"))
    # of lines with one first hash any root will do: their pairs are compared by name
    named = named.groupBy("id").agg(F.min("root").alias("root"))
    rooted = stored(met.join(named.hint("merge"), "id"), "rooted-buckets")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    open_ = stored(rooted.join(mixed, "key", "left_semi"), "open-buckets")
    counted = stored(_counted(texts.join(open_.select("id").distinct(), "id", "left_semi")), "counted-lines")
    open_, numbers = open_.join(counted, "id"), counted.columns[1:]
    # without nulls the condition is short enough to be compiled
    own, every = ([f"coalesce({c}, 0) {x}_{c}" for c in numbers] for x in "ab")
    a = open_.filter("own").selectExpr("key", "t", "id a", "root root_a", "length is null any_a", *own)
    b = open_.selectExpr("key b_key", "id b", "root root_b", "own indexed", "length is null any_b", *every)
    # an edit changes two counts by one, or one and the length; tested in the join, so that pairs far apart are not made
    near = F.col("any_a") | F.col("any_b") | (reduce(Column.__add__, [F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) for c in numbers]) <= 2 * F.col("t"))
    rest = a.join(b, F.expr("key = b_key and root_a <> root_b and if(indexed, a < b, a <> b)") & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "t")
    rest = stored(rest.distinct().join(stars, ["a", "b", "t"], "left_anti"), "open-pairs")
    return first.unionByName(verified(rest, texts, thresholds))


def _dropped(rows: DataFrame, thresholds: tuple, bucket: int) -> DataFrame:
    """(file, at, dropped) of the documents with lines to drop: the places of those lines."""
    with scratch(rows.sparkSession):
        lines = _lines(rows)
        lines = stored(lines, "lines")
        marks = lines.drop("line")
        repeated = stored(marks.groupBy("h0", "h1").count().filter("count > 1").select("h0", "h1"), "repeated-lines")
        long = lines.filter(F.length("line") >= thresholds[0][0]).select("h0", "h1", "line")
        roots = components(linked_lines(long, thresholds, bucket))
        # a root is named by its hashes; a line that is only repeated is its own
        h0, h1 = (F.conv(F.split_part("node", F.lit("-"), F.lit(k)), 16, -10).cast("long") for k in (1, 2))
        groups = repeated.join(roots.select(h0.alias("h0"), h1.alias("h1"), "root"), ["h0", "h1"], "full")
        groups = stored(groups.select("h0", "h1", F.coalesce("root", F.concat(F.hex("h0"), F.lit("-"), F.hex("h1"))).alias("root")), "line-groups")
        order = F.struct(F.col("id").isNull().alias("n"), "id", "file", "at", "pos")
        found = stored(marks.join(groups.hint("shuffle_hash"), ["h0", "h1"]).select("root", order.alias("place")), "grouped-lines")
        keep = found.groupBy("root").agg(F.min("place").alias("keep"))
        gone = found.join(keep, "root").filter("place <> keep").select("place.file", "place.at", "place.pos")
        return stored(gone.groupBy("file", "at").agg(F.collect_set("pos").alias("dropped")), "dropped-lines", outer=True)


def without_duplicate_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int | tuple = THRESHOLDS, min_chars: int | None = None, bucket: int = BUCKET, counts: bool = False
) -> DataFrame:
    """The input rows, all columns, with the texts' duplicate lines taken out.

    Lines are compared without their outer white space. Equal lines are linked, and lines within the edits that
    `threshold` allows the shorter of them: pairs (characters from which on, edits) in rising order, or one number
    of edits for all lines of at least min_chars (25 if not given); of lines linked to one another, directly or over others, the
    first stays: that of the smallest document id, then of the first row read, then the first in its
    text. Lines without a word stay. Null texts stay null; a null id comes after all others; a text may
    become empty but its row stays. An empty table gives an empty result. counts adds n_lines (with a
    word) and n_dropped.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    placed = with_places(docs)
    text = names[docs.columns.index(text_col)]
    rows = placed.select("file", "at", F.col(names[docs.columns.index(id_col)]).alias("id"), F.col(text).cast("string").alias("text"))
    thresholds = ((min_chars or THRESHOLDS[0][0], threshold),) if isinstance(threshold, int) else threshold
    gone = _dropped(rows, thresholds, bucket)
    lines = F.split(text, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "dropped")
    # a shuffled join at every size, so that small and large tables are worked alike
    joined = placed.join(gone.hint("shuffle_hash"), ["file", "at"], "left").withColumn("__lines", F.when(F.col("dropped").isNotNull(), lines))
    left = F.array_join(F.transform(stay, lambda p: F.get(F.col("__lines"), p)), "\n")
    out = joined.withColumn("__text", F.when(F.col("dropped").isNull(), F.col(text)).otherwise(left))
    columns = [F.col("__text" if n == text else n).alias(c) for n, c in zip(names, docs.columns)]
    if counts:
        with_word = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(OUTER)) != ""))
        columns += [with_word.cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped")]
    return out.select(*columns)
