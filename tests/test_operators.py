import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.dates import LAYOUTS, parse
from plumbline.functions.keys import anonymous_key, optional_key, readable_key, surrogate_key
from plumbline.functions.text import edit_similarity, phone_e164, token_sorted
from plumbline.operators import aggregates, commerce, identity, inventory, joins, matching
from plumbline.operators.history import versions


def ts(hours):
    return dt.datetime(2024, 8, 1) + dt.timedelta(hours=hours)


def day(n):
    return dt.date(2024, 8, 1) + dt.timedelta(days=n - 1)


def test_date_layouts(spark):
    good = {
        "day_slash": ("25/08/2024", dt.date(2024, 8, 25)), "iso_date": ("2024-08-08", day(8)),
        "iso_timestamp": ("2024-08-08T14:23:00", dt.datetime(2024, 8, 8, 14, 23)),
        "day_month_name": ("05-Sep-2024", dt.date(2024, 9, 5)),
        "slash_minute": ("2024/08/08 14:23", dt.datetime(2024, 8, 8, 14, 23)),
        "epoch_seconds": ("1723046400", dt.datetime(2024, 8, 7, 16, 0)),
    }
    assert set(good) == set(LAYOUTS)
    for layout, (text, want) in good.items():
        df = spark.createDataFrame([(text,), ("rubbish",), (None,)], "x string")
        assert [r[0] for r in df.select(parse("x", layout)).collect()] == [want, None, None]
    with pytest.raises(ValueError):
        parse("x", "other")


def test_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    r = df.select(readable_key("x", "y"), surrogate_key("x", "y"), optional_key("y"), anonymous_key()).collect()
    assert r[0][0] == "a|~NULL~" and r[1][0] == "a|b"
    assert len(r[0][1]) == 64 and r[0][1] != r[1][1]
    assert r[0][2] is None and r[0][3] == r[1][3]
    same = df.select(surrogate_key(F.col("x"), F.col("y"))).collect()
    assert [s[0] for s in same] == [s[1] for s in r]
    with pytest.raises(ValueError):
        surrogate_key()


def test_similarity_and_phone(spark):
    df = spark.createDataFrame([("Blue  bolt", "bolt blue", "98765-43210"), ("", "", "+919876543210")], "a string, b string, p string")
    r = df.select(edit_similarity(token_sorted("a"), token_sorted("b")), phone_e164("p")).collect()
    assert [x[0] for x in r] == [1.0, 0.0]
    assert [x[1] for x in r] == ["+919876543210"] * 2


def times(spark, rows, name):
    return spark.createDataFrame(rows, f"id int, k string, {name} timestamp_ntz")


@pytest.mark.parametrize("after", [True, False])
@pytest.mark.parametrize("strict", [True, False])
def test_mark_within_equals_brute_force(spark, after, strict):
    rnd = random.Random(7)
    left = [(i, rnd.choice(["hot", "hot", "b", None]), ts(rnd.randint(0, 200))) for i in range(120)]
    right = [(i, rnd.choice(["hot", "hot", "b", "c"]), ts(rnd.randint(0, 200))) for i in range(60)]
    width = 7
    want = {}
    for i, k, t in left:
        def near(u):
            d = (u - t) if after else (t - u)
            return (dt.timedelta(0) < d if strict else dt.timedelta(0) <= d) and d <= dt.timedelta(hours=width)
        want[i] = any(k2 == k and near(u) for _, k2, u in right)
    got = joins.mark_within(
        times(spark, left, "t"), times(spark, right, "u").select("k", "u"), ["k"], "t", "u", width * 3600, "m", after, strict)
    assert {r.id: r.m for r in got.collect()} == want


def test_latest_before_equals_brute_force(spark):
    rnd = random.Random(3)
    left = [(i, rnd.choice(["hot", "b", "c"]), ts(rnd.randint(0, 100))) for i in range(80)]
    right = [(i, rnd.choice(["hot", "b"]), ts(rnd.randint(0, 100))) for i in range(40)]
    want = {}
    for i, k, t in left:
        ok = [(u, j) for j, k2, u in right if k2 == k and u <= t and t - u <= dt.timedelta(hours=5)]
        want[i] = max(ok)[1] if ok else None
    got = joins.latest_before(
        times(spark, left, "t"), times(spark, right, "u").select("k", "u", F.col("id").alias("found")),
        ["k"], "t", "u", ["found"], 5 * 3600)
    assert {r.id: r.found for r in got.collect()} == want


def test_mark_exists_leaves_null_keys_unmatched(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, k string")
    b = spark.createDataFrame([("x",), ("x",), (None,)], "other string")
    got = joins.mark_exists(a, b, {"k": "other"}, "m")
    assert {r.id: r.m for r in got.collect()} == {1: True, 2: False, 3: False}


def stock(spark, rows):
    return spark.createDataFrame(rows, "k string, d date, q int")


def test_gap_fill(spark):
    df = stock(spark, [("a", day(1), 0), ("a", day(3), 5), ("a", day(5), 5), ("b", day(2), 7)])
    span = spark.createDataFrame([(day(1), day(6))], "first_day date, last_day date")
    spine = inventory.day_spine(df, ["k"], "d", span)
    assert spine.count() == 12
    got = {(r.k, r.d.day): (r.q, r.recon_method) for r in inventory.fill_gaps(df, ["k"], "d", ["q"], spine).collect()}
    assert got == {
        ("a", 2): (3, "LINEAR_INTERP"), ("a", 4): (5, "LINEAR_INTERP"), ("a", 6): (5, "LOCF"),
        **{("b", n): (7, "LOCF") for n in (3, 4, 5, 6)},
    }
    assert inventory.missing_days(df, ["k"], "d", spine).count() == 8


def test_fill_from_movements(spark):
    df = stock(spark, [("a", day(1), 10), ("a", day(4), 3)])
    moves = spark.createDataFrame([("a", day(1), 99), ("a", day(2), -4), ("a", day(2), 1), ("a", day(3), 2)], "k string, m date, x int")
    got = inventory.fill_from_movements(df, moves, ["k"], "d", "q", "m", "x")
    assert {(r.d.day, r.q) for r in got.collect()} == {(2, 7), (3, 9)}


def test_versions(spark):
    rows = [("a", day(1), "x"), ("a", day(2), "x"), ("a", day(3), "y"), ("a", day(5), "x"), ("b", day(1), "x")]
    got = versions(spark.createDataFrame(rows, "k string, d date, v string"), "k", ["v"], "d").collect()
    seen = sorted((r.k, r.version_number, r.v, r.valid_from.day, r.valid_to, r.is_current) for r in got)
    end = dt.date(9999, 12, 31)
    assert seen == [
        ("a", 1, "x", 1, day(2), False), ("a", 2, "y", 3, day(4), False), ("a", 3, "x", 5, end, True), ("b", 1, "x", 1, end, True)]


def test_semi_additive_guard(spark):
    df = aggregates.semi_additive(stock(spark, [("a", day(1), 1), ("a", day(2), 2)]), ["q"], "d")
    with pytest.raises(ValueError):
        aggregates.aggregate(df, ["k"], ["q"])
    assert aggregates.aggregate(df, ["d"], ["q"]).count() == 2
    with pytest.raises(ValueError):
        aggregates.aggregate(aggregates.non_additive(df, ["q"]), ["d"], ["q"])
    kept = df.filter("q > 0").withColumn("z", F.lit(1))
    with pytest.raises(ValueError):
        aggregates.aggregate(kept, ["k"], ["q"])


def test_identity_passes(spark):
    rows = [
        ("L", 1, "L1", "ann@x.org", "+919000000001", "Ann Lee", "1 High Street Delhi North"),
        ("EC", 2, "L1", None, None, None, None),
        ("EC", 3, None, " ANN@x.org ", None, None, None),
        ("EC", 4, None, None, "9000000001", None, None),
        ("EC", 5, None, None, None, "Lee Ann", "1 High Street Delhi"),
        ("EC", 6, None, None, None, "Bob Roy", "9 Low Road"),
        ("EC", 7, None, "bad", "12", None, None),
        ("EC", 8, None, "new@x.org", None, None, None),
    ]
    df = spark.createDataFrame(
        rows, "source_system string, source_id bigint, loyalty_id string, email string, phone string, name string, address string")
    got = {r.source_id: r for r in identity.resolve_identities(df).collect()}
    assert [got[i].match_pass for i in range(1, 9)] == [1, 1, 2, 3, 4, 0, 0, 2]
    assert len({got[i].customer_key for i in (1, 2, 3, 4, 5)}) == 1
    assert got[6].customer_key == got[7].customer_key != got[8].customer_key
    assert 0.70 <= got[5].identity_confidence < 0.90
    assert got[5].anomaly_reason_code == "IDENTITY_AMBIGUOUS"
    assert got[7].anomaly_reason_code == "FUZZY_MATCH_LOW_CONF,EMAIL_MALFORMED,PHONE_NORMALISATION_FAIL"


def test_similar_sets_finds_what_brute_force_finds(spark):
    rnd = random.Random(11)
    words = ["unit"] * 3 + [f"w{i}" for i in range(14)]

    def some(n):
        return sorted({tuple(sorted(set(rnd.choices(words, k=rnd.randint(1, 7))))) for _ in range(n)})

    left, right = some(80), some(60)

    def jac(a, b):
        return len(set(a) & set(b)) / len(set(a) | set(b))

    want = {}
    for a in left:
        best = min(((-jac(a, b), f"k{i:03d}") for i, b in enumerate(right)), default=None)
        if -best[0] >= 0.7:
            want[a] = (best[1], -best[0])
    ldf = spark.createDataFrame([(list(a),) for a in left], "__t array<string>")
    rdf = spark.createDataFrame([(list(b), f"k{i:03d}") for i, b in enumerate(right)], "__t array<string>, customer_key string")
    got = identity.similar_sets(ldf, rdf).selectExpr("__t", "__leader", "__s").collect()
    assert {tuple(r[0]): (r[1], pytest.approx(r[2])) for r in got} == want


def test_best_match_tiers(spark):
    names = spark.createDataFrame([("c", "blue bolt"), ("c", "red ring"), ("d", "blue bolt")], "category string, name string")
    titles = spark.createDataFrame(
        [(1, "c", "bolt BLUE"), (2, "c", "blue bo1t"), (3, "c", "phone case"), (4, "c", None), (5, "c", ""), (6, "d", "red ring")],
        "id int, category string, title string")
    got = matching.best_match(titles, "title", names, "name", ["category"]).withColumn("tier", matching.match_tier(F.col("match_score")))
    assert {r.id: (r.match_name, r.tier) for r in got.collect()} == {
        1: ("blue bolt", "MATCHED"), 2: ("blue bolt", "MATCHED"), 3: (None, "UNMATCHED"), 4: (None, "UNMATCHED"), 5: (None, "UNMATCHED"),
        6: (None, "UNMATCHED")}


def test_relisting(spark):
    rows = [
        (1, "s", "h", "SOLD", ts(0), ts(0)), (2, "s", "h", "ACTIVE", ts(29 * 24), ts(900)), (3, "s", "h", "ACTIVE", ts(30 * 24), ts(900)),
        (4, "s", "h", "ACTIVE", ts(31 * 24), ts(900)), (5, "s", "h", "ACTIVE", ts(0), ts(900)), (6, "s", None, "ACTIVE", ts(24), ts(900)),
        (7, "t", "h", "ACTIVE", ts(24), ts(900)),
    ]
    df = spark.createDataFrame(
        rows, "listing_id int, seller_account_id string, image_hash string, status_code string, created_at timestamp_ntz, updated_at timestamp_ntz")
    ever = {r.listing_id for r in commerce.mark_relisted(df).filter("is_relisted").collect()}
    recent = {r.listing_id for r in commerce.mark_relisted(df, 30).filter("is_relisted").collect()}
    assert ever == {2, 3, 4} and recent == {2, 3}
    rings = {r.listing_id for r in commerce.mark_rings(df).filter("in_ring").collect()}
    assert rings == {1, 2, 3, 4, 5, 7}


def test_refund_periods(spark):
    orders = spark.createDataFrame([("o", day(20))], "order_number string, order_date date")
    refunds = spark.sql("""SELECT * FROM VALUES
      (1, 'o', 'FULL', 100.00, 100.00, 0.00, date'2024-08-25'), (2, 'o', 'PARTIAL', 100.00, 30.00, 5.00, date'2024-09-02')
      AS t(id, original_order_ref, refund_type, subtotal, refund_amount, restocking_fee, refund_date)""")
    got = {r.id: r for r in commerce.refund_periods(refunds, orders).collect()}
    assert float(got[1].revenue_impact_return_period) == -100.0 and not got[1].is_cross_period
    assert float(got[2].revenue_impact_original_period) == -25.0 and got[2].is_cross_period


def test_version_at_and_load_by_load(spark):
    """Against a search of every version; one more load at a time gives what all loads at once give."""
    import datetime as dt
    import random

    from plumbline.operators.history import merge_load, version_at, versions
    from pyspark.sql import functions as F

    rnd = random.Random(4)
    day = lambda n: dt.date(2001, 1, 1) + dt.timedelta(n)
    loads = [(k, rnd.choice("ab"), day(d)) for k in "pqrs" for d in rnd.sample(range(1500), 40)] + [("t", "a", day(3000)), (None, "x", day(5))]
    df = spark.createDataFrame(loads, "k string, v string, on date")
    dim = versions(df.filter("k is not null"), "k", ["v"], "on")
    rows = [(i, rnd.choice(["p", "q", "r", "s", "t", "u", None]), rnd.choice([None, day(rnd.randrange(-50, 4000))])) for i in range(400)]
    facts = spark.createDataFrame(rows, "i int, sku string, d date")
    got = {r.i: r.version for r in version_at(facts, dim, "sku", "k", F.col("d"), "version", "2005-12-31").collect()}
    held = [r.asDict() for r in dim.collect()]
    for i, k, d in rows:
        found = [v["version_key"] for v in held if v["k"] == k and d and v["valid_from"] <= d <= v["valid_to"]]
        assert got.pop(i) == (found[0] if found else None)
    assert not got
    days = sorted({r[2] for r in loads})
    built = versions(df.filter(F.col("k").isNotNull() & (F.col("on") < days[-4])), "k", ["v"], "on")
    for d in days[-4:]:
        built = merge_load(built, df.filter(F.col("on") == d), "k", ["v"], "on")
    assert sorted(map(tuple, built.collect())) == sorted(map(tuple, dim.select(built.columns).collect()))
    assert merge_load(dim, df.limit(0), "k", ["v"], "on").count() == len(held)


def test_linked_groups_against_a_search(spark):
    """Chains over several kinds of identifiers, with the weakest link each group needs."""
    import random

    from plumbline.operators.groups import linked_groups

    rnd = random.Random(3)
    pick = lambda n, p: rnd.randrange(n) if rnd.random() < p else None
    rows = [(f"r{i:03}", pick(80, 0.4), pick(90, 0.4), pick(70, 0.3)) for i in range(200)]
    rows += [(f"x{i:03}", 1000 + i // 2, 2000 + (i + 1) // 2, None) for i in range(40)]  # one chain of 40
    rows += [(f"y{i:03}", 5000, None, 6000) for i in range(50)]  # a value many share
    kinds = [(1, 1.0), (2, 0.95), (3, 0.9)]

    def groups(upto):
        label = {r[0]: r[0] for r in rows}
        while True:
            least = {}
            for r in rows:
                for k, _ in kinds[:upto]:
                    if r[k] is not None:
                        least[k, r[k]] = min(least.get((k, r[k]), label[r[0]]), label[r[0]])
            new = {r[0]: min([label[r[0]], *(least[k, r[k]] for k, _ in kinds[:upto] if r[k] is not None)]) for r in rows}
            if new == label:
                return label
            label = new

    levels = [groups(n) for n in (1, 2, 3)]
    got = linked_groups(spark.createDataFrame(rows, "name string, a int, b int, c int"), "name", [("a", 1.0), ("b", 0.95), ("c", 0.9)])
    out = {r["name"]: (r.group_key, r.group_confidence, r.group_size) for r in got.collect()}
    for r in rows:
        mates = [q[0] for q in rows if levels[2][q[0]] == levels[2][r[0]]]
        want = next(c for (_, c), level in zip(kinds, levels) if len({level[m] for m in mates}) == 1)
        assert out[r[0]] == (min(mates), want, len(mates)), r
