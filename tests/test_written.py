"""Small results are written part by part: what one part shuffles is gone before the next one starts."""

import os

import pytest
from pyspark.sql import functions as F

from plumbline.functions import keys
from plumbline.operators import checks, identity, quality
from plumbline.plans import facts, registry, resolution
from plumbline.plans.warehouse import Warehouse
from plumbline.sources import written
from plumbline.sources.store import TableStore, part_of
from tests.conftest import TINY


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_") and f.endswith(".data")}


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def folder(monkeypatch, tmp_path):
    monkeypatch.setattr(written, "work_folder", lambda spark: str(tmp_path))
    return tmp_path


def test_held_tables_go_with_their_block(spark, folder):
    with written.held(spark.range(3), "t") as t:
        assert t.count() == 3 and len(os.listdir(folder)) == 1
    with pytest.raises(RuntimeError), written.held(spark.range(3), "t"):
        raise RuntimeError
    assert os.listdir(folder) == []


def test_blocks_side_by_side_put_the_setting_back(spark):
    spark.conf.unset(written.CLEANUP)
    one, two = written.shuffles_deleted(spark), written.shuffles_deleted(spark)
    one.__enter__(), two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(written.CLEANUP) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(written.CLEANUP, None) != "true"


def test_parts_leave_no_shuffle_files(spark, folder):
    before = shuffle_files(spark)
    parts = [spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")) for _ in range(3)]
    assert sum(r.n for r in written.one_by_one(parts, "part").collect()) == 3000
    assert shuffle_files(spark) - before == set()


def test_row_changes_by_digests(spark):
    """repeated rows count one by one, a value that moves to another column is a change, no text of a row is moved."""
    cols = "a string, b string, n int"
    before = spark.createDataFrame([("x", None, 1), ("x", None, 1), ("y", "z", 2), (None, None, None)], cols)
    after = spark.createDataFrame([(None, "x", 1), ("x", None, 1), ("y", "z", 2), ("new", None, 3), (None, None, None)], cols)
    changes = quality.row_changes(before, after)
    assert tuple(changes.first()) == (2, 1) and tuple(quality.row_changes(after, before).first()) == (1, 2)
    assert tuple(quality.row_changes(before, before).first()) == (0, 0)
    assert "Aggregate [a#" in plan(changes) and "Aggregate [row#" not in plan(changes)


HEX = "0123456789abcdef" * 4


def test_packed_texts_come_back(spark):
    """keys move in half their bytes and come back as they were, whatever they are."""
    texts = [None, "", "a", HEX, f"RA-1-{HEX}", HEX.upper(), f"x{HEX[1:]}", f"é{HEX}", HEX + HEX, HEX[1:] + "g", HEX[:62], f"{HEX}é"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    small = keys.pack(df, "t", "i")
    assert [r.t for r in keys.unpack(small, "t").orderBy("i").collect()] == texts and dict(small.dtypes)["i"] == "int"
    assert {r.i for r in small.filter(F.octet_length("t.tail") == 32).collect()} == {3, 4, 7, 8}
    assert small.join(keys.pack(df.select("t"), "t"), "t").count() == len(texts) - 1


@pytest.mark.parametrize("name", ["return_line", "store_sale_line"])
def test_version_joins_in_steps(spark, folder, name):
    """the query reads the rows written before its last join, and has the keys of the fact's definition."""
    w = Warehouse(spark, TINY)
    got = registry.QUERIES[f"versions_{name}"](w)
    assert len(os.listdir(folder)) == 1 and plan(got).count("Join ") == 1
    want = w.fact(name).select(got.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_usage_of_links(spark, folder):
    """F7, F8: keys known, lost and null, counted per link; what is shuffled goes with the fact."""
    f = spark.createDataFrame([(HEX, "p", None), (HEX, "q", None), (None, "p", HEX)], "a string, b string, c string")
    links = [("f", "a", "d", "k"), ("f", "b", "e", "k"), ("f", "c", "e", "k")]
    dims = {"d": spark.createDataFrame([(HEX,), (HEX,)], "k string"), "e": spark.createDataFrame([("p",), (None,)], "k string")}
    before = shuffle_files(spark)
    known = checks.known_keys(dims, links)
    lost = {r.fk: r.orphan_rows for r in checks.orphans({"f": f}, known, links).collect()}
    assert lost == {"f.a": 0, "f.b": 1, "f.c": 1} and shuffle_files(spark) - before == set()
    used = {(r.link, r.key): (r.fact_rows, r.found) for r in checks.link_usage("f", f, known, links).collect()}
    assert used == {("f.a", HEX): (2, True), ("f.a", None): (1, False), ("f.b", "p"): (2, True), ("f.b", "q"): (1, False),
                    ("f.c", HEX): (1, False), ("f.c", None): (2, False)}


def test_grain_of_packed_keys(spark, folder):
    """repeated keys, null ones among them, of one table after the other."""
    t = spark.createDataFrame([(1, HEX), (1, HEX), (2, HEX), (3, None), (3, None), (4, "x")], "i int, k string")
    before = shuffle_files(spark)
    got = {r.table_name: r.dup_groups for r in checks.grain_violations({"t": (t, ["i", "k"]), "u": (t, ["k"])}).collect()}
    assert got == {"t": 2, "u": 2} and shuffle_files(spark) - before == set()


def test_frequent_words_bring_no_pairs(spark):
    """sets that share frequent words only are not paired, however many there are."""
    sets = [([f"customer{i}", f"n{i}", "unit", "block", f"b{i % 4}", "street", f"s{i % 3}"],) for i in range(400)]
    left = spark.createDataFrame(sets, "__t array<string>")
    right = left.withColumn("customer_key", F.col("__t")[0])
    assert 400 <= identity.candidate_sets(left, right).count() <= 3 * 400
    assert {(r["__leader"], r["__s"]) for r in identity.similar_sets(left, right).collect()} == {(f"customer{i}", 1.0) for i in range(400)}


def test_a_table_is_read_once_for_its_anomalies(spark, folder):
    """anomalies of one table share a pass; F9 to F11 count table by table."""
    t = quality.resolve(quality.add_anomaly_columns(spark.range(6).selectExpr("id", "cast(id as int) - 3 as sellable_qty", "1 as physical_qty")), [resolution.negative_stock()])
    entries = [(n, resolution.negative_stock(), t, amount) for n, amount in (("x", None), ("y", F.col("id")))]
    got = resolution.before_after(entries)
    assert sorted(tuple(r) for r in got.collect()) == [
        ("x", "NEGATIVE_QTY", 3, 0, "CORRECTED_ATP_TO_ZERO", None), ("y", "NEGATIVE_QTY", 3, 0, "CORRECTED_ATP_TO_ZERO", 3.0)]
    assert len(os.listdir(folder)) == 1


def test_rebuilt_facts_leave_only_themselves(spark, folder):
    """what is written and shuffled on the way to a fact is gone."""
    before = shuffle_files(spark)
    w = Warehouse(spark, TINY)
    built = w.rebuild(["rv_reviews"])
    assert [x.rsplit("-", 5)[0] for x in os.listdir(folder)] == ["fact_customer_review"] and shuffle_files(spark) - before == set()
    assert built["customer_review"].columns == w.fact("customer_review").columns


def test_replaced_rows_are_forgotten(spark, tmp_path):
    """partitions that a rebuild replaced go; those still named stay."""
    store = TableStore(spark, str(tmp_path))
    df = spark.range(100)
    store.replace("t", df, ["id"], 4)
    changed = [r[0] for r in df.filter("id = 7").select(part_of(["id"], 4)).collect()]
    store.replace_parts("t", df.filter(part_of(["id"], 4).isin(changed)).filter("id <> 7"), changed)
    store.forget("t", 1)
    assert store.read("t").count() == 99
    kept = [p for x in os.listdir(f"{tmp_path}/t/data") for p in os.listdir(f"{tmp_path}/t/data/{x}") if p.startswith("_part")]
    assert len(kept) == 4


def test_star_join_and_held_facts_go(spark, folder, monkeypatch):
    """a fact stands on disk only while its rows are counted."""
    monkeypatch.setattr(facts, "VERSIONED", {"customer_complaint": facts.VERSIONED["customer_complaint"]})
    w = Warehouse(spark, TINY)
    got = registry.QUERIES["star_join_row_counts"](w).first()
    assert got.fact_rows == got.joined_rows > 0 and [x.rsplit("-", 5)[0] for x in os.listdir(folder)] == ["star_join_customer_complaint"]
    with w.gold_held("customer_complaint", ["case_id"]) as f:
        assert f.columns == ["case_id"] and f.count() == got.fact_rows
    assert len(os.listdir(folder)) == 1
