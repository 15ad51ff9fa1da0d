import pytest
from pyspark.sql import functions as F

from plumbline.operators import checks, quality
from plumbline.plans import facts, marts, reconciliation
from plumbline.plans.warehouse import FACTS
from plumbline.sources import raw


@pytest.mark.parametrize("fact", sorted(FACTS))
def test_grain(w, fact):
    checks.assert_grain(fact, w.fact(fact), facts.GRAIN[fact])


def test_waterfall_ties_out(w):
    reconciliation.assert_ties_out(reconciliation.waterfall(w))


def test_stock_cannot_be_summed_over_dates(w):
    from plumbline.operators.aggregates import aggregate

    with pytest.raises(ValueError):
        aggregate(w.fact("warehouse_inventory_snapshot"), ["sku"], ["atp_qty"])
    assert marts.semi_additive_offenders() == []


def test_certainties_do_not_mix(w):
    with pytest.raises(ValueError):
        marts.union_views(w, ["confirmed_gmv", "estimated_classified_gmv"])


def test_views_are_published(w, spark):
    names = marts.publish(w)
    assert len(names) == 28
    assert spark.sql("SELECT * FROM vw_gsv").count() > 0
    kinds = [v.certainty for v in marts.VIEWS.values()]
    assert kinds.count("ESTIMATED") == 1


def test_only_affected_facts_are_rebuilt(w):
    assert w.affected_facts(["rv_reviews"]) == ["customer_review"]
    assert w.affected_facts(["nl_listings"]) == ["classified_listing_snapshot", "seller_performance_snapshot"]
    with pytest.raises(ValueError):
        w.affected_facts(["nothing"])
    stored = w.rebuild(["rv_reviews"])
    assert list(stored) == ["customer_review"]
    assert stored["customer_review"].count() == w.fact("customer_review").count()


def test_ingestion(w, spark, tmp_path):
    landed = raw.ingest_raw(w.given.orders, "orders")
    assert landed.columns[-3:] == raw.META
    span = landed.agg(F.min("_source_row_number"), F.max("_source_row_number"), F.countDistinct("_source_row_number")).first()
    assert tuple(span) == (1, 1500, 1500)
    raw.write_table(raw.empty_like(spark, "x int"), str(tmp_path / "empty"))
    landed, log = raw.land_all(spark, {
        "a": lambda: w.given.orders, "b": lambda: spark.read.parquet(str(tmp_path / "empty")), "c": lambda: spark.read.parquet(str(tmp_path / "none"))})
    assert {r.source_table: (r.row_count, r.status) for r in log.collect()} == {"a": (1500, "OK"), "b": (0, "OK_EMPTY"), "c": (None, "FAILED")}
    assert set(landed) == {"a", "b"} and "PATH_NOT_FOUND" in log.filter("status = 'FAILED'").first().error
    log = log.filter("status <> 'FAILED'")
    want = spark.createDataFrame([("a", 1500), ("c", 1)], "source_table string, row_count bigint")
    assert {r.source_table: r.difference for r in raw.reconcile_counts(log, want).collect()} == {"b": 0, "c": -1}
    with pytest.raises(AssertionError):
        raw.assert_counts(log, want)
    with pytest.raises(AssertionError):
        raw.discover(spark, w.given.folder, 2)


def test_csv_and_json_sources(w, spark, tmp_path):
    df = w.given.region
    for fmt in ("csv", "json", "orc"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        back = raw.read_source(spark, str(tmp_path / fmt), fmt, "r_regionkey int, r_name string")
        assert sorted(back.collect()) == sorted(df.collect())


def test_write_is_repeatable(w, spark, tmp_path):
    for _ in range(2):
        raw.write_table(w.given.nation, str(tmp_path / "n"), ["n_regionkey"])
    assert spark.read.parquet(str(tmp_path / "n")).count() == 25


def test_hot_key_keeps_results_whole(w, spark):
    """One order with a third of all lines: every line still gets its order, exactly once."""
    lines, orders = w.silver("ec_order_lines"), w.resolved("ec_orders")
    hot = lines.withColumn("order_id", F.when(F.crc32("line_id") % 3 == 0, F.lit(1)).otherwise(F.col("order_id")))
    f = facts.ecommerce_order_line(hot, orders)
    assert f.count() == lines.count()
    assert f.filter("order_id = 1").count() >= lines.count() / 4
    assert f.filter("data_quality_status is null").count() == 0


def test_no_python_and_no_cartesian_in_plans(w):
    from plumbline.plans.registry import QUERIES

    for name in ["fact_order_fulfilment", "identity_resolution", "kpi_gsv", "resolved_nl_listings", "check_stock_balance"]:
        plan = QUERIES[name](w)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan, name


def test_codes_in_use_are_registered(w):
    used = quality.code_profile({t: w.resolved(t) for t in ["ec_orders", "nl_listings", "cs_cases"]})
    from plumbline import vocab

    assert {r.reason_code for r in used.collect()} - {None} <= set(vocab.REASON_CODES)
