"""A query computes and moves only what it reads, whatever the fact behind it holds."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators.joins import left_join_spread
from plumbline.plans import facts, marts, warehouse
from plumbline.plans.warehouse import Warehouse
from plumbline.sources import raw
from tests.conftest import TINY


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def fresh(spark, monkeypatch):
    """A warehouse of its own, and the names of the tables it writes."""
    written = []
    real = warehouse.materialise
    monkeypatch.setattr(warehouse, "materialise", lambda df, name: written.append(name) or real(df, name))
    return Warehouse(spark, TINY), written


@pytest.mark.parametrize("name", ["gsv", "ncr", "confirmed_gmv", "campaign_incremental_revenue", "payment_failure_rate", "boris_count", "stockout_rate"])
def test_views_write_nothing_and_join_no_versions(fresh, name):
    w, written = fresh
    plan = optimized(marts.kpi(w, name))
    assert written == []
    assert "version_key" not in plan and "utm_campaign" not in plan


def test_unread_milestones_are_not_computed(fresh):
    w, _ = fresh
    assert "DELIVERED-" not in optimized(marts.kpi(w, "payment_failure_rate"))
    assert "DELIVERED-" not in optimized(marts.kpi(w, "bopis_pickup_readiness_time"))
    assert "PICKED_UP" in optimized(marts.kpi(w, "on_time_delivery_rate"))


def test_built_facts_are_read(fresh):
    w, written = fresh
    w._write_all("gold", ["customer_review"], w.fact, 1)
    assert written == ["gold_customer_review"] and "customer_review" in w.gold("customer_review").inputFiles()[0]


def test_rows_without_a_key_spread_by_named_columns(spark):
    df = spark.range(60).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"), F.lit("x").alias("wide"))
    other = spark.range(4).select(F.col("id").alias("k2"), (F.col("id") * 10).alias("v"))
    want = sorted((r.id, None if r.k is None or r.k > 3 else r.k * 10) for r in df.collect())
    for by in (None, ["id"]):
        joined = left_join_spread(df, other, ["k"], ["k2"], by)
        assert sorted((r.id, r.v) for r in joined.collect()) == want
    assert "wide" not in optimized(left_join_spread(df, other, ["k"], ["k2"], ["id"]).agg(F.sum("v")))


def test_milestones_of_each_source(spark):
    """Orders and payments that repeat, orders without a milestone, null references: rows stay, the earliest time counts."""
    q = "false anomaly_flag, cast(null as string) anomaly_reason_code, 'CLEAN' data_quality_status, 'CONFIRMED' metric_certainty_level"
    at = "timestamp_ntz'1998-01-0{} 00:00:00'".format
    orders = spark.sql(
        "select * from values (1, 'EC-1'), (1, 'EC-1'), (2, 'EC-2'), (3, null) t(order_id, order_number)").selectExpr(
        "*", "date'1998-01-01' order_date", "'7' customer_id", "'DELIVERED' order_status", "'BOPIS' delivery_method_code", *q.split(", "))
    paid = spark.sql(f"select * from values ('EC-1', {at(3)}), ('EC-1', {at(2)}), ('EC-1', null), (null, {at(1)}) t(order_ref, captured_ts)")
    shipments = spark.sql("select * from values ('SH-1', 'EC-1'), ('SH-9', 'EC-1'), ('SH-2', 'EC-2') t(shipment_id, order_reference)")
    events = spark.sql(
        f"select * from values ('SH-1', 'PICKED_UP', {at(4)}, null, 'DELIVERY_BEFORE_SHIP'), ('SH-9', 'DELIVERED', {at(6)}, {at(7)}, null), "
        f"('SH-2', 'DELIVERED', {at(5)}, null, null) t(shipment_id, event_type_code, event_timestamp, corrected_event_datetime, anomaly_reason_code)")
    back = spark.sql("select * from values ('EC-2', date'1998-01-09'), ('EC-2', date'1998-01-08') t(original_order_ref, return_request_date)")
    got = facts.order_fulfilment(orders, paid, shipments, events, back).select(
        "order_id", "placed_to_captured_hours", "picked_to_delivered_hours", "total_lifecycle_hours", F.col("returned_date_key").isNotNull(), "anomaly_flag")
    assert sorted(map(tuple, got.collect())) == [
        (1, 24.0, 72.0, 144.0, False, True), (1, 24.0, 72.0, 144.0, False, True), (2, None, None, 96.0, True, False), (3, None, None, None, False, False)]


@pytest.mark.parametrize("name", list(facts.VERSIONED))
def test_keys_behind_the_version_joins(spark, name):
    """The keys a fact gets after its joins are those its definition gives, and its columns keep their order."""
    w = Warehouse(spark, TINY, lazy=True)
    own, full = warehouse.FACTS[name](w), w.fact(name)
    assert full.columns[: len(own.columns)] == own.columns
    columns = [*facts.GRAIN[name], *facts.DERIVED[name]()]
    both = own.select(*columns).unionAll(full.select(*columns)).groupBy(*columns).agg(F.count("*").alias("n"))
    assert both.filter("n % 2 = 1").count() == 0


def test_numbering_rows_moves_none(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(f"{tmp_path}/t")
    numbered = raw.source_row_number(spark.read.parquet(f"{tmp_path}/t"))
    assert sorted(r[0] for r in numbered.select("_source_row_number").collect()) == list(range(1, 1001))
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan


def test_version_keys_are_those_of_the_dimension(fresh):
    """Both keys of a fact with product and customer name the version valid on the day; none is null where one is."""
    w, _ = fresh
    f = w.fact("customer_review")
    for name, natural, dim, key in (("product_version_key", "product_sku", w.product_versions(), "sku"),
                                    ("customer_version_key", "customer_id", w.customer_versions(), "customer_id")):
        v = dim.select(F.col(key).alias("k"), "valid_from", "valid_to", "version_key")
        day = F.col("review_datetime").cast("date")
        met = f.join(v, (F.col(natural) == F.col("k")) & day.between(F.col("valid_from"), F.col("valid_to")), "left")
        assert met.filter(~F.col(name).eqNullSafe(F.col("version_key"))).count() == 0
        assert f.filter(f"{name} is not null").count() > 0
