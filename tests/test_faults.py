"""Planted faults that a rule or a check must find, and sound rows it must leave alone."""

import statistics

from pyspark.sql import functions as F

from plumbline.operators import checks
from plumbline.operators.aggregates import grouped_median
from plumbline.operators.quality import Correction, add_anomaly_columns, resolve
from plumbline.plans import marts, resolution as r


def flagged(spark, rows):
    """(id, value, codes, methods) as a table with quality and audit columns."""
    df = spark.createDataFrame(rows, "id int, v int, codes string, methods string")
    df = add_anomaly_columns(df).withColumns({"anomaly_reason_code": F.col("codes"), "resolution_method": F.col("methods")})
    return df.withColumns({"resolution_applied": F.col("methods").isNotNull(), "b_classification": F.lit(None).cast("string")}).drop("codes", "methods")


def test_a_code_from_detection_is_not_an_earlier_hit(spark):
    rule = Correction("RELISTED_AFTER_SOLD", F.col("v") > 0, "LINKED_RELISTING_EXCLUDED", sets={"v": F.lit(0)}, always={"out": lambda hit: hit})
    df = flagged(spark, [
        (1, 5, None, None), (2, 0, "RELISTED_AFTER_SOLD", None), (3, 0, "RELISTED_AFTER_SOLD", "LINKED_RELISTING_EXCLUDED"),
        (4, 0, "RELISTED_AFTER_SOLD", "FLAGGED_FRAUD_RING"), (5, 0, None, None),
    ])
    once = resolve(df, [rule])
    assert {x.id for x in once.filter("out").collect()} == {1, 3}
    twice = resolve(once.drop("out"), [rule]).select(*once.columns)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_members_who_own_a_placeholder_id_keep_their_orders(spark):
    df = spark.createDataFrame(
        [(1, "0", "SESS-GUEST-1", True), (2, "0", "S-0-19980808", True), (3, "7", "SESS-GUEST-3", False)],
        "id int, customer_id string, session_id string, is_placeholder_id boolean")
    got = {x.id: x.customer_id for x in resolve(add_anomaly_columns(df), [r.placeholder_customer()]).collect()}
    assert got == {1: "GUEST-SESS-GUEST-1", 2: "0", 3: "7"}


def test_only_low_trust_is_high_risk(spark):
    df = add_anomaly_columns(spark.createDataFrame([(1, 0.7, "A"), (2, 0.1, "B"), (3, None, None)], "id int, trust_score double, risk_tier string"))
    df = df.withColumns({"anomaly_flag": F.lit(True), "anomaly_reason_code": F.lit("STATUS_UNMAPPED")})
    got = {x.id: x.b_classification for x in resolve(df, [r.high_risk_seller()]).collect()}
    assert got == {1: None, 2: "B", 3: None}


def test_undated_rows_keep_a_phase(w, spark):
    key = w.dim("date").filter("date_iso = '1998-08-10'").first().date_key
    df = spark.createDataFrame([(1, key), (2, None), (3, "no such day")], "id int, date_key string")
    got = {x.id: x.campaign_phase for x in marts.with_phase(w, df).collect()}
    assert got == {1: "CAMPAIGN", 2: "UNDATED", 3: "OUT_OF_SCOPE"}


def test_no_date_key_is_an_orphan(w):
    days = w.dim("date").select("date_key")
    lost = w.gold("order_fulfilment").filter("delivered_date_key is not null").join(
        days, F.col("delivered_date_key") == F.col("date_key"), "left_anti")
    assert lost.isEmpty()


def test_estimated_revenue_counted_as_confirmed_is_found(spark):
    df = spark.createDataFrame([(5.0, "ESTIMATED"), (0.0, "ESTIMATED"), (5.0, "CONFIRMED")], "confirmed double, metric_certainty_level string")
    got = {x.fact: x.bad_rows for x in checks.certainty_segregation({"a": df}, {"b": df}).collect()}
    assert got == {"a": 1, "b": 1}


def test_delivery_left_before_pickup_is_found(spark):
    df = spark.createDataFrame([(-3.0, "UNRELIABLE"), (-100.0, "UNRELIABLE"), (4.0, "CONFIRMED"), (None, "CONFIRMED")],
                               "picked_to_delivered_hours double, metric_certainty_level string")
    assert checks.uncorrected_delivery(df, 72).first()[0] == 1


def test_grouped_median(spark):
    data = {"a": [1, 2, 3, 4], "b": [5, 5, 5, 1], "c": [9], "d": [2, 2, 8]}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("e", None)]
    got = {x.k: x.m for x in grouped_median(spark.createDataFrame(rows, "k string, v double"), "k", F.col("v"), "m").collect()}
    assert got == {k: float(statistics.median(v)) for k, v in data.items()}
