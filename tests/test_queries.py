"""Named queries against their SQL. A sample by default; PLUMBLINE_ALL=1 runs every one."""

import os

import pytest

import __spark_entry__ as entry
from oracle.check import compare, connect
from oracle.queries import ORACLE
from plumbline.plans.registry import QUERIES

TINY = "/root/testdata/sf0.001"
SAMPLE = [
    "gsv_to_ncr_waterfall", "kpi_gsv", "kpi_ncr", "kpi_estimated_classified_gmv", "resolved_ec_orders", "resolved_nl_listings",
    "resolve_delivered_before_pickup", "identity_resolution", "product_master", "gap_fill_interpolated", "session_order_bridge_24h",
    "relisted_within_window", "refund_periods", "seller_trust", "product_versions", "check_stock_balance", "check_referential_integrity",
    "fact_order_fulfilment", "fact_return_line", "status_map", "date_normalisation", "flag_rules", "rerun_changes_nothing", "ingest_raw_orders",
]
NAMES = sorted(QUERIES) if os.environ.get("PLUMBLINE_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return connect(TINY)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, TINY)
    got = [tuple(r) for r in df.collect()]
    want = con.sql(entry.oracle_sql()[name])
    assert compare(df.columns, got, want.columns, want.fetchall()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 4
