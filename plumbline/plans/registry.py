"""Named queries: one or more per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline import vocab
from plumbline.functions.dates import hours_between, parse
from plumbline.functions.exprs import bucket, decimals_as_double, first_column, has_code, ratio, with_one_row
from plumbline.functions.keys import anonymous_key, pack, readable_key, surrogate_key
from plumbline.functions.text import email_norm, phone_e164
from plumbline.operators import aggregates, checks, commerce, identity, inventory, joins, matching, quality
from plumbline.operators.groups import linked_groups
from plumbline.operators.history import merge_load, versions
from plumbline.operators.quality import AUDIT, QUALITY, Rule
from plumbline.plans import analyses, dims, facts, marts, rebuild, reconciliation as rec, resolution as r
from plumbline.plans.silver import SILVER
from plumbline.plans.warehouse import DIM_KEYS, RESOLVED, Warehouse
from plumbline.sources import raw, retail
from plumbline.sources.landing import Landing, RunLog
from plumbline.sources.schemas import SCHEMAS
from plumbline.sources.store import TableStore
from plumbline.sources.written import Steps, held

Query = Callable[[Warehouse], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def add(name: str, f: Query) -> None:
    QUERIES[name] = f


_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse of a folder; its lazy tables are defined once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _warehouses or _warehouses[key].spark is not spark:
        _warehouses[key] = Warehouse(spark, folder)
    return _warehouses[key]


def runnable(f: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: decimals_as_double(f(warehouse(spark, folder)))


D2 = "decimal(18,2)"


def summed(c: str) -> Column:
    return F.sum(c).cast("double")


# ---- sources and sinks -------------------------------------------------------------------------
GIVEN = list(SCHEMAS)


@query
def ingest_raw_orders(w):
    landed = raw.ingest_raw(w.given.orders, "orders")
    return landed.select("o_orderkey", "o_totalprice", "_source_table", "_source_row_number")


@query
def source_inventory(w):
    found = raw.discover(w.spark, w.given.folder, len(GIVEN))
    return checks.completeness({n: getattr(w.given, n) for n in found})


@query
def ingestion_log(w):
    """Every given table landed, and what became of it."""
    return raw.land_all(w.spark, {n: lambda n=n: getattr(w.given, n) for n in GIVEN})[1].select(
        "source_table", "row_count", "status", "error")


@query
def ingested_tables(w):
    """The landed tables read back: all rows are there and numbered without a gap."""
    landed, _ = raw.land_all(w.spark, {n: lambda n=n: getattr(w.given, n) for n in GIVEN})
    return quality.union_all([
        df.agg(F.count("*").alias("row_count"), F.min("_source_row_number").alias("first_row"), F.max("_source_row_number").alias("last_row"),
               F.count_distinct("_source_row_number").alias("row_numbers"))
        .select(F.lit(n).alias("source_table"), F.lit(len(df.columns)).alias("columns"), "*")
        for n, df in landed.items()])


def _landing(w) -> Landing:
    return Landing(TableStore(w.spark, raw.new_path(w.spark, "landing")))


@query
def row_count_reconciliation(w):
    """All given tables, and one without rows, landed under the contract they arrived with."""
    tables = {n: getattr(w.given, n) for n in GIVEN} | {"price_history": raw.empty_like(w.spark, PRICE_HISTORY)}
    landing = _landing(w)
    landing.announce(tables)
    return landing.land(w.spark, {n: lambda df=df: df for n, df in tables.items()})


PRICE_HISTORY = "sku string, changed_on date, old_price decimal(12,2)"


@query
def empty_table_landing(w):
    """Products by category against a price history that landed without rows and is read back."""
    landing = _landing(w)
    empty = raw.empty_like(w.spark, PRICE_HISTORY)
    landing.announce({"price_history": empty})
    landing.land(w.spark, {"price_history": lambda: empty})
    changes = landing.landed("price_history").groupBy("sku").agg(F.count("*").alias("changes"))
    return w.source("pc_products").join(changes, "sku", "left").groupBy("category").agg(
        F.count("*").alias("products"), F.coalesce(F.sum("changes"), F.lit(0)).alias("price_changes"))


@query
def read_projection_and_predicate(w):
    return raw.read_table(
        w.given.lineitem, ["l_orderkey", "l_partkey", "l_quantity"],
        (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 40))


@query
def write_table_roundtrip(w):
    """A table replaced by a result computed from itself, read back."""
    first = raw.materialise(w.silver("rr_return_receipts").select("receipt_id", "restocked_qty"), "receipts")
    again = raw.materialise(first.withColumn("restocked_qty", F.col("restocked_qty") * 2), "receipts")
    return again.agg(F.count("*").alias("row_count"), F.sum("restocked_qty").alias("units"))


@query
def static_reference_rows(w):
    """The channel rows kept in code, with the order and receipt lines that use them."""
    used = w.fact("ecommerce_order_line").select("channel_key").unionByName(
        w.fact("store_sale_line").select("channel_key")).groupBy("channel_key").agg(F.count("*").alias("lines"))
    return w.dim("channel").join(used, "channel_key", "left").select(
        "channel_key", "channel_code", "channel_name", "is_platform_controlled",
        F.coalesce("lines", F.lit(0)).alias("lines"))


@query
def optional_column_resolution(w):
    s = w.source("ws_page_events")
    return s.select(
        "event_id",
        first_column(s, ["page_category"], "string").alias("page_category"),
        first_column(s, ["sku", "product_sku"], "string").alias("product"),
        first_column(s, ["time_on_page_seconds", "time_on_page_secs"], "int").alias("seconds"))


@query
def lookup_pass_through(w):
    return quality.union_all([
        w.silver(t).select(F.lit(t).alias("lookup"), F.col(SILVER[t].key[0]).alias("code"),
                           F.col(f"{t}_sk").alias("lookup_key"), *QUALITY)
        for t in ["ec_order_status_codes", "ec_delivery_methods", "pg_instrument_types", "pos_stores",
                  "rr_return_reasons", "ws_event_types", "dc_carriers", "dc_event_types"]
    ])


SILVER_COLUMNS = {
    "ec_orders": ["order_id", "order_date_raw", "order_date", "created_at", "canonical_status"],
    "ec_order_lines": ["order_id", "line_id", "quantity", "line_total_excl_tax", "discount_applied"],
    "ec_order_status_history": ["history_id", "order_id", "status_code", "status_timestamp"],
    "pg_transactions": ["transaction_id", "created_ts", "captured_ts", "canonical_status", "amount"],
    "pos_transactions": ["txn_id", "txn_date_raw", "txn_date", "store_id", "canonical_status"],
    "pos_transaction_lines": ["txn_id", "line_no", "gross_amount", "net_amount", "total_amount_incl_tax"],
    "dc_shipments": ["shipment_id", "order_reference", "created_datetime", "carrier_code"],
    "dc_delivery_events": ["event_id", "shipment_id", "event_type_code", "event_timestamp"],
    "rr_return_requests": ["return_authorization_id", "return_request_date_raw", "return_request_date", "reason_code"],
    "rr_return_receipts": ["receipt_id", "received_date", "inspection_status", "restocked_qty"],
    "rr_refund_events": ["refund_id", "refund_type", "refund_amount", "refund_date"],
    "si_inventory_snapshots": ["store_id", "product_code", "snapshot_date", "physical_qty", "sellable_qty"],
    "si_inventory_movements": ["movement_id", "movement_type", "quantity_change", "reference_number", "movement_date"],
    "wh_inventory_snapshots": ["warehouse_id", "sku", "snapshot_date", "physical_qty", "atp_qty"],
    "wh_inventory_movements": ["movement_id", "movement_type", "quantity_change", "movement_datetime"],
    "ws_sessions": ["session_id", "session_start_ts", "session_end_ts", "utm_campaign", "registered_customer_id", "total_events"],
    "ws_page_events": ["session_id", "event_id", "event_timestamp", "event_type_code", "product_sku", "cart_value"],
    "nl_user_accounts": ["account_id", "created_at"],
    "nl_listings": ["listing_id", "seller_account_id", "status_code", "asking_price", "created_at", "updated_at"],
    "nl_listing_events": ["listing_id", "event_id", "event_type_code", "event_timestamp", "offer_amount"],
    "ts_seller_listings": ["listing_id", "seller_id", "catalogue_sku_ref", "seller_product_title"],
    "ts_sellers": ["seller_id", "seller_status", "canonical_status"],
    "ts_marketplace_orders": ["marketplace_order_id", "seller_id", "is_returned", "fulfilled_at"],
    "ts_safety_reports": ["report_id", "seller_id"],
    "ts_risk_signals": ["signal_id", "seller_id"],
    "rv_reviews": ["review_id", "rating", "days_post_delivery", "is_verified_purchase", "review_datetime"],
    "cs_cases": ["case_id", "canonical_case_ref", "created_datetime_raw", "created_datetime", "resolved_datetime", "channel_attribution"],
    "cs_case_events": ["case_id", "event_seq", "role"],
    "cl_customers": ["source_id", "loyalty_id", "email", "phone", "name"],
    "pc_products": ["sku", "product_name", "category", "list_price", "cogs"],
}
for _t, _cols in SILVER_COLUMNS.items():
    add(f"silver_{_t}", lambda w, t=_t, cols=_cols: w.silver(t).select(
        *cols, F.col(f"{t}_sk").alias("row_key"), *QUALITY))


# ---- projections and predicates ----------------------------------------------------------------
@query
def conditional_correction(w):
    """Quantity zero where the line is unreturned and untaxed, kept otherwise."""
    return w.given.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when((F.col("l_returnflag") == "N") & (F.col("l_tax") == 0), F.lit(0.0)).otherwise(
            F.col("l_quantity")).alias("quantity"))


@query
def predicate_forms(w):
    o = w.source("ec_orders")
    return o.agg(
        F.count_if(F.col("subtotal_excl_tax").between(100000, 200000)).alias("in_range"),
        F.count_if(F.col("promo_code_applied").isNull()).alias("without_promo"),
        F.count_if(F.col("delivery_method_code").isin("BOPIS", "EXPRESS")).alias("in_set"),
        F.count_if(F.col("session_id").startswith("SESS-GUEST")).alias("guest_sessions"),
        F.count_if(F.col("delivery_method_code").contains("SELLER")).alias("seller_shipped"),
        F.count_if((F.col("order_status") == "CANCELLED") & ~(F.col("customer_id") == "0")).alias("both"))


@query
def reason_code_membership(w):
    """Receipts by the codes they carry, told apart exactly."""
    df = w.resolved("rr_return_receipts")
    return df.groupBy(
        has_code("anomaly_reason_code", "RESTOCK_BEFORE_INSPECTION").alias("restocked_early"),
        has_code("anomaly_reason_code", "OPEN_BOX_AS_NEW").alias("opened_as_new"),
        has_code("anomaly_reason_code", "OPEN_BOX").alias("partial_code"),
    ).agg(F.count("*").alias("receipts"))


@query
def guarded_ratio(w):
    e = w.source("nl_listing_events").groupBy("listing_id").agg(
        F.count_if(F.col("event_type_code") == "OFFER_ACC").alias("answers"),
        F.count_if(F.col("event_type_code") == "CHAT").alias("chats"))
    return e.select("listing_id", ratio(F.col("answers"), F.col("chats")).alias("answer_rate"))


@query
def label_buckets(w):
    label = bucket(F.col("o_totalprice"), [(300000, "LARGE"), (100000, "MEDIUM"), (40000, "SMALL")], "TINY")
    return w.given.orders.groupBy(label.alias("size_label")).agg(F.count("*").alias("orders"))


@query
def combined_scalars(w):
    """Several one-row figures in one projection, from one pass per table."""
    a = w.given.orders.agg(F.count("*").alias("orders"),
                           F.count_if(F.col("o_orderstatus") == "P").alias("cancelled"))
    b = w.given.events.agg(F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    return with_one_row(a, b).select(
        "orders", "cancelled", "purchases",
        ratio(F.col("cancelled"), F.col("orders")).alias("cancelled_share"))


# ---- joins -------------------------------------------------------------------------------------
@query
def inner_join_lines_orders(w):
    lines, orders = w.source("ec_order_lines"), w.source("ec_orders")
    return lines.join(orders, "order_id").groupBy("order_status").agg(
        F.count("*").alias("lines"), summed("line_total_excl_tax").alias("amount"))


@query
def left_join_chain(w):
    """Orders with up to four later milestones, missing ones left empty."""
    f = w.fact("order_fulfilment")
    return f.agg(*[
        F.count(c).alias(c.replace("_date_key", "")) for c in
        ["placed_date_key", "captured_date_key", "shipped_date_key", "delivered_date_key", "returned_date_key"]
    ])


@query
def anti_join_ready_not_collected(w):
    e = w.source("dc_delivery_events")
    ready = e.filter(F.col("event_type_code") == "READY_FOR_PICKUP").select("shipment_id").distinct()
    done = e.filter(F.col("event_type_code") == "BOPIS_COLLECTED").select("shipment_id")
    return ready.join(done, "shipment_id", "left_anti")


@query
def semi_join_campaign_sessions(w):
    tagged = w.source("ws_sessions").filter(F.col("utm_campaign") == retail.CAMPAIGN_TAG)
    return w.source("ec_orders").join(tagged, "session_id", "left_semi").select("order_id", "session_id")


@query
def not_exists_over_join(w):
    """Pickup orders delivered without a collection scan."""
    return _uncollected(w).select("order_id", "order_number")


def _uncollected(w):
    scans = w.source("dc_delivery_events").filter(F.col("event_type_code") == "BOPIS_COLLECTED")
    seen = w.source("dc_shipments").join(scans.select("shipment_id"), "shipment_id", "left_semi").select(
        F.col("order_reference").alias("order_number"))
    return w.source("ec_orders").filter(
        (F.col("delivery_method_code") == "BOPIS") & (F.col("order_status") == "DELIVERED")
    ).join(seen, "order_number", "left_anti")


@query
def relisted_listings(w):
    return commerce.mark_relisted(w.silver("nl_listings")).select("listing_id", "is_relisted")


@query
def relisted_within_window(w):
    return commerce.mark_relisted(w.silver("nl_listings"), vocab.RELIST_WINDOW_DAYS).select(
        "listing_id", "is_relisted")


@query
def entity_calendar_spine(w):
    return w.snapshot_spine().groupBy("store_id").agg(
        F.count("*").alias("cells"), F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day"))


@query
def bracket_join(w):
    """For every missing day the counts before and after it; the later one may be absent."""
    s = w.silver("si_inventory_snapshots")
    b = joins.brackets(w.snapshot_spine(), s.select("store_id", "product_code", "snapshot_date", "physical_qty"),
                       ["store_id", "product_code"], "snapshot_date", ["physical_qty"])
    return b.filter("observed is null").select(
        "store_id", "product_code", "snapshot_date", F.col("left_side.physical_qty").alias("qty_before"),
        F.col("right_side.physical_qty").alias("qty_after"))


@query
def role_playing_dates(w):
    """Orders by the phase they were placed in and the phase they were delivered in."""
    f = w.gold("order_fulfilment").select("placed_date_key", "delivered_date_key")
    placed = marts.with_phase(w, f, "placed_date_key").withColumnRenamed("campaign_phase", "placed_phase")
    both = marts.with_phase(w, placed, "delivered_date_key").withColumnRenamed("campaign_phase", "delivered_phase")
    return both.groupBy("placed_phase", "delivered_phase").agg(F.count("*").alias("orders"))


@query
def gsv_by_phase_ties_out(w):
    """Gross sale value summed over all phases against the first step of the waterfall."""
    phases = marts.kpi(w, "gsv").agg(F.round(F.sum("gsv"), 2).alias("by_phase"))
    first = rec.waterfall(w).filter("step = 1").select(F.round(F.col("amount").cast("double"), 2).alias("waterfall"))
    both = with_one_row(phases, first)
    return both.withColumn("ties_out", F.abs(F.col("by_phase") - F.col("waterfall")) < 0.05)


@query
def fuzzy_title_match(w):
    """Seller titles against the catalogue names of their category, best score per listing."""
    df = matching.best_match(
        w.source("ts_seller_listings"), "seller_product_title", w.source("pc_products"), "product_name", ["category"])
    return df.select("listing_id", "match_name", "match_score", matching.match_tier(F.col("match_score")).alias("tier"))


@query
def session_order_bridge(w):
    return commerce.same_session_bridge(
        w.silver("ec_orders"), w.silver("ws_sessions"), w.campaign.tag, w.campaign.window)


def _timed(w, hours):
    return commerce.timed_session_bridge(w.resolved("ec_orders"), w.silver("ws_sessions"), w.campaign.tag, hours)


add("session_order_bridge_2h", lambda w: _timed(w, 2))
add("session_order_bridge_24h", lambda w: _timed(w, 24))


# ---- aggregations ------------------------------------------------------------------------------
@query
def group_by_aggregates(w):
    lines = w.source("pos_transaction_lines")
    return lines.groupBy("tax_rate").agg(
        F.count("*").alias("lines"), F.round(summed("gross_amount"), 2).alias("gross"),
        F.min("quantity").alias("min_qty"), F.max("quantity").alias("max_qty"),
        F.round(F.sum("quantity").cast("double") / F.count("*"), 4).alias("avg_qty"))


@query
def global_aggregate(w):
    return w.given.lineitem.agg(
        F.count("*").alias("lines"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("units"))


@query
def conditional_counts(w):
    lines = w.source("ec_order_lines")
    return lines.agg(
        F.count_if(F.col("quantity") >= 25).alias("bulk_lines"),
        F.sum(F.when(F.col("quantity") >= 25, F.col("line_total_excl_tax"))).cast("double").alias("bulk_amount"),
        F.count_if(F.col("discount_applied") == 0).alias("undiscounted"))


@query
def distinct_counts(w):
    lines = w.source("ec_order_lines")
    return lines.agg(
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("order_id", "product_sku").alias("order_products"),
        F.countDistinct(F.when(F.col("quantity") > 40, F.col("product_sku"))).alias("bulk_products"))


@query
def having_repeat_customers(w):
    return w.given.orders.groupBy("o_custkey").agg(F.count("*").alias("orders")).filter("orders > 10")


@query
def session_funnel_flags(w):
    return marts._funnel(w).groupBy("has_cart", "has_checkout", "has_purchase").agg(F.count("*").alias("sessions"))


@query
def median_transit(w):
    return commerce.median_transit_hours(commerce.shipment_milestones(w.silver("dc_delivery_events")))


@query
def rate_as_pair(w):
    f = w.given.lineitem.groupBy(F.col("l_suppkey").alias("seller_id")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("return_numerator"), F.count("*").alias("return_denominator"))
    return f


@query
def distinct_and_dedupe(w):
    d = w.given.documents.select(F.sha2("text", 256).alias("text_hash"), "lang")
    return d.dropDuplicates(["text_hash"]).select("text_hash").distinct().agg(F.count("*").alias("distinct_texts"))


@query
def case_pivot(w):
    e = w.silver("dc_delivery_events")

    def at(kind: str) -> Column:
        return F.min(F.when(F.col("event_type_code") == kind, F.col("event_timestamp")))

    return e.groupBy("shipment_id").agg(
        at("PICKED_UP").alias("picked_up"), at("READY_FOR_PICKUP").alias("ready"),
        at("BOPIS_COLLECTED").alias("collected"), at("DELIVERED").alias("delivered"),
        F.min_by("event_type_code", F.struct("event_timestamp", "event_type_code")).alias("first_event"))


# ---- windows -----------------------------------------------------------------------------------
@query
def milestones_per_shipment(w):
    e = commerce.with_milestones(w.silver("dc_delivery_events"), w.silver("dc_shipments"))
    return e.select("event_id", "pickup_ts", "delivered_ts", "ship_created_ts")


@query
def first_and_last_snapshot(w):
    return aggregates.first_and_last(
        w.silver("si_inventory_snapshots"), ["store_id", "product_code"], "snapshot_date", "physical_qty")


@query
def product_versions(w):
    return w.dim("product").select(
        "sku", "price_list", "valid_from", "valid_to", "is_current", "version_number", "version_key")


@query
def product_versions_load_by_load(w):
    """The last loads merged one by one into the versions of all loads before them."""
    loads = raw.materialise(w.source("pc_product_loads"), "product_loads")
    days = [r[0] for r in loads.select("load_date").distinct().orderBy(F.desc("load_date")).limit(3).collect()][::-1]
    dim = versions(loads.filter(F.col("load_date") < days[0]) if days else loads, "sku", ["price_list"], "load_date")
    for day in days:
        dim = raw.materialise(merge_load(dim, loads.filter(F.col("load_date") == day), "sku", ["price_list"], "load_date"), "product_versions")
    return dim


@query
def email_group_leader(w):
    """Every identity record with an address and the smallest record id that shares it."""
    recs = w.source("identity_records").withColumn("mail", email_norm("email")).filter("mail is not null")
    lead = recs.groupBy("mail").agg(F.min(F.struct("source_system", "source_id")).alias("l"))
    return recs.join(lead, "mail").select(
        "source_system", "source_id", "mail", F.col("l.source_system").alias("leader_system"),
        F.col("l.source_id").alias("leader_id"))


@query
def prior_terminal_listing(w):
    """Listings whose seller ended one with the same picture in the 30 days before, any status."""
    key = ["seller_account_id", "image_hash"]
    s = w.silver("nl_listings")
    ended = s.filter(F.col("status_code").isin("SOLD", "EXPIRED")).select(*key, F.col("updated_at").alias("end_at"))
    return joins.mark_within(s, ended, key, "created_at", "end_at", 30 * 86400, "had_prior", after=False, strict=True).select(
        "listing_id", "had_prior")


# ---- sorts, limits, set operations -------------------------------------------------------------
@query
def ordered_rings(w):
    return commerce.shared_pictures(w.source("nl_listings")).orderBy(F.desc("distinct_sellers"), "image_hash")


@query
def canonical_value_lookup(w):
    df = r.prepare_seller_listings(w.silver("ts_seller_listings"), w.silver("pc_products"))
    return df.select("listing_id", "catalogue_sku_ref", "canonical_title")


@query
def bag_union_by_channel(w):
    return marts.channel_values(w, "line_subtotal_excl_tax", "gross_amount", "v").groupBy("channel").agg(
        F.count("*").alias("lines"), summed("v").alias("gross"))


@query
def union_with_missing_columns(w):
    return w.fact("store_inventory_snapshot").groupBy("is_reconstructed").agg(
        F.count("*").alias("rows"), F.count("reserved_qty").alias("with_reserved"), F.sum("physical_qty").alias("units"))


# ---- quality core ------------------------------------------------------------------------------
def _flag_cases(w):
    """Orders with up to four rules on a row, one of them undecidable where the promo is null."""
    df = quality.add_anomaly_columns(w.source("ec_orders"))
    return quality.flag(df, [
        Rule("CANCELLED_WITH_REVENUE", F.col("order_status") == "CANCELLED"),
        Rule("ATTRIBUTION_SESSION_BRIDGE", F.col("promo_code_applied") == "VIP10"),
        Rule("PLACEHOLDER_ID_COLLISION", F.col("customer_id") == "0", "FLAGGED_AMBIGUOUS", "ESTIMATED"),
        Rule("NEGATIVE_AMOUNT", F.col("subtotal_excl_tax") < 0),
    ])


@query
def anomaly_columns(w):
    df = quality.add_anomaly_columns(w.source("cl_customers"), "FLAGGED_AMBIGUOUS", "INFERRED")
    return df.select("source_id", *QUALITY)


@query
def flag_rules(w):
    return _flag_cases(w).select("order_id", *QUALITY)


@query
def severity_merge(w):
    df = _flag_cases(w)
    return df.select(
        "order_id",
        quality.more_severe("data_quality_status", "'FLAGGED_AMBIGUOUS'", vocab.STATUSES).alias("status"),
        quality.more_severe("metric_certainty_level", "'INFERRED'", vocab.CERTAINTIES).alias("certainty"))


def _dates_raw(w):
    """Order times as text in six layouts, with some unreadable and some missing."""
    created = retail.CREATED
    return w.given.orders.selectExpr(
        "o_orderkey as id",
        "case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then 'epoch_seconds' "
        "when o_orderpriority = '1-URGENT' then 'day_slash' when o_orderpriority = '2-HIGH' then 'iso_date' "
        "when o_orderpriority = '3-MEDIUM' then 'iso_timestamp' when o_orderpriority = '5-LOW' then 'day_month_name' "
        "else 'slash_minute' end as layout",
        f"{created} as at", "o_totalprice",
    ).selectExpr(
        "id", "layout",
        "case when o_totalprice > 490000 then null when o_totalprice < 20000 then 'not a date' "
        "when layout = 'epoch_seconds' then cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', at) as string) "
        "when layout = 'day_slash' then date_format(at, 'dd/MM/yyyy') when layout = 'iso_date' then date_format(at, 'yyyy-MM-dd') "
        f"when layout = 'iso_timestamp' then date_format(at, \"{retail.ISO}\") "
        "when layout = 'day_month_name' then date_format(at, 'dd-MMM-yyyy') "
        "else date_format(at, 'yyyy/MM/dd HH:mm') end as raw",
    )


def _dates_parsed(w):
    layouts = ["epoch_seconds", "day_slash", "iso_date", "iso_timestamp", "day_month_name", "slash_minute"]
    parsed = F.coalesce(*[
        F.when(F.col("layout") == n, parse("raw", n).cast("timestamp_ntz")) for n in layouts])
    df = quality.add_anomaly_columns(_dates_raw(w).withColumn("parsed", parsed))
    return quality.flag(df, [quality.date_parse_rule("raw", "parsed")])


@query
def date_normalisation(w):
    return _dates_parsed(w).select("id", "layout", "parsed")


@query
def date_parse_flags(w):
    return _dates_parsed(w).groupBy("layout").agg(
        F.count("*").alias("rows"), F.count_if("anomaly_flag").alias("failed"),
        F.count_if(F.col("raw").isNull()).alias("missing"))


@query
def orphan_foreign_keys(w):
    known = w.source("pc_products").select(F.col("sku").alias("catalogue_sku_ref"), F.lit(True).alias("known"))
    df = w.source("ts_seller_listings").filter("catalogue_sku_ref is not null").join(known, "catalogue_sku_ref", "left")
    return quality.flag(quality.add_anomaly_columns(df), [quality.orphan_rule("known")]).select("listing_id", *QUALITY)


@query
def resolution_columns(w):
    return quality.add_resolution_columns(w.silver("rv_reviews")).select("review_id", *AUDIT)


@query
def resolve_keeps_flag_and_code(w):
    return w.resolved("rr_return_receipts").select("receipt_id", *QUALITY, *AUDIT)


@query
def resolved_counts_per_code(w):
    return quality.resolved_counts({t: w.resolved(t) for t in RESOLVED})


@query
def sticky_detection(w):
    """The same rows are found again after the fix erased what gave them away."""
    once = w.resolved("rr_return_receipts")
    twice = w.correct("rr_return_receipts", once)
    return twice.agg(
        F.count_if(has_code("anomaly_reason_code", "RESTOCK_BEFORE_INSPECTION")).alias("restocked_early"),
        F.count_if(has_code("anomaly_reason_code", "OPEN_BOX_AS_NEW")).alias("opened_as_new"),
        F.sum("restocked_qty").alias("restocked_units"))


@query
def first_resolution_wins(w):
    return w.resolved("nl_listing_events").groupBy("event_type_code", "anomaly_reason_code", "resolution_method").agg(
        F.count("*").alias("events"))


@query
def registry_of_codes(w):
    """Codes found in the corrected tables with their registered defaults; none may be unknown."""
    seen = quality.code_profile({t: w.resolved(t) for t in RESOLVED})
    known = w.spark.createDataFrame(
        [(c, v.status, v.certainty) for c, v in vocab.REASON_CODES.items()],
        "reason_code string, default_status string, default_certainty string")
    used = seen.filter("reason_code is not null").groupBy("reason_code").agg(F.sum("row_count").alias("rows"))
    return used.join(F.broadcast(known), "reason_code", "left")


@query
def universal_rules_orders(w):
    df = quality.add_anomaly_columns(w.given.orders.withColumn(
        "note", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))))
    rules = quality.universal_rules(
        dates=["o_orderdate"], window=(w.campaign.baseline_from, w.campaign.post_to), amounts=["o_totalprice"], required=["note"])
    return quality.flag(df, rules).select("o_orderkey", *QUALITY)


@query
def universal_rules_contacts(w):
    df = quality.add_anomaly_columns(w.source("identity_records"))
    rules = quality.universal_rules(email="email", phone="phone", required=["name"])
    return quality.flag(df, rules).groupBy("source_system", "anomaly_reason_code", "data_quality_status", "metric_certainty_level").agg(
        F.count("*").alias("rows"))


@query
def universal_rules_stock(w):
    df = quality.add_anomaly_columns(w.source("si_inventory_snapshots"))
    rules = quality.universal_rules(quantities=["physical_qty"], oversold=F.col("sellable_qty") < 0)
    return quality.flag(df, rules).groupBy("anomaly_reason_code", "data_quality_status", "metric_certainty_level").agg(
        F.count("*").alias("rows"))


@query
def universal_rules_accounts(w):
    df = quality.add_anomaly_columns(w.given.customer)
    return quality.flag(df, quality.universal_rules(amounts=["c_acctbal"])).select("c_custkey", *QUALITY)


@query
def anomaly_profile(w):
    return quality.code_profile({t: w.resolved(t) for t in RESOLVED})


@query
def rerun_changes_nothing(w):
    """Rows of every corrected table that a second run changes or adds, and that it changes or loses."""
    parts = []
    for t in RESOLVED:
        with held(w.resolved(t), f"once_{t}") as once:
            changes = quality.row_changes(once, w.correct(t, once).select(*once.columns))
            parts.append(raw.materialise(changes.select(F.lit(t).alias("table_name"), "*"), f"changes_{t}"))
    return quality.union_all(parts)


# ---- silver transforms -------------------------------------------------------------------------
@query
def status_map(w):
    return commerce.build_status_map(w.spark, {
        "POS": (w.source("pos_transactions"), "status_code"), "EC": (w.source("ec_orders"), "order_status"),
        "PG": (w.source("pg_transactions"), "status_code"), "MARKETPLACE": (w.source("ts_sellers"), "seller_status"),
    })


@query
def status_normalisation(w):
    parts = [(s, w.silver(t)) for s, t in [("POS", "pos_transactions"), ("EC", "ec_orders"), ("PG", "pg_transactions"), ("MARKETPLACE", "ts_sellers")]]
    return quality.union_all([
        df.groupBy("canonical_status").agg(F.count("*").alias("rows"), F.count_if("anomaly_flag").alias("flagged"))
        .select(F.lit(s).alias("source_system"), "*") for s, df in parts])


@query
def surrogate_keys(w):
    return w.source("ec_orders").select(
        "order_id", surrogate_key("order_id", "promo_code_applied").alias("order_sk"),
        readable_key("order_id", "promo_code_applied").alias("readable"),
        F.when(F.col("customer_id") == "0", anonymous_key()).otherwise(surrogate_key("customer_id")).alias("customer_sk"))


@query
def identity_resolution(w):
    return w.identities().select("source_system", "source_id", "customer_key", "identity_confidence", "match_pass", *QUALITY)


@query
def identity_groups(w):
    """Identity records joined over any chain of loyalty ids, mail addresses and phones, with the weakest link needed."""
    records = w.source("identity_records").select(
        "source_system", "source_id", F.concat_ws(":", "source_system", F.lpad(F.col("source_id").cast("string"), 12, "0")).alias("record"),
        "loyalty_id", email_norm("email").alias("mail"), phone_e164("phone").alias("phone_no"))
    found = linked_groups(records, "record", [("loyalty_id", 1.0), ("mail", 0.95), ("phone_no", 0.9)])
    return found.select("source_system", "source_id", "group_key", "group_confidence", "group_size")


@query
def identity_bridge(w):
    return identity.identity_bridge(w.identities())


@query
def customer_master(w):
    return w.customer_master().select(
        "customer_key", "identity_confidence", "lowest_confidence", "match_pass_used", "identity_records")


@query
def product_master(w):
    return w.product_master().select(
        "listing_id", "sku", "product_name", "match_confidence", "match_pass", "canonical_product_key", "requires_manual_review", *QUALITY)


@query
def missing_snapshot_days(w):
    return inventory.missing_days(
        w.silver("si_inventory_snapshots"), ["store_id", "product_code"], "snapshot_date", w.snapshot_spine())


@query
def gap_fill_interpolated(w):
    return w.reconstructed()


@query
def gap_fill_from_movements(w):
    moves = w.silver("si_inventory_movements")
    return inventory.fill_from_movements(
        w.silver("si_inventory_snapshots"), moves, ["store_id", "product_code"], "snapshot_date", "physical_qty",
        "movement_date", "quantity_change", w.snapshot_spine()).select(
        "store_id", "product_code", "snapshot_date", "physical_qty", "recon_method", *QUALITY)


@query
def listing_confidence(w):
    return w.listing_confidence()


@query
def refund_periods(w):
    return w.refunds_with_periods().select(
        "refund_id", "original_month", "refund_month", "revenue_impact_original_period",
        "revenue_impact_return_period", "is_cross_period")


@query
def campaign_attribution(w):
    return rec.campaign_rules(w)


@query
def seller_trust(w):
    return w.trust_scores()


# ---- anomalies: detect -------------------------------------------------------------------------
@query
def detect_cancelled_revenue(w):
    o = w.silver("ec_orders").filter((F.col("order_status") == "CANCELLED") & (F.col("subtotal_excl_tax") > 0))
    return o.agg(F.count("*").alias("affected_rows"), summed("subtotal_excl_tax").alias("revenue_at_risk"))


@query
def detect_payment_after_cancel(w):
    p = r.prepare_pg_transactions(w.silver("pg_transactions"), w.silver("ec_orders"), w.silver("ec_order_status_history"))
    hit = p.filter("captured_ts is not null and cancelled_ts is not null")
    return hit.agg(F.count("*").alias("affected_rows"),
                   F.count_if(F.col("captured_ts") > F.col("cancelled_ts")).alias("strictly_after"))


@query
def detect_tax_basis(w):
    a = w.silver("pos_transaction_lines").agg(F.count("*").alias("rows"), summed("total_amount_incl_tax").alias("amount")).select(
        F.lit("store_incl_tax").alias("basis"), "rows", "amount")
    b = w.silver("ec_orders").agg(F.count("*").alias("rows"), summed("subtotal_excl_tax").alias("amount")).select(
        F.lit("online_excl_tax").alias("basis"), "rows", "amount")
    return a.unionByName(b)


@query
def detect_seller_marked_sold(w):
    e = w.silver("nl_listing_events").filter(F.col("event_type_code") == "SELLER_SOLD").groupBy("listing_id").agg(F.count("*").alias("n"))
    price = w.silver("nl_listings").select("listing_id", "asking_price")
    return e.join(price, "listing_id").agg(
        F.sum("n").alias("sold_events"), F.count("*").alias("distinct_listings"),
        F.sum(F.col("n") * F.col("asking_price")).cast("double").alias("counted_value"))


@query
def detect_promised_without_stock(w):
    return w.silver("wh_inventory_snapshots").agg(
        F.count_if((F.col("atp_qty") > 0) & (F.col("physical_qty") == 0)).alias("affected_rows"))


@query
def detect_negative_stock(w):
    return w.silver("si_inventory_snapshots").agg(
        F.count_if((F.col("sellable_qty") < 0) | (F.col("physical_qty") < 0)).alias("affected_rows"))


@query
def detect_restock_before_inspection(w):
    return w.silver("rr_return_receipts").agg(
        F.count_if((F.col("inspection_status") == "PENDING") & (F.col("restocked_qty") > 0)).alias("affected_rows"))


@query
def detect_missing_snapshot_days(w):
    return missing_snapshot_days(w).groupBy("store_id").agg(F.count("*").alias("missing_cells"), F.countDistinct("snapshot_date").alias("days"))


@query
def detect_title_mismatch(w):
    c = r.title_mismatch()
    df = r.prepare_seller_listings(w.silver("ts_seller_listings"), w.silver("pc_products"))
    return df.filter(c.when).select("listing_id", "catalogue_sku_ref", "seller_product_title", "canonical_title")


@query
def detect_open_box_as_new(w):
    return w.silver("rr_return_receipts").agg(
        F.count_if((F.col("condition_on_receipt") == "OPENED") & (F.col("restocked_as_condition") == "NEW")).alias("affected_rows"))


@query
def detect_placeholder_customer(w):
    return identity.placeholder_ids(w.source("ec_orders"), w.source("cl_customers"))


@query
def detect_relisted_after_sold(w):
    s = commerce.mark_relisted(w.silver("nl_listings"), name="ever")
    s = commerce.mark_relisted(s, vocab.RELIST_WINDOW_DAYS, name="recent")
    return s.agg(F.count_if(F.col("relist_count") > 0).alias("by_metadata"),
                 F.count_if("ever").alias("by_picture"), F.count_if("recent").alias("by_picture_30d"))


@query
def detect_picture_rings(w):
    return commerce.shared_pictures(w.silver("nl_listings"))


@query
def detect_delivered_before_pickup(w):
    m = commerce.shipment_milestones(w.silver("dc_delivery_events"))
    wrong = F.col("delivered_ts") < F.col("pickup_ts")
    strict = m.agg(
        F.count_if(wrong).alias("strict_before_ship"),
        F.count_if(wrong & (F.abs(hours_between("pickup_ts", "delivered_ts")) > 72)).alias("manual_review"))
    created = w.silver("dc_shipments").select("shipment_id", "created_datetime")
    first = w.silver("dc_delivery_events").groupBy("shipment_id").agg(F.min("event_timestamp").alias("t"))
    broad = first.join(created, "shipment_id").agg(F.count_if(F.col("t") < F.col("created_datetime")).alias("broad_clock_drift"))
    return with_one_row(strict, broad)


@query
def detect_review_before_delivery(w):
    return w.silver("rv_reviews").agg(F.count_if(F.col("days_post_delivery") < 0).alias("affected_reviews"),
                                      F.count_if((F.col("days_post_delivery") < 0) & (F.col("is_verified_purchase") == 1)).alias("marked_verified"))


@query
def detect_duplicate_cases(w):
    return w.silver("cs_cases").agg(F.count_if(F.col("is_duplicate_flag") == 1).alias("duplicate_cases"),
                                    F.countDistinct(F.coalesce("canonical_case_ref", "case_reference")).alias("incidents"))


@query
def detect_session_attribution(w):
    o = joins.mark_exists(
        w.silver("ec_orders"), w.silver("ws_sessions").filter(F.col("utm_campaign") == w.campaign.tag),
        {"session_id": "session_id"}, "tagged")
    first, last = (F.lit(d).cast("date") for d in w.campaign.window)
    cand = o.filter(F.col("order_date").between(first, last) & F.col("promo_code_applied").isNull())
    return cand.agg(F.count("*").alias("candidates"), F.count_if("tagged").alias("attributed"))


@query
def detect_cross_period_refunds(w):
    return w.refunds_with_periods().filter((F.col("refund_type") == "PARTIAL") & F.col("is_cross_period")).agg(
        F.count("*").alias("affected_rows"), summed("refund_amount").alias("reversal_amount"))


@query
def detect_null_reference_movements(w):
    return w.silver("wh_inventory_movements").filter("reference_number is null").groupBy("movement_type").agg(
        F.count("*").alias("movements"), F.sum("quantity_change").alias("units"))


@query
def detect_listings_to_match(w):
    return w.silver("nl_listings").filter(F.col("status_code") == "ACTIVE").groupBy("category_code").agg(F.count("*").alias("listings"))


@query
def detect_ambiguous_identities(w):
    c = F.col("identity_confidence")
    return w.identities().agg(F.count_if((c >= 0.70) & (c < 1.0)).alias("candidates"), F.count_if((c >= 0.90) & (c < 1.0)).alias("mergeable"))


@query
def detect_value_signals(w):
    return w.silver("nl_listing_events").filter(F.col("event_type_code").isin(list(vocab.SIGNAL_WEIGHTS))).groupBy("event_type_code").agg(
        F.count("*").alias("events"), summed("offer_amount").alias("offers"))


@query
def detect_uncollected_pickups(w):
    return _uncollected(w).agg(F.count("*").alias("affected_rows"))


@query
def detect_high_risk_sellers(w):
    return w.trust_scores().groupBy("risk_tier").agg(F.count("*").alias("sellers"), F.count_if("anomaly_flag").alias("flagged"))


# ---- anomalies: resolve, one rule at a time ----------------------------------------------------
RULES: dict[str, tuple[str, Callable[[Warehouse], quality.Correction], list[str]]] = {
    "cancelled_revenue": ("ec_orders", lambda w: r.cancelled_revenue(), ["order_id", "subtotal_excl_tax"]),
    "payment_after_cancel": ("pg_transactions", lambda w: r.payment_after_cancel(), ["transaction_id", "strictly_after"]),
    "tax_basis": ("pos_transaction_lines", lambda w: r.tax_basis(), ["txn_id", "line_no", "revenue_excl_tax"]),
    "seller_marked_sold": ("nl_listing_events", lambda w: r.seller_marked_sold(), ["event_id"]),
    "promised_without_stock": ("wh_inventory_snapshots", lambda w: r.promised_without_stock(), ["warehouse_id", "sku", "snapshot_date", "atp_qty"]),
    "negative_stock": ("si_inventory_snapshots", lambda w: r.negative_stock(), ["store_id", "product_code", "snapshot_date", "physical_qty", "sellable_qty", "oversell_flag"]),
    "restock_before_inspection": ("rr_return_receipts", lambda w: r.restocked_early(), ["receipt_id", "restocked_qty"]),
    "missing_snapshot_days": ("reconstructed_snapshots", lambda w: r.reconstructed_day(), ["store_id", "product_code", "snapshot_date", "physical_qty"]),
    "title_mismatch": ("ts_seller_listings", lambda w: r.title_mismatch(), ["listing_id", "seller_product_title"]),
    "open_box_as_new": ("rr_return_receipts", lambda w: r.opened_as_new(), ["receipt_id", "restocked_as_condition"]),
    "placeholder_customer": ("ec_orders", lambda w: r.placeholder_customer(), ["order_id", "customer_id"]),
    "relisted_after_sold": ("nl_listings", lambda w: r.relisted_after_sold(), ["listing_id", "excluded_from_gmv", "relisting_reliability"]),
    "picture_rings": ("nl_listings", lambda w: r.picture_ring(), ["listing_id", "fraud_ring_flag"]),
    "delivered_before_pickup": ("dc_delivery_events", lambda w: r.delivered_before_pickup(), ["event_id", "corrected_event_datetime", "requires_manual_review"]),
    "review_before_delivery": ("rv_reviews", lambda w: r.review_before_delivery(), ["review_id", "is_verified_purchase"]),
    "duplicate_cases": ("cs_cases", lambda w: r.duplicate_case(), ["case_id", "canonical_case_key"]),
    "session_attribution": ("ec_orders", lambda w: r.session_attribution(w.campaign.window), ["order_id", "attribution_confidence"]),
    "cross_period_refunds": ("rr_refund_events", lambda w: r.partial_refund_period(), ["refund_id", "revenue_impact_return_period"]),
    "null_reference_movements": ("wh_inventory_movements", lambda w: r.missing_reference(), ["movement_id"]),
    "listing_match_tiers": ("nl_listings", lambda w: r.catalogue_match(), ["listing_id", "b4_match_confidence"]),
    "ambiguous_identities": ("identities", lambda w: r.ambiguous_identity(), ["source_system", "source_id", "identity_confidence"]),
    "value_signals": ("nl_listing_events", lambda w: r.value_signals(), ["event_id"]),
    "uncollected_pickups": ("ec_orders", lambda w: r.uncollected_pickup(), ["order_id", "collection_unconfirmed"]),
    "high_risk_sellers": ("ts_sellers", lambda w: r.high_risk_seller(), ["seller_id", "trust_score", "risk_tier"]),
}
for _n, (_t, _make, _cols) in RULES.items():
    add(f"resolve_{_n}", lambda w, t=_t, make=_make, cols=_cols: w.correct(t, only=[make(w)]).select(*cols, *QUALITY, *AUDIT))


# ---- anomalies: verify on the resolved tables ---------------------------------------------------
def _verify(name: str, table: str, left: Callable[[], Column], **more: Callable[[], Column]) -> None:
    add(f"verify_{name}", lambda w: w.resolved(table).agg(
        F.count_if(left()).alias("unresolved"),
        *[F.count_if(c()).alias(n) for n, c in more.items()]))


def _open(code: str) -> Callable[[], Column]:
    return lambda: has_code("anomaly_reason_code", code) & ~F.col("resolution_applied")


def _labelled(label: str) -> Callable[[], Column]:
    return lambda: F.col("b_classification") == label


_verify("cancelled_revenue", "ec_orders", lambda: (F.col("order_status") == "CANCELLED") & (F.col("subtotal_excl_tax") > 0))
_verify("payment_after_cancel", "pg_transactions", _open("PAYMENT_AFTER_CANCEL"))
_verify("tax_basis", "pos_transaction_lines", _open("TAX_INCLUSION_MISMATCH"), unnormalised=lambda: F.col("revenue_excl_tax").isNull())
_verify("seller_marked_sold", "nl_listing_events", lambda: (F.col("event_type_code") == "SELLER_SOLD") & (F.col("metric_certainty_level") != "ESTIMATED"))
_verify("promised_without_stock", "wh_inventory_snapshots", lambda: (F.col("atp_qty") > 0) & (F.col("physical_qty") == 0))
_verify("negative_stock", "si_inventory_snapshots", lambda: (F.col("sellable_qty") < 0) | (F.col("physical_qty") < 0))
_verify("restock_before_inspection", "rr_return_receipts", lambda: (F.col("inspection_status") == "PENDING") & (F.col("restocked_qty") > 0))
_verify("missing_snapshot_days", "reconstructed_snapshots", lambda: ~F.col("resolution_applied"), reconstructed=lambda: F.col("data_quality_status") == "RECONSTRUCTED")
_verify("title_mismatch", "ts_seller_listings", lambda: r.title_mismatch().when)
_verify("open_box_as_new", "rr_return_receipts", lambda: (F.col("condition_on_receipt") == "OPENED") & (F.col("restocked_as_condition") == "NEW"))
_verify("placeholder_customer", "ec_orders", lambda: (F.col("customer_id") == retail.PLACEHOLDER_ID) & F.col("session_id").startswith(vocab.GUEST_SESSION))
add("verify_relisted_after_sold", lambda w: commerce.mark_relisted(w.resolved("nl_listings")).agg(
    F.count_if(F.col("is_relisted") & ~F.col("excluded_from_gmv")).alias("unresolved")))
_verify("picture_rings", "nl_listings", _open("IMAGE_HASH_REUSED"))
_verify("delivered_before_pickup", "dc_delivery_events",
        lambda: (F.col("event_type_code") == "DELIVERED") & (F.col("delivered_ts") < F.col("pickup_ts")) & F.col("corrected_event_datetime").isNull() & ~F.col("requires_manual_review"),
        manual_review=lambda: F.col("requires_manual_review"))
_verify("review_before_delivery", "rv_reviews", lambda: (F.col("days_post_delivery") < 0) & (F.col("is_verified_purchase") != 0))
_verify("duplicate_cases", "cs_cases", _open("DUPLICATE_CASE"))
_verify("session_attribution", "ec_orders", _open("ATTRIBUTION_SESSION_BRIDGE"), classified=_labelled("ATTRIBUTED"))
_verify("cross_period_refunds", "rr_refund_events", _open("REFUND_PARTIAL_PERIOD_AMBIGUITY"), classified=_labelled("RECOGNISE_IN_RETURN_PERIOD"))
_verify("null_reference_movements", "wh_inventory_movements", _open("MOVEMENT_NULL_REF"), classified=_labelled("PROBABLE_MISSING_REF"))
add("verify_listing_match_tiers", lambda w: w.resolved("nl_listings").filter("b_classification is not null").groupBy("b_classification").agg(F.count("*").alias("listings")))
_verify("ambiguous_identities", "identities",
        lambda: F.col("identity_confidence").between(0.90, 1.00) & (F.col("identity_confidence") < 1.00) & ~F.col("resolution_applied"), merged=_labelled("MERGED"))
_verify("value_signals", "nl_listing_events", _open("ESTIMATED_NL_GMV"), estimated=lambda: has_code("anomaly_reason_code", "ESTIMATED_NL_GMV") & (F.col("metric_certainty_level") == "ESTIMATED"))
_verify("uncollected_pickups", "ec_orders", _open("BOPIS_NO_PICKUP_EVENT"), classified=_labelled("TREAT_AS_FULFILLED"))
add("verify_high_risk_sellers", lambda w: w.resolved("ts_sellers").filter("b_classification is not null").groupBy("b_classification").agg(F.count("*").alias("sellers")))

for _t, _cols in {
    "ec_orders": ["order_id", "subtotal_excl_tax", "customer_id", "attribution_confidence", "collection_unconfirmed"],
    "nl_listings": ["listing_id", "excluded_from_gmv", "fraud_ring_flag", "relisting_reliability"],
    "nl_listing_events": ["event_id"],
    "rr_return_receipts": ["receipt_id", "restocked_qty", "restocked_as_condition"],
}.items():
    add(f"resolved_{_t}", lambda w, t=_t, cols=_cols: w.resolved(t).select(*cols, *QUALITY, *AUDIT))


@query
def anomaly_before_after(w):
    """All catalogued anomalies."""
    orders = w.resolved("ec_orders").join(w.source("ec_orders").select("order_id", F.col("subtotal_excl_tax").alias("was")), "order_id")
    at_stake = {
        "cancelled_revenue": "was", "payment_after_cancel": "amount", "tax_basis": "tax_amount", "cross_period_refunds": "refund_amount",
        "null_reference_movements": "quantity_change",
    }
    return r.before_after([
        (name, make(w), orders if table == "ec_orders" else w.resolved(table), F.col(at_stake[name]) if name in at_stake else None)
        for name, (table, make, _) in RULES.items()])


# ---- dimensions --------------------------------------------------------------------------------
DIM_COLUMNS = {
    "date": ["date_key", "date_day", "date_iso", "year", "month", "day", "day_of_week", "is_weekend", "is_public_holiday", "campaign_phase", "is_campaign_day"],
    "payment_method": ["payment_method_key", "type_code", "type_name", "payment_certainty", "is_prepaid"],
    "delivery_method": ["delivery_method_key", "method_code", "method_name", "is_platform_controlled", "is_bopis"],
    "return_reason": ["return_reason_key", "reason_code", "reason_group", "channel_fault_attribution"],
    "listing_condition": ["listing_condition_key", "condition_code", "granularity_group"],
    "promotion": ["promotion_key", "promo_code", "promotion_channel_scope"],
    "store": ["store_key", "store_id", "store_name", "region_name", "zone_activation_date"],
    "seller": ["seller_key", "seller_code", "seller_status", "seller_risk_score", "seller_risk_tier_key"],
    "product": ["product_key", "version_key", "sku", "price_list", "product_name", "category", "list_price", "valid_from", "valid_to", "is_current", "version_number"],
    "customer": ["customer_key", "version_key", "customer_id", "delivery_habit", "valid_from", "valid_to", "is_current", "version_number", "customer_master_key", "identity_confidence_score", "match_pass_used"],
}
for _t, _cols in DIM_COLUMNS.items():
    add(f"dim_{_t}", lambda w, t=_t, cols=_cols: w.dim(t).select(*cols, "is_active", *QUALITY))


@query
def dim_channel(w):
    return static_reference_rows(w)


@query
def dim_step(w):
    used = w.fact("web_page_event").groupBy("step_key").agg(F.count("*").alias("events"))
    return w.dim("step").join(used, "step_key", "left").select(
        "step_key", "step_code", "sequence_number", "is_conversion_step", "is_active", F.coalesce("events", F.lit(0)).alias("events"))


@query
def dim_seller_risk_tier(w):
    n = w.trust_scores().groupBy("risk_tier").agg(F.count("*").alias("sellers"))
    return w.dim("seller_risk_tier").join(n, "risk_tier", "left").select(
        "seller_risk_tier_key", "risk_tier", "tier_threshold", "moderation_required", "visibility_pct", F.coalesce("sellers", F.lit(0)).alias("sellers"))


@query
def dimension_contract(w):
    return dims.contract_violations({d: (w.dim(d), *DIM_KEYS[d]) for d in DIM_KEYS})


# ---- facts -------------------------------------------------------------------------------------
FACT_COLUMNS = {
    "ecommerce_order_line": ["order_id", "line_id", "date_key", "product_key", "customer_key", "channel_key", "delivery_method_key", "promotion_key", "store_key",
                             "order_status", "quantity", "line_subtotal_excl_tax", "confirmed_revenue_excl_tax", "is_confirmed_revenue", "discount_amount",
                             "unit_price_excl_tax", "is_campaign_attributed", "attribution_rule"],
    "order_fulfilment": ["order_id", "order_number", "customer_key", "order_status", "placed_date_key", "captured_date_key", "shipped_date_key", "delivered_date_key",
                         "returned_date_key", "placed_to_captured_hours", "picked_to_delivered_hours", "total_lifecycle_hours"],
    "store_inventory_snapshot": ["store_id", "product_code", "snapshot_date", "physical_qty", "sellable_qty", "is_reconstructed", "date_key", "product_key", "store_key"],
    "warehouse_inventory_snapshot": ["warehouse_id", "sku", "snapshot_date", "physical_qty", "atp_qty", "date_key", "product_key", "warehouse_key"],
    "inventory_transaction": ["movement_id", "node_type", "node_id", "product_code", "movement_type", "quantity_delta", "reference_number", "mdate", "date_key", "node_key"],
    "web_session": ["session_id", "date_key", "customer_key", "promotion_key", "device_type", "channel_source", "session_duration_seconds", "page_count", "event_count"],
    "web_page_event": ["session_id", "event_id", "date_key", "product_key", "event_type_code", "step_id", "time_on_page_seconds", "cart_value", "is_conversion_event"],
    "classified_listing_snapshot": ["listing_id", "listing_ref", "date_key", "product_key", "seller_key", "category_code", "status_code", "asking_price", "relist_count"],
    "classified_listing_event": ["listing_id", "event_id", "date_key", "product_key", "event_type_code", "offer_amount"],
    "customer_review": ["review_id", "date_key", "product_key", "customer_key", "star_rating", "is_verified_purchase", "days_post_delivery"],
    "customer_complaint": ["case_id", "canonical_case_key", "case_reference", "date_key", "customer_key", "channel_key", "resolution_time_hours", "is_duplicate_flag"],
    "store_sale_line": ["receipt_no", "line_no", "date_key", "product_key", "store_key", "customer_key", "payment_method_key", "promotion_key", "quantity", "gross_amount", "discount_amount",
                        "net_amount", "tax_amount", "cogs_amount", "unit_price"],
    "return_line": ["return_authorization_id", "line_no", "request_date_key", "receipt_date_key", "product_key", "customer_key", "store_key", "return_reason_key", "listing_condition_key",
                    "quantity_returned", "refund_amount", "restocking_fee", "revenue_impact_original_period", "revenue_impact_return_period", "is_boris_return"],
    "seller_performance_snapshot": ["seller_id", "week_end", "date_key", "seller_key", "total_orders", "cancelled_orders", "late_fulfilments", "returned_orders", "complaints",
                                    "listings", "duplicate_listings", "listing_reports", "chats_received", "chats_answered", "seller_trust_score"],
}
for _t, _cols in FACT_COLUMNS.items():
    add(f"fact_{_t}", lambda w, t=_t, cols=_cols: w.fact(t).select(*cols, *QUALITY))


for _t in facts.VERSIONED:
    add(f"versions_{_t}", lambda w, t=_t: w.fact_in_steps(t, Steps(f"rows_{t}"), facts.GRAIN[t]))


@query
def star_join_row_counts(w):
    """Rows of each fact before and after it is joined with the versions of its product and customer. One fact after
    the other is written with its version keys, which stay only until its rows are counted."""
    with held(w.product_versions(), "product_versions") as products, held(w.customer_versions(), "customer_versions") as customers:
        return quality.union_all([_star_join(w, t, {"product": products, "customer": customers}) for t in facts.VERSIONED])


def _star_join(w, t, versions):
    step = Steps(f"rows_{t}")
    own = {c: versions[of] for c, of, natural in zip(facts.VERSION_KEYS, ("product", "customer"), facts.VERSIONED[t][1:]) if natural}
    with held(pack(w.fact_in_steps(t, step, [], versions), *own), f"version_keys_{t}") as f:
        step.end(w.spark)
        joined = f.withColumns({c: F.lit(None).cast("string") for c in facts.VERSION_KEYS if c not in own})
        for c, dim in own.items():
            number = dim.select(F.col("version_key").alias(c), F.col("version_number").alias(f"{c}_number"))
            joined = joined.join(pack(number, c), c, "left")
        counts = joined.agg(F.count("*").alias("joined_rows"), F.count("product_version_key").alias("with_product"), F.count("customer_version_key").alias("with_customer"))
        return raw.materialise(counts.withColumn("fact_rows", f.agg(F.count("*")).scalar()).select(
            F.lit(t).alias("fact"), "fact_rows", "joined_rows", "with_product", "with_customer"), f"star_join_{t}")


@query
def partial_rebuild(w):
    """Write only the facts the changed tables feed, and count what was stored."""
    built = w.rebuild(["rr_return_receipts", "wh_inventory_snapshots", "rv_reviews"])
    return checks.completeness(built)


@query
def rebuild_row_deltas(w):
    """Rows built from the uncorrected and from the corrected tables; corrections add or drop none."""
    affected = w.affected_facts(["wh_inventory_snapshots", "rv_reviews", "nl_listing_events", "rr_return_receipts"])
    before = {
        "warehouse_inventory_snapshot": facts.warehouse_inventory_snapshot(w.silver("wh_inventory_snapshots")),
        "customer_review": facts.customer_review(w.silver("rv_reviews")),
        "classified_listing_event": facts.classified_listing_event(w.silver("nl_listing_events")),
        "return_line": facts.return_line(w.silver("rr_return_requests"), w.silver("rr_return_receipts"), w.refunds_with_periods(), w.silver("ec_orders")),
    }
    return facts.row_deltas(before, {t: w.fact(t) for t in affected})


#: late rows of the corrected tables: those from this moment on arrive with the second load
LATE = {"rv_reviews": ("review_datetime", "1998-06-01"), "cs_cases": ("created_datetime", "1998-09-01"),
        "wh_inventory_snapshots": ("snapshot_date", "1998-06-01"), "nl_listings": ("created_at", "1998-08-25")}


@query
def incremental_rebuild(w):
    """Facts stored without the late rows, then rebuilt with them: only partitions with a new key are replaced."""
    early = Warehouse(w.spark, w.given.folder, {f"resolved.{c}": w.resolved(c).filter(F.col(at) < F.lit(day).cast("timestamp_ntz")) for c, (at, day) in LATE.items()})
    which = [t for t, (_, inputs) in rebuild.KEYED.items() if set(inputs) <= set(LATE)]
    kept = rebuild.FactStore(TableStore(w.spark, raw.new_path(w.spark, "facts")))
    kept.load(early, which)
    return rebuild.deltas(kept.store, kept.rebuild(w, which))


# ---- validation --------------------------------------------------------------------------------
SMALL_FACTS = ["ecommerce_order_line", "order_fulfilment", "store_inventory_snapshot", "warehouse_inventory_snapshot", "inventory_transaction", "web_session",
               "web_page_event", "classified_listing_snapshot", "classified_listing_event", "customer_review", "customer_complaint", "store_sale_line", "return_line",
               "seller_performance_snapshot"]


@query
def check_completeness(w):
    return checks.completeness({**{f"dim_{d}": w.dim(d) for d in DIM_KEYS}, **{f"fact_{f}": w.gold(f) for f in SMALL_FACTS}})


@query
def check_referential_integrity(w):
    used, known = rec.linked_tables(w)
    return checks.orphans(used, checks.known_keys(known, facts.LINKS), facts.LINKS)


@query
def check_grain(w):
    return checks.grain_violations({f: (w.gold(f), facts.GRAIN[f]) for f in SMALL_FACTS})


@query
def check_additive_identity(w):
    return checks.broken_identity(
        w.gold("store_sale_line"), F.col("net_amount"), F.col("gross_amount") - F.col("discount_amount"), vocab.ADDITIVE_TOLERANCE)


@query
def check_semi_additive(w):
    """Stock summed over places on each date, through the guard; summing over dates is refused."""
    f = w.gold("warehouse_inventory_snapshot")
    refused = 0
    try:
        aggregates.aggregate(f, ["sku"], ["atp_qty"])
    except ValueError:
        refused = 1
    return aggregates.aggregate(f, ["snapshot_date"], ["atp_qty", "physical_qty"]).withColumn(
        "sum_over_dates_refused", F.lit(refused)).withColumn("offending_views", F.lit(len(marts.semi_additive_offenders())))


@query
def check_certainty_complete(w):
    return checks.null_certainty({f: w.gold(f) for f in SMALL_FACTS})


def _first_date(t: str) -> str:
    return {"order_fulfilment": "placed_date_key", "return_line": "request_date_key"}.get(t, "date_key")


def _coverage(w):
    return checks.window_coverage({f: (w.gold(f), _first_date(f)) for f in SMALL_FACTS}, w.dim("date"), w.campaign.window)


add("check_campaign_coverage", _coverage)


@query
def check_stock_balance(w):
    return checks.stock_balance(w.gold("store_inventory_snapshot"), w.gold("inventory_transaction"), w.campaign.window)


@query
def check_certainty_segregation(w):
    """The fact rows behind the finance views and behind the estimate."""
    return checks.certainty_segregation(
        {"ecommerce_order_line": w.gold("ecommerce_order_line").withColumn("confirmed", F.col("confirmed_revenue_excl_tax")),
         "store_sale_line": w.gold("store_sale_line").withColumn("confirmed", F.col("net_amount"))},
        {"classified_listing_event": w.gold("classified_listing_event").filter(F.col("event_type_code").isin(list(vocab.SIGNAL_WEIGHTS)))})


@query
def check_temporal_order(w):
    return checks.uncorrected_delivery(w.gold("order_fulfilment"), vocab.REVIEW_BEYOND_HOURS)


@query
def validation_report(w):
    """All checks as one table of offenders and verdicts. Each fact is written with the columns that the checks of
    single facts read, and stays only while they run."""
    n = F.col
    known = checks.known_keys(rec.linked_tables(w)[1], facts.LINKS)
    per_fact = {
        "completeness": lambda t, f: checks.completeness({t: f}),
        "grain": lambda t, f: checks.grain_violations({t: (f, facts.GRAIN[t])}),
        "referential_integrity": lambda t, f: checks.orphans({t: f}, known, facts.LINKS),
        "certainty_complete": lambda t, f: checks.null_certainty({t: f}),
        "campaign_coverage": lambda t, f: checks.window_coverage({t: (f, _first_date(t))}, w.dim("date"), w.campaign.window),
    }
    found: dict[str, list[DataFrame]] = {c: [] for c in per_fact}
    for t in SMALL_FACTS:
        links = [fk for f, fk, *_ in facts.LINKS if f == t]
        with w.gold_held(t, list(dict.fromkeys([*facts.GRAIN[t], *links, _first_date(t), "metric_certainty_level"]))) as f:
            for c, check in per_fact.items():
                found[c].append(check(t, f))
    found = {c: quality.union_all(parts) for c, parts in found.items()}
    return checks.suite({
        "completeness": (found["completeness"], F.when(n("row_count") == 0, 1).otherwise(0), True),
        "grain": (found["grain"], n("dup_groups"), True),
        "referential_integrity": (found["referential_integrity"], n("orphan_rows"), True),
        "additive_identity": (check_additive_identity(w), n("broken_rows"), True),
        "certainty_complete": (found["certainty_complete"], n("null_certainty"), True),
        "campaign_coverage": (found["campaign_coverage"], F.when(n("rows_in_window") == 0, 1).otherwise(0), True),
        "stock_balance": (check_stock_balance(w), F.lit(1), True),
        "certainty_segregation": (check_certainty_segregation(w), n("bad_rows"), True),
        "temporal_order": (check_temporal_order(w), n("uncorrected_violations"), True),
        "semi_additive_views": (w.dim("step").filter("sequence_number = 1").select(F.lit(len(marts.semi_additive_offenders())).alias("v")), n("v"), True),
    }, "run-1")


@query
def validation_history(w):
    """Two runs of checks on reviews and complaints, before and after the late rows, with the change from run to run."""
    log = RunLog(TableStore(w.spark, raw.new_path(w.spark, "runs")))
    early = Warehouse(w.spark, w.given.folder, {f"resolved.{c}": w.resolved(c).filter(F.col(at) < F.lit(day).cast("timestamp_ntz"))
                                                for c, (at, day) in LATE.items() if c in ("rv_reviews", "cs_cases")}, lazy=True)
    for run, state in enumerate((early, w), 1):
        f = {t: state.fact(t) for t in ("customer_review", "customer_complaint")}
        dup = F.col("is_duplicate_flag")
        log.append(run, checks.suite({
            "grain": (checks.grain_violations({k: (v, facts.GRAIN[k]) for k, v in f.items()}), F.col("dup_groups"), True),
            "duplicate_complaints": (f["customer_complaint"].filter(dup), F.lit(1), True),
            "unversioned_products": (f["customer_review"].filter("product_version_key is null"), F.lit(1), True),
            "reviews_in_window": (f["customer_review"].filter(F.col("review_datetime") >= F.lit(LATE["rv_reviews"][1]).cast("timestamp_ntz")), F.lit(1), False),
        }, f"run-{run}"))
    return log.history()


# ---- KPI views ---------------------------------------------------------------------------------
for _n in marts.VIEWS:
    add(f"kpi_{_n}", lambda w, n=_n: marts.kpi(w, n))

# ---- reconciliation ----------------------------------------------------------------------------
add("gsv_to_ncr_waterfall", rec.waterfall)
add("team_divergence", rec.team_divergence)
add("campaign_run_rate", rec.daily_run_rate)
add("decision_sensitivity", rec.decision_sensitivity)
add("funnel_by_phase", rec.funnel_by_phase)
add("ncr_by_phase_wide", lambda w: rec.by_phase(marts.kpi(w, "ncr"), ["channel"], "ncr"))
add("kpi_catalogue", rec.kpi_catalogue)
add("bus_matrix", rec.bus_matrix)

# ---- analyses ----------------------------------------------------------------------------------
for _f in [analyses.ring_scores, analyses.repeated_complaints, analyses.open_box_premium, analyses.open_box_resold, analyses.orders_beyond_stock,
           analyses.warehouse_picks_beyond_stock, analyses.stock_accuracy_by_week, analyses.stock_by_location, analyses.promotion_effect,
           analyses.cancelled_across_channels, analyses.repeat_purchase_by_cohort, analyses.pickup_volume_by_store, analyses.fulfilment_by_cohort,
           analyses.daily_traffic, analyses.complaint_trend]:
    add(_f.__name__, _f)
