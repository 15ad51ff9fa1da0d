"""Further analyses over the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline import vocab
from plumbline.functions.exprs import has_code
from plumbline.operators.aggregates import aggregate
from plumbline.operators.aggregates import grouped_median
from plumbline.operators.joins import mark_exists, mark_within
from plumbline.plans.marts import EC, SI, STORE, WH, open_box_resale, with_phase
from plumbline.plans.warehouse import Warehouse


def ring_scores(w: Warehouse) -> DataFrame:
    """Fraud-ring score per classified account: shared pictures, account opened in bulk, phone
    numbers revealed, prices far below the category's median."""
    listings = w.resolved("nl_listings")
    usual = grouped_median(listings, "category_code", F.col("asking_price").cast("double"), "usual")
    reveals = w.silver("nl_listing_events").filter(F.col("event_type_code") == "PHN_REVEAL").groupBy(
        "listing_id").agg(F.count("*").alias("reveals"))
    per = (
        listings.join(usual, "category_code").join(reveals, "listing_id", "left")
        .groupBy("seller_account_id")
        .agg(
            F.count("*").alias("listings"),
            F.count_if("fraud_ring_flag").alias("shared"),
            F.sum(F.coalesce("reveals", F.lit(0))).alias("phone_reveals"),
            F.count_if(F.col("asking_price").cast("double") < F.col("usual") * 0.8).alias("cheap"),
        )
    )
    accounts = w.silver("nl_user_accounts").select(
        F.col("account_id").alias("seller_account_id"), F.col("created_at").cast("date").alias("opened_on"))
    bulk = accounts.groupBy("opened_on").agg(F.count("*").alias("opened_that_day"))
    joined = per.join(accounts.join(bulk, "opened_on"), "seller_account_id")
    n = F.col("listings").cast("double")
    score = (
        F.lit(0.5) * F.col("shared") / n + F.lit(0.2) * (F.col("opened_that_day") >= 3).cast("int")
        + F.lit(0.2) * F.least(F.lit(1.0), F.col("phone_reveals") / n) + F.lit(0.1) * F.col("cheap") / n
    )
    return joined.select(
        "seller_account_id", "listings", "shared", "phone_reveals", "cheap", "opened_that_day",
        F.round(score, 6).alias("ring_score"))


def repeated_complaints(w: Warehouse, hours: int = 48) -> DataFrame:
    """Cases whose customer made the same complaint within the hours before, whatever the channel."""
    cases = w.silver("cs_cases").select(
        "case_id", "customer_ref", "text_hash", F.col("created_datetime").alias("at"))
    marked = mark_within(
        cases, cases.select("customer_ref", "text_hash", F.col("at").alias("before_at")),
        ["customer_ref", "text_hash"], "at", "before_at", hours * 3600, "repeats",
        after=False, strict=True,
    )
    return marked.select("case_id", "customer_ref", "repeats")


def open_box_premium(w: Warehouse) -> DataFrame:
    """What customers would have overpaid for opened items sold as new, per category."""
    hit = w.resolved("rr_return_receipts").filter(has_code("anomaly_reason_code", "OPEN_BOX_AS_NEW"))
    price = w.source("pc_products").select(F.col("sku").alias("product_sku"), "category", "list_price")
    discount = F.lit("0.15").cast("decimal(3,2)")
    return hit.groupBy("product_sku").agg(F.count("*").alias("n"), F.sum("restocked_qty").alias("units")).join(
        price, "product_sku").groupBy("category").agg(
        F.sum("n").alias("mislabelled_returns"), F.sum("units").alias("units"),
        F.sum(F.col("units") * F.col("list_price") * discount).cast("double").alias("price_premium"))


def open_box_resold(w: Warehouse) -> DataFrame:
    """Open-box units by month of receipt, and how many were resold within 30 days."""
    return open_box_resale(w).groupBy(F.trunc("receipt_date", "month").alias("month")).agg(
        F.count("*").alias("open_box_returns"), F.count_if("was_resold").alias("resold_30d"))


def orders_beyond_stock(w: Warehouse) -> DataFrame:
    """Store sale lines for more units than the day's sellable stock of that store and product."""
    stock = w.gold(SI).select(
        "store_key", "product_key", F.col("snapshot_date").alias("txn_date"), "sellable_qty")
    sold = w.gold(STORE).groupBy("store_key", "product_key", "txn_date").agg(
        F.sum("quantity").alias("units"), F.count("*").alias("lines"))
    return sold.join(stock, ["store_key", "product_key", "txn_date"]).agg(
        F.count("*").alias("store_product_days"),
        F.count_if(F.col("units") > F.col("sellable_qty")).alias("short_days"),
        F.coalesce(F.sum(F.when(F.col("units") > F.col("sellable_qty"), F.col("lines"))), F.lit(0)).alias("short_lines"))


def warehouse_picks_beyond_stock(w: Warehouse) -> DataFrame:
    """Warehouse, SKU and day with more units picked than promised, by warehouse."""
    picks = w.gold("inventory_transaction").filter(
        (F.col("node_type") == "WAREHOUSE") & (F.col("quantity_delta") < 0)
    ).groupBy(F.col("node_id").alias("warehouse_id"), F.col("product_code").alias("sku"),
              F.col("mdate").alias("snapshot_date")).agg((-F.sum("quantity_delta")).alias("picked"))
    return picks.join(w.gold(WH), ["warehouse_id", "sku", "snapshot_date"]).groupBy("warehouse_id").agg(
        F.count("*").alias("pick_days"), F.count_if(F.col("picked") > F.col("atp_qty")).alias("short_days"))


def stock_accuracy_by_week(w: Warehouse) -> DataFrame:
    return w.gold(SI).groupBy(F.trunc("snapshot_date", "week").alias("week"), "store_id").agg(
        F.count_if(~F.col("anomaly_flag")).alias("accurate_numerator"),
        F.count("*").alias("snapshot_denominator"))


def stock_by_location(w: Warehouse) -> DataFrame:
    """Stock per location on each date; never added over dates."""
    return aggregate(w.gold(SI), ["store_id", "snapshot_date"], ["physical_qty", "sellable_qty"])


def promotion_effect(w: Warehouse) -> DataFrame:
    """Confirmed revenue by attribution rule and phase."""
    f = with_phase(w, w.gold(EC))
    return f.groupBy(F.coalesce("attribution_rule", F.lit("ORGANIC")).alias("rule"), "campaign_phase").agg(
        F.count("*").alias("order_lines"),
        F.sum("confirmed_revenue_excl_tax").cast("double").alias("confirmed_revenue"))


def cancelled_across_channels(w: Warehouse) -> DataFrame:
    """Cancelled value still carried, online and in stores."""
    cancelled = (F.col("status") == "CANCELLED") & (F.col("amount") > 0)
    a = w.gold(EC).select(F.lit("EC").alias("channel"), F.col("order_status").alias("status"),
                          F.col("line_subtotal_excl_tax").cast("decimal(18,4)").alias("amount"))
    b = w.gold(STORE).select(F.lit("STORE").alias("channel"), F.col("receipt_status").alias("status"),
                             F.col("net_amount").cast("decimal(18,4)").alias("amount"))
    return a.unionByName(b).groupBy("channel").agg(
        F.count_if(cancelled).alias("cancelled_lines"),
        F.sum(F.when(cancelled, F.col("amount"))).cast("double").alias("cancelled_amount"),
        F.sum("amount").cast("double").alias("total_amount"))


def repeat_purchase_by_cohort(w: Warehouse) -> DataFrame:
    """Customers by the month of their first order, and those who ordered again."""
    per = w.gold("order_fulfilment").filter("customer_key is not null").groupBy("customer_key").agg(
        F.trunc(F.min("order_date"), "month").alias("cohort"), F.count("*").alias("orders"))
    return per.groupBy("cohort").agg(
        F.count("*").alias("customers"), F.count_if(F.col("orders") > 1).alias("repeat_customers"))


def pickup_volume_by_store(w: Warehouse) -> DataFrame:
    store = w.dim("store").select("store_key", "store_id")
    f = w.gold(EC).filter("store_key is not null").groupBy("store_key").agg(
        F.count("*").alias("order_lines"), F.countDistinct("order_id").alias("orders"))
    return f.join(store, "store_key").select("store_id", "orders", "order_lines")


def fulfilment_by_cohort(w: Warehouse) -> DataFrame:
    """On-time deliveries by the cohort of the customer's first order.

    The cohort is reduced to one row per customer and joined back, so a busy customer is never
    gathered into one task.
    """
    f = w.gold("order_fulfilment").filter("customer_key is not null")
    cohort = f.groupBy("customer_key").agg(F.trunc(F.min("order_date"), "month").alias("cohort"))
    return f.select("customer_key", "total_lifecycle_hours").join(cohort, "customer_key").groupBy("cohort").agg(
        F.count_if(F.col("total_lifecycle_hours").isNotNull()).alias("delivered"),
        F.count_if(F.col("total_lifecycle_hours") <= vocab.ON_TIME_HOURS).alias("on_time"))


def daily_traffic(w: Warehouse) -> DataFrame:
    """Sessions per day and how many converted."""
    done = w.gold("web_page_event").filter("is_conversion_event").select("session_id")
    s = mark_exists(w.gold("web_session"), done, {"session_id": "session_id"}, "converted")
    return s.groupBy(F.col("session_start_ts").cast("date").alias("day")).agg(
        F.count("*").alias("sessions"), F.count_if("converted").alias("converted_sessions"))


def complaint_trend(w: Warehouse) -> DataFrame:
    """Cases and distinct incidents per week and channel."""
    c = w.gold("customer_complaint")
    channel = w.dim("channel").select("channel_key", "channel_code")
    return c.groupBy(F.trunc("created_datetime", "week").alias("week"), "channel_key").agg(
        F.count("*").alias("cases"), F.countDistinct("canonical_case_key").alias("incidents")
    ).join(F.broadcast(channel), "channel_key", "left").select(
        "week", F.coalesce("channel_code", F.lit("UNKNOWN")).alias("channel_code"), "cases", "incidents")
