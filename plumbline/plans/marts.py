"""KPI views. Every view carries its certainty; finance views also say whether they are confirmed.

A rate is published as numerator and denominator, so that it can still be added up.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import vocab
from plumbline.functions.exprs import bucket, has_code, with_one_row
from plumbline.operators.aggregates import group_flags
from plumbline.operators.joins import mark_within
from plumbline.plans.warehouse import Warehouse


@dataclass(frozen=True)
class View:
    group: str
    certainty: str
    facts: list[str]
    build: Callable[[Warehouse], DataFrame]
    keys: list[str]
    semi_additive: bool = False


VIEWS: dict[str, View] = {}


def view(name: str, group: str, certainty: str, facts: list[str], keys: list[str] = (), semi: bool = False):
    """Register a view under its certainty; the certainty columns are added in one place."""
    vocab.certainty_rank(certainty)

    def register(build):
        VIEWS[name] = View(group, certainty, facts, build, list(keys), semi)
        return build

    return register


def kpi(w: Warehouse, name: str) -> DataFrame:
    v = VIEWS[name]
    df = v.build(w)
    if v.group == "Finance":
        df = df.withColumn("is_confirmed_transaction", F.lit(v.certainty != "ESTIMATED"))
    return df.withColumn("metric_certainty_level", F.lit(v.certainty))


def union_views(w: Warehouse, names: list[str]) -> DataFrame:
    """Stack views; two different certainties in one column are refused."""
    kinds = {VIEWS[n].certainty for n in names}
    if len(kinds) > 1:
        raise ValueError(f"{names} mix certainty levels {sorted(kinds)}")
    out = kpi(w, names[0])
    for n in names[1:]:
        out = out.unionByName(kpi(w, n))
    return out


def publish(w: Warehouse, prefix: str = "vw_") -> list[str]:
    """Register every view for SQL users."""
    for n in VIEWS:
        kpi(w, n).createOrReplaceTempView(f"{prefix}{n}")
    return [f"{prefix}{n}" for n in VIEWS]


def with_phase(w: Warehouse, df: DataFrame, key: str = "date_key") -> DataFrame:
    """Add the campaign phase. The calendar is bounded by the project's years, so it is broadcast.

    No row is lost: one without a date is UNDATED, one outside the calendar OUT_OF_SCOPE.
    """
    days = w.dim("date").select(F.col("date_key").alias("__dk"), F.col("campaign_phase").alias("__phase"))
    phase = F.when(F.col(key).isNull(), "UNDATED").otherwise(F.coalesce("__phase", F.lit("OUT_OF_SCOPE")))
    joined = df.join(F.broadcast(days), F.col(key) == F.col("__dk"), "left")
    return joined.withColumn("campaign_phase", phase).drop("__dk", "__phase")


def channel_values(w: Warehouse, ec: str, store: str, name: str) -> DataFrame:
    """One amount of the online and the store fact, stacked by channel."""
    a = w.gold("ecommerce_order_line").select(
        F.lit("EC").alias("channel"), "date_key", F.col(ec).cast("decimal(18,4)").alias(name))
    b = w.gold("store_sale_line").select(
        F.lit("STORE").alias("channel"), "date_key", F.col(store).cast("decimal(18,4)").alias(name))
    return a.unionByName(b)


def money(c: Column) -> Column:
    return F.round(c, 2).cast("double")


EC, STORE = "ecommerce_order_line", "store_sale_line"


# ---- finance -----------------------------------------------------------------------------------
@view("gsv", "Finance", "CONFIRMED", [EC, STORE], ["channel", "campaign_phase"])
def gsv(w):
    v = with_phase(w, channel_values(w, "line_subtotal_excl_tax", "gross_amount", "v"))
    return v.groupBy("channel", "campaign_phase").agg(money(F.sum("v")).alias("gsv"))


@view("ncr", "Finance", "CONFIRMED", [EC, STORE], ["channel", "campaign_phase"])
def ncr(w):
    v = with_phase(w, channel_values(w, "confirmed_revenue_excl_tax", "net_amount", "v"))
    return v.groupBy("channel", "campaign_phase").agg(money(F.sum("v")).alias("ncr"))


@view("revenue_leakage", "Finance", "CONFIRMED", [EC, STORE, "return_line"], ["leakage_type"])
def revenue_leakage(w):
    cancelled = w.gold(EC).agg(
        F.sum(F.col("line_subtotal_excl_tax") - F.col("confirmed_revenue_excl_tax")).alias("v")
    ).select(F.lit("CANCELLATION").alias("leakage_type"), money(F.col("v")).alias("leakage_amount"))
    discount = w.gold(STORE).agg(F.sum("discount_amount").alias("v")).select(
        F.lit("STORE_DISCOUNT").alias("leakage_type"), money(F.col("v")).alias("leakage_amount"))
    refund = w.gold("return_line").agg(F.sum(F.coalesce("refund_amount", F.lit(0))).alias("v")).select(
        F.lit("RETURN_REFUND").alias("leakage_type"), money(F.col("v")).alias("leakage_amount"))
    return cancelled.unionByName(discount).unionByName(refund)


def _costed(w: Warehouse) -> DataFrame:
    """Revenue and cost per line by channel; the online line takes its cost from the catalogue."""
    store = w.gold(STORE).select(
        F.lit("STORE").alias("channel"), F.col("net_amount").cast("decimal(18,4)").alias("revenue"),
        F.col("cogs_amount").alias("cogs"))
    cost = w.source("pc_products").select(F.col("sku").alias("product_sku"), "cogs")
    lines = w.gold(EC).select("product_sku", "quantity", "confirmed_revenue_excl_tax")
    online = lines.join(cost, "product_sku", "left").select(
        F.lit("EC").alias("channel"),
        F.col("confirmed_revenue_excl_tax").cast("decimal(18,4)").alias("revenue"),
        (F.col("cogs") * F.col("quantity")).cast("decimal(18,2)").alias("cogs"))
    return store.unionByName(online)


def _margin(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sums over lines with a known cost; revenue without one is shown apart, never as margin."""
    known = F.col("cogs").isNotNull()
    return df.groupBy(*keys).agg(
        F.sum(F.when(known, F.col("revenue"))).alias("revenue"),
        F.sum(F.when(known, F.col("revenue") - F.col("cogs"))).alias("margin"),
        F.sum(F.when(~known, F.col("revenue"))).alias("uncosted"),
    )


@view("gross_margin_by_channel", "Finance", "CONFIRMED", [EC, STORE], ["channel"])
def gross_margin_by_channel(w):
    return _margin(_costed(w), ["channel"]).select(
        "channel", money(F.col("revenue")).alias("revenue_denominator"),
        money(F.col("margin")).alias("gross_margin_numerator"),
        money(F.col("uncosted")).alias("uncosted_revenue"))


@view("net_margin_after_fulfilment", "Finance", "CONFIRMED", [EC, STORE, "return_line"])
def net_margin_after_fulfilment(w):
    total = _margin(_costed(w), [])
    back = w.gold("return_line").agg(F.sum("refund_amount").alias("refunds"))
    return with_one_row(total, back).select(
        money(F.col("margin") - F.coalesce("refunds", F.lit(0))).alias("net_margin_numerator"),
        money(F.col("revenue")).alias("revenue_denominator"))


@view("confirmed_gmv", "Finance", "CONFIRMED", [EC, STORE], ["campaign_phase"])
def confirmed_gmv(w):
    v = with_phase(w, channel_values(w, "confirmed_revenue_excl_tax", "net_amount", "v"))
    return v.groupBy("campaign_phase").agg(money(F.sum("v")).alias("confirmed_gmv"))


@view("estimated_classified_gmv", "Finance", "ESTIMATED",
      ["classified_listing_event", "classified_listing_snapshot"])
def estimated_classified_gmv(w):
    """Weighted signals x asking price x listing confidence, relisted listings left out.

    Signals are counted per listing and kind before they meet the listing.
    """
    weight = F.coalesce(
        *[F.when(F.col("event_type_code") == k, F.lit(v).cast("decimal(3,2)"))
          for k, v in vocab.SIGNAL_WEIGHTS.items()],
        F.lit("0").cast("decimal(3,2)"),
    )
    signals = (
        w.gold("classified_listing_event")
        .filter(has_code("anomaly_reason_code", "ESTIMATED_NL_GMV"))
        .groupBy("listing_id", "event_type_code")
        .agg(F.count("*").alias("n"))
        .groupBy("listing_id")
        .agg(F.sum(weight * F.col("n")).cast("decimal(18,2)").alias("signal"))
    )
    value = w.gold("classified_listing_snapshot").filter(~F.col("excluded_from_gmv")).select(
        "listing_id", "asking_price")
    trust = w.listing_confidence().select(
        "listing_id", F.col("confidence_score").cast("decimal(8,6)").alias("confidence"))
    worth = (
        F.col("signal") * F.col("asking_price")
        * F.coalesce("confidence", F.lit("1").cast("decimal(8,6)"))
    )
    total = signals.join(value, "listing_id").join(trust, "listing_id", "left").agg(
        F.sum(worth).cast("double").alias("v"))
    low, high = (float(b) for b in vocab.GMV_BAND)
    return total.select(
        F.round("v", 2).alias("gmv_point"), F.round(F.col("v") * low, 2).alias("gmv_lower"),
        F.round(F.col("v") * high, 2).alias("gmv_upper"))


@view("campaign_incremental_revenue", "Finance", "CONFIRMED", [EC])
def campaign_incremental_revenue(w):
    """Campaign revenue less the baseline's daily revenue over as many calendar days."""
    def of(phase: str, c: str) -> Column:
        return F.sum(F.when(F.col("campaign_phase") == phase, F.col(c)))

    revenue = with_phase(w, w.gold(EC).select("date_key", "confirmed_revenue_excl_tax")).agg(
        of("CAMPAIGN", "confirmed_revenue_excl_tax").cast("double").alias("campaign"),
        of("BASELINE", "confirmed_revenue_excl_tax").cast("double").alias("baseline"))
    days = w.dim("date").withColumn("one", F.lit(1)).agg(
        of("CAMPAIGN", "one").alias("campaign_days"), of("BASELINE", "one").alias("baseline_days"))
    scaled = F.try_divide(F.col("baseline"), F.col("baseline_days").cast("double")) * F.col("campaign_days")
    return with_one_row(revenue, days).select(
        F.round("campaign", 2).alias("campaign_ncr"),
        F.round(scaled, 2).alias("baseline_normalised_ncr"),
        F.round(F.col("campaign") - scaled, 2).alias("incremental_revenue"))


# ---- inventory ---------------------------------------------------------------------------------
WH, SI = "warehouse_inventory_snapshot", "store_inventory_snapshot"


@view("atp_sku_loc_date", "Inventory", "CONFIRMED", [WH], ["sku", "location_id", "snapshot_date"], True)
def atp_sku_loc_date(w):
    return w.gold(WH).select("sku", F.col("warehouse_id").alias("location_id"), "snapshot_date", "atp_qty")


@view("stockout_rate", "Inventory", "CONFIRMED", [WH], ["snapshot_date"])
def stockout_rate(w):
    return w.gold(WH).groupBy("snapshot_date").agg(
        F.count_if(F.col("atp_qty") == 0).alias("stockout_numerator"),
        F.count("*").alias("sku_day_denominator"))


@view("oversell_count", "Inventory", "CONFIRMED", [WH], ["snapshot_date"])
def oversell_count(w):
    """Risky snapshots found and, of those, the ones still promising stock that is not there."""
    hit = has_code("anomaly_reason_code", "ATP_POSITIVE_PHYSICAL_ZERO")
    still = (F.col("atp_qty") > 0) & (F.col("physical_qty") == 0)
    return w.gold(WH).groupBy("snapshot_date").agg(
        F.count_if(hit).alias("oversell_risk_snapshots"),
        F.count_if(hit & still).alias("unresolved_snapshots"))


@view("inventory_accuracy_rate", "Inventory", "CONFIRMED", [SI])
def inventory_accuracy_rate(w):
    return w.gold(SI).agg(
        F.count_if(~F.col("anomaly_flag")).alias("accurate_numerator"),
        F.count("*").alias("snapshot_denominator"))


@view("return_to_restock_cycle_time", "Inventory", "CONFIRMED", ["return_line"])
def return_to_restock_cycle_time(w):
    """Average days from request to receipt, through the two roles of the calendar, of returns with both."""
    def role(name: str) -> DataFrame:
        return F.broadcast(w.dim("date").select(
            F.col("date_key").alias(f"{name}_key"), F.col("date_day").alias(f"{name}_day")))

    f = w.gold("return_line").join(
        role("request"), F.col("request_date_key") == F.col("request_key"), "left"
    ).join(role("receipt"), F.col("receipt_date_key") == F.col("receipt_key"), "left")
    days = F.date_diff(F.col("receipt_day"), F.col("request_day"))
    return f.agg(
        F.round(F.try_divide(F.sum(days).cast("double"), F.count(days).cast("double")), 2).alias("avg_cycle_days"),
        F.count(days).alias("restocked_returns"))


def open_box_resale(w: Warehouse, days: int = 30) -> DataFrame:
    """Open-box returns, and whether the same product was sold in store within the days after."""
    returned = w.gold("return_line").filter(F.col("restocked_as_condition") == "OPEN_BOX").select(
        "return_authorization_id", "product_sku", "receipt_date",
        F.col("receipt_date").cast("timestamp_ntz").alias("at"))
    sold = w.gold(STORE).select(
        F.col("product_code").alias("product_sku"), F.col("txn_date").cast("timestamp_ntz").alias("sold_at"))
    return mark_within(returned, sold, ["product_sku"], "at", "sold_at", days * 86400, "was_resold")


@view("open_box_conversion_rate", "Inventory", "INFERRED", ["return_line", STORE])
def open_box_conversion_rate(w):
    return open_box_resale(w).agg(
        F.count_if("was_resold").alias("converted_numerator"), F.count("*").alias("returns_denominator"))


# ---- online and store --------------------------------------------------------------------------
def _funnel(w: Warehouse) -> DataFrame:
    code = F.col("event_type_code")
    return group_flags(w.gold("web_page_event"), ["session_id"], {
        "has_cart": code.isin(vocab.CART_EVENTS),
        "has_checkout": code.isin(vocab.CHECKOUT_EVENTS),
        "has_purchase": code.isin(vocab.PURCHASE_EVENTS),
    })


@view("cart_abandonment_rate", "Ecommerce and store", "CONFIRMED", ["web_page_event"])
def cart_abandonment_rate(w):
    return _funnel(w).agg(
        F.count_if(F.col("has_cart") & ~F.col("has_purchase")).alias("abandoned_numerator"),
        F.count_if("has_cart").alias("cart_sessions_denominator"))


@view("checkout_conversion_rate", "Ecommerce and store", "CONFIRMED", ["web_page_event"])
def checkout_conversion_rate(w):
    return _funnel(w).agg(
        F.count_if("has_purchase").alias("purchase_numerator"),
        F.count_if("has_checkout").alias("checkout_init_denominator"))


@view("browse_online_buy_in_store_rate", "Ecommerce and store", "INFERRED",
      ["web_page_event", "web_session", STORE])
def browse_online_buy_in_store_rate(w, hours: int = 48):
    """Customer and product pairs viewed online, and those bought in a store within the hours after."""
    who = w.gold("web_session").filter("registered_customer_id is not null").select(
        "session_id", F.col("registered_customer_id").alias("customer_id"))
    seen = (
        w.gold("web_page_event").filter("product_sku is not null")
        .select("session_id", F.col("product_sku").alias("product_code"), F.col("event_timestamp").cast("date").alias("d")).distinct()
        .join(who, "session_id").select("customer_id", "product_code", "d").distinct()
        .withColumn("at", F.col("d").cast("timestamp_ntz"))
    )
    bought = w.gold(STORE).filter("customer_id is not null").select(
        "customer_id", "product_code", F.col("txn_date").cast("timestamp_ntz").alias("bought_at"))
    pair = ["customer_id", "product_code"]  # the natural keys: what is moved is short
    marked = mark_within(seen, bought, pair, "at", "bought_at", hours * 3600, "bought")
    return marked.groupBy(*pair).agg(F.bool_or("bought").alias("bought")).agg(
        F.count_if("bought").alias("browse_buy_numerator"), F.count("*").alias("browse_denominator"))


@view("browse_online_contact_classifieds_rate", "Ecommerce and store", "INFERRED",
      ["web_page_event", "web_session", "classified_listing_event"])
def browse_online_contact_classifieds_rate(w, hours: int = 24):
    """Product-view sessions, and those whose customer contacted a listing within the hours after."""
    viewed = w.gold("web_page_event").filter("product_key is not null").select("session_id").distinct()
    sessions = w.gold("web_session").join(viewed, "session_id", "left_semi").select(
        "session_id", F.col("registered_customer_id").alias("user_ref"), "session_end_ts")
    contacts = w.gold("classified_listing_event").filter(
        F.col("event_type_code").isin(vocab.CONTACT_EVENTS)
    ).select("user_ref", F.col("event_timestamp").alias("contact_at"))
    marked = mark_within(
        sessions, contacts, ["user_ref"], "session_end_ts", "contact_at", hours * 3600, "followed")
    return marked.agg(
        F.count_if("followed").alias("contact_followup_numerator"),
        F.count("*").alias("product_view_sessions_denominator"))


@view("bopis_pickup_readiness_time", "Ecommerce and store", "CONFIRMED", ["order_fulfilment"])
def bopis_pickup_readiness_time(w):
    h = F.col("placed_to_captured_hours")
    return w.gold("order_fulfilment").filter((F.col("delivery_method_code") == "BOPIS") & h.isNotNull()).agg(
        F.round(F.sum(h) / F.count("*"), 2).alias("avg_readiness_hours"),
        F.count("*").alias("bopis_orders"))


@view("boris_count", "Ecommerce and store", "CONFIRMED", ["return_line"])
def boris_count(w):
    return w.gold("return_line").agg(F.count_if("is_boris_return").alias("boris_returns"))


@view("on_time_delivery_rate", "Ecommerce and store", "CONFIRMED", ["order_fulfilment"])
def on_time_delivery_rate(w):
    return w.gold("order_fulfilment").agg(
        F.count_if(F.col("total_lifecycle_hours") <= vocab.ON_TIME_HOURS).alias("on_time_numerator"),
        F.count_if(F.col("delivered_date_key").isNotNull()).alias("delivered_denominator"))


@view("payment_failure_rate", "Ecommerce and store", "CONFIRMED", ["order_fulfilment"])
def payment_failure_rate(w):
    return w.gold("order_fulfilment").agg(
        F.count_if(F.col("captured_date_key").isNull()).alias("failed_numerator"),
        F.count("*").alias("attempts_denominator"))


# ---- classifieds and sellers -------------------------------------------------------------------
LS, LE = "classified_listing_snapshot", "classified_listing_event"


@view("active_listing_count", "Classifieds and sellers", "CONFIRMED", [LS])
def active_listing_count(w):
    return w.gold(LS).agg(F.count_if(F.col("status_code") == "ACTIVE").alias("active_listings"))


@view("listing_contact_rate", "Classifieds and sellers", "CONFIRMED", [LE, LS])
def listing_contact_rate(w):
    contact = F.col("event_type_code").isin([*vocab.CONTACT_EVENTS, "OFFER_MADE"])
    a = w.gold(LE).agg(F.count_if(contact).alias("contact_numerator"))
    b = w.gold(LS).agg(F.count_if(F.col("status_code") == "ACTIVE").alias("active_listing_denominator"))
    return with_one_row(a, b)


@view("relisting_rate", "Classifieds and sellers", "CONFIRMED", [LS])
def relisting_rate(w):
    again = (F.coalesce("relist_count", F.lit(0)) > 0) | has_code("anomaly_reason_code", "RELISTED_AFTER_SOLD")
    return w.gold(LS).agg(
        F.count_if(again).alias("relisted_numerator"), F.count("*").alias("listing_denominator"))


@view("duplicate_listing_inflation_factor", "Classifieds and sellers", "CONFIRMED", [LS])
def duplicate_listing_inflation_factor(w):
    dup = has_code("anomaly_reason_code", "RELISTED_AFTER_SOLD") | has_code("anomaly_reason_code", "IMAGE_HASH_REUSED")
    return w.gold(LS).agg(
        F.count("*").alias("total_listings"), F.count_if(~dup).alias("deduplicated_listings"))


@view("seller_risk_score_distribution", "Classifieds and sellers", "CONFIRMED", ["dim_seller"], ["risk_band"])
def seller_risk_score_distribution(w):
    """Sellers per risk band; the band is on risk, the opposite of the trust score."""
    band = bucket(F.col("seller_risk_score"), [(0.65, "HIGH"), (0.40, "MEDIUM")], "LOW")
    return w.dim("seller").filter("seller_risk_score is not null").groupBy(band.alias("risk_band")).agg(
        F.count("*").alias("seller_count"))


@view("validated_report_rate", "Classifieds and sellers", "INFERRED", [LS])
def validated_report_rate(w):
    return w.gold(LS).agg(
        F.count_if(has_code("anomaly_reason_code", "IMAGE_HASH_REUSED")).alias("corroborated_numerator"),
        F.count_if("anomaly_flag").alias("flagged_denominator"))


def semi_additive_offenders() -> list[str]:
    """Registered views that publish a stock measure without its date among their keys."""
    return [n for n, v in VIEWS.items() if v.semi_additive and "snapshot_date" not in v.keys]
