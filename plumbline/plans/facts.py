"""Facts at a declared grain, built from resolved tables so that flags travel with the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import vocab
from plumbline.functions.dates import hours_between
from plumbline.functions.exprs import first_column, holds
from plumbline.functions.keys import date_key, optional_key, pack, surrogate_key, unpack
from plumbline.operators.aggregates import non_additive, semi_additive
from plumbline.operators.commerce import attribution_rule
from plumbline.operators.history import version_at
from plumbline.operators.joins import mark_exists
from plumbline.operators.quality import QUALITY, Rule, add_anomaly_columns, flag, union_all

# declared grain of every fact
GRAIN = {
    "ecommerce_order_line": ["order_id", "line_id"],
    "order_fulfilment": ["order_id"],
    "store_inventory_snapshot": ["store_id", "product_code", "snapshot_date"],
    "warehouse_inventory_snapshot": ["warehouse_id", "sku", "snapshot_date"],
    "inventory_transaction": ["movement_id", "node_type"],
    "web_session": ["session_id"],
    "web_page_event": ["session_id", "event_id"],
    "classified_listing_snapshot": ["listing_id"],
    "classified_listing_event": ["listing_id", "event_id"],
    "customer_review": ["review_id"],
    "customer_complaint": ["case_id"],
    "store_sale_line": ["receipt_no", "line_no"],
    "return_line": ["return_authorization_id", "line_no"],
    "seller_performance_snapshot": ["seller_id", "week_end"],
}

# facts with a day on which a product or customer version is valid: day, product, customer
VERSIONED = {
    "ecommerce_order_line": ("order_date", "product_sku", "customer_id"),
    "order_fulfilment": ("order_date", None, "customer_id"),
    "store_inventory_snapshot": ("snapshot_date", "product_code", None),
    "warehouse_inventory_snapshot": ("snapshot_date", "sku", None),
    "inventory_transaction": ("mdate", "product_code", None),
    "web_session": ("session_start_ts", None, "registered_customer_id"),
    "web_page_event": ("event_timestamp", "product_sku", None),
    "customer_review": ("review_datetime", "product_sku", "customer_id"),
    "customer_complaint": ("created_datetime", None, "customer_ref"),
    "store_sale_line": ("txn_date", "product_code", "customer_id"),
    "return_line": ("request_date", "product_sku", "customer_id"),
}

VERSION_KEYS = ["product_version_key", "customer_version_key"]

# keys of versioned facts that follow from columns they keep; long hashes, so they are taken behind the version joins
DERIVED = {
    "ecommerce_order_line": lambda: {
        "date_key": date_key("order_date"), "product_key": surrogate_key("product_sku"), "customer_key": optional_key("customer_id")},
    "order_fulfilment": lambda: {"placed_date_key": date_key("order_date"), "customer_key": optional_key("customer_id")},
    "store_inventory_snapshot": lambda: {
        "date_key": date_key("snapshot_date"), "product_key": surrogate_key("product_code"), "store_key": surrogate_key("store_id")},
    "warehouse_inventory_snapshot": lambda: {
        "date_key": date_key("snapshot_date"), "product_key": surrogate_key("sku"), "warehouse_key": surrogate_key("warehouse_id")},
    "inventory_transaction": lambda: {
        "date_key": date_key("mdate"), "product_key": surrogate_key("product_code"), "node_key": surrogate_key("node_type", "node_id")},
    "web_session": lambda: {
        "date_key": date_key("session_start_ts"), "customer_key": optional_key("registered_customer_id"),
        "promotion_key": optional_key("utm_campaign")},
    "web_page_event": lambda: {
        "date_key": date_key("event_timestamp"), "product_key": optional_key("product_sku"), "step_key": optional_key("step_id")},
    "customer_review": lambda: {
        "date_key": date_key("review_datetime"), "product_key": optional_key("product_sku"), "customer_key": optional_key("customer_id")},
    "customer_complaint": lambda: {"date_key": date_key("created_datetime"), "customer_key": optional_key("customer_ref")},
    "store_sale_line": lambda: {
        "date_key": date_key("txn_date"), "product_key": surrogate_key("product_code"), "customer_key": optional_key("customer_id")},
    "return_line": lambda: {
        "request_date_key": date_key("request_date"), "receipt_date_key": date_key("receipt_date"),
        "product_key": surrogate_key("product_sku"), "customer_key": optional_key("customer_id"),
        "return_reason_key": optional_key("reason_code"), "channel_key": surrogate_key("channel_code")},
}

# declared links: fact, foreign key, dimension, its key
LINKS = [
    ("ecommerce_order_line", "date_key", "date", "date_key"),
    ("ecommerce_order_line", "product_key", "product", "product_key"),
    ("ecommerce_order_line", "customer_key", "customer", "customer_key"),
    ("ecommerce_order_line", "channel_key", "channel", "channel_key"),
    ("ecommerce_order_line", "delivery_method_key", "delivery_method", "delivery_method_key"),
    ("ecommerce_order_line", "promotion_key", "promotion", "promotion_key"),
    ("ecommerce_order_line", "store_key", "store", "store_key"),
    ("order_fulfilment", "placed_date_key", "date", "date_key"),
    ("order_fulfilment", "captured_date_key", "date", "date_key"),
    ("order_fulfilment", "shipped_date_key", "date", "date_key"),
    ("order_fulfilment", "delivered_date_key", "date", "date_key"),
    ("order_fulfilment", "returned_date_key", "date", "date_key"),
    ("order_fulfilment", "customer_key", "customer", "customer_key"),
    ("store_inventory_snapshot", "date_key", "date", "date_key"),
    ("store_inventory_snapshot", "product_key", "product", "product_key"),
    ("store_inventory_snapshot", "store_key", "store", "store_key"),
    ("warehouse_inventory_snapshot", "date_key", "date", "date_key"),
    ("warehouse_inventory_snapshot", "product_key", "product", "product_key"),
    ("inventory_transaction", "date_key", "date", "date_key"),
    ("inventory_transaction", "product_key", "product", "product_key"),
    ("web_session", "date_key", "date", "date_key"),
    ("web_session", "customer_key", "customer", "customer_key"),
    ("web_session", "promotion_key", "promotion", "promotion_key"),
    ("web_page_event", "date_key", "date", "date_key"),
    ("web_page_event", "product_key", "product", "product_key"),
    ("web_page_event", "step_key", "step", "step_key"),
    ("classified_listing_snapshot", "date_key", "date", "date_key"),
    ("classified_listing_snapshot", "seller_key", "seller", "seller_key"),
    ("classified_listing_event", "date_key", "date", "date_key"),
    ("customer_review", "date_key", "date", "date_key"),
    ("customer_review", "product_key", "product", "product_key"),
    ("customer_review", "customer_key", "customer", "customer_key"),
    ("customer_complaint", "date_key", "date", "date_key"),
    ("customer_complaint", "customer_key", "customer", "customer_key"),
    ("customer_complaint", "channel_key", "channel", "channel_key"),
    ("store_sale_line", "date_key", "date", "date_key"),
    ("store_sale_line", "product_key", "product", "product_key"),
    ("store_sale_line", "store_key", "store", "store_key"),
    ("store_sale_line", "customer_key", "customer", "customer_key"),
    ("store_sale_line", "payment_method_key", "payment_method", "payment_method_key"),
    ("store_sale_line", "channel_key", "channel", "channel_key"),
    ("store_sale_line", "promotion_key", "promotion", "promotion_key"),
    ("return_line", "request_date_key", "date", "date_key"),
    ("return_line", "receipt_date_key", "date", "date_key"),
    ("return_line", "store_key", "store", "store_key"),
    ("return_line", "return_reason_key", "return_reason", "return_reason_key"),
    ("return_line", "listing_condition_key", "listing_condition", "listing_condition_key"),
    ("return_line", "product_key", "product", "product_key"),
    ("return_line", "customer_key", "customer", "customer_key"),
    ("seller_performance_snapshot", "date_key", "date", "date_key"),
    ("seller_performance_snapshot", "seller_key", "seller", "seller_key"),
    ("seller_performance_snapshot", "seller_risk_tier_key", "seller_risk_tier", "seller_risk_tier_key"),
]


def carried(prefix: str = "__") -> list[Column]:
    """Quality columns of a joined parent, clean where the parent is missing."""
    return [
        F.coalesce(F.col(f"{prefix}anomaly_flag"), F.lit(False)).alias("anomaly_flag"),
        F.col(f"{prefix}anomaly_reason_code").alias("anomaly_reason_code"),
        F.coalesce(F.col(f"{prefix}data_quality_status"), F.lit("CLEAN")).alias("data_quality_status"),
        F.coalesce(F.col(f"{prefix}metric_certainty_level"), F.lit("CONFIRMED")).alias(
            "metric_certainty_level"
        ),
    ]


def with_versions(
    t: str, df: DataFrame, dims: dict[str, DataFrame], last_day: str, step: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """The fact with the version of its product and customer that was valid on its day. dims: product, customer.
    step: applied to the rows before each join."""
    if t not in VERSIONED:
        return df
    day, product, customer = VERSIONED[t]
    columns, derived = df.columns, {c: key for c, key in DERIVED[t]().items() if c in df.columns}
    # what tells rows apart reaches the joins as one number
    texts = [c for c in GRAIN[t] if c not in VERSIONED[t]]
    df = pack(df.drop(*derived).withColumn("__row", F.xxhash64(*GRAIN[t])), *texts)
    for of, natural, name in (("product", product, "product_version_key"), ("customer", customer, "customer_version_key")):
        if natural:
            key = {"product": "sku", "customer": "customer_id"}[of]
            # the version's number stands for its key until all joins are done
            numbered = dims[of].select(key, "valid_from", "valid_to", F.col("version_number").alias("version_key"))
            df = version_at(step(df), numbered, natural, key, F.col(day), name, last_day, ["__row"])
            derived[name] = F.when(F.col(name).isNotNull(), surrogate_key(natural, name))
    return unpack(df, *texts).withColumns(derived).select(*columns, *[c for c in derived if c not in columns])


def ecommerce_order_line(
    lines: DataFrame, orders: DataFrame, eligible: DataFrame | None = None, window: tuple[str, str] | None = None
) -> DataFrame:
    """One row per online order line: gross, confirmed revenue, attribution. eligible: products (sku) whose pickup
    in the campaign window counts for it; without products and window no pickup does."""
    if eligible is None or window is None:
        lines, window = lines.withColumn("__eligible", F.lit(False)), (None, None)
    else:
        lines = mark_exists(lines, eligible, {"product_sku": "sku"}, "__eligible", ["order_id"])
    head = orders.select(
        "order_id", "order_date", "customer_id", "delivery_method_code", "pickup_store_id",
        "promo_code_applied", "order_status", "attribution_confidence",
        *[F.col(c).alias(f"__{c}") for c in QUALITY],
    )
    method = F.col("delivery_method_code")
    bridged = F.col("attribution_confidence").isNotNull()
    cancelled = F.col("order_status") == "CANCELLED"
    gross = F.col("line_total_excl_tax")
    first, last = (F.lit(d).cast("date") for d in window)
    picked_up = F.col("pickup_store_id").isNotNull() & F.col("order_date").between(first, last) & F.col("__eligible")
    f = unpack(pack(lines.drop(*QUALITY), "line_id").join(head, "order_id", "left"), "line_id").select(
        "order_id", "line_id", "order_date",
        date_key("order_date").alias("date_key"),
        surrogate_key("product_sku").alias("product_key"),
        optional_key("customer_id").alias("customer_key"),
        surrogate_key(F.when(method == "BOPIS", "BOPIS").otherwise("EC")).alias("channel_key"),
        optional_key(method).alias("delivery_method_key"),
        optional_key("promo_code_applied").alias("promotion_key"),
        optional_key("pickup_store_id").alias("store_key"),
        "product_sku", "customer_id", "order_status", "quantity",
        gross.alias("line_subtotal_excl_tax"),
        F.when(cancelled, F.lit(0).cast("decimal(12,2)")).otherwise(gross).alias(
            "confirmed_revenue_excl_tax"),
        (~holds(cancelled)).alias("is_confirmed_revenue"),
        F.col("discount_applied").alias("discount_amount"),
        "unit_price_excl_tax",
        bridged.alias("is_campaign_attributed"),
        attribution_rule(F.col("promo_code_applied"), bridged, picked_up).alias("attribution_rule"),
        *carried(),
    )
    f = flag(f, [Rule("ORPHAN_FK", F.col("order_status").isNull())])
    return non_additive(f, ["unit_price_excl_tax"])


def order_fulfilment(
    orders: DataFrame, payments: DataFrame, shipments: DataFrame, events: DataFrame, returns: DataFrame
) -> DataFrame:
    """One row per order with its five milestones; a milestone not reached has no date.

    The milestones of each source are reduced to one row per order, so that every join keeps the orders' rows and a
    query that reads few milestones meets only their sources. All joins share the key, so the orders move once.
    """
    paid = payments.groupBy(F.col("order_ref").alias("order_number")).agg(F.min("captured_ts").alias("captured_ts"))
    at = F.coalesce("corrected_event_datetime", "event_timestamp")

    def first(code: str) -> Column:
        return F.min(F.when(F.col("event_type_code") == code, at))

    drift = F.array_contains(F.split("anomaly_reason_code", ","), "DELIVERY_BEFORE_SHIP")
    moved = (
        events.groupBy("shipment_id")
        .agg(first("PICKED_UP").alias("picked"), first("DELIVERED").alias("delivered"), F.bool_or(drift).alias("drift"))
        .join(shipments.select("shipment_id", F.col("order_reference").alias("order_number")), "shipment_id")
        .groupBy("order_number")
        .agg(F.min("picked").alias("picked_ts"), F.min("delivered").alias("delivered_ts"), F.bool_or("drift").alias("drift"))
    )
    sent_back = returns.groupBy(F.col("original_order_ref").alias("order_number")).agg(
        F.min(F.col("return_request_date").cast("timestamp_ntz")).alias("returned_ts"))
    met = orders
    for miles in (paid, moved, sent_back):
        met = met.join(miles, "order_number", "left")
    placed = F.col("order_date").cast("timestamp_ntz")
    f = met.select(
        "order_id", "order_number", "order_date",
        optional_key("customer_id").alias("customer_key"), "customer_id", "order_status",
        "delivery_method_code",
        date_key("order_date").alias("placed_date_key"),
        date_key("captured_ts").alias("captured_date_key"),
        date_key("picked_ts").alias("shipped_date_key"),
        date_key("delivered_ts").alias("delivered_date_key"),
        date_key("returned_ts").alias("returned_date_key"),
        hours_between(placed, F.col("captured_ts")).alias("placed_to_captured_hours"),
        hours_between("picked_ts", "delivered_ts").alias("picked_to_delivered_hours"),
        hours_between(placed, F.col("delivered_ts")).alias("total_lifecycle_hours"),
        *QUALITY, "drift",
    )
    return flag(f, [Rule("DELIVERY_BEFORE_SHIP", F.col("drift"))]).drop("drift")


def store_inventory_snapshot(counted: DataFrame, reconstructed: DataFrame) -> DataFrame:
    """One row per store, product and day: counted days and reconstructed ones."""
    cols = ["store_id", "product_code", "snapshot_date", "physical_qty", "sellable_qty"]
    clean = counted.select(
        *cols, "reserved_qty", "damaged_qty", F.lit(False).alias("is_reconstructed"), *QUALITY
    )
    filled = reconstructed.select(*cols, F.lit(True).alias("is_reconstructed"), *QUALITY)
    both = clean.unionByName(filled, allowMissingColumns=True).withColumns({
        "date_key": date_key("snapshot_date"),
        "product_key": surrogate_key("product_code"),
        "store_key": surrogate_key("store_id"),
    })
    return semi_additive(
        both, ["physical_qty", "sellable_qty", "reserved_qty", "damaged_qty"], "snapshot_date"
    )


def warehouse_inventory_snapshot(snapshots: DataFrame) -> DataFrame:
    f = snapshots.select(
        "warehouse_id", "sku", "snapshot_date",
        date_key("snapshot_date").alias("date_key"),
        surrogate_key("sku").alias("product_key"),
        surrogate_key("warehouse_id").alias("warehouse_key"),
        "physical_qty", "atp_qty", *QUALITY,
    )
    return semi_additive(f, ["physical_qty", "atp_qty"], "snapshot_date")


def inventory_transaction(store: DataFrame, warehouse: DataFrame) -> DataFrame:
    """One row per movement and node type, with a signed quantity."""
    si = store.select(
        "movement_id", F.lit("STORE").alias("node_type"), F.col("store_id").alias("node_id"),
        "product_code", "movement_type", F.col("quantity_change").alias("quantity_delta"),
        "reference_number", F.col("movement_date").alias("mdate"), *QUALITY,
    )
    wh = warehouse.select(
        "movement_id", F.lit("WAREHOUSE").alias("node_type"), F.col("warehouse_id").alias("node_id"),
        F.col("sku").alias("product_code"), "movement_type",
        F.col("quantity_change").alias("quantity_delta"), "reference_number",
        F.col("movement_datetime").cast("date").alias("mdate"), *QUALITY,
    )
    return si.unionByName(wh).withColumns({
        "date_key": date_key("mdate"),
        "product_key": surrogate_key("product_code"),
        "node_key": surrogate_key("node_type", "node_id"),
    })


def web_session(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id",
        date_key("session_start_ts").alias("date_key"),
        optional_key("registered_customer_id").alias("customer_key"),
        optional_key("utm_campaign").alias("promotion_key"),
        "registered_customer_id", "utm_campaign", "device_type", "channel_source",
        "session_start_ts", "session_end_ts",
        F.timestamp_diff("SECOND", F.col("session_start_ts"), F.col("session_end_ts")).alias(
            "session_duration_seconds"),
        F.col("total_pageviews").alias("page_count"), F.col("total_events").alias("event_count"),
        *QUALITY,
    )


def web_page_event(events: DataFrame) -> DataFrame:
    return events.select(
        "session_id", "event_id", "event_timestamp",
        date_key("event_timestamp").alias("date_key"),
        optional_key("product_sku").alias("product_key"),
        optional_key("step_id").alias("step_key"),
        "event_type_code", first_column(events, ["page_category"], "string").alias("page_category"),
        "product_sku", first_column(events, ["search_query"], "string").alias("search_query"),
        "step_id", F.col("time_on_page_secs").alias("time_on_page_seconds"), "cart_value",
        "is_conversion_event", *QUALITY,
    )


def classified_listing_snapshot(listings: DataFrame) -> DataFrame:
    f = listings.select(
        "listing_id", "listing_ref",
        date_key("created_at").alias("date_key"),
        surrogate_key("category_code").alias("product_key"),  # classifieds know no product below the category
        surrogate_key("seller_account_id").alias("seller_key"),
        "seller_account_id", "category_code", "status_code", "asking_price", "views_count",
        "favourites_count", "relist_count", "created_at", "image_hash", "excluded_from_gmv",
        "fraud_ring_flag", *QUALITY,
    )
    return non_additive(f, ["asking_price"])


def classified_listing_event(events: DataFrame) -> DataFrame:
    return events.select(
        "listing_id", "event_id", "event_timestamp",
        date_key("event_timestamp").alias("date_key"),
        surrogate_key("listing_id").alias("product_key"),  # the thing offered is the listing
        "event_type_code", "offer_amount",
        first_column(events, ["user_ref"], "string").alias("user_ref"), *QUALITY,
    )


def customer_review(reviews: DataFrame) -> DataFrame:
    f = reviews.select(
        "review_id", date_key("review_datetime").alias("date_key"),
        optional_key("product_sku").alias("product_key"),
        optional_key("customer_id").alias("customer_key"),
        F.col("rating").alias("star_rating"),
        (F.col("is_verified_purchase") == 1).alias("is_verified_purchase"),
        "days_post_delivery", "product_sku", "customer_id", "review_datetime", *QUALITY,
    )
    return non_additive(f, ["star_rating"])


def customer_complaint(cases: DataFrame) -> DataFrame:
    return cases.select(
        "case_id", "canonical_case_key", "case_reference",
        date_key("created_datetime").alias("date_key"),
        optional_key("customer_ref").alias("customer_key"),
        optional_key("channel_attribution").alias("channel_key"),
        "customer_ref", "category_code", "status_code", "resolution_outcome", "fault_attribution",
        "created_datetime",
        hours_between("created_datetime", "resolved_datetime").alias("resolution_time_hours"),
        (F.col("is_duplicate_flag") == 1).alias("is_duplicate_flag"), *QUALITY,
    )


def store_sale_line(lines: DataFrame, receipts: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per receipt line. Cost is quantity times catalogue cost, null where unknown."""
    head = receipts.select(
        "txn_id", "txn_date", "store_id", "customer_id", "payment_method_code", "promo_code", "canonical_status"
    )
    cost = catalogue.select(F.col("sku").alias("product_code"), "cogs")
    f = unpack(pack(lines, "line_no").join(head, "txn_id", "left").join(cost, "product_code", "left"), "line_no").select(
        F.col("txn_id").alias("receipt_no"), "line_no", "txn_date",
        date_key("txn_date").alias("date_key"),
        surrogate_key("product_code").alias("product_key"),
        optional_key("store_id").alias("store_key"),
        optional_key("customer_id").alias("customer_key"),
        optional_key("payment_method_code").alias("payment_method_key"),
        surrogate_key(F.lit("STORE")).alias("channel_key"),
        optional_key("promo_code").alias("promotion_key"),
        "product_code", "customer_id", F.col("canonical_status").alias("receipt_status"),
        "quantity", "gross_amount", "discount_amount", "net_amount", "tax_amount",
        "revenue_excl_tax",
        (F.col("cogs") * F.col("quantity")).cast("decimal(18,2)").alias("cogs_amount"),
        (F.col("gross_amount").cast("double") / F.col("quantity")).alias("unit_price"),
        *QUALITY,
    )
    margin = F.try_divide(
        (F.col("net_amount") - F.col("cogs_amount")).cast("double"), F.col("net_amount").cast("double")
    )
    return non_additive(f.withColumn("margin_percentage", margin), ["unit_price", "margin_percentage"])


def return_line(requests: DataFrame, receipts: DataFrame, refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per returned product of a return authorisation. The customer is that of the order sent back."""
    buyers = orders.select(F.col("order_number").alias("original_order_ref"), "customer_id")
    got = receipts.select(
        "return_authorization_id", "received_date", "restocked_qty", "restocked_as_condition",
        "condition_on_receipt", *[F.col(c).alias(f"__{c}") for c in QUALITY],
    )
    paid = refunds.select(
        "return_authorization_id", "refund_type", "refund_amount", "restocking_fee", "refund_date",
        "original_month", "refund_month",
        "revenue_impact_original_period", "revenue_impact_return_period",
        F.col("anomaly_reason_code").alias("refund_reason_code"),
    )
    key, texts = "return_authorization_id", ["return_authorization_id", "line_no"]
    met = pack(requests.drop(*QUALITY), *texts).join(buyers, "original_order_ref", "left")
    for other in (got, paid):
        met = met.join(pack(other, key), key, "left")
    return unpack(met, *texts).select(
        "return_authorization_id", "original_order_ref", "line_no",
        date_key("return_request_date").alias("request_date_key"),
        date_key("received_date").alias("receipt_date_key"),
        F.col("return_request_date").alias("request_date"), F.col("received_date").alias("receipt_date"),
        surrogate_key("product_sku").alias("product_key"), "product_sku",
        optional_key("customer_id").alias("customer_key"), "customer_id",
        optional_key("return_store_id").alias("store_key"),
        optional_key("reason_code").alias("return_reason_key"), "reason_code",
        surrogate_key("channel_code").alias("channel_key"), "channel_code",
        optional_key("condition_on_receipt").alias("listing_condition_key"),
        "restocked_as_condition", "quantity_returned", "restocked_qty",
        "refund_type", "refund_amount", "restocking_fee", "original_month", "refund_month",
        "revenue_impact_original_period", "revenue_impact_return_period", "refund_reason_code",
        ((F.col("channel_code") == "EC") & F.col("return_store_id").isNotNull()).alias("is_boris_return"),
        *carried(),
    )


def seller_performance_snapshot(
    market: DataFrame, orders: DataFrame, cases: DataFrame, listings: DataFrame,
    reports: DataFrame, events: DataFrame, trust: DataFrame, seller_of: Column,
) -> DataFrame:
    """One row per seller and ISO week: numerators and denominators, never a finished rate.

    Every signal is reduced to (seller, week, name, count) where it lives; the small rows are
    stacked and summed in one pass. `seller_of` reads the seller from a listing's account.
    """
    def week(c: Column) -> Column:
        return F.date_add(F.trunc(c, "week"), 6)

    def part(df: DataFrame, seller: Column, when: Column, **sums: Column) -> list[DataFrame]:
        g = df.select(
            seller.cast("bigint").alias("seller_id"), week(when).alias("week_end"),
            *[c.cast("bigint").alias(n) for n, c in sums.items()],
        ).groupBy("seller_id", "week_end").agg(*[F.sum(n).alias(n) for n in sums])
        kinds = F.array(*[F.struct(F.lit(n).alias("k"), F.col(n).alias("v")) for n in sums])
        return [g.select("seller_id", "week_end", F.explode(kinds).alias("e")).select(
            "seller_id", "week_end", "e.k", "e.v")]

    one = F.lit(1)
    placed = orders.select("order_id", "order_status", F.col("order_date"))
    sold = market.join(placed, "order_id")
    limit = F.col("order_date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(vocab.ON_TIME_HOURS)
    )
    dup = F.col("excluded_from_gmv") | F.col("fraud_ring_flag")
    lst = listings.select("listing_id", seller_of.alias("s"), "created_at", dup.alias("dup"))
    parts = part(
        sold, F.col("seller_id"), F.col("fulfilled_at").cast("date"),
        total_orders=one, cancelled_orders=F.col("order_status") == "CANCELLED",
        late_fulfilments=F.col("fulfilled_at") > limit, returned_orders=F.col("is_returned"),
    )
    parts += part(cases, F.col("seller_id"), F.col("created_datetime").cast("date"), complaints=one)
    parts += part(lst, F.col("s"), F.col("created_at").cast("date"), listings=one, duplicate_listings=F.col("dup"))
    told = reports.groupBy("listing_id").agg(F.count("*").alias("n"))
    parts += part(lst.join(told, "listing_id"), F.col("s"), F.col("created_at").cast("date"), listing_reports=F.col("n"))
    chats = (
        events.groupBy("listing_id", F.col("event_timestamp").cast("date").alias("d"))
        .agg(F.count_if(F.col("event_type_code") == "CHAT").alias("asked"),
             F.count_if(F.col("event_type_code") == "OFFER_ACC").alias("answered"))
        .join(lst.select("listing_id", "s"), "listing_id")
    )
    parts += part(chats, F.col("s"), F.col("d"), chats_received=F.col("asked"), chats_answered=F.col("answered"))

    names = [
        "total_orders", "cancelled_orders", "late_fulfilments", "returned_orders", "complaints",
        "listings", "duplicate_listings", "listing_reports", "chats_received", "chats_answered",
    ]
    f = union_all(parts).groupBy("seller_id", "week_end").agg(*[
        F.coalesce(F.sum(F.when(F.col("k") == n, F.col("v"))), F.lit(0)).alias(n) for n in names
    ])
    scores = trust.select(
        "seller_id", F.col("trust_score").alias("seller_trust_score"), "risk_tier"
    )
    f = f.join(scores, "seller_id", "left").withColumns({
        "date_key": date_key("week_end"),
        "seller_key": surrogate_key("seller_id"),
        "seller_risk_tier_key": optional_key("risk_tier"),
    })
    return non_additive(add_anomaly_columns(f), ["seller_trust_score"])


def row_deltas(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Rows per fact before and after a rebuild; a correction must not change them."""
    def counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
        return union_all([
            df.agg(F.count("*").alias(name)).select(F.lit(t).alias("fact"), name)
            for t, df in tables.items()
        ])

    return counts(before, "rows_before").join(
        counts(after, "rows_after"), "fact", "full_outer"
    ).withColumn("delta", F.coalesce("rows_after", F.lit(0)) - F.coalesce("rows_before", F.lit(0)))
