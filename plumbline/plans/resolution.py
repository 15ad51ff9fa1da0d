"""The catalogued anomalies: what is wrong, what is written, which method is recorded.

Per table one `prepare` (facts from other tables, as marker columns) and one list of corrections,
applied together in one projection. Running it on its own output changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import vocab
from plumbline.functions.text import edit_similarity, token_sorted
from plumbline.operators import commerce
from plumbline.operators.joins import left_join_spread, mark_exists
from plumbline.operators.matching import best_match, match_tier
from plumbline.functions.exprs import has_code, holds, with_one_row
from plumbline.operators.quality import Correction, Rule, flag
from plumbline.plans.silver import SILVER
from plumbline.sources.written import one_by_one

DECISION = "B_DECISION_APPLIED"


# ---- online orders -----------------------------------------------------------------------------
def cancelled_revenue() -> Correction:
    return Correction(
        "CANCELLED_WITH_REVENUE",
        (F.col("order_status") == "CANCELLED") & (F.col("subtotal_excl_tax") > 0),
        "ZEROED_CANCELLED_REVENUE",
        sets={"subtotal_excl_tax": F.lit(0).cast("decimal(12,2)")},
    )


def placeholder_customer() -> Correction:
    """Guests under a placeholder id; a member who really owns that id keeps their own orders."""
    return Correction(
        "PLACEHOLDER_ID_COLLISION",
        F.col("is_placeholder_id") & F.col("session_id").startswith(vocab.GUEST_SESSION),
        "REKEYED_GUEST_BUCKET",
        sets={"customer_id": F.concat(F.lit("GUEST-"), F.col("session_id"))},
    )


def session_attribution(window: tuple[str, str]) -> Correction:
    first, last = (F.lit(w).cast("date") for w in window)
    return Correction(
        "ATTRIBUTION_SESSION_BRIDGE",
        F.col("order_date").between(first, last)
        & F.col("promo_code_applied").isNull()
        & F.col("in_campaign_session"),
        DECISION,
        always={
            "attribution_confidence": lambda hit: F.when(hit, F.lit(vocab.ATTRIBUTION_CONFIDENCE))
        },
        classification="ATTRIBUTED",
    )


def uncollected_pickup() -> Correction:
    return Correction(
        "BOPIS_NO_PICKUP_EVENT",
        (F.col("delivery_method_code") == "BOPIS")
        & (F.col("order_status") == "DELIVERED")
        & ~F.col("was_collected"),
        DECISION,
        always={"collection_unconfirmed": lambda hit: hit},
        classification="TREAT_AS_FULFILLED",
    )


def prepare_ec_orders(
    orders: DataFrame, sessions: DataFrame, shipments: DataFrame, events: DataFrame, tag: str, placeholders: DataFrame
) -> DataFrame:
    tagged = sessions.filter(F.col("utm_campaign") == tag)
    scanned = events.filter(F.col("event_type_code") == "BOPIS_COLLECTED").select("shipment_id")
    collected = shipments.join(scanned, "shipment_id", "left_semi")
    out = mark_exists(orders, placeholders, {"customer_id": "customer_id"}, "is_placeholder_id", ["order_id"])
    out = mark_exists(out, tagged, {"session_id": "session_id"}, "in_campaign_session", ["order_id"])
    return mark_exists(out, collected, {"order_number": "order_reference"}, "was_collected", ["order_id"])


# ---- payments, tax -----------------------------------------------------------------------------
def payment_after_cancel() -> Correction:
    return Correction(
        "PAYMENT_AFTER_CANCEL",
        F.col("captured_ts").isNotNull() & F.col("cancelled_ts").isNotNull(),
        "FLAGGED_REVERSAL_REQUIRED",
        always={
            "strictly_after": lambda hit: hit & (F.col("captured_ts") > F.col("cancelled_ts"))
        },
    )


def prepare_pg_transactions(payments: DataFrame, orders: DataFrame, history: DataFrame) -> DataFrame:
    cancelled = (
        history.filter(F.col("status_code") == "CANCELLED")
        .groupBy("order_id")
        .agg(F.min("status_timestamp").alias("cancelled_ts"))
        .join(orders.select("order_id", F.col("order_number").alias("order_ref")), "order_id")
        .select("order_ref", "cancelled_ts")
    )
    return payments.join(cancelled, "order_ref", "left")


def tax_basis() -> Correction:
    return Correction(
        "TAX_INCLUSION_MISMATCH", F.col("revenue_excl_tax").isNotNull(), "NORMALISED_TAX_EXCLUSIVE"
    )


def prepare_pos_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("revenue_excl_tax", commerce.tax_exclusive(SILVER["pos_transaction_lines"].basis))


# ---- stock and returns -------------------------------------------------------------------------
def promised_without_stock() -> Correction:
    return Correction(
        "ATP_POSITIVE_PHYSICAL_ZERO",
        (F.col("atp_qty") > 0) & (F.col("physical_qty") == 0),
        "CORRECTED_ATP_TO_ZERO",
        sets={"atp_qty": F.lit(0)},
    )


def negative_stock() -> Correction:
    return Correction(
        "NEGATIVE_QTY",
        (F.col("sellable_qty") < 0) | (F.col("physical_qty") < 0),
        "CORRECTED_ATP_TO_ZERO",
        sets={c: F.greatest(F.col(c), F.lit(0)) for c in ("sellable_qty", "physical_qty")},
        always={"oversell_flag": lambda hit: hit},
    )


def restocked_early() -> Correction:
    return Correction(
        "RESTOCK_BEFORE_INSPECTION",
        (F.col("inspection_status") == "PENDING") & (F.col("restocked_qty") > 0),
        "ZEROED_RESTOCK_PRE_INSPECTION",
        sets={"restocked_qty": F.lit(0)},
    )


def opened_as_new() -> Correction:
    return Correction(
        "OPEN_BOX_AS_NEW",
        (F.col("condition_on_receipt") == "OPENED") & (F.col("restocked_as_condition") == "NEW"),
        "CORRECTED_CONDITION_OPEN_BOX",
        sets={"restocked_as_condition": F.lit("OPEN_BOX")},
    )


def reconstructed_day() -> Correction:
    return Correction(
        "MISSING_SNAPSHOT_DAY", F.lit(True), "RECONSTRUCTED_SNAPSHOT",
        status="RECONSTRUCTED", certainty="INFERRED",
    )


def missing_reference() -> Correction:
    return Correction(
        "MOVEMENT_NULL_REF", F.col("reference_number").isNull(), DECISION,
        classification="PROBABLE_MISSING_REF",
    )


def partial_refund_period() -> Correction:
    return Correction(
        "REFUND_PARTIAL_PERIOD_AMBIGUITY",
        (F.upper("refund_type") == "PARTIAL") & F.col("is_cross_period"),
        DECISION,
        classification="RECOGNISE_IN_RETURN_PERIOD",
    )


# ---- classifieds and marketplace ---------------------------------------------------------------
def seller_marked_sold() -> Correction:
    return Correction(
        "NL_SELLER_SOLD_AS_REVENUE", F.col("event_type_code") == "SELLER_SOLD",
        "RELABELLED_ESTIMATED_GMV",
    )


def value_signals() -> Correction:
    return Correction(
        "ESTIMATED_NL_GMV", F.col("event_type_code").isin(list(vocab.SIGNAL_WEIGHTS)), DECISION,
        only_unresolved=True,
    )


def title_mismatch(below: float = 0.5) -> Correction:
    likeness = edit_similarity(token_sorted("seller_product_title"), token_sorted("canonical_title"))
    return Correction(
        "SKU_PRODUCT_MISMATCH",
        F.col("canonical_title").isNotNull() & (likeness < F.lit(below)),
        "APPLIED_CANONICAL_PRODUCT",
        sets={"seller_product_title": F.col("canonical_title")},
    )


def prepare_seller_listings(listings: DataFrame, catalogue: DataFrame) -> DataFrame:
    names = catalogue.select(
        F.col("sku").alias("__ref"), F.col("product_name").alias("canonical_title")
    )
    return left_join_spread(listings.drop("canonical_title"), names, ["catalogue_sku_ref"], ["__ref"])


def relisted_after_sold() -> Correction:
    return Correction(
        "RELISTED_AFTER_SOLD", F.col("is_relisted"), "LINKED_RELISTING_EXCLUDED",
        always={
            "excluded_from_gmv": lambda hit: hit,
            "relisting_reliability": lambda hit: F.when(hit, "LOW"),
        },
    )


def picture_ring() -> Correction:
    return Correction(
        "IMAGE_HASH_REUSED", F.col("in_ring"), "FLAGGED_FRAUD_RING",
        always={"fraud_ring_flag": lambda hit: hit},
    )


def catalogue_match() -> Correction:
    return Correction(
        None,
        F.col("status_code") == "ACTIVE",
        DECISION,
        classification=match_tier(F.col("b4_match_confidence")),
        only_unresolved=True,
    )


def prepare_nl_listings(listings: DataFrame, catalogue: DataFrame) -> DataFrame:
    out = commerce.mark_relisted(listings)
    out = commerce.mark_rings(out)
    scored = best_match(
        out.withColumn("__t", F.when(F.col("status_code") == "ACTIVE", F.col("listing_title"))),
        "__t",
        catalogue.withColumnRenamed("category", "category_code"),
        "product_name",
        ["category_code"],
    )
    return scored.withColumnRenamed("match_score", "b4_match_confidence").drop("__t", "match_name")


# ---- delivery, reviews, support, customers, sellers --------------------------------------------
def _late_pickup_hours() -> Column:
    return F.abs(F.timestamp_diff("SECOND", F.col("pickup_ts"), F.col("delivered_ts"))) / F.lit(3600.0)


def delivered_before_pickup() -> Correction:
    small = _late_pickup_hours() <= vocab.REVIEW_BEYOND_HOURS
    moved = F.col("pickup_ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("transit_hours") * 3600).cast("decimal(18,6)")
    )
    return Correction(
        "DELIVERY_BEFORE_SHIP",
        (F.col("event_type_code") == "DELIVERED") & (F.col("delivered_ts") < F.col("pickup_ts")),
        lambda: [(small, "CORRECTED_DELIVERY_TS"), (~small, "ESCALATED_MANUAL_REVIEW")],
        always={
            "corrected_event_datetime": lambda hit: F.when(hit & small, moved),
            "requires_manual_review": lambda hit: hit & ~small,
        },
    )


def prepare_delivery_events(events: DataFrame, shipments: DataFrame) -> DataFrame:
    df = events.drop("pickup_ts", "delivered_ts", "ship_created_ts", "transit_hours")
    usual = commerce.median_transit_hours(commerce.shipment_milestones(df))
    df = with_one_row(commerce.with_milestones(df, shipments), usual)
    # the broad signal: any event before its shipment existed; labelled, not corrected
    return flag(df, [
        Rule("COURIER_CLOCK_DRIFT", F.col("event_timestamp") < F.col("ship_created_ts"))
    ])


def review_before_delivery() -> Correction:
    return Correction(
        "REVIEW_BEFORE_DELIVERY", F.col("days_post_delivery") < 0, "SET_VERIFIED_PURCHASE_FALSE",
        sets={"is_verified_purchase": F.lit(0)},
    )


def duplicate_case() -> Correction:
    return Correction(
        "DUPLICATE_CASE", F.col("is_duplicate_flag") == 1, "DEDUPED_CANONICAL_CASE",
        always={
            "canonical_case_key": lambda hit: F.coalesce("canonical_case_ref", "case_reference")
        },
    )


def ambiguous_identity() -> Correction:
    return Correction(
        "IDENTITY_AMBIGUOUS",
        (F.col("identity_confidence") >= 0.90) & (F.col("identity_confidence") < 1.00),
        DECISION,
        classification="MERGED",
    )


def high_risk_seller() -> Correction:
    return Correction(
        "SELLER_HIGH_RISK", F.col("trust_score") < vocab.LOW_CONFIDENCE, DECISION, classification=F.col("risk_tier")
    )


def prepare_sellers(sellers: DataFrame, trust: DataFrame) -> DataFrame:
    scores = trust.select("seller_id", "trust_score", "risk_tier")
    return sellers.drop("trust_score", "risk_tier").join(scores, "seller_id", "left")


# ---- before and after --------------------------------------------------------------------------
def before_after(entries: list[tuple[str, Correction, DataFrame, Column | None]]) -> DataFrame:
    """Per anomaly: rows corrected, rows that carry its code but were not, methods used, amount at stake.

    An entry is (name, correction, corrected table, amount before the fix or null). A decision without
    a code of its own is told by its classification.
    """
    def counted(name: str, c: Correction, amount: Column | None) -> Column:
        own = [m for _, m in c.methods()]
        known = has_code("anomaly_reason_code", c.code) if c.code else F.col("b_classification").isNotNull()
        by = F.array_intersect(F.split("resolution_method", ","), F.array(*map(F.lit, own)))
        corrected = known & holds(F.size(by) > 0)
        value = F.lit(None).cast("double") if amount is None else F.sum(F.when(corrected, amount)).cast("double")
        used = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(corrected, by)))))  # a few names
        return F.struct(
            F.lit(name).alias("anomaly"), F.lit(c.code).cast("string").alias("reason_code"),
            F.count_if(corrected).alias("corrected_rows"),
            F.count_if(known & ~corrected).alias("flagged_only_rows"),
            F.nullif(F.array_join(used, ","), F.lit("")).alias("methods"),
            value.alias("impact"),
        )

    # a table is read once for all its anomalies, one table after the other
    tables = {id(df): df for _, _, df, _ in entries}
    return one_by_one((
        df.agg(F.array(*[counted(name, c, amount) for name, c, of, amount in entries if of is df]).alias("found")).select(F.inline("found"))
        for df in tables.values()
    ), "before_after")
