"""Status mapping, campaign attribution, refund periods, delivery milestones, listing history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline import vocab
from plumbline.functions.exprs import holds
from plumbline.functions.keys import surrogate_key
from plumbline.operators.joins import latest_before, mark_exists, mark_within
from plumbline.operators.quality import Rule, add_anomaly_columns, flag, union_all


# ---- status codes ------------------------------------------------------------------------------
def curated_status_map(spark: SparkSession) -> DataFrame:
    rows = [
        (system, code, canonical, 1.0)
        for system, codes in vocab.STATUS_MAP.items()
        for code, canonical in codes.items()
    ]
    return spark.createDataFrame(
        rows,
        "source_system string, raw_code string, canonical_status string, mapping_confidence double",
    )


def build_status_map(spark: SparkSession, observed: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Curated pairs plus every observed code they lack, which is mapped to UNMAPPED."""
    curated = curated_status_map(spark)
    seen = union_all([
        df.select(F.lit(system).alias("source_system"), F.upper(col).alias("raw_code"))
        .filter("raw_code is not null")
        .distinct()
        for system, (df, col) in observed.items()
    ])
    unknown = seen.join(F.broadcast(curated), ["source_system", "raw_code"], "left_anti").withColumns({
        "canonical_status": F.lit(vocab.UNMAPPED),
        "mapping_confidence": F.lit(0.0),
    })
    out = add_anomaly_columns(curated.unionByName(unknown))
    return flag(out, [Rule("STATUS_UNMAPPED", F.col("canonical_status") == vocab.UNMAPPED)])


def apply_status_map(df: DataFrame, system: str, code: str) -> DataFrame:
    """Add canonical_status; a code the curated map lacks becomes UNMAPPED and is flagged.

    The map is a fixed list of some thirty pairs, so it is broadcast whatever the table's size.
    """
    pairs = curated_status_map(df.sparkSession).filter(F.col("source_system") == system).select(
        F.col("raw_code").alias("__code"), "canonical_status"
    )
    out = df.join(F.broadcast(pairs), F.upper(code) == F.col("__code"), "left").drop("__code")
    out = out.withColumn(
        "canonical_status", F.coalesce("canonical_status", F.lit(vocab.UNMAPPED))
    )
    return flag(out, [
        Rule("STATUS_UNMAPPED",
             F.col(code).isNotNull() & (F.col("canonical_status") == vocab.UNMAPPED))
    ])


# ---- campaign attribution ----------------------------------------------------------------------
def same_session_bridge(orders: DataFrame, sessions: DataFrame, tag: str, window: tuple[str, str]) -> DataFrame:
    """Promo-less orders of the window placed in a session that carried the campaign tag."""
    candidates = orders.filter(
        F.col("order_date").between(F.lit(window[0]).cast("date"), F.lit(window[1]).cast("date"))
        & F.col("promo_code_applied").isNull()
    )
    tagged = sessions.filter(F.col("utm_campaign") == tag).select(
        "session_id", F.col("session_end_ts").alias("session_end_at"),
        F.col("registered_customer_id").alias("session_customer"),
    )
    joined = candidates.join(tagged, "session_id")
    return _bridge(joined.select(
        "session_id", "order_id", F.col("session_customer").alias("customer_id"),
        "session_end_at", F.col("order_date").alias("order_placed_at"),
    ))


def timed_session_bridge(
    orders: DataFrame, sessions: DataFrame, tag: str, hours: int = vocab.SESSION_WINDOW_HOURS
) -> DataFrame:
    """Orders whose customer's latest session, ended at most `hours` before, carried the tag."""
    prior = sessions.filter(F.col("registered_customer_id").isNotNull()).select(
        F.col("registered_customer_id").alias("customer_id"), "session_end_ts", "session_id",
        "utm_campaign",
    )
    found = latest_before(
        orders.select("order_id", "customer_id", "created_at"),
        prior.select("customer_id", "session_end_ts", F.col("session_id").alias("prior_session"),
                     F.col("utm_campaign").alias("prior_tag")),
        ["customer_id"], "created_at", "session_end_ts",
        ["prior_session", "prior_tag"], hours * 3600,
    )
    return found.filter(F.col("prior_tag") == tag).select(
        surrogate_key("prior_session", "order_id").alias("bridge_key"),
        F.col("prior_session").alias("session_id"), "order_id", "customer_id",
        F.lit("SESSION_BRIDGE").alias("attribution_rule"),
        F.lit(vocab.ATTRIBUTION_CONFIDENCE).alias("attribution_confidence"),
    )


def _bridge(df: DataFrame) -> DataFrame:
    out = df.withColumns({
        "bridge_key": surrogate_key("session_id", "order_id"),
        "attribution_rule": F.lit("SESSION_BRIDGE"),
        "attribution_confidence": F.lit(vocab.ATTRIBUTION_CONFIDENCE),
    })
    out = add_anomaly_columns(out, certainty="INFERRED")
    return flag(out, [Rule("ATTRIBUTION_SESSION_BRIDGE", F.lit(True))])


def attribution_rule(promo: Column, bridged: Column, pickup_eligible: Column) -> Column:
    """Which rule attributes an order to the campaign, the strongest first; null for none."""
    return (
        F.when(promo.isNotNull(), "PROMO_CODE")
        .when(holds(bridged), "SESSION_BRIDGE")
        .when(holds(pickup_eligible), "BOPIS_WINDOW")
    )


# ---- refunds -----------------------------------------------------------------------------------
def refund_periods(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """The effect of every refund on the month of the sale and on the month of the refund.

    A full refund takes back the subtotal, a partial one what was paid back, less a restocking fee
    kept. Both columns carry it; the period label says which one the decision books.
    """
    sold = orders.select(
        F.col("order_number").alias("original_order_ref"), F.col("order_date").alias("sold_on")
    )
    back = F.when(F.col("refund_type") == "FULL", F.col("subtotal")).otherwise(F.col("refund_amount"))
    impact = F.col("restocking_fee") - back
    out = refunds.join(sold, "original_order_ref", "left").withColumns({
        "original_month": F.trunc("sold_on", "month"),
        "refund_month": F.trunc("refund_date", "month"),
        "revenue_impact_original_period": impact,
        "revenue_impact_return_period": impact,
    })
    return out.withColumn(
        "is_cross_period", holds(F.col("original_month") != F.col("refund_month"))
    )


# ---- delivery ----------------------------------------------------------------------------------
def shipment_milestones(events: DataFrame) -> DataFrame:
    """Last pickup and first delivery per shipment: one partial aggregate, no sorted group."""
    def at(kind: str) -> Column:
        return F.when(F.col("event_type_code") == kind, F.col("event_timestamp"))

    return events.groupBy("shipment_id").agg(
        F.max(at("PICKED_UP")).alias("pickup_ts"), F.min(at("DELIVERED")).alias("delivered_ts")
    )


def median_transit_hours(milestones: DataFrame) -> DataFrame:
    """One row: the median hours from pickup to delivery of shipments in the right order."""
    clean = milestones.filter(F.col("delivered_ts") >= F.col("pickup_ts"))
    hours = F.timestamp_diff("HOUR", F.col("pickup_ts"), F.col("delivered_ts"))
    # whole hours keep the exact median's table of distinct values small
    return clean.agg(
        F.coalesce(F.median(hours), F.lit(float(vocab.FALLBACK_TRANSIT_HOURS))).alias("transit_hours")
    )


def with_milestones(events: DataFrame, shipments: DataFrame) -> DataFrame:
    """Delivery events with their shipment's pickup, delivery and creation times.

    The two sides with one row per shipment meet first, so the events, which may crowd on a
    shipment, go through a single join that can be split where it is skewed.
    """
    created = shipments.select("shipment_id", F.col("created_datetime").alias("ship_created_ts"))
    per_shipment = shipment_milestones(events).join(created, "shipment_id", "left")
    return events.join(per_shipment, "shipment_id")


# ---- classified listings -----------------------------------------------------------------------
def mark_relisted(listings: DataFrame, days: int | None = None, name: str = "is_relisted") -> DataFrame:
    """Active listings whose seller had sold or let expire the same picture before.

    Only the earliest end of a (seller, picture) matters, or, with a window of days, the earliest
    and latest end per time bucket; the table is never joined with itself row by row.
    """
    key = ["seller_account_id", "image_hash"]
    ended = listings.filter(F.col("status_code").isin("SOLD", "EXPIRED") & F.col("image_hash").isNotNull())
    if days is None:
        first = ended.groupBy(
            F.col("seller_account_id").alias("__s"), F.col("image_hash").alias("__i")
        ).agg(F.min("updated_at").alias("__end"))
        on = (F.col("seller_account_id") == F.col("__s")) & (F.col("image_hash") == F.col("__i"))
        out = listings.join(first, on, "left").withColumn(
            name, holds((F.col("status_code") == "ACTIVE") & (F.col("created_at") > F.col("__end")))
        )
        return out.drop("__s", "__i", "__end")
    marked = mark_within(
        listings, ended.select(*key, F.col("updated_at").alias("__end_ts")), key,
        "created_at", "__end_ts", days * 86400, "__w", after=False, strict=True,
    )
    return marked.withColumn(name, (F.col("status_code") == "ACTIVE") & F.col("__w")).drop("__w")


def shared_pictures(listings: DataFrame, sellers_from: int = 2) -> DataFrame:
    """Pictures used by several sellers. Sellers are made distinct per picture before counting."""
    return (
        listings.filter("image_hash is not null")
        .groupBy("image_hash")
        .agg(
            F.countDistinct("seller_account_id").alias("distinct_sellers"),
            F.count("*").alias("listing_count"),
        )
        .filter(F.col("distinct_sellers") >= sellers_from)
    )


def mark_rings(listings: DataFrame, name: str = "in_ring") -> DataFrame:
    return mark_exists(listings, shared_pictures(listings), {"image_hash": "image_hash"}, name)


# ---- tax ---------------------------------------------------------------------------------------
@dataclass(frozen=True)
class TaxBasis:
    """What a table's amount means. tax_inside: the column with the tax it contains, none if net."""

    amount: str
    tax_inside: str | None = None


def tax_exclusive(basis: TaxBasis) -> Column:
    tax = F.col(basis.tax_inside) if basis.tax_inside else F.lit(0)
    return F.round(F.col(basis.amount) - tax, 2)
