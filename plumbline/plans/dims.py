"""Conformed dimensions. Each has a unique key, its natural key, is_active and quality columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline import vocab
from plumbline.functions.exprs import lookup, with_one_row
from plumbline.functions.keys import date_key, surrogate_key
from plumbline.operators.history import versions
from plumbline.operators.quality import add_anomaly_columns
from plumbline.operators.trust import risk_tier
from plumbline.sources.raw import static_rows

# fixed values: public holidays as month and day, the same days in any calendar year
HOLIDAYS = ["01-26", "03-25", "04-11", "08-15", "10-02", "11-01", "12-25"]


class Campaign:
    """The campaign calendar of one year. Baseline starts on a stated day, not with the data."""

    def __init__(self, year: int, tag: str):
        self.tag = tag
        self.baseline_from = f"{year}-03-01"
        self.ramp_from = f"{year}-08-01"
        self.first, self.last = f"{year}-08-08", f"{year}-08-28"
        self.post_to = f"{year}-09-14"
        self.window = (self.first, self.last)

    def phase(self, day: Column) -> Column:
        def on(text: str) -> Column:
            return F.lit(text).cast("date")

        return (
            F.when(day < on(self.baseline_from), "OUT_OF_SCOPE")
            .when(day < on(self.ramp_from), "BASELINE")
            .when(day < on(self.first), "PRE_RAMP")
            .when(day <= on(self.last), "CAMPAIGN")
            .when(day <= on(self.post_to), "POST_CAMPAIGN")
            .otherwise("OUT_OF_SCOPE")
        )


def _finish(df: DataFrame) -> DataFrame:
    return add_anomaly_columns(df.withColumn("is_active", F.lit(True)))


def dim_date(days: DataFrame, campaign: Campaign) -> DataFrame:
    """Every calendar day of a one-row table (first_day, last_day)."""
    day = F.col("date_day")
    holiday = F.date_format(day, "MM-dd").isin(HOLIDAYS)
    return _finish(
        days.select(F.explode(F.sequence("first_day", "last_day")).alias("date_day")).select(
            date_key(day).alias("date_key"),
            day,
            F.date_format(day, "yyyy-MM-dd").alias("date_iso"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            (F.weekday(day) + 1).alias("day_of_week"),
            (F.weekday(day) >= 5).alias("is_weekend"),
            holiday.alias("is_public_holiday"),
            campaign.phase(day).alias("campaign_phase"),
        ).withColumn("is_campaign_day", F.col("campaign_phase") == "CAMPAIGN")
    )


def dim_channel(spark: SparkSession) -> DataFrame:
    return _finish(static_rows(
        spark, vocab.CHANNELS,
        "channel_code string, channel_name string, is_platform_controlled boolean",
        "channel_key", "channel_code",
    ))


def dim_step(spark: SparkSession) -> DataFrame:
    return _finish(static_rows(
        spark, vocab.FUNNEL_STEPS,
        "step_code string, sequence_number int, is_conversion_step boolean",
        "step_key", "step_code",
    ))


def dim_seller_risk_tier(spark: SparkSession) -> DataFrame:
    return _finish(static_rows(
        spark, vocab.RISK_TIERS,
        "risk_tier string, tier_threshold double, moderation_required boolean, visibility_pct int",
        "seller_risk_tier_key", "risk_tier",
    ))


def dim_payment_method(instruments: DataFrame) -> DataFrame:
    name = F.lower("type_name")
    on_delivery = F.upper("type_code").contains("COD") | name.contains("cash") | name.contains("delivery")
    certainty = F.when(on_delivery, "INFERRED").otherwise("CONFIRMED")
    return _finish(instruments.select(
        surrogate_key("type_code").alias("payment_method_key"), "type_code", "type_name",
        certainty.alias("payment_certainty"), (~on_delivery).alias("is_prepaid"),
    ))


def dim_delivery_method(methods: DataFrame) -> DataFrame:
    code = F.col("method_code")
    return _finish(methods.select(
        surrogate_key(code).alias("delivery_method_key"), "method_code", "method_name",
        "est_days_min", "est_days_max",
        (~code.isin(vocab.SELLER_SHIPPED)).alias("is_platform_controlled"),
        (F.upper(code) == "BOPIS").alias("is_bopis"),
    ))


def dim_return_reason(reasons: DataFrame) -> DataFrame:
    group = lookup({r: g for r, g, _ in vocab.RETURN_REASONS}, F.col("reason_code"))
    fault = lookup({r: f for r, _, f in vocab.RETURN_REASONS}, F.col("reason_code"))
    return _finish(reasons.select(
        surrogate_key("reason_code").alias("return_reason_key"), "reason_code",
        group.alias("reason_group"), fault.alias("channel_fault_attribution"),
    ))


def dim_listing_condition(receipts: DataFrame) -> DataFrame:
    """Conditions met on receipt or on restocking."""
    seen = receipts.select(
        F.explode(F.array("condition_on_receipt", "restocked_as_condition")).alias("condition_code")
    ).distinct()
    return _finish(seen.select(
        surrogate_key("condition_code").alias("listing_condition_key"), "condition_code",
        lookup(vocab.CONDITION_GROUPS, F.col("condition_code")).alias("granularity_group"),
    ))


def dim_promotion(orders: DataFrame, sessions: DataFrame, receipts: DataFrame) -> DataFrame:
    """Promo codes and campaign tags with the channels they were seen in."""
    channel = F.when(F.col("delivery_method_code") == "BOPIS", "BOPIS").otherwise("EC")
    used = orders.select(F.col("promo_code_applied").alias("promo_code"), channel.alias("c")).unionByName(
        sessions.select(F.col("utm_campaign").alias("promo_code"), F.lit("WEB").alias("c"))
    ).unionByName(receipts.select("promo_code", F.lit("STORE").alias("c")))
    scope = used.filter("promo_code is not null").distinct().groupBy("promo_code").agg(
        # at most a handful of channels per code
        F.array_join(F.array_sort(F.collect_set("c")), ",").alias("promotion_channel_scope")
    )
    return _finish(scope.select(
        surrogate_key("promo_code").alias("promotion_key"), "promo_code", "promotion_channel_scope"
    ))


def dim_store(stores: DataFrame, movements: DataFrame) -> DataFrame:
    """Stores with the first day any stock moved there."""
    start = movements.groupBy("store_id").agg(F.min("movement_date").alias("zone_activation_date"))
    return _finish(stores.join(start, "store_id", "left").select(
        surrogate_key("store_id").alias("store_key"), "store_id", "store_name", "region_name",
        "zone_activation_date",
    ))


def dim_seller(sellers: DataFrame, trust: DataFrame, accounts: DataFrame) -> DataFrame:
    """Marketplace sellers with their risk, and classified accounts, which have no score."""
    scored = sellers.join(trust.select("seller_id", "trust_score", "risk_score"), "seller_id", "left")
    market = scored.select(
        F.col("seller_id").cast("string").alias("seller_code"), "seller_name",
        F.col("canonical_status").alias("seller_status"),
        F.col("risk_score").alias("seller_risk_score"),
        F.when(F.col("trust_score").isNotNull(),
               surrogate_key(risk_tier(F.col("trust_score")))).alias("seller_risk_tier_key"),
    )
    classified = accounts.select(
        F.col("account_id").alias("seller_code"), F.col("account_id").alias("seller_name"),
        F.lit("OPEN").alias("seller_status"),
        F.lit(None).cast("double").alias("seller_risk_score"),
        F.lit(None).cast("string").alias("seller_risk_tier_key"),
    )
    return _finish(
        market.unionByName(classified).withColumn("seller_key", surrogate_key("seller_code"))
    )


def product_versions(loads: DataFrame) -> DataFrame:
    return versions(loads, "sku", ["price_list"], "load_date")


def customer_versions(loads: DataFrame) -> DataFrame:
    return versions(loads, "customer_id", ["delivery_habit"], "load_date")


def dim_product(v: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Product versions; name, category and prices are the catalogue's current ones."""
    facts = catalogue.select("sku", "product_name", "brand", "category", "list_price", "cogs")
    return _finish(v.join(facts, "sku", "left").withColumns({
        "product_key": surrogate_key("sku"),
        "product_master_confidence": F.when(F.col("product_name").isNotNull(), 1.0).otherwise(0.0),
    }))


def dim_customer(v: DataFrame, identities: DataFrame) -> DataFrame:
    """Customer versions with the identity they resolve to."""
    who = identities.filter("source_system = 'LOYALTY'").select(
        F.col("source_id").cast("string").alias("customer_id"),
        F.col("customer_key").alias("customer_master_key"),
        F.col("identity_confidence").alias("identity_confidence_score"),
        F.col("match_pass").alias("match_pass_used"),
    )
    return _finish(v.join(who, "customer_id", "left").withColumn(
        "customer_key", surrogate_key("customer_id")
    ))


def contract_violations(dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Per dimension (table, key, natural key): duplicate keys, null natural keys, missing columns,
    and, for versioned ones, versions that do not follow each other."""
    from pyspark.sql import Window

    from plumbline.operators.quality import QUALITY, union_all

    parts = []
    for name, (df, key, natural) in dims.items():
        missing = [c for c in [*QUALITY, "is_active"] if c not in df.columns]
        versioned = "version_number" in df.columns
        dup = df.groupBy("version_key" if versioned else key).agg(F.count("*").alias("n")).agg(
            F.count_if(F.col("n") > 1).alias("duplicate_keys")
        )
        nulls = df.agg(F.count_if(F.col(natural).isNull()).alias("null_natural_keys"))
        if versioned:  # a key has at most one version per load day
            w = Window.partitionBy(key).orderBy("version_number")
            nxt = F.lead("valid_from").over(w)
            gap = F.when(nxt.isNull(), ~F.col("is_current")).otherwise(
                F.col("is_current") | (F.date_add("valid_to", 1) != nxt)
            )
            chain = df.select(gap.alias("gap")).agg(F.count_if("gap").alias("broken_chains"))
        else:
            chain = None
        row = with_one_row(dup, nulls)
        row = (
            row.withColumn("broken_chains", F.lit(0).cast("bigint"))
            if chain is None
            else with_one_row(row, chain)
        )
        parts.append(row.select(
            F.lit(name).alias("dimension"), "duplicate_keys", "null_natural_keys", "broken_chains",
            F.lit(len(missing)).alias("missing_columns"),
        ))
    return union_all(parts)
