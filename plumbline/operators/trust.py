"""Seller trust and listing confidence: rates kept as pairs, weighted into a score from 0 to 1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import vocab
from plumbline.functions.exprs import bucket, ratio, with_one_row
from plumbline.operators.aggregates import grouped_median
from plumbline.operators.quality import Rule, add_anomaly_columns, flag, union_all

RATES = ["cancellation", "late", "return", "complaint", "duplicate", "report", "moderation", "response"]


def seller_inputs(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """Numerators and denominators per seller from tables (seller_id, num, den), one pass.

    Every part is aggregated per seller before they meet, and the parts are stacked and summed
    rather than joined one by one: one shuffle of small rows instead of eight joins.
    """
    stacked = union_all([
        df.groupBy("seller_id").agg(F.sum("num").alias("num"), F.sum("den").alias("den")).select(
            "seller_id", F.lit(rate).alias("rate"), "num", "den"
        )
        for rate, df in parts
    ])
    sums = []
    for r in RATES:
        here = F.col("rate") == r
        sums += [
            F.coalesce(F.sum(F.when(here, F.col("num"))), F.lit(0)).cast("bigint").alias(f"{r}_numerator"),
            F.coalesce(F.sum(F.when(here, F.col("den"))), F.lit(0)).cast("bigint").alias(f"{r}_denominator"),
        ]
    return stacked.groupBy("seller_id").agg(*sums)


def clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def trust_score(df: DataFrame, weights: dict[str, float] = vocab.TRUST_WEIGHTS) -> DataFrame:
    """1 minus the weighted risks. A rate nobody has a base for adds no risk; a response counts
    against the seller when it is missing."""
    risk = None
    for r in RATES:
        rate = ratio(F.col(f"{r}_numerator"), F.col(f"{r}_denominator"))
        part = F.lit(1.0) - rate if r == "response" else rate
        term = F.lit(weights[r]) * clamp(F.coalesce(part, F.lit(0.0)))
        risk = term if risk is None else risk + term
    out = df.withColumn("trust_score", F.round(clamp(F.lit(1.0) - risk), 6))
    out = out.withColumns({
        "risk_score": F.round(F.lit(1.0) - F.col("trust_score"), 6),
        "risk_tier": risk_tier(F.col("trust_score")),
    })
    return flag(add_anomaly_columns(out), [
        Rule("SELLER_HIGH_RISK", F.col("trust_score") < vocab.LOW_CONFIDENCE)
    ])


def risk_tier(score: Column) -> Column:
    tiers = [(low, name) for name, low, _, _ in vocab.RISK_TIERS[:-1]]
    return bucket(score, tiers, vocab.RISK_TIERS[-1][0])


def listing_confidence(
    listings: DataFrame,
    events: DataFrame,
    reports: DataFrame,
    relisted: str,
    as_of: str,
    weights: dict[str, float] = vocab.LISTING_WEIGHTS,
) -> DataFrame:
    """Confidence per listing from age, replies, price, relisting and reports.

    The category median is a grouped aggregate joined back; one listing is one row throughout.
    """
    asked = F.col("event_type_code") == "CHAT"
    answered = F.col("event_type_code") == "OFFER_ACC"
    replies = events.groupBy("listing_id").agg(
        F.count_if(asked).alias("chats"), F.count_if(answered).alias("answers")
    )
    told = reports.groupBy("listing_id").agg(F.count("*").alias("reports"))
    usual = grouped_median(listings, "category_code", F.col("asking_price").cast("double"), "category_median")
    df = (
        listings.join(usual, "category_code", "left")
        .join(replies, "listing_id", "left")
        .join(told, "listing_id", "left")
    )
    known = told.join(listings.select("listing_id"), "listing_id", "left_semi")
    df = with_one_row(df, known.agg(F.max("reports").alias("most_reports")))
    age = F.date_diff(F.lit(as_of).cast("date"), F.col("created_at").cast("date"))
    price, median = F.col("asking_price").cast("double"), F.col("category_median")
    parts = {
        "age_part": clamp(age / F.lit(30.0)),
        "response_part": clamp(F.coalesce(ratio(F.col("answers"), F.col("chats")), F.lit(0.0))),
        "price_part": clamp(F.lit(1.0) - F.coalesce(
            F.try_divide(F.abs(price - median), median), F.lit(0.0))),
        "relist_part": F.when(F.col(relisted), F.lit(0.0)).otherwise(F.lit(1.0)),
        "report_part": F.lit(1.0) - F.coalesce(ratio(F.col("reports"), F.col("most_reports")), F.lit(0.0)),
    }
    df = df.withColumns(parts)
    score = None
    for name, w in weights.items():
        term = F.lit(w) * F.col(f"{name}_part")
        score = term if score is None else score + term
    df = df.withColumn("confidence_score", F.round(score, 6)).select(
        "listing_id", *parts, "confidence_score"
    )
    return flag(add_anomaly_columns(df), [
        Rule("LISTING_LOW_CONFIDENCE", F.col("confidence_score") < vocab.LOW_CONFIDENCE)
    ])
