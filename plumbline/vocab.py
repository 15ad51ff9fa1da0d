"""Closed vocabularies. Everything the quality layer may write is listed here."""

from __future__ import annotations

from typing import NamedTuple

# --- fixed values: severity order, low to high -------------------------------------------------
STATUSES = [
    "CLEAN",
    "RECONSTRUCTED",
    "FLAGGED_AMBIGUOUS",
    "FLAGGED_ANOMALY",
    "EXCLUDED_WITH_REASON",
]
CERTAINTIES = ["CONFIRMED", "INFERRED", "ESTIMATED", "UNRELIABLE"]


class Code(NamedTuple):
    status: str
    certainty: str


# --- fixed values: registered reason codes with their default status and certainty -------------
REASON_CODES: dict[str, Code] = {
    # any domain
    "DATE_PARSE_FAIL": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "DATE_FUTURE": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "DATE_BEFORE_RANGE": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "STATUS_UNMAPPED": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "ORPHAN_FK": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "NEGATIVE_QTY": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "NEGATIVE_AMOUNT": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "MISSING_REQUIRED_FIELD": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    # customer
    "IDENTITY_AMBIGUOUS": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "PLACEHOLDER_ID_COLLISION": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "FUZZY_MATCH_LOW_CONF": Code("EXCLUDED_WITH_REASON", "UNRELIABLE"),
    "EMAIL_MALFORMED": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "PHONE_NORMALISATION_FAIL": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    # product
    "SKU_PRODUCT_MISMATCH": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "SKU_NOT_IN_CATALOGUE": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "PRODUCT_FUZZY_MATCH": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "PRODUCT_NAME_CONFLICT": Code("FLAGGED_ANOMALY", "INFERRED"),
    # inventory
    "RECONSTRUCTED_SNAPSHOT": Code("RECONSTRUCTED", "INFERRED"),
    "MISSING_SNAPSHOT_DAY": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "ATP_POSITIVE_PHYSICAL_ZERO": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "OPEN_BOX_AS_NEW": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "RESTOCK_BEFORE_INSPECTION": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "MOVEMENT_NULL_REF": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "OVERSELL": Code("FLAGGED_ANOMALY", "INFERRED"),
    # sales, payments, delivery, returns
    "CANCELLED_WITH_REVENUE": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "PAYMENT_AFTER_CANCEL": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "TAX_INCLUSION_MISMATCH": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "DELIVERY_BEFORE_SHIP": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "COURIER_CLOCK_DRIFT": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "BOPIS_NO_PICKUP_EVENT": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "REFUND_PARTIAL_PERIOD_AMBIGUITY": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
    "ATTRIBUTION_SESSION_BRIDGE": Code("CLEAN", "INFERRED"),
    # classifieds, marketplace, reviews, support
    "NL_SELLER_SOLD_AS_REVENUE": Code("FLAGGED_ANOMALY", "ESTIMATED"),
    "RELISTED_AFTER_SOLD": Code("FLAGGED_ANOMALY", "INFERRED"),
    "IMAGE_HASH_REUSED": Code("FLAGGED_ANOMALY", "INFERRED"),
    "REVIEW_BEFORE_DELIVERY": Code("FLAGGED_ANOMALY", "UNRELIABLE"),
    "DUPLICATE_CASE": Code("FLAGGED_ANOMALY", "INFERRED"),
    "ESTIMATED_NL_GMV": Code("CLEAN", "ESTIMATED"),
    "LISTING_LOW_CONFIDENCE": Code("FLAGGED_AMBIGUOUS", "UNRELIABLE"),
    "SELLER_HIGH_RISK": Code("FLAGGED_ANOMALY", "INFERRED"),
    "MANUAL_CHANNEL_ATTRIBUTION": Code("FLAGGED_AMBIGUOUS", "INFERRED"),
}

# --- fixed values: registered resolution methods ------------------------------------------------
RESOLUTION_METHODS = [
    "ZEROED_CANCELLED_REVENUE",
    "FLAGGED_REVERSAL_REQUIRED",
    "NORMALISED_TAX_EXCLUSIVE",
    "RELABELLED_ESTIMATED_GMV",
    "CORRECTED_ATP_TO_ZERO",
    "ZEROED_RESTOCK_PRE_INSPECTION",
    "RECONSTRUCTED_SNAPSHOT",
    "APPLIED_CANONICAL_PRODUCT",
    "CORRECTED_CONDITION_OPEN_BOX",
    "REKEYED_GUEST_BUCKET",
    "LINKED_RELISTING_EXCLUDED",
    "FLAGGED_FRAUD_RING",
    "CORRECTED_DELIVERY_TS",
    "ESCALATED_MANUAL_REVIEW",
    "SET_VERIFIED_PURCHASE_FALSE",
    "DEDUPED_CANONICAL_CASE",
    "B_DECISION_APPLIED",
]

# --- fixed values: canonical order states and the curated source codes --------------------------
CANONICAL_STATUSES = [
    "OPEN", "CONFIRMED", "IN_FULFILMENT", "DELIVERED", "CANCELLED", "RETURNED", "REFUNDED",
]
UNMAPPED = "UNMAPPED"

STATUS_MAP = {
    "POS": {
        "OPN": "OPEN", "CMP": "CONFIRMED", "ABT": "CANCELLED",
        "RFD": "REFUNDED", "VOD": "CANCELLED", "HLD": "OPEN",
    },
    "EC": {
        "PENDING": "OPEN", "PROCESSING": "OPEN", "CONFIRMED": "CONFIRMED",
        "PICKED": "IN_FULFILMENT", "PACKED": "IN_FULFILMENT", "SHIPPED": "IN_FULFILMENT",
        "DELIVERED": "DELIVERED", "CANCELLED": "CANCELLED", "RETURNED": "RETURNED",
    },
    "PG": {
        "INITIATED": "OPEN", "AUTHORIZED": "OPEN", "CAPTURED": "CONFIRMED",
        "FAILED": "CANCELLED", "REVERSED": "REFUNDED", "DISPUTED": "OPEN",
        "PENDING": "OPEN", "REFUNDED": "REFUNDED",
    },
    "MARKETPLACE": {
        "ACTIVE": "OPEN", "SUSPENDED": "CANCELLED", "BANNED": "CANCELLED",
        "PENDING": "OPEN", "TERMINATED": "CANCELLED",
    },
}

# --- fixed values: channels, funnel steps, tiers, conditions, return reasons --------------------
CHANNELS = [
    # code, name, platform controlled
    ("STORE", "Physical Store", True),
    ("EC", "Ecommerce", True),
    ("BOPIS", "Buy Online, Pick Up In Store", True),
    ("MARKETPLACE_FBN", "Marketplace (platform fulfilled)", True),
    ("MARKETPLACE_SF", "Marketplace (seller fulfilled)", False),
    ("CLASSIFIEDS", "Classified listings", False),
]
FUNNEL_STEPS = [
    # code, sequence, is the conversion step
    ("AWARENESS", 1, False),
    ("CONSIDERATION", 2, False),
    ("INTENT", 3, False),
    ("CONVERSION", 4, True),
    ("POST_PURCHASE", 5, False),
]
RISK_TIERS = [
    # tier, lowest trust score, moderation required, listing visibility in percent
    ("VERIFIED_TRUSTED", 0.85, False, 100),
    ("STANDARD", 0.65, False, 100),
    ("UNDER_REVIEW", 0.40, True, 50),
    ("HIGH_RISK", 0.20, True, 20),
    ("SUSPENDED", 0.0, True, 0),
]
CONDITION_GROUPS = {
    "SEALED": "NEW", "NEW": "NEW", "OPENED": "OPEN_BOX", "OPEN_BOX": "OPEN_BOX",
    "REFURBISHED": "REFURBISHED", "USED": "USED", "DAMAGED": "DAMAGED",
}
RETURN_REASONS = [
    # reason, group, channel at fault
    ("DEFECTIVE", "Product Quality", "PLATFORM"),
    ("WRONG_ITEM", "Wrong Item", "WAREHOUSE"),
    ("CHANGED_MIND", "Change of Mind", "NONE"),
    ("NOT_AS_DESCRIBED", "Not as Described", "SELLER"),
    ("LATE_DELIVERY", "Delivery Issue", "COURIER"),
    ("DAMAGED_IN_TRANSIT", "Delivery Issue", "COURIER"),
    ("SELLER_ERROR", "Seller Issue", "SELLER"),
]
SELLER_SHIPPED = ["MARKETPLACE_SELLER", "NL_SELLER_HANDOFF", "SELLER", "MARKETPLACE"]

# --- fixed values: event synonyms, signal weights, thresholds -----------------------------------
CART_EVENTS = ["ADD_TO_CART", "CART_ADD", "ADD_CART"]
CHECKOUT_EVENTS = ["CHECKOUT_INIT", "CHECKOUT_START", "CHECKOUT_INITIATED"]
PURCHASE_EVENTS = ["CHECKOUT_COMPLETE", "PURCHASE", "ORDER_CONFIRMED", "ORDER_PLACED"]
SIGNAL_WEIGHTS = {  # both spellings of a chat signal carry the chat weight
    "SELLER_SOLD": "0.60", "OFFER_ACC": "0.30", "PHN_REVEAL": "0.15",
    "CHAT": "0.08", "CHAT_START": "0.08",
}
CONTACT_EVENTS = ["CHAT", "CHAT_START", "PHN_REVEAL", "OFFER_ACC"]
GMV_BAND = ("0.65", "1.35")
TRUST_WEIGHTS = {
    "cancellation": 0.20, "late": 0.20, "complaint": 0.15, "duplicate": 0.12,
    "report": 0.10, "return": 0.10, "moderation": 0.08, "response": 0.05,
}
LISTING_WEIGHTS = {
    "response": 0.30, "price": 0.30, "age": 0.20, "relist": 0.10, "report": 0.10,
}
ATTRIBUTION_CONFIDENCE = 0.85
SESSION_WINDOW_HOURS = 2
ON_TIME_HOURS = 120
REVIEW_BEYOND_HOURS = 72
FALLBACK_TRANSIT_HOURS = 36
RELIST_WINDOW_DAYS = 30
MATCHED_FROM, REVIEW_FROM = 0.75, 0.65
LOW_CONFIDENCE = 0.30
ADDITIVE_TOLERANCE = "0.01"


def status_rank(label: str) -> int:
    return _rank(STATUSES, label, "data_quality_status")


def certainty_rank(label: str) -> int:
    return _rank(CERTAINTIES, label, "metric_certainty_level")


def _rank(labels: list[str], label: str, what: str) -> int:
    if label not in labels:
        raise ValueError(f"{label!r} is not a {what}; use one of {labels}")
    return labels.index(label)


def registered(code: str) -> Code:
    if code not in REASON_CODES:
        raise ValueError(f"{code!r} is not a registered reason code")
    return REASON_CODES[code]


def registered_method(method: str) -> str:
    if method not in RESOLUTION_METHODS:
        raise ValueError(f"{method!r} is not a registered resolution method")
    return method

# a session of a customer without an account
GUEST_SESSION = "SESS-GUEST-"

# the project's years: no date outside them gets a calendar row
CALENDAR = ("1990-01-01", "2009-12-31")
