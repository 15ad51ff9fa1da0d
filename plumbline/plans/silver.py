"""The cleaned layer: one line of configuration per source table.

Every table gets typed dates (the raw text stays in <column>_raw), a surrogate key, the four
quality columns, and the flags its own rules raise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from plumbline import vocab
from plumbline.functions.dates import parse
from plumbline.functions.keys import surrogate_key
from plumbline.operators.commerce import TaxBasis, apply_status_map
from plumbline.operators.quality import Rule, add_anomaly_columns, date_parse_rule, flag, universal_rules

CHANNEL_CODES = [c for c, _, _ in vocab.CHANNELS]


@dataclass(frozen=True)
class Spec:
    key: list[str]
    dates: dict[str, str] = field(default_factory=dict)
    rules: Callable[[], list[Rule]] = list
    status: tuple[str, str] | None = None  # (source system, column) to map
    basis: TaxBasis | None = None


SILVER: dict[str, Spec] = {
    # lookups pass through with a key and the quality columns
    "ec_order_status_codes": Spec(["status_code"]),
    "ec_delivery_methods": Spec(["method_code"]),
    "pg_instrument_types": Spec(["type_code"]),
    "pos_stores": Spec(["store_id"]),
    "rr_return_reasons": Spec(["reason_code"]),
    "ws_event_types": Spec(["event_type_code"]),
    "dc_carriers": Spec(["carrier_code"]),
    "dc_event_types": Spec(["event_type_code"]),
    "pc_products": Spec(["sku"], rules=lambda: universal_rules(amounts=["list_price"], required=["product_name"])),
    # orders, payments, store sales
    "ec_orders": Spec(["order_id"], {"order_date": "iso_date", "created_at": "iso_timestamp"},
                      status=("EC", "order_status")),
    "ec_order_lines": Spec(["order_id", "line_id"]),
    "ec_order_status_history": Spec(["history_id"], {"status_timestamp": "iso_timestamp"}),
    "pg_transactions": Spec(["transaction_id"], {"created_ts": "epoch_seconds", "captured_ts": "epoch_seconds"},
                            status=("PG", "status_code")),
    "pos_transactions": Spec(["txn_id"], {"txn_date": "day_slash"}, status=("POS", "status_code")),
    "pos_transaction_lines": Spec(["txn_id", "line_no"], basis=TaxBasis("total_amount_incl_tax", "tax_amount")),
    # delivery
    "dc_shipments": Spec(["shipment_id"], {"created_datetime": "iso_timestamp"}),
    "dc_delivery_events": Spec(["event_id"], {"event_timestamp": "iso_timestamp"}),
    # returns
    "rr_return_requests": Spec(["return_authorization_id"], {"return_request_date": "day_month_name"}),
    "rr_return_receipts": Spec(["receipt_id"], {"received_date": "iso_date"}),
    "rr_refund_events": Spec(["refund_id"], {"refund_date": "iso_date"}),
    # stock
    "si_inventory_snapshots": Spec(["store_id", "product_code", "snapshot_date_raw"],
                                   {"snapshot_date": "day_slash"}),
    "si_inventory_movements": Spec(["movement_id"], {"movement_date": "day_slash"}),
    "wh_inventory_snapshots": Spec(["warehouse_id", "sku", "snapshot_date_raw"],
                                   {"snapshot_date": "iso_date"}),
    "wh_inventory_movements": Spec(["movement_id"], {"movement_datetime": "iso_timestamp"}),
    # click stream
    "ws_sessions": Spec(["session_id"], {"session_start_ts": "iso_timestamp", "session_end_ts": "iso_timestamp"}),
    "ws_page_events": Spec(["session_id", "event_id"], {"event_timestamp": "iso_timestamp"}),
    # classifieds and marketplace
    "nl_user_accounts": Spec(["account_id"], {"created_at": "iso_timestamp"}),
    "nl_listings": Spec(["listing_id"], {"created_at": "iso_timestamp", "updated_at": "iso_timestamp"},
                        rules=lambda: [Rule("RELISTED_AFTER_SOLD", F.col("relist_count") > 0)]),
    "nl_listing_events": Spec(["listing_id", "event_id"], {"event_timestamp": "iso_timestamp"}),
    "ts_seller_listings": Spec(["listing_id"]),
    "ts_sellers": Spec(["seller_id"], status=("MARKETPLACE", "seller_status")),
    "ts_marketplace_orders": Spec(["marketplace_order_id"], {"fulfilled_at": "iso_timestamp"}),
    "ts_safety_reports": Spec(["report_id"]),
    "ts_risk_signals": Spec(["signal_id"]),
    # reviews and support
    "rv_reviews": Spec(["review_id"], {"review_datetime": "iso_timestamp"}),
    "cs_cases": Spec(["case_id"], {"created_datetime": "slash_minute", "resolved_datetime": "slash_minute"},
                     rules=lambda: universal_rules(channel="channel_attribution", known_channels=CHANNEL_CODES)),
    "cs_case_events": Spec(["case_id", "event_seq"]),
    "cl_customers": Spec(["source_id"]),
}


def typed(df: DataFrame, dates: dict[str, str]) -> DataFrame:
    """Parse text dates by layout, keeping the text."""
    if not dates:
        return df
    raw = df.withColumnsRenamed({c: f"{c}_raw" for c in dates})
    return raw.withColumns({c: parse(f"{c}_raw", layout) for c, layout in dates.items()})


def clean(name: str, source: DataFrame) -> DataFrame:
    spec = SILVER[name]
    df = typed(source, spec.dates).withColumn(f"{name}_sk", surrogate_key(*spec.key))
    df = flag(
        add_anomaly_columns(df),
        [date_parse_rule(f"{c}_raw", c) for c in spec.dates] + spec.rules(),
    )
    return apply_status_map(df, *spec.status) if spec.status else df
