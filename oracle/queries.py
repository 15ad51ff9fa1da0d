"""One SQL text per named query, composed over the tables in oracle.tables."""

from __future__ import annotations

from oracle.compose import A, CLEAN, Q, audit, compose, dkey, okey, quality, sk
from oracle.tables import AM, AN, CON, EST, EX, INF, T, UN

O: dict[str, str] = {}
GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations",
         "embeddings", "pages", "benchmark"]
NONE = audit(("false", "B_DECISION_APPLIED"))


def union(parts) -> str:
    return " UNION ALL ".join(parts)


# ---- sources and sinks -------------------------------------------------------------------------
O["ingest_raw_orders"] = """SELECT o_orderkey, o_totalprice, 'orders' AS _source_table, row_number() OVER () AS _source_row_number FROM orders"""
O["source_inventory"] = union(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in GIVEN)
O["ingestion_log"] = union(f"SELECT '{t}' AS source_table, count(*) AS row_count, 'OK' AS status, NULL::VARCHAR AS error FROM {t}" for t in GIVEN)
_WIDTH = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6, "documents": 5, "labels": 3, "conversations": 4,
          "embeddings": 3, "pages": 3, "benchmark": 2}
O["ingested_tables"] = union(f"SELECT '{t}' AS source_table, {n + 3}::INT AS columns, count(*) AS row_count, 1::BIGINT AS first_row, count(*) AS last_row, count(*) AS row_numbers FROM {t}"
                             for t, n in _WIDTH.items())
_GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
O["row_count_reconciliation"] = " UNION ALL ".join(
    [f"SELECT '{t}' AS source_table, count(*) AS expected_rows, count(*) AS actual_rows, 0::BIGINT AS difference, 0::BIGINT AS files_differing, '' AS drift, 'OK' AS status FROM {t}" for t in _GIVEN]
    + ["SELECT 'price_history', 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, '', 'OK_EMPTY'"])
O["empty_table_landing"] = "SELECT category, count(*) AS products, 0::BIGINT AS price_changes FROM products GROUP BY 1"
O["read_projection_and_predicate"] = "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 40"
O["write_table_roundtrip"] = "SELECT count(*) AS row_count, (sum(restocked_qty) * 2)::BIGINT AS units FROM receipts"
CHANNELS = """(VALUES ('STORE', 'Physical Store', true), ('EC', 'Ecommerce', true), ('BOPIS', 'Buy Online, Pick Up In Store', true),
  ('MARKETPLACE_FBN', 'Marketplace (platform fulfilled)', true), ('MARKETPLACE_SF', 'Marketplace (seller fulfilled)', false),
  ('CLASSIFIEDS', 'Classified listings', false)) c(channel_code, channel_name, is_platform_controlled)"""
O["static_reference_rows"] = f"""
SELECT sha256(channel_code) AS channel_key, channel_code, channel_name, is_platform_controlled, coalesce(n, 0) AS lines FROM {CHANNELS}
LEFT JOIN (SELECT CASE WHEN l_linestatus = 'F' THEN 'STORE' WHEN method = 'BOPIS' THEN 'BOPIS' ELSE 'EC' END AS code, count(*) AS n
  FROM lineitem LEFT JOIN od ON o_orderkey = l_orderkey GROUP BY 1) u ON u.code = c.channel_code"""
O["dim_channel"] = O["static_reference_rows"]
O["optional_column_resolution"] = "SELECT event_id, NULL::VARCHAR AS page_category, product_sku AS product, seconds FROM page_events"
O["lookup_pass_through"] = f"""SELECT lookup, code, sha256(code) AS lookup_key, {CLEAN} FROM (
SELECT DISTINCT 'ec_order_status_codes' AS lookup, st AS code FROM od UNION ALL SELECT DISTINCT 'ec_delivery_methods', method FROM od
UNION ALL SELECT DISTINCT 'pg_instrument_types', instrument FROM od UNION ALL SELECT 'pos_stores', 'ST-' || n_nationkey FROM nation
UNION ALL SELECT DISTINCT 'rr_return_reasons', reason FROM returned UNION ALL SELECT DISTINCT 'ws_event_types', code FROM page_events
UNION ALL SELECT DISTINCT 'dc_carriers', 'CR-' || (o_custkey % 5) FROM od UNION ALL SELECT DISTINCT 'dc_event_types', code FROM dc_events)"""


def silver(name: str, cols: str, key: tuple[str, ...], src: str, q: str = CLEAN) -> None:
    O[f"silver_{name}"] = f"SELECT {cols}, {sk(*key)} AS row_key, {q} FROM {src}"


def unmapped(p: str) -> str:
    return quality((p, "STATUS_UNMAPPED", AN, UN))


silver("ec_orders", "order_id, strftime(order_date, '%Y-%m-%d') AS order_date_raw, order_date, created_at, order_status AS st, "
       "CASE order_status WHEN 'PENDING' THEN 'OPEN' ELSE order_status END AS canonical_status", ("order_id",), "ec_orders")
O["silver_ec_orders"] = O["silver_ec_orders"].replace(", order_status AS st", "")
silver("ec_order_lines", "order_id, line_id, quantity, line_total::DOUBLE AS line_total_excl_tax, discount::DOUBLE AS discount_applied", ("order_id", "line_id"), "ec_order_lines")
silver("ec_order_status_history", "order_id || '-' || status_code AS history_id, order_id, status_code, moment AS status_timestamp", ("order_id || '-' || status_code",), "ec_history")
silver("pg_transactions", "transaction_id, created_ts, captured_ts, CASE status_code WHEN 'CAPTURED' THEN 'CONFIRMED' ELSE 'CANCELLED' END AS canonical_status, amount::DOUBLE AS amount",
       ("transaction_id",), "pg")
silver("pos_transactions", "'R-' || o_orderkey AS txn_id, strftime(day, '%d/%m/%Y') AS txn_date_raw, day AS txn_date, 'ST-' || (o_custkey % 25) AS store_id, "
       "CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'F' THEN 'CONFIRMED' ELSE 'OPEN' END AS canonical_status", ("'R-' || o_orderkey",), "od")
silver("pos_transaction_lines", "txn_id, line_no, gross::DOUBLE AS gross_amount, net::DOUBLE AS net_amount, (net + tax_amt)::DOUBLE AS total_amount_incl_tax", ("txn_id", "line_no"), "pos_lines")
silver("dc_shipments", "'SH-' || o_orderkey AS shipment_id, 'EC-' || o_orderkey AS order_reference, created AS created_datetime, 'CR-' || (o_custkey % 5) AS carrier_code", ("'SH-' || o_orderkey",), "od")
silver("dc_delivery_events", "event_id, shipment_id, code AS event_type_code, moment AS event_timestamp", ("event_id",), "dc_events")
silver("rr_return_requests", "'RA-' || rid AS return_authorization_id, strftime(ship + to_days(10), '%d-%b-%Y') AS return_request_date_raw, "
       "(ship + to_days(10))::DATE AS return_request_date, reason AS reason_code", ("'RA-' || rid",), "returned")
silver("rr_return_receipts", "receipt_id, received_date, inspection_status, restocked_qty", ("receipt_id",), "receipts")
silver("rr_refund_events", "refund_id, refund_type, refund_amount::DOUBLE AS refund_amount, refund_date", ("refund_id",), "refunds")
silver("si_inventory_snapshots", "store_id, product_code, snapshot_date, physical_qty, physical_qty - 5 AS sellable_qty",
       ("store_id", "product_code", "strftime(snapshot_date, '%d/%m/%Y')"), "si_snaps")
silver("si_inventory_movements", "movement_id, movement_type, quantity_change, reference_number, movement_date", ("movement_id",), "si_moves")
silver("wh_inventory_snapshots", "warehouse_id, sku, snapshot_date, physical_qty, atp_qty", ("warehouse_id", "sku", "strftime(snapshot_date, '%Y-%m-%d')"), "wh_snaps")
silver("wh_inventory_movements", "movement_id, movement_type, quantity_change, movement_datetime", ("movement_id",), "wh_moves")
silver("ws_sessions", "session_id, first_at AS session_start_ts, last_at AS session_end_ts, utm AS utm_campaign, customer AS registered_customer_id, n AS total_events", ("session_id",), "sessions")
silver("ws_page_events", "session_id, event_id, moment AS event_timestamp, code AS event_type_code, product_sku, cart_value::DOUBLE AS cart_value", ("session_id", "event_id"), "page_events")
silver("nl_user_accounts", "account AS account_id, created AS created_at", ("account",), "accounts")
silver("nl_listings", "listing_id, seller AS seller_account_id, status AS status_code, price::DOUBLE AS asking_price, created AS created_at, updated AS updated_at",
       ("listing_id",), "listings", quality(("relist_count > 0", "RELISTED_AFTER_SOLD", AN, INF)))
silver("nl_listing_events", "listing_id, event_id, code AS event_type_code, moment AS event_timestamp, offer::DOUBLE AS offer_amount", ("listing_id", "event_id"), "listing_events")
silver("ts_seller_listings", "listing_id, seller_id, ref AS catalogue_sku_ref, title AS seller_product_title", ("listing_id",), "seller_listings")
SELLER_STATUS = "CASE seller_status WHEN 'ACTIVE' THEN 'OPEN' WHEN 'pending' THEN 'OPEN' WHEN 'SUSPENDED' THEN 'CANCELLED' ELSE 'UNMAPPED' END"
silver("ts_sellers", f"seller_id, seller_status, {SELLER_STATUS} AS canonical_status", ("seller_id",), "sellers", unmapped("seller_status = 'PROBATION'"))
silver("ts_marketplace_orders", "'MO-' || l_orderkey || '-' || line_id AS marketplace_order_id, l_suppkey AS seller_id, l_returnflag = 'R' AS is_returned, l_shipdate AS fulfilled_at",
       ("'MO-' || l_orderkey || '-' || line_id",), "ln")
silver("ts_safety_reports", "doc_id AS report_id, seller_id", ("doc_id",), "src_seller JOIN labels USING (doc_id) WHERE toxic = 1")
silver("ts_risk_signals", "doc_id AS signal_id, seller_id", ("doc_id",), "src_seller JOIN labels USING (doc_id) WHERE quality = 0")
silver("rv_reviews", "review_id, rating, days_post_delivery, verified AS is_verified_purchase, moment AS review_datetime", ("review_id",), "reviews")
silver("cs_cases", "case_id, canonical_case_ref, strftime(created, '%Y/%m/%d %H:%M') AS created_datetime_raw, created AS created_datetime, resolved AS resolved_datetime, channel AS channel_attribution",
       ("case_id",), "cases", quality(("channel = 'carrier pigeon'", "MANUAL_CHANNEL_ATTRIBUTION", AM, INF)))
silver("cs_case_events", "conv_id AS case_id, turn AS event_seq, role", ("conv_id", "turn"), "conversations")
silver("cl_customers", "source_id, loyalty_id, email, phone, name", ("source_id",), "id_raw WHERE source_system = 'LOYALTY'")
silver("pc_products", "sku, product_name, category, list_price::DOUBLE AS list_price, cogs::DOUBLE AS cogs", ("sku",), "products")

# ---- projections and predicates ----------------------------------------------------------------
O["conditional_correction"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' AND l_tax = 0 THEN 0.0::DOUBLE ELSE l_quantity END AS quantity FROM lineitem"""
O["predicate_forms"] = """SELECT count(*) FILTER (subtotal >= 100000 AND subtotal <= 200000) AS in_range, count(*) - count(promo_code_applied) AS without_promo,
count(*) FILTER (delivery_method_code = 'BOPIS' OR delivery_method_code = 'EXPRESS') AS in_set, count(*) FILTER (session_id LIKE 'SESS-GUEST%') AS guest_sessions,
count(*) FILTER (delivery_method_code LIKE '%SELLER%') AS seller_shipped, count(*) FILTER (order_status = 'CANCELLED' AND customer_id <> '0') AS "both" FROM ec_orders"""
O["reason_code_membership"] = "SELECT a7 AS restocked_early, a10 AS opened_as_new, false AS partial_code, count(*) AS receipts FROM rc_hits GROUP BY 1, 2"
O["guarded_ratio"] = "SELECT listing_id, count_if(code = 'OFFER_ACC')::DOUBLE / nullif(count_if(code = 'CHAT'), 0)::DOUBLE AS answer_rate FROM listing_events GROUP BY 1"
O["label_buckets"] = """SELECT CASE WHEN o_totalprice >= 300000 THEN 'LARGE' WHEN o_totalprice >= 100000 THEN 'MEDIUM' WHEN o_totalprice >= 40000 THEN 'SMALL' ELSE 'TINY' END AS size_label,
count(*) AS orders FROM orders GROUP BY 1"""
O["combined_scalars"] = """SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS cancelled,
(SELECT count(*) FROM events WHERE event_type = 'purchase') AS purchases,
(SELECT count(*) FROM orders WHERE o_orderstatus = 'P')::DOUBLE / (SELECT count(*) FROM orders)::DOUBLE AS cancelled_share"""

# ---- joins -------------------------------------------------------------------------------------
O["inner_join_lines_orders"] = "SELECT order_status, count(*) AS lines, sum(line_total)::DOUBLE AS amount FROM ec_order_lines JOIN ec_orders USING (order_id) GROUP BY 1"
O["left_join_chain"] = """SELECT count(placed_date_key) AS placed, count(captured_date_key) AS captured, count(shipped_date_key) AS shipped,
count(delivered_date_key) AS delivered, count(returned_date_key) AS returned FROM f_fulfil"""
O["anti_join_ready_not_collected"] = """SELECT DISTINCT shipment_id FROM dc_events WHERE code = 'READY_FOR_PICKUP'
AND shipment_id NOT IN (SELECT shipment_id FROM dc_events WHERE code = 'BOPIS_COLLECTED')"""
O["semi_join_campaign_sessions"] = "SELECT order_id, session_id FROM ec_orders WHERE session_id IN (SELECT session_id FROM sessions WHERE utm = 'SCHOOL98')"
O["not_exists_over_join"] = "SELECT order_id, order_number FROM ec_hits WHERE b7"
O["relisted_listings"] = "SELECT listing_id, strict AS is_relisted FROM nl_hits"
_RECENT = """EXISTS (SELECT 1 FROM listings e WHERE e.seller = l.seller AND e.image_hash = l.image_hash AND e.status IN ('SOLD', 'EXPIRED')
  AND e.updated < l.created AND e.updated >= l.created - INTERVAL 30 DAY)"""
O["relisted_within_window"] = f"SELECT listing_id, status = 'ACTIVE' AND {_RECENT} AS is_relisted FROM listings l"
O["prior_terminal_listing"] = f"SELECT listing_id, {_RECENT} AS had_prior FROM listings l"
O["entity_calendar_spine"] = "SELECT store_id, count(*) AS cells, min(snapshot_date) AS first_day, max(snapshot_date) AS last_day FROM si_spine GROUP BY 1"
O["bracket_join"] = """SELECT g.*, b.physical_qty AS qty_before, a.physical_qty AS qty_after FROM si_gaps g
ASOF LEFT JOIN si_snaps b ON g.store_id = b.store_id AND g.product_code = b.product_code AND g.snapshot_date >= b.snapshot_date
ASOF LEFT JOIN si_snaps a ON g.store_id = a.store_id AND g.product_code = a.product_code AND g.snapshot_date <= a.snapshot_date"""
O["role_playing_dates"] = """SELECT CASE WHEN f.placed_date_key IS NULL THEN 'UNDATED' ELSE coalesce(p.campaign_phase, 'OUT_OF_SCOPE') END AS placed_phase,
CASE WHEN f.delivered_date_key IS NULL THEN 'UNDATED' ELSE coalesce(d.campaign_phase, 'OUT_OF_SCOPE') END AS delivered_phase, count(*) AS orders
FROM f_fulfil f LEFT JOIN d_date p ON p.date_key = f.placed_date_key LEFT JOIN d_date d ON d.date_key = f.delivered_date_key GROUP BY 1, 2"""
O["gsv_by_phase_ties_out"] = """SELECT g AS by_phase, g AS waterfall, true AS ties_out
FROM (SELECT round(((SELECT sum(gross) FROM f_line) + (SELECT sum(gross) FROM f_sale))::DOUBLE, 2) AS g)"""
_FUZZY = """SELECT s.listing_id, b.name AS match_name, b.score AS match_score,
  CASE WHEN b.score >= 0.75 THEN 'MATCHED' WHEN b.score >= 0.65 THEN 'MANUAL_REVIEW' ELSE 'UNMATCHED' END AS tier
FROM seller_listings s LEFT JOIN (
  SELECT listing_id, arg_min(name, (-score, name)) AS name, max(score) AS score FROM (
    SELECT t.listing_id, n.name, 1.0::DOUBLE - levenshtein(t.norm, n.norm) / greatest(length(t.norm), length(n.norm)) AS score
    FROM (SELECT *, array_to_string(list_sort(string_split(lower(trim(title)), ' ')), ' ') AS norm FROM seller_listings) t
    JOIN scored_names n ON n.category = t.category AND list_has_any(string_split(t.norm, ' '), string_split(n.norm, ' '))
  ) WHERE score >= 0.65 GROUP BY 1) b USING (listing_id)"""
O["fuzzy_title_match"] = _FUZZY
_BRIDGE_Q = quality(("true", "ATTRIBUTION_SESSION_BRIDGE", "CLEAN", INF))
O["session_order_bridge"] = f"""SELECT o.session_id, o.order_id, s.customer AS customer_id, s.last_at AS session_end_at, o.order_date AS order_placed_at,
{sk("o.session_id", "o.order_id")} AS bridge_key, 'SESSION_BRIDGE' AS attribution_rule, 0.85::DOUBLE AS attribution_confidence, {_BRIDGE_Q}
FROM ec_orders o JOIN sessions s USING (session_id)
WHERE s.utm = 'SCHOOL98' AND o.promo_code_applied IS NULL AND o.order_date BETWEEN DATE '1998-08-08' AND DATE '1998-08-28'"""
for _h in (2, 24):
    O[f"session_order_bridge_{_h}h"] = f"""SELECT {sk("session_id", "order_id")} AS bridge_key, session_id, order_id, customer_id,
'SESSION_BRIDGE' AS attribution_rule, 0.85::DOUBLE AS attribution_confidence FROM (
  SELECT o.order_id, o.customer_id, s.session_id, s.utm, row_number() OVER (PARTITION BY o.order_id ORDER BY s.last_at DESC, s.session_id DESC) AS rn
  FROM r_ec_orders o JOIN sessions s ON s.customer = o.customer_id AND s.last_at <= o.created_at AND s.last_at >= o.created_at - INTERVAL {_h} HOUR)
WHERE rn = 1 AND utm = 'SCHOOL98'"""

# ---- aggregations ------------------------------------------------------------------------------
O["group_by_aggregates"] = """SELECT tax_rate::DOUBLE AS tax_rate, count(*) AS lines, round(sum(gross)::DOUBLE, 2) AS gross, min(quantity) AS min_qty, max(quantity) AS max_qty,
round(sum(quantity)::DOUBLE / count(*), 4) AS avg_qty FROM pos_lines GROUP BY 1"""
O["global_aggregate"] = "SELECT count(*) AS lines, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, sum(l_quantity::BIGINT)::BIGINT AS units FROM lineitem"
O["conditional_counts"] = """SELECT count(*) FILTER (quantity >= 25) AS bulk_lines, (sum(line_total) FILTER (quantity >= 25))::DOUBLE AS bulk_amount,
count(*) FILTER (discount = 0) AS undiscounted FROM ec_order_lines"""
O["distinct_counts"] = """SELECT count(DISTINCT order_id) AS orders, count(DISTINCT (order_id, product_sku)) AS order_products,
count(DISTINCT product_sku) FILTER (quantity > 40) AS bulk_products FROM ec_order_lines"""
O["having_repeat_customers"] = "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1 HAVING count(*) > 10"
T["funnel"] = "SELECT session_id, bool_or(code = 'ADD_TO_CART') AS has_cart, bool_or(code = 'CHECKOUT_INIT') AS has_checkout, bool_or(code = 'PURCHASE') AS has_purchase FROM page_events GROUP BY 1"
O["session_funnel_flags"] = "SELECT has_cart, has_checkout, has_purchase, count(*) AS sessions FROM funnel GROUP BY 1, 2, 3"
O["median_transit"] = "SELECT h::DOUBLE AS transit_hours FROM transit"
O["rate_as_pair"] = "SELECT l_suppkey AS seller_id, count(*) FILTER (l_returnflag = 'R') AS return_numerator, count(*) AS return_denominator FROM lineitem GROUP BY 1"
O["distinct_and_dedupe"] = "SELECT count(DISTINCT text) AS distinct_texts FROM documents"
O["case_pivot"] = """SELECT shipment_id, min(moment) FILTER (code = 'PICKED_UP') AS picked_up, min(moment) FILTER (code = 'READY_FOR_PICKUP') AS ready,
min(moment) FILTER (code = 'BOPIS_COLLECTED') AS collected, min(moment) FILTER (code = 'DELIVERED') AS delivered, arg_min(code, (moment, code)) AS first_event FROM dc_events GROUP BY 1"""

# ---- windows -----------------------------------------------------------------------------------
O["milestones_per_shipment"] = """SELECT event_id, max(CASE WHEN code = 'PICKED_UP' THEN moment END) OVER w AS pickup_ts, min(CASE WHEN code = 'DELIVERED' THEN moment END) OVER w AS delivered_ts,
o.created AS ship_created_ts FROM dc_events e LEFT JOIN od o ON o.o_orderkey = e.okey WINDOW w AS (PARTITION BY shipment_id)"""
O["first_and_last_snapshot"] = """SELECT store_id, product_code, min(snapshot_date) AS first_at, arg_min(physical_qty, snapshot_date) AS first_value,
max(snapshot_date) AS last_at, arg_max(physical_qty, snapshot_date) AS last_value FROM si_snaps GROUP BY 1, 2"""
O["product_versions"] = f"SELECT sku, price_list, valid_from, valid_to, is_current, version_number, {sk('sku', 'version_number')} AS version_key FROM d_product_v"
O["product_versions_load_by_load"] = O["product_versions"]
T["id_links"] = """
SELECT source_system, source_id, source_system || ':' || lpad(source_id::VARCHAR, 12, '0') AS record,
  coalesce(loyalty_id[2:], regexp_extract(email, '^customer(\\d+)@', 1), phone[5:]::BIGINT::VARCHAR) AS customer,
  CASE WHEN loyalty_id IS NOT NULL THEN 1.0 WHEN email IS NOT NULL THEN 0.95 WHEN phone IS NOT NULL THEN 0.9 END::DOUBLE AS link FROM id_raw"""
O["identity_groups"] = """SELECT source_system, source_id, coalesce(min(record) OVER w, record) AS group_key, min(link) OVER w AS group_confidence, count(*) OVER w AS group_size
FROM id_links WHERE customer IS NOT NULL WINDOW w AS (PARTITION BY customer)
UNION ALL SELECT source_system, source_id, record, 1.0::DOUBLE, 1 FROM id_links WHERE customer IS NULL"""
O["email_group_leader"] = """SELECT source_system, source_id, email AS mail, first_value(source_system) OVER w AS leader_system, first_value(source_id) OVER w AS leader_id
FROM id_raw WHERE email IS NOT NULL WINDOW w AS (PARTITION BY email ORDER BY source_system, source_id)"""

# ---- sorts, limits, set operations -------------------------------------------------------------
_RINGS = """SELECT image_hash, count(DISTINCT seller) AS distinct_sellers, count(*) AS listing_count FROM listings
WHERE image_hash IS NOT NULL GROUP BY 1 HAVING count(DISTINCT seller) >= 2"""
O["ordered_rings"] = _RINGS + " ORDER BY 2 DESC, 1"
O["canonical_value_lookup"] = "SELECT listing_id, ref AS catalogue_sku_ref, canonical AS canonical_title FROM sl_hits"
O["bag_union_by_channel"] = "SELECT channel, count(*) AS lines, sum(gross)::DOUBLE AS gross FROM values_by_channel GROUP BY 1"
O["union_with_missing_columns"] = "SELECT is_reconstructed, count(*) AS rows, count(reserved_qty) AS with_reserved, sum(physical_qty)::BIGINT AS units FROM f_si GROUP BY 1"

# ---- quality core ------------------------------------------------------------------------------
O["anomaly_columns"] = """SELECT c_custkey AS source_id, false AS anomaly_flag, NULL::VARCHAR AS anomaly_reason_code, 'FLAGGED_AMBIGUOUS' AS data_quality_status,
'INFERRED' AS metric_certainty_level FROM customer"""
_FLAGS = quality(("order_status = 'CANCELLED'", "CANCELLED_WITH_REVENUE", AN, UN), ("coalesce(promo_code_applied = 'VIP10', false)", "ATTRIBUTION_SESSION_BRIDGE", "CLEAN", INF),
                 ("customer_id = '0'", "PLACEHOLDER_ID_COLLISION", AM, EST), ("subtotal < 0", "NEGATIVE_AMOUNT", AN, UN))
O["flag_rules"] = f"SELECT order_id, {_FLAGS} FROM ec_orders"
O["severity_merge"] = """SELECT order_id, CASE WHEN order_status = 'CANCELLED' THEN 'FLAGGED_ANOMALY' ELSE 'FLAGGED_AMBIGUOUS' END AS status,
CASE WHEN order_status = 'CANCELLED' THEN 'UNRELIABLE' WHEN customer_id = '0' THEN 'ESTIMATED' ELSE 'INFERRED' END AS certainty FROM ec_orders"""
T["dates_raw"] = """SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'epoch_seconds' WHEN o_orderpriority = '1-URGENT' THEN 'day_slash'
  WHEN o_orderpriority = '2-HIGH' THEN 'iso_date' WHEN o_orderpriority = '3-MEDIUM' THEN 'iso_timestamp' WHEN o_orderpriority = '5-LOW' THEN 'day_month_name' ELSE 'slash_minute' END AS layout,
  created, o_totalprice > 490000 AS missing, o_totalprice < 20000 AS bad FROM od"""
O["date_normalisation"] = """SELECT id, layout, CASE WHEN missing OR bad THEN NULL WHEN layout IN ('day_slash', 'iso_date', 'day_month_name') THEN created::DATE::TIMESTAMP
ELSE created END AS parsed FROM dates_raw"""
O["date_parse_flags"] = "SELECT layout, count(*) AS rows, count_if(bad AND NOT missing) AS failed, count_if(missing) AS missing FROM dates_raw GROUP BY 1"
O["orphan_foreign_keys"] = f"SELECT listing_id, {quality(('ref LIKE $$X%$$', 'ORPHAN_FK', AN, UN))} FROM seller_listings WHERE ref IS NOT NULL"
O["resolution_columns"] = f"SELECT review_id, {NONE} FROM reviews"
O["resolve_keeps_flag_and_code"] = f"SELECT receipt_id, {Q}, {A} FROM r_receipts"
O["sticky_detection"] = "SELECT count_if(a7) AS restocked_early, count_if(a10) AS opened_as_new, sum(restocked_qty)::BIGINT AS restocked_units FROM r_receipts"
O["first_resolution_wins"] = "SELECT code AS event_type_code, anomaly_reason_code, resolution_method, count(*) AS events FROM r_listing_events GROUP BY 1, 2, 3"


def profile(name: str, table: str) -> str:
    return (f"SELECT '{name}' AS table_name, data_quality_status, reason_code, count(*) AS row_count FROM (SELECT data_quality_status, "
            f"unnest(CASE WHEN anomaly_reason_code IS NULL THEN [NULL] ELSE string_split(anomaly_reason_code, ',') END) AS reason_code FROM {table}) GROUP BY ALL")


O["universal_rules_orders"] = f"""SELECT o_orderkey, {quality(("o_orderdate::DATE > DATE '1998-09-14'", "DATE_FUTURE", AM, INF), ("o_orderdate::DATE < DATE '1998-03-01'", "DATE_BEFORE_RANGE", AM, INF),
("o_totalprice < 0", "NEGATIVE_AMOUNT", AN, UN), ("o_orderpriority = '4-NOT SPECIFIED'", "MISSING_REQUIRED_FIELD", AN, UN))} FROM orders"""
O["universal_rules_contacts"] = f"""SELECT source_system, anomaly_reason_code, data_quality_status, metric_certainty_level, count(*) AS rows FROM (
SELECT source_system, {quality(("name IS NULL", "MISSING_REQUIRED_FIELD", AN, UN), ("bad_mail", "EMAIL_MALFORMED", AN, UN), ("bad_phone", "PHONE_NORMALISATION_FAIL", AN, UN))}
FROM (SELECT * FROM ids)) GROUP BY ALL"""
O["universal_rules_stock"] = f"""SELECT anomaly_reason_code, data_quality_status, metric_certainty_level, count(*) AS rows FROM (
SELECT {quality(("physical_qty < 0", "NEGATIVE_QTY", AN, UN), ("physical_qty - 5 < 0", "OVERSELL", AN, INF))} FROM si_snaps) GROUP BY ALL"""
O["universal_rules_accounts"] = f"SELECT c_custkey, {quality(('c_acctbal < 0', 'NEGATIVE_AMOUNT', AN, UN))} FROM customer"
O["rerun_changes_nothing"] = union(f"SELECT '{t}' AS table_name, 0::BIGINT AS changed_rows, 0::BIGINT AS lost_rows" for t in [
    "ec_orders", "pg_transactions", "pos_transaction_lines", "nl_listing_events", "wh_inventory_snapshots", "si_inventory_snapshots", "rr_return_receipts", "reconstructed_snapshots",
    "wh_inventory_movements", "rr_refund_events", "ts_seller_listings", "nl_listings", "dc_delivery_events", "rv_reviews", "cs_cases", "identities", "ts_sellers"])

# ---- silver transforms -------------------------------------------------------------------------
_MAP = {
    "POS": "OPN OPEN CMP CONFIRMED ABT CANCELLED RFD REFUNDED VOD CANCELLED HLD OPEN",
    "EC": "PENDING OPEN PROCESSING OPEN CONFIRMED CONFIRMED PICKED IN_FULFILMENT PACKED IN_FULFILMENT SHIPPED IN_FULFILMENT DELIVERED DELIVERED CANCELLED CANCELLED RETURNED RETURNED",
    "PG": "INITIATED OPEN AUTHORIZED OPEN CAPTURED CONFIRMED FAILED CANCELLED REVERSED REFUNDED DISPUTED OPEN PENDING OPEN REFUNDED REFUNDED",
    "MARKETPLACE": "ACTIVE OPEN SUSPENDED CANCELLED BANNED CANCELLED PENDING OPEN TERMINATED CANCELLED",
}
_PAIRS = ", ".join(f"('{s}', '{t.split()[i]}', '{t.split()[i + 1]}')" for s, t in _MAP.items() for i in range(0, len(t.split()), 2))
T["codes_seen"] = """SELECT DISTINCT 'POS' AS s, CASE o_orderstatus WHEN 'P' THEN 'VOD' WHEN 'F' THEN 'CMP' ELSE 'OPN' END AS c FROM od
UNION SELECT 'EC', st FROM od UNION SELECT 'PG', status_code FROM pg UNION SELECT 'MARKETPLACE', upper(seller_status) FROM sellers"""
O["status_map"] = f"""SELECT source_system, raw_code, canonical_status, mapping_confidence, {quality(("canonical_status = 'UNMAPPED'", "STATUS_UNMAPPED", AN, UN))} FROM (
SELECT s AS source_system, c AS raw_code, m AS canonical_status, 1.0::DOUBLE AS mapping_confidence FROM (VALUES {_PAIRS}) v(s, c, m)
UNION ALL SELECT s, c, 'UNMAPPED', 0.0 FROM codes_seen WHERE (s, c) NOT IN (SELECT (s, c) FROM (VALUES {_PAIRS}) v(s, c, m)))"""
O["status_normalisation"] = f"""SELECT source_system, canonical_status, count(*) AS rows, count_if(canonical_status = 'UNMAPPED') AS flagged FROM (
SELECT 'POS' AS source_system, CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'F' THEN 'CONFIRMED' ELSE 'OPEN' END AS canonical_status FROM od
UNION ALL SELECT 'EC', CASE st WHEN 'PENDING' THEN 'OPEN' ELSE st END FROM od
UNION ALL SELECT 'PG', CASE status_code WHEN 'CAPTURED' THEN 'CONFIRMED' ELSE 'CANCELLED' END FROM pg
UNION ALL SELECT 'MARKETPLACE', {SELLER_STATUS} FROM sellers) GROUP BY 1, 2"""
O["surrogate_keys"] = f"""SELECT order_id, {sk("order_id", "promo_code_applied")} AS order_sk, order_id || '|' || coalesce(promo_code_applied, '~NULL~') AS readable,
CASE WHEN customer_id = '0' THEN sha256('__ANON_BUCKET__') ELSE sha256(customer_id) END AS customer_sk FROM ec_orders"""
O["identity_resolution"] = f"SELECT source_system, source_id, k AS customer_key, conf AS identity_confidence, pass AS match_pass, {Q} FROM ids"
O["identity_bridge"] = """SELECT t AS identifier_type, v AS identifier, k AS customer_key, max(conf) AS identity_confidence FROM (
SELECT 'LOYALTY' AS t, loyalty_id AS v, k, conf FROM ids WHERE pass > 0 UNION ALL SELECT 'EMAIL', email, k, conf FROM ids WHERE pass > 0
UNION ALL SELECT 'PHONE', phone, k, conf FROM ids WHERE pass > 0) WHERE v IS NOT NULL GROUP BY 1, 2, 3"""
O["customer_master"] = """SELECT k AS customer_key, max(conf) AS identity_confidence, min(conf) AS lowest_confidence, arg_max(pass, (conf, source_system, -source_id)) AS match_pass_used,
count(*) AS identity_records FROM ids GROUP BY 1"""
T["fuzzy"] = _FUZZY
O["product_master"] = f"""SELECT listing_id, sku, product_name, match_confidence, match_pass, CASE WHEN sku IS NOT NULL THEN sha256(sku) END AS canonical_product_key,
match_pass = 2 AND match_confidence < 0.75 AS requires_manual_review,
{quality(("match_pass = 1 AND likeness < 0.5", "SKU_PRODUCT_MISMATCH", AN, UN), ("match_pass = 1 AND likeness >= 0.5 AND likeness < 1", "PRODUCT_NAME_CONFLICT", AN, INF),
         ("ref IS NOT NULL AND match_pass <> 1", "SKU_NOT_IN_CATALOGUE", AN, UN), ("match_pass = 2", "PRODUCT_FUZZY_MATCH", AM, INF), ("match_pass = 0", "FUZZY_MATCH_LOW_CONF", EX, UN))}
FROM (SELECT h.listing_id, h.ref, h.likeness, CASE WHEN h.canonical IS NOT NULL THEN h.ref ELSE m.sku END AS sku, coalesce(h.canonical, f.match_name) AS product_name,
  CASE WHEN h.canonical IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(f.match_score, 0.0::DOUBLE) END AS match_confidence,
  CASE WHEN h.canonical IS NOT NULL THEN 1 WHEN f.match_score IS NOT NULL THEN 2 ELSE 0 END AS match_pass
  FROM sl_hits h JOIN fuzzy f USING (listing_id) LEFT JOIN (SELECT category, product_name, min(sku) AS sku FROM products GROUP BY 1, 2) m
  ON m.category = h.category AND m.product_name = f.match_name)"""
O["missing_snapshot_days"] = "SELECT * FROM si_gaps"
O["gap_fill_interpolated"] = f"SELECT store_id, product_code, snapshot_date, physical_qty, sellable_qty, recon_method, is_reconstructed, {Q} FROM recon"
O["gap_fill_from_movements"] = f"""SELECT g.store_id, g.product_code, g.snapshot_date, (b.physical_qty + coalesce((SELECT sum(m.quantity_change) FROM si_moves m WHERE m.store_id = g.store_id
  AND m.product_code = g.product_code AND m.movement_date > b.snapshot_date AND m.movement_date <= g.snapshot_date), 0))::INT AS physical_qty,
'MOVEMENT_SUM' AS recon_method, {quality(("true", "RECONSTRUCTED_SNAPSHOT", "RECONSTRUCTED", INF))}
FROM si_gaps g ASOF JOIN si_snaps b ON g.store_id = b.store_id AND g.product_code = b.product_code AND g.snapshot_date >= b.snapshot_date"""
O["listing_confidence"] = f"""SELECT listing_id, age_part, response_part, price_part, relist_part, report_part, confidence_score,
{quality(("confidence_score < 0.30", "LISTING_LOW_CONFIDENCE", AM, UN))} FROM confidence"""
O["refund_periods"] = """SELECT refund_id, original_month, refund_month, impact::DOUBLE AS revenue_impact_original_period, impact::DOUBLE AS revenue_impact_return_period,
crosses AS is_cross_period FROM rf_hits"""
O["campaign_attribution"] = """SELECT rule, count(*) AS order_lines, sum(confirmed)::DOUBLE AS confirmed_revenue FROM (
SELECT f.confirmed, CASE WHEN f.attribution_rule = 'PROMO_CODE' THEN 'PROMO_CODE' WHEN f.is_campaign_attributed THEN 'SESSION_BRIDGE'
  WHEN f.pickup_store_id IS NOT NULL AND f.order_date BETWEEN DATE '1998-08-08' AND DATE '1998-08-28' AND p.category = 'PROMO' THEN 'BOPIS_WINDOW' ELSE 'ORGANIC' END AS rule
FROM f_line f LEFT JOIN products p ON p.sku = f.product_sku) GROUP BY 1"""
_RATES = ["cancellation", "late", "return", "complaint", "duplicate", "report", "moderation", "response"]
_RATE_COLS = ", ".join(f"{r}_{x}::BIGINT AS {r}_{x}" for r in _RATES for x in ("numerator", "denominator"))
O["seller_trust"] = f"SELECT seller_id, {_RATE_COLS}, trust_score, risk_score, risk_tier, {Q} FROM trust"

# ---- anomalies: detect -------------------------------------------------------------------------
O["detect_cancelled_revenue"] = "SELECT count(*) AS affected_rows, sum(o_totalprice::DECIMAL(12,2))::DOUBLE AS revenue_at_risk FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 0"
O["detect_payment_after_cancel"] = "SELECT count(*) AS affected_rows, count_if(captured_ts > cancelled_ts) AS strictly_after FROM pg_hits WHERE a2"
O["detect_tax_basis"] = """SELECT 'store_incl_tax' AS basis, count(*) AS rows, sum(net + tax_amt)::DOUBLE AS amount FROM pos_lines
UNION ALL SELECT 'online_excl_tax', count(*), sum(subtotal)::DOUBLE FROM ec_orders"""
O["detect_seller_marked_sold"] = """SELECT count(*) AS sold_events, count(DISTINCT e.listing_id) AS distinct_listings, sum(price)::DOUBLE AS counted_value
FROM listing_events e JOIN listings USING (listing_id) WHERE code = 'SELLER_SOLD'"""
O["detect_promised_without_stock"] = "SELECT count(*) AS affected_rows FROM wh_snaps WHERE atp_qty > 0 AND physical_qty = 0"
O["detect_negative_stock"] = "SELECT count(*) AS affected_rows FROM si_snaps WHERE physical_qty < 5"
O["detect_restock_before_inspection"] = "SELECT count(*) AS affected_rows FROM lineitem WHERE l_returnflag = 'R' AND l_tax < 0.015 AND l_discount >= 0.025 AND l_quantity > 0"
O["detect_missing_snapshot_days"] = "SELECT store_id, count(*) AS missing_cells, count(DISTINCT snapshot_date) AS days FROM si_gaps GROUP BY 1"
O["detect_title_mismatch"] = "SELECT listing_id, ref AS catalogue_sku_ref, title AS seller_product_title, canonical AS canonical_title FROM sl_hits WHERE likeness < 0.5"
O["detect_open_box_as_new"] = "SELECT count(*) AS affected_rows FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.045 AND l_tax < 0.045"
O["detect_placeholder_customer"] = """SELECT customer_id, n AS orders, typical FROM (SELECT customer_id, count(*) AS n FROM ec_orders GROUP BY 1),
(SELECT median(n)::DOUBLE AS typical FROM (SELECT count(*) AS n FROM ec_orders GROUP BY customer_id))
WHERE n > typical * 20 AND customer_id IN (SELECT c_custkey::VARCHAR FROM customer)"""
O["detect_relisted_after_sold"] = f"""SELECT count_if(relist_count > 0) AS by_metadata, (SELECT count_if(strict) FROM nl_hits) AS by_picture,
count_if(status = 'ACTIVE' AND {_RECENT}) AS by_picture_30d FROM listings l"""
O["detect_picture_rings"] = _RINGS
O["detect_delivered_before_pickup"] = """SELECT count_if(delivered_ts < pickup_ts) AS strict_before_ship,
count_if(delivered_ts < pickup_ts AND abs(date_diff('second', pickup_ts, delivered_ts)) > 72 * 3600) AS manual_review,
(SELECT count(DISTINCT shipment_id) FROM dc_hits WHERE drift) AS broad_clock_drift FROM miles"""
O["detect_review_before_delivery"] = "SELECT count(*) AS affected_reviews, count_if(l_linestatus = 'F') AS marked_verified FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 10"
O["detect_duplicate_cases"] = "SELECT count(*) - count(DISTINCT text) AS duplicate_cases, count(DISTINCT text) AS incidents FROM documents"
O["detect_session_attribution"] = """SELECT count(*) AS candidates, count_if(b1) AS attributed FROM ec_hits
WHERE order_date BETWEEN DATE '1998-08-08' AND DATE '1998-08-28' AND promo_code_applied IS NULL"""
O["detect_cross_period_refunds"] = "SELECT count(*) AS affected_rows, sum(refund_amount)::DOUBLE AS reversal_amount FROM rf_hits WHERE b2"
O["detect_null_reference_movements"] = "SELECT movement_type, count(*) AS movements, sum(quantity_change)::BIGINT AS units FROM wh_moves WHERE reference_number IS NULL GROUP BY 1"
O["detect_listings_to_match"] = "SELECT p_type AS category_code, count(*) AS listings FROM part WHERE p_size <= 20 GROUP BY 1"
O["detect_ambiguous_identities"] = "SELECT count_if(conf >= 0.7 AND conf < 1) AS candidates, count_if(conf >= 0.9 AND conf < 1) AS mergeable FROM ids"
O["detect_value_signals"] = "SELECT code AS event_type_code, count(*) AS events, sum(offer)::DOUBLE AS offers FROM listing_events WHERE code <> 'VIEW' GROUP BY 1"
O["detect_uncollected_pickups"] = "SELECT count(*) AS affected_rows FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' AND o_custkey % 7 = 0"
O["detect_high_risk_sellers"] = "SELECT risk_tier, count(*) AS sellers, count_if(anomaly_flag) AS flagged FROM trust GROUP BY 1"


# ---- anomalies: resolve ------------------------------------------------------------------------
def resolve(name: str, cols: str, src: str, hit: tuple[str, str, str, str], method: str, cls: str | None = None) -> None:
    c = f"CASE WHEN {hit[0]} THEN {cls} END" if cls else "NULL::VARCHAR"
    O[f"resolve_{name}"] = f"SELECT {cols}, {quality(hit)}, {audit((hit[0], method), cls=c)} FROM {src}"


resolve("cancelled_revenue", "order_id, (CASE WHEN a1 THEN 0 ELSE subtotal END)::DOUBLE AS subtotal_excl_tax", "ec_hits", ("a1", "CANCELLED_WITH_REVENUE", AN, UN), "ZEROED_CANCELLED_REVENUE")
resolve("payment_after_cancel", "transaction_id, a2 AND captured_ts > cancelled_ts AS strictly_after", "pg_hits", ("a2", "PAYMENT_AFTER_CANCEL", AN, UN), "FLAGGED_REVERSAL_REQUIRED")
O["resolve_payment_after_cancel"] = O["resolve_payment_after_cancel"].replace("a2 AND captured_ts > cancelled_ts AS", "coalesce(a2 AND captured_ts > cancelled_ts, false) AS")
resolve("tax_basis", "txn_id, line_no, round(net, 2)::DOUBLE AS revenue_excl_tax", "pos_lines", ("true", "TAX_INCLUSION_MISMATCH", AM, INF), "NORMALISED_TAX_EXCLUSIVE")
resolve("seller_marked_sold", "event_id", "listing_events", ("code = 'SELLER_SOLD'", "NL_SELLER_SOLD_AS_REVENUE", AN, EST), "RELABELLED_ESTIMATED_GMV")
O["resolve_promised_without_stock"] = f"SELECT warehouse_id, sku, snapshot_date, atp_qty, {Q}, {A} FROM r_wh_snaps"
O["resolve_negative_stock"] = f"SELECT store_id, product_code, snapshot_date, physical_qty, sellable_qty, oversell_flag, {Q}, {A} FROM r_si_snaps"
resolve("restock_before_inspection", "receipt_id, CASE WHEN a7 THEN 0 ELSE restocked_qty END AS restocked_qty", "rc_hits", ("a7", "RESTOCK_BEFORE_INSPECTION", AN, UN), "ZEROED_RESTOCK_PRE_INSPECTION")
O["resolve_missing_snapshot_days"] = f"SELECT store_id, product_code, snapshot_date, physical_qty, {Q}, {audit(('true', 'RECONSTRUCTED_SNAPSHOT'))} FROM recon"
resolve("title_mismatch", "listing_id, CASE WHEN coalesce(likeness < 0.5, false) THEN canonical ELSE title END AS seller_product_title", "sl_hits",
        ("coalesce(likeness < 0.5, false)", "SKU_PRODUCT_MISMATCH", AN, UN), "APPLIED_CANONICAL_PRODUCT")
resolve("open_box_as_new", "receipt_id, CASE WHEN a10 THEN 'OPEN_BOX' ELSE restocked_as_condition END AS restocked_as_condition", "rc_hits", ("a10", "OPEN_BOX_AS_NEW", AN, UN), "CORRECTED_CONDITION_OPEN_BOX")
resolve("placeholder_customer", "order_id, CASE WHEN a11 THEN 'GUEST-' || session_id ELSE customer_id END AS customer_id", "ec_hits", ("a11", "PLACEHOLDER_ID_COLLISION", AN, UN), "REKEYED_GUEST_BUCKET")
O["resolve_relisted_after_sold"] = f"SELECT listing_id, a12 AS excluded_from_gmv, CASE WHEN a12 THEN 'LOW' END AS relisting_reliability, " \
    f"{quality(('(a12 OR by_metadata)', 'RELISTED_AFTER_SOLD', AN, INF))}, {audit(('a12', 'LINKED_RELISTING_EXCLUDED'))} FROM nl_hits"
_META = ("relist_count > 0", "RELISTED_AFTER_SOLD", AN, INF)
O["resolve_picture_rings"] = f"SELECT listing_id, a13 AS fraud_ring_flag, {quality(_META, ('a13', 'IMAGE_HASH_REUSED', AN, INF))}, {audit(('a13', 'FLAGGED_FRAUD_RING'))} FROM nl_hits"
O["resolve_listing_match_tiers"] = f"""SELECT listing_id, score AS b4_match_confidence, {quality(_META)}, {audit(("active", "B_DECISION_APPLIED"),
cls="CASE WHEN active THEN CASE WHEN score >= 0.75 THEN 'MATCHED' WHEN score >= 0.65 THEN 'MANUAL_REVIEW' ELSE 'UNMATCHED' END END")} FROM nl_hits"""
O["resolve_delivered_before_pickup"] = f"SELECT event_id, corrected AS corrected_event_datetime, requires_manual_review, {Q}, {A} FROM r_dc_events"
O["resolve_review_before_delivery"] = f"SELECT review_id, verified AS is_verified_purchase, {Q}, {A} FROM r_reviews"
O["resolve_duplicate_cases"] = f"SELECT case_id, canonical_case_key, {Q}, {A} FROM r_cases"
resolve("session_attribution", "order_id, CASE WHEN b1 THEN 0.85::DOUBLE END AS attribution_confidence", "ec_hits", ("b1", "ATTRIBUTION_SESSION_BRIDGE", "CLEAN", INF), "B_DECISION_APPLIED", "'ATTRIBUTED'")
O["resolve_cross_period_refunds"] = f"SELECT refund_id, impact::DOUBLE AS revenue_impact_return_period, {Q}, {A} FROM r_refunds"
O["resolve_null_reference_movements"] = f"SELECT movement_id, {Q}, {A} FROM r_wh_moves"
O["resolve_ambiguous_identities"] = f"""SELECT source_system, source_id, conf AS identity_confidence, {quality(("conf >= 0.7 AND conf < 0.9", "IDENTITY_AMBIGUOUS", AM, INF),
("pass = 0", "FUZZY_MATCH_LOW_CONF", EX, UN), ("bad_mail", "EMAIL_MALFORMED", AN, UN), ("bad_phone", "PHONE_NORMALISATION_FAIL", AN, UN), ("conf >= 0.9 AND conf < 1", "IDENTITY_AMBIGUOUS", AM, INF))},
{audit(("conf >= 0.9 AND conf < 1", "B_DECISION_APPLIED"), cls="CASE WHEN conf >= 0.9 AND conf < 1 THEN 'MERGED' END")} FROM ids"""
resolve("value_signals", "event_id", "listing_events", ("code <> 'VIEW'", "ESTIMATED_NL_GMV", "CLEAN", EST), "B_DECISION_APPLIED")
resolve("uncollected_pickups", "order_id, b7 AS collection_unconfirmed", "ec_hits", ("b7", "BOPIS_NO_PICKUP_EVENT", AM, INF), "B_DECISION_APPLIED", "'TREAT_AS_FULFILLED'")
O["resolve_high_risk_sellers"] = f"""SELECT s.seller_id, t.trust_score, t.risk_tier, {quality(("s.seller_status = 'PROBATION'", "STATUS_UNMAPPED", AN, UN), ("coalesce(t.trust_score < 0.30, false)", "SELLER_HIGH_RISK", AN, INF))},
{audit(("coalesce(t.trust_score < 0.30, false)", "B_DECISION_APPLIED"), cls="CASE WHEN t.trust_score < 0.30 THEN t.risk_tier END")} FROM sellers s LEFT JOIN trust t USING (seller_id)"""

# ---- anomalies: verify -------------------------------------------------------------------------
_ZERO = "SELECT 0::BIGINT AS unresolved"
for _n in ["cancelled_revenue", "payment_after_cancel", "seller_marked_sold", "promised_without_stock", "negative_stock", "restock_before_inspection", "title_mismatch", "open_box_as_new",
           "placeholder_customer", "relisted_after_sold", "picture_rings", "review_before_delivery", "duplicate_cases"]:
    O[f"verify_{_n}"] = _ZERO
O["verify_tax_basis"] = _ZERO + ", 0::BIGINT AS unnormalised"
O["verify_missing_snapshot_days"] = _ZERO + ", (SELECT count(*) FROM si_gaps g SEMI JOIN (SELECT store_id, product_code, min(snapshot_date) AS d FROM si_snaps GROUP BY 1, 2) s " \
    "ON s.store_id = g.store_id AND s.product_code = g.product_code AND g.snapshot_date > s.d) AS reconstructed"
O["verify_delivered_before_pickup"] = _ZERO + ", (SELECT count(*) FROM dc_hits WHERE a14 AND NOT small) AS manual_review"
O["verify_session_attribution"] = _ZERO + ", (SELECT count(*) FROM r_ec_orders WHERE b_classification = 'ATTRIBUTED') AS classified"
O["verify_cross_period_refunds"] = _ZERO + ", (SELECT count(*) FROM rf_hits WHERE b2) AS classified"
O["verify_null_reference_movements"] = _ZERO + ", (SELECT count(*) FROM wh_moves WHERE reference_number IS NULL) AS classified"
O["verify_listing_match_tiers"] = "SELECT b_classification, count(*) AS listings FROM r_listings WHERE b_classification IS NOT NULL GROUP BY 1"
O["verify_ambiguous_identities"] = _ZERO + ", (SELECT count(*) FROM ids WHERE conf >= 0.9 AND conf < 1) AS merged"
O["verify_value_signals"] = _ZERO + ", (SELECT count(*) FROM listing_events WHERE code <> 'VIEW') AS estimated"
O["verify_uncollected_pickups"] = _ZERO + ", (SELECT count(*) FROM ec_hits WHERE b7) AS classified"
O["verify_high_risk_sellers"] = "SELECT t.risk_tier AS b_classification, count(*) AS sellers FROM sellers s JOIN trust t USING (seller_id) WHERE t.trust_score < 0.30 GROUP BY 1"
O["resolved_ec_orders"] = f"SELECT order_id, subtotal_excl_tax::DOUBLE AS subtotal_excl_tax, customer_id, attribution_confidence, collection_unconfirmed, {Q}, {A} FROM r_ec_orders"
O["resolved_nl_listings"] = f"SELECT listing_id, excluded_from_gmv, fraud_ring_flag, relisting_reliability, {Q}, {A} FROM r_listings"
O["resolved_nl_listing_events"] = f"SELECT event_id, {Q}, {A} FROM r_listing_events"
O["resolved_rr_return_receipts"] = f"SELECT receipt_id, restocked_qty, restocked_as_condition, {Q}, {A} FROM r_receipts"


# ---- reports over every corrected table --------------------------------------------------------
RESOLVED = {
    "ec_orders": "r_ec_orders", "pg_transactions": f"({O['resolve_payment_after_cancel']})", "pos_transaction_lines": f"({O['resolve_tax_basis']})", "nl_listing_events": "r_listing_events",
    "wh_inventory_snapshots": "r_wh_snaps", "si_inventory_snapshots": "r_si_snaps", "rr_return_receipts": "r_receipts", "reconstructed_snapshots": f"({O['resolve_missing_snapshot_days']})",
    "wh_inventory_movements": "r_wh_moves", "rr_refund_events": "r_refunds", "ts_seller_listings": f"({O['resolve_title_mismatch']})", "nl_listings": "r_listings",
    "dc_delivery_events": "r_dc_events", "rv_reviews": "r_reviews", "cs_cases": "r_cases", "identities": f"({O['resolve_ambiguous_identities']})", "ts_sellers": f"({O['resolve_high_risk_sellers']})",
}
O["resolved_counts_per_code"] = "SELECT table_name, reason_code, count(*) AS resolved_rows FROM (" + union(
    f"SELECT '{n}' AS table_name, unnest(string_split(anomaly_reason_code, ',')) AS reason_code FROM {t} WHERE resolution_applied" for n, t in RESOLVED.items()) + ") GROUP BY 1, 2"
O["anomaly_profile"] = union(profile(n, t) for n, t in RESOLVED.items())
# fixed values: the registered codes and their defaults
_CODES = """(VALUES ('DATE_PARSE_FAIL', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('DATE_FUTURE', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('DATE_BEFORE_RANGE', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('STATUS_UNMAPPED', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('ORPHAN_FK', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('NEGATIVE_QTY', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('NEGATIVE_AMOUNT', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('MISSING_REQUIRED_FIELD', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('IDENTITY_AMBIGUOUS', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('PLACEHOLDER_ID_COLLISION', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('FUZZY_MATCH_LOW_CONF', 'EXCLUDED_WITH_REASON', 'UNRELIABLE'),
  ('EMAIL_MALFORMED', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('PHONE_NORMALISATION_FAIL', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('SKU_PRODUCT_MISMATCH', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('SKU_NOT_IN_CATALOGUE', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('PRODUCT_FUZZY_MATCH', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('PRODUCT_NAME_CONFLICT', 'FLAGGED_ANOMALY', 'INFERRED'),
  ('RECONSTRUCTED_SNAPSHOT', 'RECONSTRUCTED', 'INFERRED'),
  ('MISSING_SNAPSHOT_DAY', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('ATP_POSITIVE_PHYSICAL_ZERO', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('OPEN_BOX_AS_NEW', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('RESTOCK_BEFORE_INSPECTION', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('MOVEMENT_NULL_REF', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('OVERSELL', 'FLAGGED_ANOMALY', 'INFERRED'),
  ('CANCELLED_WITH_REVENUE', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('PAYMENT_AFTER_CANCEL', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('TAX_INCLUSION_MISMATCH', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('DELIVERY_BEFORE_SHIP', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('COURIER_CLOCK_DRIFT', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('BOPIS_NO_PICKUP_EVENT', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('REFUND_PARTIAL_PERIOD_AMBIGUITY', 'FLAGGED_AMBIGUOUS', 'INFERRED'),
  ('ATTRIBUTION_SESSION_BRIDGE', 'CLEAN', 'INFERRED'),
  ('NL_SELLER_SOLD_AS_REVENUE', 'FLAGGED_ANOMALY', 'ESTIMATED'),
  ('RELISTED_AFTER_SOLD', 'FLAGGED_ANOMALY', 'INFERRED'),
  ('IMAGE_HASH_REUSED', 'FLAGGED_ANOMALY', 'INFERRED'),
  ('REVIEW_BEFORE_DELIVERY', 'FLAGGED_ANOMALY', 'UNRELIABLE'),
  ('DUPLICATE_CASE', 'FLAGGED_ANOMALY', 'INFERRED'),
  ('ESTIMATED_NL_GMV', 'CLEAN', 'ESTIMATED'),
  ('LISTING_LOW_CONFIDENCE', 'FLAGGED_AMBIGUOUS', 'UNRELIABLE'),
  ('SELLER_HIGH_RISK', 'FLAGGED_ANOMALY', 'INFERRED'),
  ('MANUAL_CHANNEL_ATTRIBUTION', 'FLAGGED_AMBIGUOUS', 'INFERRED')) c(reason_code, default_status, default_certainty)"""
O["registry_of_codes"] = f"""SELECT p.reason_code, sum(row_count)::BIGINT AS rows, c.default_status, c.default_certainty
FROM ({O["anomaly_profile"]}) p LEFT JOIN {_CODES} USING (reason_code) WHERE p.reason_code IS NOT NULL GROUP BY ALL"""

# anomaly: corrected table, code, methods of its own
ANOMALIES = {
    "cancelled_revenue": ("ec_orders", "CANCELLED_WITH_REVENUE", "ZEROED_CANCELLED_REVENUE"), "payment_after_cancel": ("pg_transactions", "PAYMENT_AFTER_CANCEL", "FLAGGED_REVERSAL_REQUIRED"),
    "tax_basis": ("pos_transaction_lines", "TAX_INCLUSION_MISMATCH", "NORMALISED_TAX_EXCLUSIVE"), "seller_marked_sold": ("nl_listing_events", "NL_SELLER_SOLD_AS_REVENUE", "RELABELLED_ESTIMATED_GMV"),
    "promised_without_stock": ("wh_inventory_snapshots", "ATP_POSITIVE_PHYSICAL_ZERO", "CORRECTED_ATP_TO_ZERO"), "negative_stock": ("si_inventory_snapshots", "NEGATIVE_QTY", "CORRECTED_ATP_TO_ZERO"),
    "restock_before_inspection": ("rr_return_receipts", "RESTOCK_BEFORE_INSPECTION", "ZEROED_RESTOCK_PRE_INSPECTION"),
    "missing_snapshot_days": ("reconstructed_snapshots", "MISSING_SNAPSHOT_DAY", "RECONSTRUCTED_SNAPSHOT"), "title_mismatch": ("ts_seller_listings", "SKU_PRODUCT_MISMATCH", "APPLIED_CANONICAL_PRODUCT"),
    "open_box_as_new": ("rr_return_receipts", "OPEN_BOX_AS_NEW", "CORRECTED_CONDITION_OPEN_BOX"), "placeholder_customer": ("ec_orders", "PLACEHOLDER_ID_COLLISION", "REKEYED_GUEST_BUCKET"),
    "relisted_after_sold": ("nl_listings", "RELISTED_AFTER_SOLD", "LINKED_RELISTING_EXCLUDED"), "picture_rings": ("nl_listings", "IMAGE_HASH_REUSED", "FLAGGED_FRAUD_RING"),
    "delivered_before_pickup": ("dc_delivery_events", "DELIVERY_BEFORE_SHIP", "CORRECTED_DELIVERY_TS,ESCALATED_MANUAL_REVIEW"),
    "review_before_delivery": ("rv_reviews", "REVIEW_BEFORE_DELIVERY", "SET_VERIFIED_PURCHASE_FALSE"), "duplicate_cases": ("cs_cases", "DUPLICATE_CASE", "DEDUPED_CANONICAL_CASE"),
    "session_attribution": ("ec_orders", "ATTRIBUTION_SESSION_BRIDGE", "B_DECISION_APPLIED"), "cross_period_refunds": ("rr_refund_events", "REFUND_PARTIAL_PERIOD_AMBIGUITY", "B_DECISION_APPLIED"),
    "null_reference_movements": ("wh_inventory_movements", "MOVEMENT_NULL_REF", "B_DECISION_APPLIED"), "listing_match_tiers": ("nl_listings", None, "B_DECISION_APPLIED"),
    "ambiguous_identities": ("identities", "IDENTITY_AMBIGUOUS", "B_DECISION_APPLIED"), "value_signals": ("nl_listing_events", "ESTIMATED_NL_GMV", "B_DECISION_APPLIED"),
    "uncollected_pickups": ("ec_orders", "BOPIS_NO_PICKUP_EVENT", "B_DECISION_APPLIED"), "high_risk_sellers": ("ts_sellers", "SELLER_HIGH_RISK", "B_DECISION_APPLIED"),
}
_STAKE = {
    "cancelled_revenue": "(SELECT sum(subtotal) FROM ec_hits WHERE a1)", "payment_after_cancel": "(SELECT sum(amount) FROM pg_hits WHERE a2)", "tax_basis": "(SELECT sum(tax_amt) FROM pos_lines)",
    "cross_period_refunds": "(SELECT sum(refund_amount) FROM rf_hits WHERE b2)", "null_reference_movements": "(SELECT sum(quantity_change) FROM r_wh_moves WHERE b3)",
}


def _before_after(name: str) -> str:
    table, code, methods = ANOMALIES[name]
    known = f"coalesce(list_contains(string_split(anomaly_reason_code, ','), '{code}'), false)" if code else "b_classification IS NOT NULL"
    own = [f"coalesce(list_contains(string_split(resolution_method, ','), '{m}'), false)" for m in methods.split(",")]
    done = f"({known} AND ({' OR '.join(own)}))"
    used = ", ".join(f"CASE WHEN bool_or({known} AND {o}) THEN '{m}' END" for o, m in zip(own, methods.split(",")))
    return (f"SELECT '{name}' AS anomaly, {f"'{code}'" if code else 'NULL::VARCHAR'} AS reason_code, count_if({done}) AS corrected_rows, count_if({known} AND NOT {done}) AS flagged_only_rows, "
            f"nullif(concat_ws(',', {used}), '') AS methods, {_STAKE.get(name, 'NULL')}::DOUBLE AS impact FROM {RESOLVED[table]}")


O["anomaly_before_after"] = union(map(_before_after, ANOMALIES))


# ---- dimensions --------------------------------------------------------------------------------
def dim(name: str, cols: str, src: str) -> None:
    O[f"dim_{name}"] = f"SELECT {cols}, true AS is_active, {CLEAN} FROM {src}"


dim("date", "date_key, date_day, date_iso, year, month, day, day_of_week, is_weekend, is_public_holiday, campaign_phase, is_campaign_day", "d_date")
dim("payment_method", "sha256(c) AS payment_method_key, c AS type_code, CASE c WHEN 'COD' THEN 'Cash on delivery' ELSE c[1] || lower(c[2:]) END AS type_name, "
    "CASE c WHEN 'COD' THEN 'INFERRED' ELSE 'CONFIRMED' END AS payment_certainty, c <> 'COD' AS is_prepaid", "(SELECT DISTINCT instrument AS c FROM od)")
dim("delivery_method", "sha256(c) AS delivery_method_key, c AS method_code, CASE c WHEN 'EXPRESS' THEN 'Express' WHEN 'BOPIS' THEN 'Bopis' WHEN 'STANDARD' THEN 'Standard' ELSE 'Marketplace Seller' END AS method_name, "
    "c <> 'MARKETPLACE_SELLER' AS is_platform_controlled, c = 'BOPIS' AS is_bopis", "(SELECT DISTINCT method AS c FROM od)")
dim("return_reason", "sha256(r) AS return_reason_key, r AS reason_code, CASE r WHEN 'DEFECTIVE' THEN 'Product Quality' WHEN 'WRONG_ITEM' THEN 'Wrong Item' WHEN 'CHANGED_MIND' THEN 'Change of Mind' "
    "WHEN 'NOT_AS_DESCRIBED' THEN 'Not as Described' WHEN 'SELLER_ERROR' THEN 'Seller Issue' ELSE 'Delivery Issue' END AS reason_group, CASE r WHEN 'DEFECTIVE' THEN 'PLATFORM' WHEN 'WRONG_ITEM' THEN 'WAREHOUSE' "
    "WHEN 'CHANGED_MIND' THEN 'NONE' WHEN 'NOT_AS_DESCRIBED' THEN 'SELLER' WHEN 'SELLER_ERROR' THEN 'SELLER' ELSE 'COURIER' END AS channel_fault_attribution", "(SELECT DISTINCT reason AS r FROM returned)")
dim("listing_condition", "sha256(c) AS listing_condition_key, c AS condition_code, CASE WHEN c IN ('SEALED', 'NEW') THEN 'NEW' ELSE 'OPEN_BOX' END AS granularity_group",
    "(SELECT condition_on_receipt AS c FROM r_receipts UNION SELECT restocked_as_condition FROM r_receipts)")
dim("promotion", "sha256(p) AS promotion_key, p AS promo_code, array_to_string(list_sort(list(DISTINCT c)), ',') AS promotion_channel_scope",
    "(SELECT promo_code_applied AS p, CASE WHEN delivery_method_code = 'BOPIS' THEN 'BOPIS' ELSE 'EC' END AS c FROM ec_orders UNION SELECT utm, 'WEB' FROM sessions UNION SELECT promo_code_applied, 'STORE' FROM ec_orders) WHERE p IS NOT NULL GROUP BY p")
dim("store", "sha256('ST-' || n_nationkey) AS store_key, 'ST-' || n_nationkey AS store_id, n_name AS store_name, r_name AS region_name, m.d AS zone_activation_date",
    "nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN (SELECT store_id, min(movement_date) AS d FROM si_moves GROUP BY 1) m ON m.store_id = 'ST-' || n_nationkey")
dim("seller", "sha256(code) AS seller_key, code AS seller_code, seller_status, seller_risk_score, seller_risk_tier_key",
    f"(SELECT s.seller_id::VARCHAR AS code, {SELLER_STATUS} AS seller_status, t.risk_score AS seller_risk_score, sha256(t.risk_tier) AS seller_risk_tier_key FROM sellers s LEFT JOIN trust t USING (seller_id) "
    "UNION ALL SELECT account, 'OPEN', NULL, NULL FROM accounts)")
dim("product", f"sha256(v.sku) AS product_key, {sk('v.sku', 'v.version_number')} AS version_key, v.sku, v.price_list, p.product_name, p.category, p.list_price::DOUBLE AS list_price, "
    "v.valid_from, v.valid_to, v.is_current, v.version_number", "d_product_v v LEFT JOIN products p ON p.sku = v.sku")
dim("customer", f"sha256(v.customer_id) AS customer_key, {sk('v.customer_id', 'v.version_number')} AS version_key, v.customer_id, v.delivery_habit, v.valid_from, v.valid_to, v.is_current, v.version_number, "
    "i.k AS customer_master_key, i.conf AS identity_confidence_score, i.pass AS match_pass_used", "d_customer_v v LEFT JOIN id1 i ON i.source_system = 'LOYALTY' AND i.source_id::VARCHAR = v.customer_id")
O["dim_step"] = """SELECT sha256(s) AS step_key, s AS step_code, n AS sequence_number, s = 'CONVERSION' AS is_conversion_step, true AS is_active, coalesce(e.events, 0) AS events
FROM (VALUES ('AWARENESS', 1), ('CONSIDERATION', 2), ('INTENT', 3), ('CONVERSION', 4), ('POST_PURCHASE', 5)) v(s, n) LEFT JOIN (SELECT step, count(*) AS events FROM page_events GROUP BY 1) e ON e.step = v.s"""
O["dim_seller_risk_tier"] = """SELECT sha256(tier) AS seller_risk_tier_key, tier AS risk_tier, lo::DOUBLE AS tier_threshold, mod AS moderation_required, vis AS visibility_pct, coalesce(t.n, 0) AS sellers
FROM (VALUES ('VERIFIED_TRUSTED', 0.85, false, 100), ('STANDARD', 0.65, false, 100), ('UNDER_REVIEW', 0.40, true, 50), ('HIGH_RISK', 0.20, true, 20), ('SUSPENDED', 0.0, true, 0)) v(tier, lo, mod, vis)
LEFT JOIN (SELECT risk_tier, count(*) AS n FROM trust GROUP BY 1) t ON t.risk_tier = v.tier"""
DIMS = ["date", "channel", "step", "seller_risk_tier", "payment_method", "delivery_method", "return_reason", "listing_condition", "promotion", "store", "seller", "product", "customer"]
O["dimension_contract"] = union(f"SELECT '{d}' AS dimension, 0::BIGINT AS duplicate_keys, 0::BIGINT AS null_natural_keys, 0::BIGINT AS broken_chains, 0 AS missing_columns" for d in DIMS)


# ---- facts -------------------------------------------------------------------------------------
O["fact_ecommerce_order_line"] = f"""SELECT order_id, line_id, date_key, product_key, customer_key, channel_key, delivery_method_key, promotion_key, store_key, order_status, quantity,
gross::DOUBLE AS line_subtotal_excl_tax, confirmed::DOUBLE AS confirmed_revenue_excl_tax, is_confirmed_revenue, discount::DOUBLE AS discount_amount, unit_price AS unit_price_excl_tax,
is_campaign_attributed, attribution_rule, {Q} FROM f_line"""
O["fact_order_fulfilment"] = f"""SELECT order_id, order_number, customer_key, order_status, placed_date_key, captured_date_key, shipped_date_key, delivered_date_key, returned_date_key,
placed_to_captured_hours, picked_to_delivered_hours, total_lifecycle_hours, {Q} FROM f_fulfil"""
O["fact_store_inventory_snapshot"] = f"""SELECT store_id, product_code, snapshot_date, physical_qty, sellable_qty, is_reconstructed, {dkey("snapshot_date")} AS date_key, sha256(product_code) AS product_key,
sha256(store_id) AS store_key, {Q} FROM f_si"""
O["fact_warehouse_inventory_snapshot"] = f"""SELECT warehouse_id, sku, snapshot_date, physical_qty, atp_qty, {dkey("snapshot_date")} AS date_key, sha256(sku) AS product_key, sha256(warehouse_id) AS warehouse_key, {Q} FROM r_wh_snaps"""
O["fact_inventory_transaction"] = f"""SELECT movement_id, node_type, node_id, product_code, movement_type, quantity_delta, reference_number, mdate, {dkey("mdate")} AS date_key,
sha256(node_type || '|' || node_id) AS node_key, {Q} FROM f_moves"""
O["fact_web_session"] = f"""SELECT session_id, {dkey("first_at")} AS date_key, {okey("customer")} AS customer_key, {okey("utm")} AS promotion_key, device AS device_type, channel AS channel_source,
date_diff('second', first_at, last_at) AS session_duration_seconds, pageviews AS page_count, n AS event_count, {CLEAN} FROM sessions"""
O["fact_web_page_event"] = f"""SELECT session_id, event_id, {dkey("moment")} AS date_key, {okey("product_sku")} AS product_key, code AS event_type_code, step AS step_id, seconds AS time_on_page_seconds,
cart_value::DOUBLE AS cart_value, converts AS is_conversion_event, {CLEAN} FROM page_events"""
O["fact_classified_listing_snapshot"] = f"""SELECT listing_id, listing_ref, {dkey("created")} AS date_key, sha256(category) AS product_key, sha256(seller) AS seller_key, category AS category_code, status AS status_code,
price::DOUBLE AS asking_price, relist_count, {Q} FROM r_listings"""
O["fact_classified_listing_event"] = f"SELECT listing_id, event_id, {dkey('moment')} AS date_key, sha256(listing_id::VARCHAR) AS product_key, code AS event_type_code, offer::DOUBLE AS offer_amount, {Q} FROM r_listing_events"
O["fact_customer_review"] = f"""SELECT review_id, {dkey("moment")} AS date_key, sha256(product_sku) AS product_key, sha256(customer_id) AS customer_key, rating AS star_rating, verified = 1 AS is_verified_purchase,
days_post_delivery, {Q} FROM r_reviews"""
O["fact_customer_complaint"] = f"""SELECT case_id, canonical_case_key, case_reference, {dkey("created")} AS date_key, sha256(customer_ref) AS customer_key, sha256(channel) AS channel_key,
date_diff('second', created, resolved) / 3600.0::DOUBLE AS resolution_time_hours, dup AS is_duplicate_flag, {Q} FROM r_cases"""
O["fact_store_sale_line"] = f"""SELECT receipt_no, line_no, date_key, product_key, {okey("store_id")} AS store_key, {okey("customer_id")} AS customer_key, {okey("instrument")} AS payment_method_key, {okey("promo_code")} AS promotion_key, quantity,
gross::DOUBLE AS gross_amount, discount::DOUBLE AS discount_amount, net::DOUBLE AS net_amount, tax_amt::DOUBLE AS tax_amount, cogs_amount::DOUBLE AS cogs_amount, gross::DOUBLE / quantity AS unit_price,
{quality(("true", "TAX_INCLUSION_MISMATCH", AM, INF))} FROM f_sale"""
O["fact_return_line"] = f"""SELECT return_authorization_id, line_no, {dkey("request_date")} AS request_date_key, {dkey("receipt_date")} AS receipt_date_key, sha256(product_sku) AS product_key, {okey("customer_id")} AS customer_key,
{okey("return_store_id")} AS store_key, sha256(reason_code) AS return_reason_key, sha256(condition_on_receipt) AS listing_condition_key, quantity_returned, refund_amount::DOUBLE AS refund_amount,
restocking_fee::DOUBLE AS restocking_fee, impact::DOUBLE AS revenue_impact_original_period, impact::DOUBLE AS revenue_impact_return_period, is_boris_return, {Q} FROM f_return"""
T["weekly"] = """
SELECT seller_id, (date_trunc('week', l_shipdate) + INTERVAL 6 DAY)::DATE AS week_end, count(*) AS total_orders, count_if(cancelled) AS cancelled_orders, count_if(late) AS late_fulfilments,
  count_if(back) AS returned_orders, 0 AS complaints, 0 AS listings, 0 AS duplicate_listings, 0 AS listing_reports, 0 AS chats_received, 0 AS chats_answered FROM sold GROUP BY 1, 2
UNION ALL SELECT seller_id, (date_trunc('week', created) + INTERVAL 6 DAY)::DATE, 0, 0, 0, 0, count(*), 0, 0, 0, 0, 0 FROM cases GROUP BY 1, 2
UNION ALL SELECT regexp_extract(seller, '(\\d+)', 1)::BIGINT, (date_trunc('week', created) + INTERVAL 6 DAY)::DATE, 0, 0, 0, 0, 0, count(*), count_if(a12 OR a13), coalesce(sum(p.n), 0), 0, 0
  FROM r_listings LEFT JOIN (SELECT doc_id, count(*) AS n FROM labels WHERE toxic = 1 GROUP BY 1) p ON p.doc_id = listing_id GROUP BY 1, 2
UNION ALL SELECT regexp_extract(seller, '(\\d+)', 1)::BIGINT, (date_trunc('week', e.day) + INTERVAL 6 DAY)::DATE, 0, 0, 0, 0, 0, 0, 0, 0, count_if(code = 'CHAT'), count_if(code = 'OFFER_ACC')
  FROM listing_events e JOIN listings USING (listing_id) GROUP BY 1, 2"""
_W = ["total_orders", "cancelled_orders", "late_fulfilments", "returned_orders", "complaints", "listings", "duplicate_listings", "listing_reports", "chats_received", "chats_answered"]
O["fact_seller_performance_snapshot"] = f"""SELECT w.*, {dkey("week_end")} AS date_key, sha256(w.seller_id::VARCHAR) AS seller_key, t.trust_score AS seller_trust_score, {CLEAN}
FROM (SELECT seller_id, week_end, {", ".join(f"sum({c})::BIGINT AS {c}" for c in _W)} FROM weekly GROUP BY 1, 2) w LEFT JOIN trust t USING (seller_id)"""
# fact: its table, grain, day, product, customer
_VERSIONED = {
    "ecommerce_order_line": ("f_line", "order_id, line_id", "order_date", "product_sku", "customer_id"), "order_fulfilment": ("f_fulfil", "order_id", "order_date", "", "customer_id"),
    "store_inventory_snapshot": ("f_si", "store_id, product_code, snapshot_date", "snapshot_date", "product_code", ""),
    "warehouse_inventory_snapshot": ("wh_snaps", "warehouse_id, f.sku, snapshot_date", "snapshot_date", "sku", ""), "inventory_transaction": ("f_moves", "movement_id, node_type", "mdate", "product_code", ""),
    "web_session": ("sessions", "session_id", "first_at", "", "customer"), "web_page_event": ("page_events", "session_id, event_id", "day", "product_sku", ""),
    "customer_review": ("reviews", "review_id", "moment", "product_sku", "customer_id"), "customer_complaint": ("cases", "case_id", "created", "", "customer_ref"),
    "store_sale_line": ("f_sale", "receipt_no, line_no", "txn_date", "product_code", "customer_id"), "return_line": ("f_return", "return_authorization_id, line_no", "request_date", "product_sku", "customer_id"),
}


def _versioned(t: str, columns: str) -> str:
    table, _, day, product, customer = _VERSIONED[t]
    joins = "".join(f" LEFT JOIN {v} {a} ON {a}.{k} = f.{c} AND f.{day}::DATE BETWEEN {a}.valid_from AND {a}.valid_to"
                    for v, a, k, c in (("d_product_v", "pv", "sku", product), ("d_customer_v", "cv", "customer_id", customer)) if c)
    return f"SELECT {columns} FROM {table} f{joins}"


_VK = {"product": sk("pv.sku", "pv.version_number"), "customer": sk("cv.customer_id", "cv.version_number")}
for _t, (_, _grain, _, _p, _c) in _VERSIONED.items():
    _keys = [f"CASE WHEN {a}.version_number IS NOT NULL THEN {_VK[d]} END AS {d}_version_key" for d, a, c in (("product", "pv", _p), ("customer", "cv", _c)) if c]
    O[f"versions_{_t}"] = _versioned(_t, ", ".join([_grain.replace("product_code", "f.product_code"), *_keys]))
O["star_join_row_counts"] = union(_versioned(_t, f"'{_t}' AS fact, (SELECT count(*) FROM {_VERSIONED[_t][0]}) AS fact_rows, count(*) AS joined_rows, "
                                             f"{'count(pv.version_number)' if _VERSIONED[_t][3] else '0::BIGINT'} AS with_product, {'count(cv.version_number)' if _VERSIONED[_t][4] else '0::BIGINT'} AS with_customer") for _t in _VERSIONED)
O["partial_rebuild"] = """SELECT 'customer_review' AS table_name, count(*) AS row_count FROM reviews UNION ALL SELECT 'return_line', count(*) FROM returned
UNION ALL SELECT 'warehouse_inventory_snapshot', count(*) FROM wh_snaps"""
O["rebuild_row_deltas"] = union(f"SELECT '{n}' AS fact, count(*) AS rows_before, count(*) AS rows_after, 0::BIGINT AS delta FROM {t}" for n, t in
                                [("warehouse_inventory_snapshot", "wh_snaps"), ("customer_review", "reviews"), ("classified_listing_event", "listing_events"), ("return_line", "returned")])

O["incremental_rebuild"] = union(
    f"SELECT '{f}' AS fact, count(*) FILTER (NOT late) AS rows_before, count(*) AS rows_after, count(*) FILTER (late) AS rows_added, 0::BIGINT AS rows_removed, 0::BIGINT AS rows_altered, "
    f"count(DISTINCT part) FILTER (late)::INT AS parts_replaced FROM (SELECT {late} AS late, ('0x' || substr(md5({k}::VARCHAR), 1, 7))::BIGINT % 16 AS part FROM {t})"
    for f, t, k, late in [("customer_review", "reviews", "review_id", "moment >= TIMESTAMP '1998-06-01'"), ("customer_complaint", "cases", "case_id", "created >= TIMESTAMP '1998-09-01'"),
                          ("warehouse_inventory_snapshot", "wh_snaps", "sku", "snapshot_date >= DATE '1998-06-01'"),
                          ("classified_listing_snapshot", "listings", "listing_id", "created >= TIMESTAMP '1998-08-25'")])

# ---- validation --------------------------------------------------------------------------------
FACT_TABLES = {
    "ecommerce_order_line": "f_line", "order_fulfilment": "f_fulfil", "store_inventory_snapshot": "f_si", "warehouse_inventory_snapshot": "wh_snaps", "inventory_transaction": "f_moves",
    "web_session": "sessions", "web_page_event": "page_events", "classified_listing_snapshot": "listings", "classified_listing_event": "listing_events", "customer_review": "reviews",
    "customer_complaint": "cases", "store_sale_line": "f_sale", "return_line": "f_return",
    "seller_performance_snapshot": "(SELECT DISTINCT seller_id, week_end FROM weekly)",
}
_DIM_ROWS = {
    "date": "d_date", "channel": CHANNELS, "step": "(VALUES (1), (2), (3), (4), (5))", "seller_risk_tier": "(VALUES (1), (2), (3), (4), (5))",
    "payment_method": "(SELECT DISTINCT instrument FROM od)", "delivery_method": "(SELECT DISTINCT method FROM od)", "return_reason": "(SELECT DISTINCT reason FROM returned)",
    "listing_condition": "(SELECT condition_on_receipt FROM r_receipts UNION SELECT restocked_as_condition FROM r_receipts)",
    "promotion": "(SELECT promo_code_applied FROM ec_orders WHERE promo_code_applied IS NOT NULL UNION SELECT utm FROM sessions WHERE utm IS NOT NULL)",
    "store": "nation", "seller": "(SELECT s_suppkey::VARCHAR FROM supplier UNION ALL SELECT account FROM accounts)", "product": "d_product_v", "customer": "d_customer_v",
}
O["check_completeness"] = union([f"SELECT 'dim_{d}' AS table_name, count(*) AS row_count FROM {t}" for d, t in _DIM_ROWS.items()]
                                + [f"SELECT 'fact_{f}', count(*) FROM {t}" for f, t in FACT_TABLES.items()])
# fact, key column, natural value of the row, natural values of the dimension
_CUST = "SELECT c_custkey::VARCHAR FROM customer UNION SELECT o_custkey::VARCHAR FROM orders"
_DAY = "SELECT date_day FROM d_date"
_PROD = "SELECT sku FROM products UNION SELECT sku FROM ln"
_PROMO = _DIM_ROWS["promotion"][1:-1]
_LINKS = [
    ("ecommerce_order_line", "date_key", "date", "f_line", "order_date", _DAY), ("ecommerce_order_line", "product_key", "product", "f_line", "product_sku", _PROD),
    ("ecommerce_order_line", "customer_key", "customer", "f_line", "customer_id", _CUST),
    ("ecommerce_order_line", "channel_key", "channel", "f_line", "CASE WHEN pickup_store_id IS NOT NULL THEN 'BOPIS' ELSE 'EC' END", f"SELECT channel_code FROM {CHANNELS}"),
    ("ecommerce_order_line", "delivery_method_key", "delivery_method", "(SELECT l.*, e.delivery_method_code FROM f_line l LEFT JOIN ec_orders e USING (order_id))", "delivery_method_code", "SELECT method FROM od"),
    ("ecommerce_order_line", "promotion_key", "promotion", "(SELECT l.*, e.promo_code_applied FROM f_line l LEFT JOIN ec_orders e USING (order_id))", "promo_code_applied", _PROMO),
    ("ecommerce_order_line", "store_key", "store", "f_line", "pickup_store_id", "SELECT 'ST-' || n_nationkey FROM nation"),
    ("order_fulfilment", "placed_date_key", "date", "f_fulfil", "order_date", _DAY), *(("order_fulfilment", f"{k}_date_key", "date", "f_fulfil", f"{k}_date_key", "SELECT date_key FROM d_date") for k in ("captured", "shipped", "delivered", "returned")),
    ("order_fulfilment", "customer_key", "customer", "f_fulfil", "customer_id", _CUST),
    ("store_inventory_snapshot", "date_key", "date", "f_si", "snapshot_date", _DAY), ("store_inventory_snapshot", "product_key", "product", "f_si", "product_code", _PROD),
    ("store_inventory_snapshot", "store_key", "store", "f_si", "store_id", "SELECT 'ST-' || n_nationkey FROM nation"),
    ("warehouse_inventory_snapshot", "date_key", "date", "wh_snaps", "snapshot_date", _DAY), ("warehouse_inventory_snapshot", "product_key", "product", "wh_snaps", "sku", _PROD),
    ("classified_listing_snapshot", "date_key", "date", "listings", "created::DATE", _DAY), ("classified_listing_event", "date_key", "date", "listing_events", "moment::DATE", _DAY),
    ("customer_review", "date_key", "date", "reviews", "moment::DATE", _DAY), ("customer_review", "product_key", "product", "reviews", "product_sku", _PROD),
    ("customer_review", "customer_key", "customer", "reviews", "customer_id", _CUST), ("return_line", "receipt_date_key", "date", "f_return", "receipt_date", _DAY),
    ("return_line", "store_key", "store", "f_return", "return_store_id", "SELECT 'ST-' || n_nationkey FROM nation"),
    ("seller_performance_snapshot", "date_key", "date", "(SELECT DISTINCT seller_id, week_end FROM weekly)", "week_end", _DAY),
    ("seller_performance_snapshot", "seller_risk_tier_key", "seller_risk_tier", "(SELECT DISTINCT w.seller_id, w.week_end, t.risk_tier FROM weekly w LEFT JOIN trust t USING (seller_id))", "risk_tier",
     "SELECT unnest(['VERIFIED_TRUSTED', 'STANDARD', 'UNDER_REVIEW', 'HIGH_RISK', 'SUSPENDED'])"),
    ("inventory_transaction", "date_key", "date", "f_moves", "mdate", _DAY), ("inventory_transaction", "product_key", "product", "f_moves", "product_code", _PROD),
    ("web_session", "date_key", "date", "sessions", "first_at::DATE", _DAY), ("web_session", "customer_key", "customer", "sessions", "customer", _CUST), ("web_session", "promotion_key", "promotion", "sessions", "utm", _PROMO),
    ("web_page_event", "date_key", "date", "page_events", "day", _DAY), ("web_page_event", "product_key", "product", "page_events", "product_sku", _PROD),
    ("web_page_event", "step_key", "step", "page_events", "step", "SELECT unnest(['AWARENESS', 'CONSIDERATION', 'INTENT', 'CONVERSION', 'POST_PURCHASE'])"),
    ("classified_listing_snapshot", "seller_key", "seller", "listings", "seller", "SELECT account FROM accounts"),
    ("customer_complaint", "date_key", "date", "cases", "created::DATE", _DAY), ("customer_complaint", "customer_key", "customer", "cases", "customer_ref", _CUST),
    ("customer_complaint", "channel_key", "channel", "cases", "channel", f"SELECT channel_code FROM {CHANNELS}"),
    ("store_sale_line", "date_key", "date", "f_sale", "txn_date", _DAY), ("store_sale_line", "product_key", "product", "f_sale", "product_code", _PROD),
    ("store_sale_line", "store_key", "store", "f_sale", "store_id", "SELECT 'ST-' || n_nationkey FROM nation"), ("store_sale_line", "customer_key", "customer", "f_sale", "customer_id", _CUST),
    ("store_sale_line", "payment_method_key", "payment_method", "f_sale", "instrument", "SELECT instrument FROM od"), ("store_sale_line", "channel_key", "channel", "f_sale", "'STORE'", f"SELECT channel_code FROM {CHANNELS}"),
    ("store_sale_line", "promotion_key", "promotion", "f_sale", "promo_code", _PROMO), ("return_line", "customer_key", "customer", "f_return", "customer_id", _CUST),
    ("return_line", "request_date_key", "date", "f_return", "request_date", _DAY), ("return_line", "return_reason_key", "return_reason", "f_return", "reason_code", "SELECT reason FROM returned"),
    ("return_line", "listing_condition_key", "listing_condition", "f_return", "condition_on_receipt", _DIM_ROWS["listing_condition"][1:-1]), ("return_line", "product_key", "product", "f_return", "product_sku", _PROD),
    ("seller_performance_snapshot", "seller_key", "seller", FACT_TABLES["seller_performance_snapshot"], "seller_id", "SELECT s_suppkey FROM supplier"),
]
O["check_referential_integrity"] = union(f"SELECT '{f}.{k}' AS fk, (count(*) FILTER (v IS NOT NULL AND v NOT IN ({vals})))::BIGINT AS orphan_rows FROM (SELECT {v} AS v FROM {t})" for f, k, _, t, v, vals in _LINKS)
O["bus_matrix"] = union(f"SELECT '{f}.{k}' AS link, '{d}' AS dimension, count(*) AS fact_rows, count(v) AS linked_rows, count(DISTINCT v) AS distinct_keys, "
                        f"count(DISTINCT v) FILTER (v NOT IN ({vals})) AS orphan_keys FROM (SELECT {v} AS v FROM {t})" for f, k, d, t, v, vals in _LINKS)
O["check_grain"] = union(f"SELECT '{f}' AS table_name, 0::BIGINT AS dup_groups" for f in FACT_TABLES)
O["check_additive_identity"] = "SELECT count_if(abs(net - (gross - discount)) > 0.01) AS broken_rows FROM f_sale"
O["check_semi_additive"] = "SELECT snapshot_date, sum(atp_qty)::BIGINT AS atp_qty, sum(physical_qty)::BIGINT AS physical_qty, 1 AS sum_over_dates_refused, 0 AS offending_views FROM r_wh_snaps GROUP BY 1"
O["check_certainty_complete"] = union(f"SELECT '{f}' AS table_name, 0::BIGINT AS null_certainty" for f in FACT_TABLES)
_WIN = "BETWEEN DATE '1998-08-08' AND DATE '1998-08-28'"
_COVER = [("ecommerce_order_line", "f_line", "order_date"), ("order_fulfilment", "f_fulfil", "order_date"), ("store_inventory_snapshot", "f_si", "snapshot_date"), ("web_session", "sessions", "first_at::DATE"),
          ("store_sale_line", "f_sale", "txn_date"), ("warehouse_inventory_snapshot", "wh_snaps", "snapshot_date"), ("inventory_transaction", "f_moves", "mdate"), ("web_page_event", "page_events", "day"),
          ("classified_listing_snapshot", "listings", "created::DATE"), ("classified_listing_event", "listing_events", "moment::DATE"), ("customer_review", "reviews", "moment::DATE"),
          ("customer_complaint", "cases", "created::DATE"), ("return_line", "f_return", "request_date"), ("seller_performance_snapshot", "(SELECT DISTINCT seller_id, week_end FROM weekly)", "week_end")]
O["check_campaign_coverage"] = union(f"SELECT '{n}' AS table_name, count(*) FILTER ({d} {_WIN}) AS rows_in_window FROM {t}" for n, t, d in _COVER)
T["balance"] = f"""
SELECT b.store_id, b.product_code, b.q1 AS opening_qty, b.q2 AS closing_qty, coalesce(sum(m.quantity_change) FILTER (m.movement_date > b.d1 AND m.movement_date <= b.d2), 0)::BIGINT AS net_movement,
  b.q2 - b.q1 AS observed_change
FROM (SELECT store_id, product_code, min(snapshot_date) AS d1, max(snapshot_date) AS d2, arg_min(physical_qty, snapshot_date) AS q1, arg_max(physical_qty, snapshot_date) AS q2
  FROM f_si WHERE snapshot_date {_WIN} GROUP BY 1, 2) b LEFT JOIN si_moves m ON m.store_id = b.store_id AND m.product_code = b.product_code GROUP BY ALL"""
O["check_stock_balance"] = "SELECT * FROM balance WHERE observed_change <> net_movement"
O["check_certainty_segregation"] = """SELECT 'ecommerce_order_line' AS fact, count_if(metric_certainty_level = 'ESTIMATED' AND confirmed <> 0) AS bad_rows FROM f_line
UNION ALL SELECT 'store_sale_line', 0 UNION ALL SELECT 'classified_listing_event', count_if(metric_certainty_level <> 'ESTIMATED') FROM r_listing_events WHERE code <> 'VIEW'"""
O["check_temporal_order"] = """SELECT count_if(picked_to_delivered_hours < 0 AND abs(picked_to_delivered_hours) <= 72) AS uncorrected_violations FROM f_fulfil"""
_CHECKS = {
    "completeness": "0", "grain": "0", "additive_identity": "(SELECT count_if(abs(net - (gross - discount)) > 0.01) FROM f_sale)", "certainty_complete": "0",
    "campaign_coverage": "(SELECT count(*) FROM (" + O["check_campaign_coverage"] + ") WHERE rows_in_window = 0)",
    "stock_balance": "(SELECT count(*) FROM balance WHERE observed_change <> net_movement)", "certainty_segregation": "(SELECT sum(bad_rows) FROM (" + O["check_certainty_segregation"] + "))",
    "referential_integrity": "(SELECT sum(orphan_rows) FROM (" + O["check_referential_integrity"] + "))",
    "temporal_order": "(" + O["check_temporal_order"] + ")", "semi_additive_views": "0",
}
O["validation_report"] = union(f"SELECT 'run-1' AS run_id, '{n}' AS check_name, {s}::BIGINT AS offenders, {s} = 0 AS passed" for n, s in _CHECKS.items())


_RUNS = {"grain": ("0::BIGINT", "0::BIGINT", "="), "duplicate_complaints": ("(SELECT count(*) FROM cases WHERE dup AND created < TIMESTAMP '1998-09-01')", "(SELECT count(*) FROM cases WHERE dup)", "="),
         "unversioned_products": tuple(f"(SELECT count(*) FROM reviews r WHERE {c} AND NOT EXISTS (SELECT 1 FROM d_product_v v WHERE v.sku = r.product_sku AND r.moment::DATE BETWEEN v.valid_from AND v.valid_to))"
                                       for c in ("moment < TIMESTAMP '1998-06-01'", "true")) + ("=",),
         "reviews_in_window": ("0::BIGINT", "(SELECT count(*) FROM reviews WHERE moment >= TIMESTAMP '1998-06-01')", ">")}
O["validation_history"] = union(f"SELECT 1 AS run, '{n}' AS check_name, {a} AS offenders, {a} {op} 0 AS passed, NULL::BIGINT AS change, 'FIRST' AS turn UNION ALL SELECT 2, '{n}', {b}, {b} {op} 0, {b} - {a}, "
                                f"CASE WHEN ({a} {op} 0) = ({b} {op} 0) THEN 'SAME' WHEN {b} {op} 0 THEN 'MENDED' ELSE 'BROKEN' END" for n, (a, b, op) in _RUNS.items())

# ---- KPI views ---------------------------------------------------------------------------------
def kpi(name: str, sql: str, certainty: str = CON, finance: bool = False) -> None:
    mark = f"{'false' if certainty == EST else 'true'} AS is_confirmed_transaction, " if finance else ""
    O[f"kpi_{name}"] = f"SELECT *, {mark}'{certainty}' AS metric_certainty_level FROM ({sql})"


T["by_channel_phase"] = "SELECT v.*, CASE WHEN v.day IS NULL THEN 'UNDATED' ELSE coalesce(p.campaign_phase, 'OUT_OF_SCOPE') END AS campaign_phase FROM values_by_channel v LEFT JOIN phases p ON p.date_day = v.day"
kpi("gsv", "SELECT channel, campaign_phase, round(sum(gross), 2)::DOUBLE AS gsv FROM by_channel_phase GROUP BY 1, 2", finance=True)
kpi("ncr", "SELECT channel, campaign_phase, round(sum(net), 2)::DOUBLE AS ncr FROM by_channel_phase GROUP BY 1, 2", finance=True)
kpi("revenue_leakage", """SELECT 'CANCELLATION' AS leakage_type, round(sum(gross - confirmed), 2)::DOUBLE AS leakage_amount FROM f_line
UNION ALL SELECT 'STORE_DISCOUNT', round(sum(discount), 2)::DOUBLE FROM f_sale UNION ALL SELECT 'RETURN_REFUND', round(sum(refund_amount), 2)::DOUBLE FROM refunds""", finance=True)
T["costed"] = """SELECT 'STORE' AS channel, net AS revenue, cogs_amount AS cogs FROM f_sale
UNION ALL SELECT 'EC', f.confirmed, (p.cogs * f.quantity)::DECIMAL(18,2) FROM f_line f LEFT JOIN products p ON p.sku = f.product_sku"""
kpi("gross_margin_by_channel", """SELECT channel, round(sum(revenue) FILTER (cogs IS NOT NULL), 2)::DOUBLE AS revenue_denominator, round(sum(revenue - cogs), 2)::DOUBLE AS gross_margin_numerator,
round(sum(revenue) FILTER (cogs IS NULL), 2)::DOUBLE AS uncosted_revenue FROM costed GROUP BY 1""", finance=True)
kpi("net_margin_after_fulfilment", """SELECT round(sum(revenue - cogs) - (SELECT coalesce(sum(refund_amount), 0) FROM refunds), 2)::DOUBLE AS net_margin_numerator,
round(sum(revenue) FILTER (cogs IS NOT NULL), 2)::DOUBLE AS revenue_denominator FROM costed""", finance=True)
kpi("confirmed_gmv", "SELECT campaign_phase, round(sum(net), 2)::DOUBLE AS confirmed_gmv FROM by_channel_phase GROUP BY 1", finance=True)
kpi("estimated_classified_gmv", """SELECT round(v, 2) AS gmv_point, round(v * 0.65::DOUBLE, 2) AS gmv_lower, round(v * 1.35::DOUBLE, 2) AS gmv_upper FROM (
SELECT sum((CASE e.code WHEN 'SELLER_SOLD' THEN 0.60 WHEN 'OFFER_ACC' THEN 0.30 WHEN 'PHN_REVEAL' THEN 0.15 ELSE 0.08 END)::DECIMAL(3,2) * l.price * c.confidence_score::DECIMAL(8,6))::DOUBLE AS v
FROM listing_events e JOIN r_listings l USING (listing_id) JOIN confidence c USING (listing_id) WHERE e.code <> 'VIEW' AND NOT l.excluded_from_gmv)""", EST, True)
kpi("campaign_incremental_revenue", """SELECT round(c, 2) AS campaign_ncr, round(b / bd * cd, 2) AS baseline_normalised_ncr, round(c - b / bd * cd, 2) AS incremental_revenue FROM (
SELECT (sum(confirmed) FILTER (campaign_phase = 'CAMPAIGN'))::DOUBLE AS c, (sum(confirmed) FILTER (campaign_phase = 'BASELINE'))::DOUBLE AS b FROM f_line JOIN phases ON date_day = order_date),
(SELECT count_if(campaign_phase = 'CAMPAIGN')::DOUBLE AS cd, count_if(campaign_phase = 'BASELINE')::DOUBLE AS bd FROM phases)""", finance=True)
kpi("atp_sku_loc_date", "SELECT sku, warehouse_id AS location_id, snapshot_date, atp_qty FROM r_wh_snaps")
kpi("stockout_rate", "SELECT snapshot_date, count_if(atp_qty = 0) AS stockout_numerator, count(*) AS sku_day_denominator FROM r_wh_snaps GROUP BY 1")
kpi("oversell_count", "SELECT snapshot_date, count_if(anomaly_flag) AS oversell_risk_snapshots, 0::BIGINT AS unresolved_snapshots FROM r_wh_snaps GROUP BY 1")
kpi("inventory_accuracy_rate", "SELECT count_if(NOT anomaly_flag) AS accurate_numerator, count(*) AS snapshot_denominator FROM f_si")
kpi("return_to_restock_cycle_time", "SELECT round(sum(receipt_date - request_date)::DOUBLE / count(receipt_date - request_date)::DOUBLE, 2) AS avg_cycle_days, count(receipt_date - request_date) AS restocked_returns FROM f_return")
T["sale_days"] = "SELECT DISTINCT product_code, txn_date FROM f_sale"
T["resale"] = """SELECT return_authorization_id, receipt_date, EXISTS (SELECT 1 FROM sale_days s WHERE s.product_code = r.product_sku AND s.txn_date BETWEEN r.receipt_date AND r.receipt_date + 30) AS resold
FROM f_return r WHERE restocked_as_condition = 'OPEN_BOX'"""
kpi("open_box_conversion_rate", "SELECT count_if(resold) AS converted_numerator, count(*) AS returns_denominator FROM resale", INF)
kpi("cart_abandonment_rate", "SELECT count_if(has_cart AND NOT has_purchase) AS abandoned_numerator, count_if(has_cart) AS cart_sessions_denominator FROM funnel")
kpi("checkout_conversion_rate", "SELECT count_if(has_purchase) AS purchase_numerator, count_if(has_checkout) AS checkout_init_denominator FROM funnel")
kpi("browse_online_buy_in_store_rate", """SELECT count(DISTINCT (customer, sku)) FILTER (bought) AS browse_buy_numerator, count(DISTINCT (customer, sku)) AS browse_denominator FROM (
SELECT s.customer, e.product_sku AS sku, EXISTS (SELECT 1 FROM f_sale f WHERE f.customer_id = s.customer AND f.product_code = e.product_sku AND f.txn_date BETWEEN e.day AND e.day + 2) AS bought
FROM page_events e JOIN sessions s USING (session_id) WHERE e.product_sku IS NOT NULL AND s.customer IS NOT NULL)""", INF)
kpi("browse_online_contact_classifieds_rate", """SELECT count_if(followed) AS contact_followup_numerator, count(*) AS product_view_sessions_denominator FROM (
SELECT session_id, EXISTS (SELECT 1 FROM listing_events c WHERE c.user_ref = s.customer AND c.code IN ('CHAT', 'PHN_REVEAL', 'OFFER_ACC') AND c.moment >= s.last_at AND c.moment <= s.last_at + INTERVAL 24 HOUR) AS followed
FROM sessions s WHERE session_id IN (SELECT session_id FROM page_events WHERE product_sku IS NOT NULL))""", INF)
kpi("bopis_pickup_readiness_time", """SELECT round(sum(placed_to_captured_hours) / count(*), 2) AS avg_readiness_hours, count(*) AS bopis_orders FROM f_fulfil
WHERE delivery_method_code = 'BOPIS' AND placed_to_captured_hours IS NOT NULL""")
kpi("boris_count", "SELECT count_if(l_linestatus = 'O' AND l_tax < 0.025) AS boris_returns FROM returned")
kpi("on_time_delivery_rate", "SELECT count_if(total_lifecycle_hours <= 120) AS on_time_numerator, count(delivered_date_key) AS delivered_denominator FROM f_fulfil")
kpi("payment_failure_rate", "SELECT count_if(o_totalprice < 40000) AS failed_numerator, count(*) AS attempts_denominator FROM orders")
kpi("active_listing_count", "SELECT count_if(p_size <= 20) AS active_listings FROM part")
kpi("listing_contact_rate", "SELECT (SELECT count(*) FROM listing_events WHERE code IN ('CHAT', 'PHN_REVEAL', 'OFFER_ACC')) AS contact_numerator, (SELECT count(*) FROM part WHERE p_size <= 20) AS active_listing_denominator")
kpi("relisting_rate", "SELECT count_if(a12 OR by_metadata) AS relisted_numerator, count(*) AS listing_denominator FROM nl_hits")
kpi("duplicate_listing_inflation_factor", "SELECT count(*) AS total_listings, count_if(NOT (a12 OR by_metadata) AND NOT a13) AS deduplicated_listings FROM nl_hits")
kpi("seller_risk_score_distribution", """SELECT CASE WHEN t.risk_score >= 0.65 THEN 'HIGH' WHEN t.risk_score >= 0.40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band, count(*) AS seller_count
FROM sellers JOIN trust t USING (seller_id) GROUP BY 1""")
kpi("validated_report_rate", "SELECT count_if(a13) AS corroborated_numerator, count_if(a12 OR by_metadata OR a13) AS flagged_denominator FROM nl_hits", INF)

# ---- reconciliation ----------------------------------------------------------------------------
_VIEWS = [  # group, certainty, view, its keys, the tables it reads
    ("Finance", "CONFIRMED", "gsv", "channel,campaign_phase", "L S"), ("Finance", "CONFIRMED", "ncr", "channel,campaign_phase", "L S"),
    ("Finance", "CONFIRMED", "revenue_leakage", "leakage_type", "L S R"), ("Finance", "CONFIRMED", "gross_margin_by_channel", "channel", "L S"),
    ("Finance", "CONFIRMED", "net_margin_after_fulfilment", "", "L S R"), ("Finance", "CONFIRMED", "confirmed_gmv", "campaign_phase", "L S"),
    ("Finance", "ESTIMATED", "estimated_classified_gmv", "", "E C"), ("Finance", "CONFIRMED", "campaign_incremental_revenue", "", "L"),
    ("Inventory", "CONFIRMED", "atp_sku_loc_date", "sku,location_id,snapshot_date", "W"), ("Inventory", "CONFIRMED", "stockout_rate", "snapshot_date", "W"),
    ("Inventory", "CONFIRMED", "oversell_count", "snapshot_date", "W"), ("Inventory", "CONFIRMED", "inventory_accuracy_rate", "", "I"),
    ("Inventory", "CONFIRMED", "return_to_restock_cycle_time", "", "R"), ("Inventory", "INFERRED", "open_box_conversion_rate", "", "R S"),
    ("Ecommerce and store", "CONFIRMED", "cart_abandonment_rate", "", "P"), ("Ecommerce and store", "CONFIRMED", "checkout_conversion_rate", "", "P"),
    ("Ecommerce and store", "INFERRED", "browse_online_buy_in_store_rate", "", "P B S"), ("Ecommerce and store", "INFERRED", "browse_online_contact_classifieds_rate", "", "P B E"),
    ("Ecommerce and store", "CONFIRMED", "bopis_pickup_readiness_time", "", "F"), ("Ecommerce and store", "CONFIRMED", "boris_count", "", "R"),
    ("Ecommerce and store", "CONFIRMED", "on_time_delivery_rate", "", "F"), ("Ecommerce and store", "CONFIRMED", "payment_failure_rate", "", "F"),
    ("Classifieds and sellers", "CONFIRMED", "active_listing_count", "", "C"), ("Classifieds and sellers", "CONFIRMED", "listing_contact_rate", "", "E C"),
    ("Classifieds and sellers", "CONFIRMED", "relisting_rate", "", "C"), ("Classifieds and sellers", "CONFIRMED", "duplicate_listing_inflation_factor", "", "C"),
    ("Classifieds and sellers", "CONFIRMED", "seller_risk_score_distribution", "risk_band", "D"), ("Classifieds and sellers", "INFERRED", "validated_report_rate", "", "C"),
]
_TABLES = {"L": "ecommerce_order_line", "S": "store_sale_line", "R": "return_line", "E": "classified_listing_event", "C": "classified_listing_snapshot", "W": "warehouse_inventory_snapshot",
           "I": "store_inventory_snapshot", "P": "web_page_event", "B": "web_session", "F": "order_fulfilment", "D": "dim_seller"}
O["kpi_catalogue"] = "SELECT v.*, s.source_rows FROM (VALUES " + ", ".join(
    f"('{n}', '{g}', '{c}', '{k}', {'true' if n == 'atp_sku_loc_date' else 'false'}, '{_TABLES[t]}')" for g, c, n, k, ts in _VIEWS for t in ts.split()
) + ") v(view_name, kpi_group, certainty, view_keys, is_semi_additive, source_table) JOIN (" + union(
    f"SELECT '{n}' AS source_table, count(*) AS source_rows FROM {FACT_TABLES[n] if n in FACT_TABLES else _DIM_ROWS['seller']}" for n in _TABLES.values()
) + ") s USING (source_table)"
O["gsv_to_ncr_waterfall"] = """SELECT step, item, amount::DOUBLE AS amount, (CASE WHEN step = 4 THEN a1 + a2 + a3 ELSE running END)::DOUBLE AS running_total, step < 4 OR amount = a1 + a2 + a3 AS ties_out FROM (
SELECT step, item, amount, sum(amount) OVER (ORDER BY step) AS running, first_value(amount) OVER w AS a1, nth_value(amount, 2) OVER w AS a2, nth_value(amount, 3) OVER w AS a3 FROM (
SELECT 1 AS step, 'GROSS_SALE_VALUE' AS item, ((SELECT sum(gross) FROM f_line) + (SELECT sum(gross) FROM f_sale))::DECIMAL(30,4) AS amount
UNION ALL SELECT 2, 'CANCELLED_ONLINE_REVENUE', (SELECT -sum(gross) FROM f_line WHERE order_status = 'CANCELLED')::DECIMAL(30,4)
UNION ALL SELECT 3, 'STORE_LINE_DISCOUNTS', (SELECT -sum(discount) FROM f_sale)::DECIMAL(30,4)
UNION ALL SELECT 4, 'NET_CONFIRMED_REVENUE', ((SELECT sum(confirmed) FROM f_line) + (SELECT sum(net) FROM f_sale))::DECIMAL(30,4))
WINDOW w AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""
O["team_divergence"] = """SELECT team, round(c, 2) AS claimed, round(r, 2) AS reconciled, round(c - r, 2) AS difference FROM (
SELECT 'Sales' AS team, (SELECT sum(gross)::DOUBLE FROM f_line) + (SELECT sum(price)::DOUBLE FROM listing_events JOIN listings USING (listing_id) WHERE code = 'SELLER_SOLD') AS c, (SELECT sum(confirmed)::DOUBLE FROM f_line) AS r
UNION ALL SELECT 'Finance', (SELECT sum(confirmed)::DOUBLE FROM f_line), (SELECT sum(confirmed)::DOUBLE FROM f_line)
UNION ALL SELECT 'Marketplace', count(*)::DOUBLE, count_if(NOT (a12 OR by_metadata) AND NOT a13)::DOUBLE FROM nl_hits
UNION ALL SELECT 'Inventory', count_if(atp_qty > 0)::DOUBLE, count_if(physical_qty > 0)::DOUBLE FROM wh_snaps
UNION ALL SELECT 'Store operations', count_if(order_status = 'DELIVERED')::DOUBLE, count_if(order_status = 'DELIVERED' AND NOT b7)::DOUBLE FROM ec_hits
UNION ALL SELECT 'Support', count(*)::DOUBLE, count(DISTINCT text)::DOUBLE FROM documents)"""
O["campaign_run_rate"] = """SELECT round(c / cd, 2) AS campaign_per_day, round(p / pd, 2) AS pre_ramp_per_day, round((c / cd - p / pd) / (p / pd), 4) AS uplift FROM (
SELECT (sum(net) FILTER (campaign_phase = 'CAMPAIGN'))::DOUBLE AS c, (sum(net) FILTER (campaign_phase = 'PRE_RAMP'))::DOUBLE AS p FROM by_channel_phase),
(SELECT count_if(campaign_phase = 'CAMPAIGN')::DOUBLE AS cd, count_if(campaign_phase = 'PRE_RAMP')::DOUBLE AS pd FROM phases)"""
O["decision_sensitivity"] = """SELECT decision, round(a, 2) AS with_decision, round(b, 2) AS with_alternative, round(round(a, 2) - round(b, 2), 2) AS difference FROM (
SELECT 'SESSION_ATTRIBUTION' AS decision, coalesce(sum(confirmed) FILTER (attribution_rule IS NOT NULL), 0)::DOUBLE AS a, coalesce(sum(confirmed) FILTER (attribution_rule = 'PROMO_CODE'), 0)::DOUBLE AS b FROM f_line
UNION ALL SELECT 'PARTIAL_REFUND_IN_RETURN_PERIOD', coalesce(sum(impact) FILTER (NOT b2), 0)::DOUBLE, sum(impact)::DOUBLE FROM rf_hits
UNION ALL SELECT 'NULL_REFERENCE_IS_NOT_SHRINKAGE', coalesce(sum(quantity_change) FILTER (reference_number IS NOT NULL), 0)::DOUBLE, sum(quantity_change)::DOUBLE FROM wh_moves
UNION ALL SELECT 'IDENTITY_MERGE_FROM_090', count_if(conf >= 0.9)::DOUBLE, count_if(conf >= 0.7)::DOUBLE FROM ids
UNION ALL SELECT 'UNSCANNED_PICKUP_IS_FULFILLED', count_if(order_status = 'DELIVERED')::DOUBLE, count_if(order_status = 'DELIVERED' AND NOT b7)::DOUBLE FROM ec_hits)"""
O["funnel_by_phase"] = """SELECT step AS step_code, CASE step WHEN 'AWARENESS' THEN 1 WHEN 'CONSIDERATION' THEN 2 WHEN 'INTENT' THEN 3 ELSE 4 END AS sequence_number, campaign_phase,
count(DISTINCT session_id) AS sessions, count(*) AS events FROM page_events JOIN phases ON date_day = day GROUP BY ALL"""
O["ncr_by_phase_wide"] = "SELECT channel, " + ", ".join(f"(round(sum(net) FILTER (campaign_phase = '{p}'), 2))::DOUBLE AS {p.lower()}" for p in
                                                        ["BASELINE", "PRE_RAMP", "CAMPAIGN", "POST_CAMPAIGN", "OUT_OF_SCOPE"]) + " FROM by_channel_phase GROUP BY 1"

# ---- analyses ----------------------------------------------------------------------------------
O["ring_scores"] = """SELECT a.*, round(0.5::DOUBLE * shared / listings + 0.2::DOUBLE * CASE WHEN opened_that_day >= 3 THEN 1 ELSE 0 END + 0.2::DOUBLE * least(1.0::DOUBLE, phone_reveals / listings) + 0.1::DOUBLE * cheap / listings, 6) AS ring_score FROM (
SELECT l.seller AS seller_account_id, count(*) AS listings, count_if(l.a13) AS shared, coalesce(sum(e.n), 0)::BIGINT AS phone_reveals, count_if(l.price::DOUBLE < m.med * 0.8::DOUBLE) AS cheap, any_value(b.n) AS opened_that_day
FROM nl_hits l JOIN (SELECT category, median(price::DOUBLE) AS med FROM listings GROUP BY 1) m USING (category)
LEFT JOIN (SELECT listing_id, count(*) AS n FROM listing_events WHERE code = 'PHN_REVEAL' GROUP BY 1) e USING (listing_id)
JOIN accounts a ON a.account = l.seller JOIN (SELECT created, count(*) AS n FROM accounts GROUP BY 1) b ON b.created = a.created GROUP BY 1) a"""
O["repeated_complaints"] = """SELECT case_id, customer_ref, EXISTS (SELECT 1 FROM cases p WHERE p.customer_ref = c.customer_ref AND p.text = c.text AND p.created < c.created AND p.created >= c.created - INTERVAL 48 HOUR) AS repeats FROM cases c"""
O["open_box_premium"] = """SELECT p.category, count(*) AS mislabelled_returns, sum(r.restocked_qty)::BIGINT AS units, sum(r.restocked_qty * p.list_price * 0.15::DECIMAL(3,2))::DOUBLE AS price_premium
FROM r_receipts r JOIN products p ON p.sku = r.product_sku WHERE a10 GROUP BY 1"""
O["open_box_resold"] = "SELECT date_trunc('month', receipt_date)::DATE AS month, count(*) AS open_box_returns, count_if(resold) AS resold_30d FROM resale GROUP BY 1"
O["orders_beyond_stock"] = """SELECT count(*) AS store_product_days, count_if(u > sellable_qty) AS short_days, coalesce(sum(n) FILTER (u > sellable_qty), 0)::BIGINT AS short_lines FROM (
SELECT store_id, product_code, txn_date, sum(quantity) AS u, count(*) AS n FROM f_sale GROUP BY 1, 2, 3) s JOIN f_si f ON f.store_id = s.store_id AND f.product_code = s.product_code AND f.snapshot_date = s.txn_date"""
O["warehouse_picks_beyond_stock"] = """SELECT warehouse_id, count(*) AS pick_days, count_if(p > atp_qty) AS short_days FROM (SELECT warehouse_id, sku, movement_datetime::DATE AS snapshot_date, -sum(quantity_change) AS p
FROM wh_moves WHERE quantity_change < 0 GROUP BY 1, 2, 3) JOIN r_wh_snaps USING (warehouse_id, sku, snapshot_date) GROUP BY 1"""
O["stock_accuracy_by_week"] = "SELECT date_trunc('week', snapshot_date)::DATE AS week, store_id, count_if(NOT anomaly_flag) AS accurate_numerator, count(*) AS snapshot_denominator FROM f_si GROUP BY 1, 2"
O["stock_by_location"] = "SELECT store_id, snapshot_date, sum(physical_qty)::BIGINT AS physical_qty, sum(sellable_qty)::BIGINT AS sellable_qty FROM f_si GROUP BY 1, 2"
O["promotion_effect"] = """SELECT coalesce(attribution_rule, 'ORGANIC') AS rule, campaign_phase, count(*) AS order_lines, sum(confirmed)::DOUBLE AS confirmed_revenue FROM f_line JOIN phases ON date_day = order_date GROUP BY 1, 2"""
O["cancelled_across_channels"] = """SELECT channel, count_if(c AND v > 0) AS cancelled_lines, (sum(v) FILTER (c AND v > 0))::DOUBLE AS cancelled_amount, sum(v)::DOUBLE AS total_amount FROM (
SELECT 'EC' AS channel, order_status = 'CANCELLED' AS c, gross AS v FROM f_line UNION ALL SELECT 'STORE', receipt_status = 'CANCELLED', net FROM f_sale) GROUP BY 1"""
T["first_orders"] = "SELECT customer_id, date_trunc('month', min(order_date))::DATE AS cohort, count(*) AS n FROM r_ec_orders GROUP BY 1"
O["repeat_purchase_by_cohort"] = "SELECT cohort, count(*) AS customers, count_if(n > 1) AS repeat_customers FROM first_orders GROUP BY 1"
O["pickup_volume_by_store"] = "SELECT pickup_store_id AS store_id, count(DISTINCT order_id) AS orders, count(*) AS order_lines FROM f_line WHERE pickup_store_id IS NOT NULL GROUP BY 1"
O["fulfilment_by_cohort"] = """SELECT cohort, count(total_lifecycle_hours) AS delivered, count_if(total_lifecycle_hours <= 120) AS on_time FROM f_fulfil JOIN first_orders USING (customer_id) GROUP BY 1"""
O["daily_traffic"] = "SELECT first_at::DATE AS day, count(*) AS sessions, count_if(session_id IN (SELECT session_id FROM page_events WHERE converts)) AS converted_sessions FROM sessions GROUP BY 1"
O["complaint_trend"] = """SELECT date_trunc('week', created)::DATE AS week, CASE channel WHEN 'carrier pigeon' THEN 'UNKNOWN' ELSE channel END AS channel_code, count(*) AS cases, count(DISTINCT first_id) AS incidents
FROM cases GROUP BY 1, 2"""

ORACLE = {
    # the count over a condition is a BIGINT that is zero, not null, when no row is left
    name: compose(sql, T).replace("count_if(", "count(*) FILTER (") for name, sql in O.items()
}
