"""Source, resolved, dimension and fact tables as SQL over the given tables."""

from __future__ import annotations

from oracle.compose import CLEAN, Q, audit, dkey, okey, quality, sk

AN, AM, EX = "FLAGGED_ANOMALY", "FLAGGED_AMBIGUOUS", "EXCLUDED_WITH_REASON"
UN, INF, EST, CON = "UNRELIABLE", "INFERRED", "ESTIMATED", "CONFIRMED"

T: dict[str, str] = {}

# ---- the given tables, enriched ----------------------------------------------------------------
T["ln"] = """
SELECT *, sha256(concat_ws('|', l_linenumber, l_partkey, l_suppkey, l_quantity::INT,
  l_extendedprice::DECIMAL(12,2), l_discount::DECIMAL(4,2), l_tax::DECIMAL(4,2), l_returnflag,
  l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS line_id,
  l_extendedprice::DECIMAL(12,2) AS gross, l_discount::DECIMAL(4,2) AS disc,
  l_tax::DECIMAL(4,2) AS tax, l_quantity::INT AS qty,
  CASE l_returnflag WHEN 'N' THEN -l_quantity::INT ELSE l_quantity::INT END AS signed,
  'P' || l_partkey AS sku FROM lineitem"""
T["od"] = """
SELECT *, o_orderdate::DATE AS day, o_orderdate + to_hours(o_orderkey % 24) AS created,
  CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'F' THEN 'DELIVERED' ELSE 'PENDING' END AS st,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'EXPRESS' WHEN '2-HIGH' THEN 'BOPIS'
    WHEN '5-LOW' THEN 'MARKETPLACE_SELLER' ELSE 'STANDARD' END AS method,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'UPI'
    WHEN '3-MEDIUM' THEN 'NETBANKING' WHEN '5-LOW' THEN 'COD' ELSE 'WALLET' END AS instrument,
  o_orderpriority = '4-NOT SPECIFIED' AS guest FROM orders"""
T["ev"] = """
SELECT *, date_trunc('second', ts - to_days(9284)) AS moment, (ts - to_days(9284))::DATE AS day,
  CASE event_type WHEN 'view' THEN 'ST-1' WHEN 'click' THEN 'ST-2' WHEN 'signup' THEN 'ST-3'
    WHEN 'purchase' THEN 'ST-4' ELSE 'ST-5' END AS store, floor(value)::INT - 40 AS delta,
  json_extract_string(props, '$.k')::INT AS k,
  'S-' || user_id || '-' || strftime(ts - to_days(9284), '%Y%m%d') AS session_id FROM events"""

# ---- source tables -----------------------------------------------------------------------------
T["ec_orders"] = """
SELECT o_orderkey AS order_id, 'EC-' || o_orderkey AS order_number, day AS order_date,
  created AS created_at, st AS order_status, CASE WHEN guest THEN '0' ELSE o_custkey::VARCHAR END AS customer_id,
  CASE WHEN guest THEN 'SESS-GUEST-' || o_orderkey
    ELSE 'S-' || o_custkey || '-' || strftime(day, '%Y%m%d') END AS session_id,
  method AS delivery_method_code, CASE WHEN method = 'BOPIS' THEN 'ST-' || (o_custkey % 25) END AS pickup_store_id,
  CASE WHEN o_totalprice >= 400000 THEN 'VIP10' WHEN o_totalprice >= 300000 THEN 'SCHOOL15' END AS promo_code_applied,
  o_totalprice::DECIMAL(12,2) AS subtotal FROM od"""
T["ec_order_lines"] = """
SELECT l_orderkey AS order_id, line_id, sku AS product_sku, qty AS quantity, gross AS line_total,
  gross * disc AS discount, l_extendedprice / l_quantity AS unit_price FROM ln WHERE l_linestatus = 'O'"""
T["ec_history"] = """
SELECT o_orderkey AS order_id, 'PLACED' AS status_code, created AS moment FROM od
UNION ALL SELECT o_orderkey, 'CANCELLED', created + to_hours(o_custkey % 72) FROM od WHERE o_orderstatus = 'P'"""
T["pg"] = """
SELECT 'PG-' || o_orderkey AS transaction_id, 'EC-' || o_orderkey AS order_ref, instrument AS type_code,
  CASE WHEN o_totalprice < 40000 THEN 'FAILED' ELSE 'CAPTURED' END AS status_code, created AS created_ts,
  CASE WHEN o_totalprice >= 40000 THEN created + to_hours((o_orderkey * 7) % 96) END AS captured_ts,
  o_totalprice::DECIMAL(12,2) AS amount, o_orderkey FROM od"""
T["pos_lines"] = """
SELECT 'R-' || l_orderkey AS txn_id, line_id AS line_no, sku AS product_code, qty AS quantity, gross,
  gross * disc AS discount, gross - gross * disc AS net, (gross - gross * disc) * tax AS tax_amt, tax AS tax_rate,
  l_orderkey FROM ln WHERE l_linestatus = 'F'"""
T["dc_events"] = """
SELECT 'PICKED_UP-' || o_orderkey AS event_id, 'SH-' || o_orderkey AS shipment_id, 'PICKED_UP' AS code,
  created + to_hours(6) AS moment, o_orderkey AS okey FROM od WHERE method <> 'BOPIS'
UNION ALL SELECT 'READY_FOR_PICKUP-' || o_orderkey, 'SH-' || o_orderkey, 'READY_FOR_PICKUP', created + to_hours(4),
  o_orderkey FROM od WHERE method = 'BOPIS'
UNION ALL SELECT 'BOPIS_COLLECTED-' || o_orderkey, 'SH-' || o_orderkey, 'BOPIS_COLLECTED', created + to_hours(30),
  o_orderkey FROM od WHERE method = 'BOPIS' AND o_orderstatus = 'F' AND o_custkey % 7 <> 0
UNION ALL SELECT 'DELIVERED-' || l_orderkey || '-' || line_id, 'SH-' || l_orderkey, 'DELIVERED', l_shipdate,
  l_orderkey FROM ln WHERE l_linestatus = 'O'"""
T["returned"] = """
SELECT *, l_orderkey || '-' || line_id AS rid, l_shipdate::DATE AS ship,
  (['DEFECTIVE','WRONG_ITEM','CHANGED_MIND','NOT_AS_DESCRIBED','LATE_DELIVERY','DAMAGED_IN_TRANSIT','SELLER_ERROR'])[l_linenumber] AS reason
FROM ln WHERE l_returnflag = 'R'"""
T["receipts"] = """
SELECT 'RC-' || rid AS receipt_id, 'RA-' || rid AS ra_id, sku AS product_sku,
  (ship + to_days(10 + l_linenumber))::DATE AS received_date,
  CASE WHEN l_tax < 0.015 THEN 'PENDING' ELSE 'PASSED' END AS inspection_status,
  CASE WHEN l_discount < 0.025 THEN 0 ELSE qty END AS restocked_qty,
  CASE WHEN l_discount >= 0.045 THEN 'OPENED' ELSE 'SEALED' END AS condition_on_receipt,
  CASE WHEN l_tax < 0.045 THEN 'NEW' ELSE 'OPEN_BOX' END AS restocked_as_condition FROM returned"""
T["refunds"] = """
SELECT 'RF-' || rid AS refund_id, 'RA-' || rid AS ra_id, 'EC-' || l_orderkey AS original_order_ref,
  CASE WHEN l_discount >= 0.065 THEN 'PARTIAL' ELSE 'FULL' END AS refund_type, gross AS subtotal,
  CASE WHEN l_discount >= 0.065 THEN gross * disc ELSE gross::DECIMAL(17,4) END AS refund_amount,
  CASE WHEN l_tax >= 0.065 THEN 5.00::DECIMAL(8,2) ELSE 0::DECIMAL(8,2) END AS restocking_fee,
  (ship + to_days(20))::DATE AS refund_date, l_orderkey FROM returned"""
T["si_snaps"] = """
SELECT store AS store_id, 'P' || user_id AS product_code, day AS snapshot_date,
  (sum(sum(delta)) OVER (PARTITION BY store, user_id ORDER BY day))::INT AS physical_qty
FROM ev GROUP BY store, user_id, day"""
T["si_moves"] = """
SELECT 'SM-' || event_id AS movement_id, store AS store_id, 'P' || user_id AS product_code,
  CASE WHEN value < 40 THEN 'PICK' WHEN event_type = 'error' THEN 'RET' ELSE 'RCVD' END AS movement_type,
  delta AS quantity_change, CASE WHEN event_type <> 'error' THEN 'REF-' || event_id END AS reference_number,
  day AS movement_date FROM ev WHERE value < 250"""
T["wh_snaps"] = """
SELECT 'WH-' || l_suppkey AS warehouse_id, sku, l_shipdate::DATE AS snapshot_date,
  greatest(sum(signed), 0)::INT AS physical_qty,
  sum(CASE WHEN l_returnflag <> 'N' OR l_tax >= 0.065 THEN qty ELSE 0 END)::INT AS atp_qty
FROM ln WHERE l_linestatus = 'O' GROUP BY ALL"""
T["wh_moves"] = """
SELECT 'WM-' || l_orderkey || '-' || line_id AS movement_id, 'WH-' || l_suppkey AS warehouse_id, sku,
  CASE l_returnflag WHEN 'N' THEN 'PCK' WHEN 'A' THEN 'RCV' ELSE 'RET' END AS movement_type,
  signed AS quantity_change,
  CASE WHEN NOT (l_returnflag = 'N' AND l_discount < 0.015) THEN 'EC-' || l_orderkey END AS reference_number,
  l_shipdate AS movement_datetime FROM ln WHERE l_linestatus = 'O'"""
T["page_events"] = """
SELECT session_id, event_id, moment,
  CASE event_type WHEN 'view' THEN 'PRODUCT_VIEW' WHEN 'click' THEN 'ADD_TO_CART' WHEN 'signup' THEN 'CHECKOUT_INIT'
    WHEN 'purchase' THEN 'PURCHASE' ELSE 'ERROR' END AS code,
  CASE event_type WHEN 'view' THEN 'CONSIDERATION' WHEN 'click' THEN 'INTENT' WHEN 'signup' THEN 'INTENT'
    WHEN 'purchase' THEN 'CONVERSION' ELSE 'AWARENESS' END AS step,
  CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'P' || k END AS product_sku,
  floor(value)::INT AS seconds, CASE WHEN event_type = 'click' THEN value::DECIMAL(12,2) END AS cart_value,
  event_type = 'purchase' AS converts, day FROM ev"""
T["sessions"] = """
SELECT session_id, min(moment) AS first_at, max(moment) AS last_at, CASE WHEN min(k) < 30 THEN 'SCHOOL98' END AS utm,
  CASE WHEN count(*) > 1 THEN user_id::VARCHAR END AS customer,
  CASE WHEN min(k) % 2 = 0 THEN 'MOBILE' ELSE 'DESKTOP' END AS device,
  CASE WHEN min(k) < 30 THEN 'PAID' ELSE 'ORGANIC' END AS channel,
  count(*) FILTER (event_type = 'view')::INT AS pageviews, count(*)::INT AS n
FROM ev GROUP BY session_id, user_id"""
T["listings"] = """
SELECT p_partkey AS listing_id, 'NL-' || p_partkey AS listing_ref, p_brand AS seller, p_type AS category,
  CASE WHEN p_size <= 20 THEN 'ACTIVE' WHEN p_size <= 35 THEN 'SOLD' WHEN p_size <= 45 THEN 'EXPIRED' ELSE 'DRAFT' END AS status,
  p_name AS title, p_retailprice::DECIMAL(12,2) AS price,
  CASE WHEN p_size <> 50 THEN sha256(concat_ws('|', p_name, p_type, p_partkey % 4)) END AS image_hash,
  CASE WHEN p_size = 7 THEN 1 ELSE 0 END AS relist_count, p_size,
  TIMESTAMP '1998-06-01' + to_days((p_partkey % 90)::INT) AS created,
  TIMESTAMP '1998-06-01' + to_days((p_partkey % 90)::INT + p_size) AS updated FROM part"""
T["listing_events"] = """
SELECT user_id AS listing_id, event_id, moment, day, k::VARCHAR AS user_ref,
  CASE event_type WHEN 'view' THEN 'VIEW' WHEN 'click' THEN 'CHAT' WHEN 'signup' THEN 'PHN_REVEAL'
    WHEN 'purchase' THEN 'SELLER_SOLD' ELSE 'OFFER_ACC' END AS code,
  CASE WHEN event_type = 'error' THEN value::DECIMAL(12,2) END AS offer FROM ev"""
T["accounts"] = """
SELECT p_brand AS account, min(TIMESTAMP '1998-06-01' + to_days((p_partkey % 90)::INT)) AS created FROM part GROUP BY 1"""
T["products"] = """
SELECT 'P' || p_partkey AS sku, p_name AS product_name, p_brand AS brand, p_type AS category,
  p_retailprice::DECIMAL(12,2) AS list_price,
  CASE WHEN p_type <> 'PROMO' THEN (p_retailprice::DECIMAL(12,2) * 0.6::DECIMAL(2,1))::DECIMAL(12,2) END AS cogs FROM part"""
T["seller_listings"] = """
SELECT p_partkey AS listing_id, regexp_extract(p_brand, '(\\d+)', 1)::BIGINT AS seller_id,
  CASE WHEN p_size = 49 THEN 'X' || p_partkey WHEN p_size IN (10, 25, 40) THEN NULL ELSE 'P' || p_partkey END AS ref,
  CASE WHEN p_size <= 3 THEN 'phone case ' || lower(p_type) WHEN p_size <= 20 THEN replace(p_name, 'e', '3')
    WHEN p_size <= 30 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) ELSE upper(p_name) END AS title,
  p_type AS category FROM part"""
T["sellers"] = """
SELECT s_suppkey AS seller_id, s_name AS seller_name, CASE WHEN s_acctbal < 0 THEN 'SUSPENDED'
  WHEN s_acctbal < 1000 THEN 'pending' WHEN s_acctbal < 2000 THEN 'PROBATION' ELSE 'ACTIVE' END AS seller_status FROM supplier"""
T["src_seller"] = "SELECT doc_id, substr(source, 4)::BIGINT AS seller_id FROM documents"
T["reviews"] = """
SELECT 'RV-' || l_orderkey || '-' || line_id AS review_id, 1 + l_linenumber % 5 AS rating, sku AS product_sku,
  (l_orderkey % 150)::VARCHAR AS customer_id, qty - 10 AS days_post_delivery,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS verified, (l_shipdate + to_days(qty - 10)) AS moment
FROM ln WHERE l_returnflag = 'A'"""
T["cases"] = """
SELECT doc_id AS case_id, 'CS-' || doc_id AS case_reference, first_id,
  CASE WHEN first_id < doc_id THEN 'CS-' || first_id END AS canonical_case_ref, first_id < doc_id AS dup,
  TIMESTAMP '1998-08-01' + to_days((doc_id % 45)::INT) + to_hours(doc_id % 24) AS created,
  CASE WHEN lang <> 'de' THEN TIMESTAMP '1998-08-01' + to_days((doc_id % 45)::INT) + to_hours(doc_id % 24)
    + to_hours(n_chars % 200) END AS resolved,
  (doc_id % 15)::VARCHAR AS customer_ref, CASE lang WHEN 'en' THEN 'EC' WHEN 'fr' THEN 'STORE'
    WHEN 'es' THEN 'CLASSIFIEDS' ELSE 'carrier pigeon' END AS channel,
  substr(source, 4)::BIGINT AS seller_id, 'CAT-' || lang AS category_code,
  CASE WHEN lang = 'de' THEN 'OPEN' ELSE 'CLOSED' END AS status_code,
  CASE WHEN n_chars > 1000 THEN 'REFUND' ELSE 'INFO' END AS outcome,
  CASE WHEN n_chars > 1000 THEN 'SELLER' ELSE 'NONE' END AS fault, text
FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents)"""

# ---- resolved tables ---------------------------------------------------------------------------
T["placeholders"] = """
SELECT customer_id FROM (SELECT customer_id, count(*) AS n FROM ec_orders GROUP BY 1)
WHERE n > 20 * (SELECT median(n) FROM (SELECT count(*) AS n FROM ec_orders GROUP BY customer_id))
  AND customer_id IN (SELECT c_custkey::VARCHAR FROM customer)"""
T["ec_hits"] = """
SELECT o.*, o.order_status = 'CANCELLED' AND o.subtotal > 0 AS a1, o.customer_id IN (SELECT customer_id FROM placeholders) AND o.session_id LIKE 'SESS-GUEST-%' AS a11,
  o.order_date BETWEEN DATE '1998-08-08' AND DATE '1998-08-28' AND o.promo_code_applied IS NULL
    AND EXISTS (SELECT 1 FROM sessions s WHERE s.session_id = o.session_id AND s.utm = 'SCHOOL98') AS b1,
  o.delivery_method_code = 'BOPIS' AND o.order_status = 'DELIVERED'
    AND NOT EXISTS (SELECT 1 FROM dc_events e WHERE e.okey = o.order_id AND e.code = 'BOPIS_COLLECTED') AS b7
FROM ec_orders o"""
T["r_ec_orders"] = f"""
SELECT * EXCLUDE (subtotal, customer_id), CASE WHEN a1 THEN 0 ELSE subtotal END AS subtotal_excl_tax,
  CASE WHEN a11 THEN 'GUEST-' || session_id ELSE customer_id END AS customer_id,
  CASE WHEN b1 THEN 0.85::DOUBLE END AS attribution_confidence, b7 AS collection_unconfirmed,
  {quality(("a1", "CANCELLED_WITH_REVENUE", AN, UN), ("a11", "PLACEHOLDER_ID_COLLISION", AN, UN),
           ("b1", "ATTRIBUTION_SESSION_BRIDGE", "CLEAN", INF), ("b7", "BOPIS_NO_PICKUP_EVENT", AM, INF))},
  {audit(("a1", "ZEROED_CANCELLED_REVENUE"), ("a11", "REKEYED_GUEST_BUCKET"), ("b1", "B_DECISION_APPLIED"),
         ("b7", "B_DECISION_APPLIED"),
         cls="CASE WHEN b7 THEN 'TREAT_AS_FULFILLED' WHEN b1 THEN 'ATTRIBUTED' END")}
FROM ec_hits"""
T["pg_hits"] = """
SELECT p.*, c.cancelled_ts, coalesce(p.captured_ts IS NOT NULL AND c.cancelled_ts IS NOT NULL, false) AS a2
FROM pg p LEFT JOIN (SELECT 'EC-' || order_id AS ref, min(moment) AS cancelled_ts FROM ec_history
  WHERE status_code = 'CANCELLED' GROUP BY 1) c ON c.ref = p.order_ref"""
T["rc_hits"] = """
SELECT *, inspection_status = 'PENDING' AND restocked_qty > 0 AS a7,
  condition_on_receipt = 'OPENED' AND restocked_as_condition = 'NEW' AS a10 FROM receipts"""
T["r_receipts"] = f"""
SELECT * REPLACE (CASE WHEN a7 THEN 0 ELSE restocked_qty END AS restocked_qty,
    CASE WHEN a10 THEN 'OPEN_BOX' ELSE restocked_as_condition END AS restocked_as_condition),
  {quality(("a7", "RESTOCK_BEFORE_INSPECTION", AN, UN), ("a10", "OPEN_BOX_AS_NEW", AN, UN))},
  {audit(("a7", "ZEROED_RESTOCK_PRE_INSPECTION"), ("a10", "CORRECTED_CONDITION_OPEN_BOX"))}
FROM rc_hits"""
T["rf_hits"] = """
SELECT r.*, date_trunc('month', o.order_date)::DATE AS original_month,
  date_trunc('month', r.refund_date)::DATE AS refund_month,
  r.restocking_fee - CASE WHEN r.refund_type = 'FULL' THEN r.subtotal ELSE r.refund_amount END AS impact,
  coalesce(date_trunc('month', o.order_date) <> date_trunc('month', r.refund_date), false) AS crosses,
  coalesce(r.refund_type = 'PARTIAL' AND date_trunc('month', o.order_date) <> date_trunc('month', r.refund_date), false) AS b2
FROM refunds r LEFT JOIN ec_orders o ON o.order_number = r.original_order_ref"""
T["r_refunds"] = f"""
SELECT *, {quality(("b2", "REFUND_PARTIAL_PERIOD_AMBIGUITY", AM, INF))},
  {audit(("b2", "B_DECISION_APPLIED"), cls="CASE WHEN b2 THEN 'RECOGNISE_IN_RETURN_PERIOD' END")} FROM rf_hits"""
T["r_si_snaps"] = f"""
SELECT store_id, product_code, snapshot_date, greatest(physical_qty, 0) AS physical_qty,
  greatest(physical_qty - 5, 0) AS sellable_qty, a6 AS oversell_flag,
  {quality(("a6", "NEGATIVE_QTY", AN, UN))}, {audit(("a6", "CORRECTED_ATP_TO_ZERO"))}
FROM (SELECT *, physical_qty - 5 < 0 OR physical_qty < 0 AS a6 FROM si_snaps)"""
T["si_spine"] = """
SELECT p.store_id, p.product_code, d::DATE AS snapshot_date
FROM (SELECT DISTINCT store_id, product_code FROM si_snaps) p,
  (SELECT unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 DAY)) AS d FROM si_snaps)"""
T["si_gaps"] = """
SELECT s.* FROM si_spine s ANTI JOIN si_snaps USING (store_id, product_code, snapshot_date)"""
T["recon"] = f"""
SELECT g.store_id, g.product_code, g.snapshot_date,
  round(b.physical_qty + coalesce(a.physical_qty - b.physical_qty, 0)
    * coalesce(date_diff('day', b.snapshot_date, g.snapshot_date) / date_diff('day', b.snapshot_date, a.snapshot_date), 0.0))::INT AS physical_qty,
  round(b.sellable_qty + coalesce(a.sellable_qty - b.sellable_qty, 0)
    * coalesce(date_diff('day', b.snapshot_date, g.snapshot_date) / date_diff('day', b.snapshot_date, a.snapshot_date), 0.0))::INT AS sellable_qty,
  CASE WHEN a.snapshot_date IS NULL THEN 'LOCF' ELSE 'LINEAR_INTERP' END AS recon_method,
  true AS is_reconstructed, true AS anomaly_flag,
  'RECONSTRUCTED_SNAPSHOT,MISSING_SNAPSHOT_DAY' AS anomaly_reason_code,
  'RECONSTRUCTED' AS data_quality_status, 'INFERRED' AS metric_certainty_level
FROM si_gaps g
ASOF JOIN r_si_snaps b ON g.store_id = b.store_id AND g.product_code = b.product_code AND g.snapshot_date >= b.snapshot_date
ASOF LEFT JOIN r_si_snaps a ON g.store_id = a.store_id AND g.product_code = a.product_code AND g.snapshot_date <= a.snapshot_date"""
T["r_wh_snaps"] = f"""
SELECT warehouse_id, sku, snapshot_date, physical_qty, CASE WHEN a5 THEN 0 ELSE atp_qty END AS atp_qty,
  {quality(("a5", "ATP_POSITIVE_PHYSICAL_ZERO", AN, UN))}, {audit(("a5", "CORRECTED_ATP_TO_ZERO"))}
FROM (SELECT *, atp_qty > 0 AND physical_qty = 0 AS a5 FROM wh_snaps)"""
T["r_wh_moves"] = f"""
SELECT *, {quality(("b3", "MOVEMENT_NULL_REF", AM, INF))},
  {audit(("b3", "B_DECISION_APPLIED"), cls="CASE WHEN b3 THEN 'PROBABLE_MISSING_REF' END")}
FROM (SELECT *, reference_number IS NULL AS b3 FROM wh_moves)"""
T["r_listing_events"] = f"""
SELECT *, {quality(("a4", "NL_SELLER_SOLD_AS_REVENUE", AN, EST), ("b6", "ESTIMATED_NL_GMV", "CLEAN", EST))},
  {audit(("a4", "RELABELLED_ESTIMATED_GMV"), ("b6 AND NOT a4", "B_DECISION_APPLIED"))}
FROM (SELECT *, code = 'SELLER_SOLD' AS a4, code IN ('SELLER_SOLD', 'OFFER_ACC', 'PHN_REVEAL', 'CHAT', 'CHAT_START') AS b6
  FROM listing_events)"""
T["scored_names"] = """
SELECT p_type AS category, array_to_string(list_sort(string_split(lower(trim(p_name)), ' ')), ' ') AS norm, min(p_name) AS name
FROM part GROUP BY 1, 2"""
T["nl_scores"] = """
SELECT listing_id, CASE WHEN s >= 0.65 THEN s END AS score FROM (
  SELECT l.listing_id, max(1.0::DOUBLE - levenshtein(l.norm, n.norm) / greatest(length(l.norm), length(n.norm))) AS s
  FROM (SELECT *, array_to_string(list_sort(string_split(lower(trim(title)), ' ')), ' ') AS norm FROM listings WHERE status = 'ACTIVE') l
  JOIN scored_names n ON n.category = l.category
    AND list_has_any(string_split(l.norm, ' '), string_split(n.norm, ' ')) GROUP BY 1)"""
T["nl_hits"] = """
SELECT l.*, l.status = 'ACTIVE' AND coalesce(l.created > e.first_end, false) AS a12, l.relist_count > 0 AS by_metadata,
  l.status = 'ACTIVE' AND coalesce(l.created > e.first_end, false) AS strict,
  coalesce(r.sellers >= 2, false) AS a13, l.status = 'ACTIVE' AS active, s.score
FROM listings l
LEFT JOIN (SELECT seller, image_hash, min(updated) AS first_end FROM listings
  WHERE status IN ('SOLD', 'EXPIRED') AND image_hash IS NOT NULL GROUP BY 1, 2) e
  ON e.seller = l.seller AND e.image_hash = l.image_hash
LEFT JOIN (SELECT image_hash, count(DISTINCT seller) AS sellers FROM listings WHERE image_hash IS NOT NULL GROUP BY 1) r
  ON r.image_hash = l.image_hash
LEFT JOIN nl_scores s USING (listing_id)"""
T["r_listings"] = f"""
SELECT *, a12 AS excluded_from_gmv, CASE WHEN a12 THEN 'LOW' END AS relisting_reliability, a13 AS fraud_ring_flag,
  score AS b4_match_confidence,
  {quality(("(a12 OR by_metadata)", "RELISTED_AFTER_SOLD", AN, INF), ("a13", "IMAGE_HASH_REUSED", AN, INF))},
  {audit(("a12", "LINKED_RELISTING_EXCLUDED"), ("a13", "FLAGGED_FRAUD_RING"),
         ("active AND NOT a12 AND NOT a13", "B_DECISION_APPLIED"),
         cls="CASE WHEN active AND NOT a12 AND NOT a13 THEN CASE WHEN score >= 0.75 THEN 'MATCHED' "
             "WHEN score >= 0.65 THEN 'MANUAL_REVIEW' ELSE 'UNMATCHED' END END")}
FROM nl_hits"""
T["miles"] = """
SELECT shipment_id, okey, max(moment) FILTER (code = 'PICKED_UP') AS pickup_ts, min(moment) FILTER (code = 'DELIVERED') AS delivered_ts
FROM dc_events GROUP BY 1, 2"""
T["transit"] = """
SELECT coalesce(median(date_sub('hour', pickup_ts, delivered_ts)), 36.0) AS h FROM miles WHERE delivered_ts >= pickup_ts"""
T["dc_hits"] = """
SELECT e.*, m.pickup_ts, m.delivered_ts, o.created AS ship_created_ts, t.h,
  coalesce(e.moment < o.created, false) AS drift,
  e.code = 'DELIVERED' AND coalesce(m.delivered_ts < m.pickup_ts, false) AS a14,
  coalesce(abs(date_diff('second', m.pickup_ts, m.delivered_ts)) / 3600.0 <= 72, false) AS small
FROM dc_events e JOIN miles m USING (shipment_id) LEFT JOIN od o ON o.o_orderkey = e.okey, transit t"""
T["r_dc_events"] = f"""
SELECT *, CASE WHEN a14 AND small THEN pickup_ts + to_seconds(h * 3600) END AS corrected,
  a14 AND NOT small AS requires_manual_review,
  {quality(("drift", "COURIER_CLOCK_DRIFT", AM, INF), ("a14", "DELIVERY_BEFORE_SHIP", AN, UN))},
  {audit(("a14 AND small", "CORRECTED_DELIVERY_TS"), ("a14 AND NOT small", "ESCALATED_MANUAL_REVIEW"))} FROM dc_hits"""
T["r_reviews"] = f"""
SELECT * REPLACE (CASE WHEN a15 THEN 0 ELSE verified END AS verified), {quality(("a15", "REVIEW_BEFORE_DELIVERY", AN, UN))},
  {audit(("a15", "SET_VERIFIED_PURCHASE_FALSE"))} FROM (SELECT *, days_post_delivery < 0 AS a15 FROM reviews)"""
T["r_cases"] = f"""
SELECT *, coalesce(canonical_case_ref, case_reference) AS canonical_case_key,
  {quality(("channel = 'carrier pigeon'", "MANUAL_CHANNEL_ATTRIBUTION", AM, INF), ("dup", "DUPLICATE_CASE", AN, INF))},
  {audit(("dup", "DEDUPED_CANONICAL_CASE"))} FROM cases"""
T["sl_hits"] = """
SELECT s.*, p.product_name AS canonical, 1.0::DOUBLE - levenshtein(s.norm, p.norm) / greatest(length(s.norm), length(p.norm)) AS likeness
FROM (SELECT *, array_to_string(list_sort(string_split(lower(trim(title)), ' ')), ' ') AS norm FROM seller_listings) s
LEFT JOIN (SELECT *, array_to_string(list_sort(string_split(lower(trim(product_name)), ' ')), ' ') AS norm FROM products) p
  ON p.sku = s.ref"""

# ---- seller trust and listing confidence -------------------------------------------------------
T["sold"] = """
SELECT l.l_suppkey AS seller_id, l.l_orderkey, l.l_shipdate, l.l_returnflag = 'R' AS back, o.day, o.st = 'CANCELLED' AS cancelled,
  l.l_shipdate > o.o_orderdate + to_hours(120) AS late FROM ln l JOIN od o ON o.o_orderkey = l.l_orderkey"""
T["trust_inputs"] = """
SELECT seller_id, coalesce(s.cancelled, 0) AS cancellation_numerator, coalesce(s.n, 0) AS cancellation_denominator,
  coalesce(s.late, 0) AS late_numerator, coalesce(s.n, 0) AS late_denominator,
  coalesce(s.back, 0) AS return_numerator, coalesce(s.n, 0) AS return_denominator,
  CASE WHEN s.n IS NULL THEN 0 ELSE coalesce(c.n, 0) END AS complaint_numerator, coalesce(s.n, 0) AS complaint_denominator,
  coalesce(l.dup, 0) AS duplicate_numerator, coalesce(l.n, 0) AS duplicate_denominator,
  CASE WHEN l.n IS NULL THEN 0 ELSE coalesce(p.n, 0) END AS report_numerator, coalesce(l.n, 0) AS report_denominator,
  CASE WHEN s.n IS NULL THEN 0 ELSE coalesce(m.n, 0) END AS moderation_numerator, coalesce(s.n, 0) AS moderation_denominator,
  coalesce(least(t.a, t.q), 0) AS response_numerator, coalesce(t.q, 0) AS response_denominator
FROM (SELECT seller_id, count(*) AS n, count_if(cancelled) AS cancelled, count_if(late) AS late, count_if(back) AS back FROM sold GROUP BY 1) s
FULL JOIN (SELECT regexp_extract(seller, '(\\d+)', 1)::BIGINT AS seller_id, count(*) AS n, count_if(excluded_from_gmv OR fraud_ring_flag) AS dup
  FROM r_listings GROUP BY 1) l USING (seller_id)
FULL JOIN (SELECT conv_id % 20 AS seller_id, count_if(role = 'assistant') AS a, count_if(role = 'user') AS q FROM conversations GROUP BY 1) t USING (seller_id)
LEFT JOIN (SELECT seller_id, count(*) AS n FROM src_seller GROUP BY 1) c USING (seller_id)
LEFT JOIN (SELECT seller_id, count(*) AS n FROM src_seller JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY 1) p USING (seller_id)
LEFT JOIN (SELECT seller_id, count(*) AS n FROM src_seller JOIN labels USING (doc_id) WHERE quality = 0 GROUP BY 1) m USING (seller_id)"""


def _risk(rate: str, weight: float) -> str:
    r = f"{rate}_numerator::DOUBLE / nullif({rate}_denominator, 0)::DOUBLE"
    r = f"1.0::DOUBLE - {r}" if rate == "response" else r
    return f"{weight}::DOUBLE * greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce({r}, 0.0::DOUBLE)))"


_RISK = " + ".join(
    _risk(r, x) for r, x in [
        ("cancellation", 0.2), ("late", 0.2), ("return", 0.1), ("complaint", 0.15), ("duplicate", 0.12),
        ("report", 0.1), ("moderation", 0.08), ("response", 0.05),
    ]
)
T["trust"] = f"""
SELECT *, round(1.0::DOUBLE - trust_score, 6) AS risk_score, CASE WHEN trust_score >= 0.85 THEN 'VERIFIED_TRUSTED'
  WHEN trust_score >= 0.65 THEN 'STANDARD' WHEN trust_score >= 0.40 THEN 'UNDER_REVIEW' WHEN trust_score >= 0.20 THEN 'HIGH_RISK'
  ELSE 'SUSPENDED' END AS risk_tier, {quality(("trust_score < 0.30", "SELLER_HIGH_RISK", AN, INF))}
FROM (SELECT *, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - ({_RISK}))), 6) AS trust_score FROM trust_inputs)"""
T["confidence"] = """
SELECT *, round(0.3::DOUBLE * response_part + 0.3::DOUBLE * price_part + 0.2::DOUBLE * age_part + 0.1::DOUBLE * relist_part + 0.1::DOUBLE * report_part, 6) AS confidence_score
FROM (SELECT l.listing_id,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, date_diff('day', l.created::DATE, DATE '1998-09-14') / 30.0::DOUBLE)) AS age_part,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(e.answers::DOUBLE / nullif(e.chats, 0)::DOUBLE, 0.0::DOUBLE))) AS response_part,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - coalesce(abs(l.price::DOUBLE - m.med) / nullif(m.med, 0), 0.0::DOUBLE))) AS price_part,
  CASE WHEN l.excluded_from_gmv THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS relist_part,
  1.0::DOUBLE - coalesce(p.n::DOUBLE / x.top::DOUBLE, 0.0::DOUBLE) AS report_part
FROM r_listings l JOIN (SELECT category, median(price::DOUBLE) AS med FROM listings GROUP BY 1) m USING (category)
LEFT JOIN (SELECT listing_id, count_if(code = 'CHAT') AS chats, count_if(code = 'OFFER_ACC') AS answers FROM listing_events GROUP BY 1) e USING (listing_id)
LEFT JOIN (SELECT doc_id AS listing_id, count(*) AS n FROM labels WHERE toxic = 1 GROUP BY 1) p USING (listing_id),
(SELECT max(n) AS top FROM (SELECT r.doc_id, count(*) AS n FROM labels r JOIN part ON p_partkey = r.doc_id WHERE toxic = 1 GROUP BY 1)) x)"""

# ---- identities --------------------------------------------------------------------------------
T["id_raw"] = """
SELECT 'LOYALTY' AS source_system, c_custkey AS source_id, 'L' || c_custkey AS loyalty_id,
  'customer' || c_custkey || '@example.com' AS email, '+919' || lpad(c_custkey::VARCHAR, 9, '0') AS phone, c_name AS name,
  'unit ' || c_custkey || ' block ' || (c_custkey % 97) || ' street ' || (c_custkey % 13) AS address FROM customer
UNION ALL
SELECT 'EC', o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'L' || o_custkey END,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 'customer' || o_custkey || '@example.com' END,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus <> 'O' THEN '+919' || lpad(o_custkey::VARCHAR, 9, '0') END,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') END,
  CASE WHEN o_orderpriority <> '5-LOW' THEN NULL WHEN o_orderstatus = 'P' THEN 'unit ' || o_custkey || ' block ' || (o_custkey % 97)
    WHEN o_orderstatus = 'F' THEN 'poste restante'
    ELSE 'unit ' || o_custkey || ' block ' || (o_custkey % 97) || ' street ' || (o_custkey % 13) END FROM orders"""
T["id_base"] = """
SELECT *, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(name, '') || ' ' || coalesce(address, '')), '[^a-z0-9]+'), lambda x: x <> '')) AS words
FROM id_raw"""
T["id1"] = "SELECT *, sha256(loyalty_id) AS k, 1.0::DOUBLE AS conf, 1 AS pass FROM id_base WHERE loyalty_id IS NOT NULL"
T["id2"] = """
SELECT r.*, coalesce(m.k, sha256(r.email)) AS k, 0.95::DOUBLE AS conf, 2 AS pass FROM id_base r
LEFT JOIN (SELECT email, min(k) AS k FROM id1 WHERE email IS NOT NULL GROUP BY 1) m USING (email)
WHERE r.loyalty_id IS NULL AND r.email IS NOT NULL"""
T["id3"] = """
SELECT r.*, coalesce(m.k, sha256(r.phone)) AS k, 0.9::DOUBLE AS conf, 3 AS pass FROM id_base r
LEFT JOIN (SELECT phone, min(k) AS k FROM (SELECT phone, k FROM id1 UNION ALL SELECT phone, k FROM id2) WHERE phone IS NOT NULL GROUP BY 1) m USING (phone)
WHERE r.loyalty_id IS NULL AND r.email IS NULL AND r.phone IS NOT NULL"""
T["id_known"] = """
SELECT list_sort(words) AS words, min(k) AS k FROM (SELECT words, k FROM id1 UNION ALL SELECT words, k FROM id2 UNION ALL SELECT words, k FROM id3)
WHERE len(words) > 0 GROUP BY 1"""
T["id_best"] = """
SELECT words, arg_min(k, (-s, k)) AS k, max(s) AS s FROM (
  SELECT a.words, b.k, len(list_intersect(a.words, b.words))::DOUBLE
    / (len(a.words) + len(b.words) - len(list_intersect(a.words, b.words)))::DOUBLE AS s
  FROM (SELECT DISTINCT list_sort(words) AS words FROM id_base WHERE loyalty_id IS NULL AND email IS NULL AND phone IS NULL AND len(words) > 0) a
  JOIN id_known b ON list_has_any(a.words, list_filter(b.words, lambda x: NOT regexp_full_match(x, 'unit|block|street|customer')))
) WHERE s >= 0.7 GROUP BY 1"""
T["id4"] = """
SELECT r.*, coalesce(m.k, sha256('__ANON_BUCKET__')) AS k, CASE WHEN m.k IS NULL THEN 0.0::DOUBLE ELSE least(round(m.s, 4), 0.89::DOUBLE) END AS conf,
  CASE WHEN m.k IS NULL THEN 0 ELSE 4 END AS pass
FROM id_base r LEFT JOIN id_best m ON m.words = list_sort(r.words)
WHERE r.loyalty_id IS NULL AND r.email IS NULL AND r.phone IS NULL"""
T["ids"] = f"""
SELECT i.*, {quality(("conf >= 0.7 AND conf < 0.9", "IDENTITY_AMBIGUOUS", AM, INF), ("pass = 0", "FUZZY_MATCH_LOW_CONF", EX, UN),
    ("bad_mail", "EMAIL_MALFORMED", AN, UN), ("bad_phone", "PHONE_NORMALISATION_FAIL", AN, UN))}
FROM (SELECT u.*, coalesce(u.source_system = 'EC' AND o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'P', false) AS bad_mail,
  coalesce(u.source_system = 'EC' AND o.o_orderpriority = '3-MEDIUM' AND o.o_orderstatus = 'O', false) AS bad_phone
  FROM (SELECT * FROM id1 UNION ALL SELECT * FROM id2 UNION ALL SELECT * FROM id3 UNION ALL SELECT * FROM id4) u
  LEFT JOIN orders o ON u.source_system = 'EC' AND o.o_orderkey = u.source_id) i"""

# ---- dimensions --------------------------------------------------------------------------------
T["d_date"] = f"""
SELECT sha256(strftime(d, '%Y-%m-%d')) AS date_key, d AS date_day, strftime(d, '%Y-%m-%d') AS date_iso, year(d)::INT AS year, month(d)::INT AS month,
  day(d)::INT AS day, isodow(d)::INT AS day_of_week, isodow(d) >= 6 AS is_weekend,
  strftime(d, '%m-%d') IN ('01-26', '03-25', '04-11', '08-15', '10-02', '11-01', '12-25') AS is_public_holiday,
  CASE WHEN d BETWEEN DATE '1998-03-01' AND DATE '1998-07-31' THEN 'BASELINE' WHEN d BETWEEN DATE '1998-08-01' AND DATE '1998-08-07' THEN 'PRE_RAMP'
    WHEN d BETWEEN DATE '1998-08-08' AND DATE '1998-08-28' THEN 'CAMPAIGN' WHEN d BETWEEN DATE '1998-08-29' AND DATE '1998-09-14' THEN 'POST_CAMPAIGN'
    ELSE 'OUT_OF_SCOPE' END AS campaign_phase, d BETWEEN DATE '1998-08-08' AND DATE '1998-08-28' AS is_campaign_day
FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS d FROM (
  SELECT greatest(DATE '1990-01-01', date_trunc('year', least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem)))) AS a,
    least(DATE '2009-12-31', date_trunc('year', greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem))) + INTERVAL 3 YEAR - INTERVAL 1 DAY) AS b))"""
T["d_product_v"] = """
SELECT sku, price_list, load_date AS valid_from,
  coalesce(lead(load_date) OVER w - 1, DATE '9999-12-31') AS valid_to, lead(load_date) OVER w IS NULL AS is_current,
  row_number() OVER w AS version_number
FROM (SELECT *, lag(price_list) OVER (PARTITION BY sku ORDER BY load_date) AS prior FROM (
  SELECT sku, load_date, max(price_list) AS price_list FROM (
    SELECT 'P' || p_partkey AS sku, DATE '1995-01-01' AS load_date, 'LIST' AS price_list FROM part
    UNION ALL SELECT sku, date_trunc('quarter', l_shipdate)::DATE, CASE WHEN l_discount >= 0.095 THEN 'PROMO' ELSE 'LIST' END FROM ln) GROUP BY 1, 2))
WHERE prior IS NULL OR prior <> price_list WINDOW w AS (PARTITION BY sku ORDER BY load_date)"""
T["d_customer_v"] = """
SELECT customer_id, delivery_habit, load_date AS valid_from,
  coalesce(lead(load_date) OVER w - 1, DATE '9999-12-31') AS valid_to, lead(load_date) OVER w IS NULL AS is_current,
  row_number() OVER w AS version_number
FROM (SELECT *, lag(delivery_habit) OVER (PARTITION BY customer_id ORDER BY load_date) AS prior FROM (
  SELECT customer_id, load_date, max(habit) AS delivery_habit FROM (
    SELECT c_custkey::VARCHAR AS customer_id, DATE '1995-01-01' AS load_date, '0-NONE' AS habit FROM customer
    UNION ALL SELECT o_custkey::VARCHAR, date_trunc('quarter', o_orderdate)::DATE, o_orderpriority FROM orders) GROUP BY 1, 2))
WHERE prior IS NULL OR prior <> delivery_habit WINDOW w AS (PARTITION BY customer_id ORDER BY load_date)"""

# ---- facts -------------------------------------------------------------------------------------
T["f_line"] = f"""
SELECT l.order_id, l.line_id, o.order_date, {dkey("o.order_date")} AS date_key, {sk("l.product_sku")} AS product_key,
  {okey("o.customer_id")} AS customer_key,
  sha256(CASE WHEN o.delivery_method_code = 'BOPIS' THEN 'BOPIS' ELSE 'EC' END) AS channel_key,
  {okey("o.delivery_method_code")} AS delivery_method_key, {okey("o.promo_code_applied")} AS promotion_key,
  {okey("o.pickup_store_id")} AS store_key, l.product_sku, o.customer_id, o.order_status, l.quantity,
  l.line_total AS gross, CASE WHEN o.order_status = 'CANCELLED' THEN 0 ELSE l.line_total END AS confirmed,
  o.order_status IS DISTINCT FROM 'CANCELLED' AS is_confirmed_revenue, l.discount, l.unit_price,
  o.attribution_confidence IS NOT NULL AS is_campaign_attributed,
  CASE WHEN o.promo_code_applied IS NOT NULL THEN 'PROMO_CODE' WHEN o.attribution_confidence IS NOT NULL THEN 'SESSION_BRIDGE'
    WHEN o.pickup_store_id IS NOT NULL AND o.order_date BETWEEN DATE '1998-08-08' AND DATE '1998-08-28' AND p.category = 'PROMO' THEN 'BOPIS_WINDOW' END AS attribution_rule,
  o.anomaly_flag, o.anomaly_reason_code, o.data_quality_status, o.metric_certainty_level, o.pickup_store_id
FROM ec_order_lines l LEFT JOIN r_ec_orders o USING (order_id) LEFT JOIN products p ON p.sku = l.product_sku"""
T["f_fulfil"] = f"""
SELECT o.order_id, o.order_number, o.order_date, {okey("o.customer_id")} AS customer_key, o.customer_id, o.order_status, o.delivery_method_code,
  {dkey("o.order_date")} AS placed_date_key, {dkey("p.moment")} AS captured_date_key, {dkey("m.picked")} AS shipped_date_key,
  {dkey("m.delivered")} AS delivered_date_key, {dkey("b.moment")} AS returned_date_key,
  date_diff('second', o.order_date::TIMESTAMP, p.moment) / 3600.0::DOUBLE AS placed_to_captured_hours,
  date_diff('second', m.picked, m.delivered) / 3600.0::DOUBLE AS picked_to_delivered_hours,
  date_diff('second', o.order_date::TIMESTAMP, m.delivered) / 3600.0::DOUBLE AS total_lifecycle_hours,
  {quality(("a1", "CANCELLED_WITH_REVENUE", AN, UN), ("a11", "PLACEHOLDER_ID_COLLISION", AN, UN), ("b1", "ATTRIBUTION_SESSION_BRIDGE", "CLEAN", INF),
           ("b7", "BOPIS_NO_PICKUP_EVENT", AM, INF), ("coalesce(m.drift, false)", "DELIVERY_BEFORE_SHIP", AN, UN))}
FROM r_ec_orders o
LEFT JOIN (SELECT order_ref, min(captured_ts) AS moment FROM pg WHERE captured_ts IS NOT NULL GROUP BY 1) p ON p.order_ref = o.order_number
LEFT JOIN (SELECT okey, min(coalesce(corrected, moment)) FILTER (code = 'PICKED_UP') AS picked,
  min(coalesce(corrected, moment)) FILTER (code = 'DELIVERED') AS delivered, bool_or(a14) AS drift FROM r_dc_events GROUP BY 1) m ON m.okey = o.order_id
LEFT JOIN (SELECT l_orderkey, min(ship + to_days(10)) AS moment FROM returned GROUP BY 1) b ON b.l_orderkey = o.order_id"""
T["f_si"] = f"""
SELECT store_id, product_code, snapshot_date, physical_qty, sellable_qty, 5 AS reserved_qty, 0 AS damaged_qty, false AS is_reconstructed, {Q} FROM r_si_snaps
UNION ALL SELECT store_id, product_code, snapshot_date, physical_qty, sellable_qty, NULL, NULL, true, {Q} FROM recon"""
T["f_moves"] = f"""
SELECT movement_id, 'STORE' AS node_type, store_id AS node_id, product_code, movement_type, quantity_change AS quantity_delta, reference_number,
  movement_date AS mdate, {CLEAN} FROM si_moves
UNION ALL SELECT movement_id, 'WAREHOUSE', warehouse_id, sku, movement_type, quantity_change, reference_number, movement_datetime::DATE, {Q} FROM r_wh_moves"""
T["f_sale"] = f"""
SELECT l.txn_id AS receipt_no, l.line_no, o.day AS txn_date, {dkey("o.day")} AS date_key, {sk("l.product_code")} AS product_key,
  'ST-' || (o.o_custkey % 25) AS store_id, o.o_custkey::VARCHAR AS customer_id, o.instrument, l.product_code,
  CASE WHEN o.o_totalprice >= 400000 THEN 'VIP10' WHEN o.o_totalprice >= 300000 THEN 'SCHOOL15' END AS promo_code,
  CASE o.o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'OPEN' END AS receipt_status,
  l.quantity, l.gross, l.discount, l.net, l.tax_amt, round(l.net + l.tax_amt - l.tax_amt, 2) AS revenue_excl_tax,
  (p.cogs * l.quantity)::DECIMAL(18,2) AS cogs_amount
FROM pos_lines l LEFT JOIN od o ON o.o_orderkey = l.l_orderkey LEFT JOIN products p ON p.sku = l.product_code"""
T["f_return"] = f"""
SELECT c.ra_id AS return_authorization_id, r.line_id AS line_no, (r.ship + to_days(10))::DATE AS request_date, c.received_date AS receipt_date,
  r.sku AS product_sku, b.customer_id, CASE WHEN r.l_tax < 0.025 THEN 'ST-' || (r.l_suppkey % 25) END AS return_store_id, r.reason AS reason_code,
  CASE WHEN r.l_linestatus = 'O' THEN 'EC' ELSE 'STORE' END AS channel_code, c.condition_on_receipt, c.restocked_as_condition, r.qty AS quantity_returned,
  c.restocked_qty, f.refund_type, f.refund_amount, f.restocking_fee, f.original_month, f.refund_month, f.impact,
  f.anomaly_reason_code AS refund_reason_code, r.l_linestatus = 'O' AND r.l_tax < 0.025 AS is_boris_return,
  c.anomaly_flag, c.anomaly_reason_code, c.data_quality_status, c.metric_certainty_level
FROM returned r JOIN r_receipts c ON c.ra_id = 'RA-' || r.rid JOIN r_refunds f ON f.ra_id = 'RA-' || r.rid
LEFT JOIN r_ec_orders b ON b.order_id = r.l_orderkey"""
T["phases"] = "SELECT date_day, campaign_phase FROM d_date"
T["values_by_channel"] = """
SELECT 'EC' AS channel, order_date AS day, gross, confirmed AS net FROM f_line
UNION ALL SELECT 'STORE', txn_date, gross, net FROM f_sale"""
