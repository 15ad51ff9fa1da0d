"""The given tables in the shape of the operational source tables.

Each function maps star-schema tables to one raw source table: names, codes and text dates as the
operational system would deliver them. Nearly all are plain projections, so they add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from plumbline.sources.schemas import SCHEMAS

# the click stream is dated 2024; these days move it onto the campaign calendar of the orders
EVENT_SHIFT_DAYS = 9284
CAMPAIGN_TAG = "SCHOOL98"
PLACEHOLDER_ID = "0"

ISO = "yyyy-MM-dd'T'HH:mm:ss"

LINE_ID = (
    "sha2(concat_ws('|', l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int), "
    "cast(l_extendedprice as decimal(12,2)), cast(l_discount as decimal(4,2)), "
    "cast(l_tax as decimal(4,2)), l_returnflag, l_linestatus, "
    "date_format(l_shipdate, 'yyyy-MM-dd')), 256)"
)
GROSS = "cast(l_extendedprice as decimal(12,2))"
DISC = "cast(l_discount as decimal(4,2))"
TAX = "cast(l_tax as decimal(4,2))"
QTY = "cast(l_quantity as int)"
SIGNED_QTY = f"case l_returnflag when 'N' then -{QTY} else {QTY} end"
CREATED = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))"
GUEST = "o_orderpriority = '4-NOT SPECIFIED'"
STORE_OF_ORDER = "concat('ST-', o_custkey % 25)"
EVENT_TS = f"ts - make_dt_interval({EVENT_SHIFT_DAYS})"
EVENT_STORE = (
    "case event_type when 'view' then 'ST-1' when 'click' then 'ST-2' when 'signup' then 'ST-3' "
    "when 'purchase' then 'ST-4' else 'ST-5' end"
)
EVENT_DELTA = "cast(floor(value) as int) - 40"
SESSION_ID = f"concat('S-', user_id, '-', date_format({EVENT_TS}, 'yyyyMMdd'))"
STATUS = "case o_orderstatus when 'P' then 'CANCELLED' when 'F' then 'DELIVERED' else 'PENDING' end"
METHOD = (
    "case o_orderpriority when '1-URGENT' then 'EXPRESS' when '2-HIGH' then 'BOPIS' "
    "when '5-LOW' then 'MARKETPLACE_SELLER' else 'STANDARD' end"
)
PROMO = "case when o_totalprice >= 400000 then 'VIP10' when o_totalprice >= 300000 then 'SCHOOL15' end"
INSTRUMENT = (
    "case o_orderpriority when '1-URGENT' then 'CARD' when '2-HIGH' then 'UPI' "
    "when '3-MEDIUM' then 'NETBANKING' when '5-LOW' then 'COD' else 'WALLET' end"
)


class Given:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")


# ---- online orders -----------------------------------------------------------------------------
def ec_orders(g: Given) -> DataFrame:
    return g.orders.selectExpr(
        "o_orderkey as order_id",
        "concat('EC-', o_orderkey) as order_number",
        "date_format(o_orderdate, 'yyyy-MM-dd') as order_date",
        f'date_format({CREATED}, "{ISO}") as created_at',
        f"{STATUS} as order_status",
        f"if({GUEST}, '{PLACEHOLDER_ID}', cast(o_custkey as string)) as customer_id",
        f"if({GUEST}, concat('SESS-GUEST-', o_orderkey), "
        "concat('S-', o_custkey, '-', date_format(o_orderdate, 'yyyyMMdd'))) as session_id",
        f"{METHOD} as delivery_method_code",
        f"if(o_orderpriority = '2-HIGH', {STORE_OF_ORDER}, null) as pickup_store_id",
        f"{PROMO} as promo_code_applied",
        "cast(o_totalprice as decimal(12,2)) as subtotal_excl_tax",
    )


def ec_order_lines(g: Given) -> DataFrame:
    return g.lineitem.filter("l_linestatus = 'O'").selectExpr(
        "l_orderkey as order_id",
        f"{LINE_ID} as line_id",
        "concat('P', l_partkey) as product_sku",
        f"{QTY} as quantity",
        f"{GROSS} as line_total_excl_tax",
        f"{GROSS} * {DISC} as discount_applied",
        "l_extendedprice / l_quantity as unit_price_excl_tax",
    )


def ec_order_status_history(g: Given) -> DataFrame:
    rows = (
        f"array(struct('PLACED' as status_code, {CREATED} as at), "
        "struct(if(o_orderstatus = 'P', 'CANCELLED', null) as status_code, "
        f"{CREATED} + make_dt_interval(0, cast(o_custkey % 72 as int)) as at))"
    )
    return (
        g.orders.selectExpr("o_orderkey as order_id", f"inline({rows})")
        .filter("status_code is not null")
        .selectExpr(
            "concat(order_id, '-', status_code) as history_id",
            "order_id",
            "status_code",
            f'date_format(at, "{ISO}") as status_timestamp',
        )
    )


def ec_order_status_codes(g: Given) -> DataFrame:
    return g.orders.selectExpr(f"{STATUS} as status_code").distinct()


def ec_delivery_methods(g: Given) -> DataFrame:
    return g.orders.selectExpr(f"{METHOD} as method_code").distinct().selectExpr(
        "method_code",
        "initcap(replace(method_code, '_', ' ')) as method_name",
        "case method_code when 'EXPRESS' then 1 when 'BOPIS' then 0 else 3 end as est_days_min",
        "case method_code when 'EXPRESS' then 2 when 'BOPIS' then 1 else 7 end as est_days_max",
    )


# ---- payments and stores -----------------------------------------------------------------------
def pg_transactions(g: Given) -> DataFrame:
    epoch = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {})"
    captured = f"{CREATED} + make_dt_interval(0, cast((o_orderkey * 7) % 96 as int))"
    return g.orders.selectExpr(
        "concat('PG-', o_orderkey) as transaction_id",
        "concat('EC-', o_orderkey) as order_ref",
        f"{INSTRUMENT} as type_code",
        "case when o_totalprice < 40000 then 'FAILED' else 'CAPTURED' end as status_code",
        f"cast({epoch.format(CREATED)} as string) as created_ts",
        f"if(o_totalprice < 40000, null, cast({epoch.format(captured)} as string)) as captured_ts",
        "cast(o_totalprice as decimal(12,2)) as amount",
    )


def pg_instrument_types(g: Given) -> DataFrame:
    return g.orders.selectExpr(f"{INSTRUMENT} as type_code").distinct().selectExpr(
        "type_code",
        "case type_code when 'COD' then 'Cash on delivery' else initcap(type_code) end as type_name",
    )


def pos_stores(g: Given) -> DataFrame:
    region = g.region.selectExpr("r_regionkey as n_regionkey", "r_name as region_name")
    return g.nation.join(region, "n_regionkey").selectExpr(
        "concat('ST-', n_nationkey) as store_id", "n_name as store_name", "region_name"
    )


def pos_transactions(g: Given) -> DataFrame:
    return g.orders.selectExpr(
        "concat('R-', o_orderkey) as txn_id",
        "date_format(o_orderdate, 'dd/MM/yyyy') as txn_date",
        f"{STORE_OF_ORDER} as store_id",
        "cast(o_custkey as string) as customer_id",
        f"{INSTRUMENT} as payment_method_code",
        f"{PROMO} as promo_code",
        "case o_orderstatus when 'P' then 'VOD' when 'F' then 'CMP' else 'OPN' end as status_code",
    )


def pos_transaction_lines(g: Given) -> DataFrame:
    return (
        g.lineitem.filter("l_linestatus = 'F'")
        .selectExpr(
            "concat('R-', l_orderkey) as txn_id",
            f"{LINE_ID} as line_no",
            "concat('P', l_partkey) as product_code",
            f"{QTY} as quantity",
            f"{GROSS} as gross_amount",
            f"{GROSS} * {DISC} as discount_amount",
            f"{TAX} as tax_rate",
        )
        .selectExpr("*", "gross_amount - discount_amount as net_amount")
        .selectExpr("*", "net_amount * tax_rate as tax_amount")
        .selectExpr("*", "net_amount + tax_amount as total_amount_incl_tax")
    )


# ---- delivery ----------------------------------------------------------------------------------
def dc_shipments(g: Given) -> DataFrame:
    return g.orders.selectExpr(
        "concat('SH-', o_orderkey) as shipment_id",
        "concat('EC-', o_orderkey) as order_reference",
        f'date_format({CREATED}, "{ISO}") as created_datetime',
        "concat('CR-', o_custkey % 5) as carrier_code",
    )


def dc_delivery_events(g: Given) -> DataFrame:
    bopis = "o_orderpriority = '2-HIGH'"

    def at(hours: int) -> str:
        return f"{CREATED} + make_dt_interval(0, {hours})"

    rows = (
        f"array(struct(if({bopis}, null, 'PICKED_UP') as event_type_code, {at(6)} as at), "
        f"struct(if({bopis}, 'READY_FOR_PICKUP', null) as event_type_code, {at(4)} as at), "
        f"struct(if({bopis} and o_orderstatus = 'F' and o_custkey % 7 <> 0, 'BOPIS_COLLECTED', "
        f"null) as event_type_code, {at(30)} as at))"
    )
    handling = (
        g.orders.selectExpr("o_orderkey", f"inline({rows})")
        .filter("event_type_code is not null")
        .selectExpr(
            "concat(event_type_code, '-', o_orderkey) as event_id",
            "concat('SH-', o_orderkey) as shipment_id",
            "event_type_code",
            f'date_format(at, "{ISO}") as event_timestamp',
        )
    )
    arrivals = g.lineitem.filter("l_linestatus = 'O'").selectExpr(
        f"concat('DELIVERED-', l_orderkey, '-', {LINE_ID}) as event_id",
        "concat('SH-', l_orderkey) as shipment_id",
        "'DELIVERED' as event_type_code",
        f'date_format(l_shipdate, "{ISO}") as event_timestamp',
    )
    return handling.unionByName(arrivals)


# ---- returns -----------------------------------------------------------------------------------
def _returned(g: Given) -> DataFrame:
    return g.lineitem.filter("l_returnflag = 'R'")


REASON_OF_LINE = (
    "element_at(array('DEFECTIVE', 'WRONG_ITEM', 'CHANGED_MIND', 'NOT_AS_DESCRIBED', "
    "'LATE_DELIVERY', 'DAMAGED_IN_TRANSIT', 'SELLER_ERROR'), l_linenumber)"
)


def rr_return_requests(g: Given) -> DataFrame:
    return _returned(g).selectExpr(
        f"concat('RA-', l_orderkey, '-', {LINE_ID}) as return_authorization_id",
        "concat('EC-', l_orderkey) as original_order_ref",
        f"{LINE_ID} as line_no",
        "concat('P', l_partkey) as product_sku",
        f"{REASON_OF_LINE} as reason_code",
        "if(l_linestatus = 'O', 'EC', 'STORE') as channel_code",
        "if(l_tax < 0.025, concat('ST-', l_suppkey % 25), null) as return_store_id",
        "date_format(l_shipdate + make_dt_interval(10), 'dd-MMM-yyyy') as return_request_date",
        f"{QTY} as quantity_returned",
    )


def rr_return_receipts(g: Given) -> DataFrame:
    return _returned(g).selectExpr(
        f"concat('RC-', l_orderkey, '-', {LINE_ID}) as receipt_id",
        f"concat('RA-', l_orderkey, '-', {LINE_ID}) as return_authorization_id",
        "concat('P', l_partkey) as product_sku",
        "date_format(l_shipdate + make_dt_interval(10 + l_linenumber), 'yyyy-MM-dd') "
        "as received_date",
        "if(l_tax < 0.015, 'PENDING', 'PASSED') as inspection_status",
        f"if(l_discount < 0.025, 0, {QTY}) as restocked_qty",
        "if(l_discount >= 0.045, 'OPENED', 'SEALED') as condition_on_receipt",
        "if(l_tax < 0.045, 'NEW', 'OPEN_BOX') as restocked_as_condition",
    )


def rr_refund_events(g: Given) -> DataFrame:
    return _returned(g).selectExpr(
        f"concat('RF-', l_orderkey, '-', {LINE_ID}) as refund_id",
        f"concat('RA-', l_orderkey, '-', {LINE_ID}) as return_authorization_id",
        "concat('EC-', l_orderkey) as original_order_ref",
        "if(l_discount >= 0.065, 'PARTIAL', 'FULL') as refund_type",
        f"{GROSS} as subtotal",
        f"if(l_discount >= 0.065, {GROSS} * {DISC}, cast({GROSS} as decimal(17,4))) "
        "as refund_amount",
        "if(l_tax >= 0.065, cast(5 as decimal(8,2)), cast(0 as decimal(8,2))) as restocking_fee",
        "date_format(l_shipdate + make_dt_interval(20), 'yyyy-MM-dd') as refund_date",
    )


def rr_return_reasons(g: Given) -> DataFrame:
    return _returned(g).selectExpr(f"{REASON_OF_LINE} as reason_code").distinct()


# ---- stock -------------------------------------------------------------------------------------
def si_inventory_snapshots(g: Given) -> DataFrame:
    """Store stock counts: the running balance of the day's changes, on days with any change."""
    daily = g.events.selectExpr(
        f"{EVENT_STORE} as store_id",
        "concat('P', user_id) as product_code",
        f"cast({EVENT_TS} as date) as day",
        f"{EVENT_DELTA} as delta",
    ).groupBy("store_id", "product_code", "day").agg(F.sum("delta").alias("delta"))
    # one row per calendar day at most, so the running sum never meets an unbounded group
    w = Window.partitionBy("store_id", "product_code").orderBy("day")
    return daily.withColumn("physical_qty", F.sum("delta").over(w).cast("int")).selectExpr(
        "store_id",
        "product_code",
        "date_format(day, 'dd/MM/yyyy') as snapshot_date",
        "physical_qty",
        "physical_qty - 5 as sellable_qty",
        "5 as reserved_qty",
        "0 as damaged_qty",
    )


def si_inventory_movements(g: Given) -> DataFrame:
    """The store ledger. Large changes are sell-through, which the ledger does not record."""
    return g.events.filter("value < 250").selectExpr(
        "concat('SM-', event_id) as movement_id",
        f"{EVENT_STORE} as store_id",
        "concat('P', user_id) as product_code",
        "case when value < 40 then 'PICK' when event_type = 'error' then 'RET' else 'RCVD' end "
        "as movement_type",
        f"{EVENT_DELTA} as quantity_change",
        "if(event_type = 'error', null, concat('REF-', event_id)) as reference_number",
        f"date_format({EVENT_TS}, 'dd/MM/yyyy') as movement_date",
    )


def wh_inventory_snapshots(g: Given) -> DataFrame:
    return (
        g.lineitem.filter("l_linestatus = 'O'")
        .selectExpr(
            "concat('WH-', l_suppkey) as warehouse_id",
            "concat('P', l_partkey) as sku",
            "date_format(l_shipdate, 'yyyy-MM-dd') as snapshot_date",
            f"{SIGNED_QTY} as signed",
            f"if(l_returnflag <> 'N' or l_tax >= 0.065, {QTY}, 0) as promised",
        )
        .groupBy("warehouse_id", "sku", "snapshot_date")
        .agg(
            F.greatest(F.sum("signed"), F.lit(0)).cast("int").alias("physical_qty"),
            F.sum("promised").cast("int").alias("atp_qty"),
        )
    )


def wh_inventory_movements(g: Given) -> DataFrame:
    return g.lineitem.filter("l_linestatus = 'O'").selectExpr(
        f"concat('WM-', l_orderkey, '-', {LINE_ID}) as movement_id",
        "concat('WH-', l_suppkey) as warehouse_id",
        "concat('P', l_partkey) as sku",
        "case l_returnflag when 'N' then 'PCK' when 'A' then 'RCV' else 'RET' end as movement_type",
        f"{SIGNED_QTY} as quantity_change",
        "if(l_returnflag = 'N' and l_discount < 0.015, null, concat('EC-', l_orderkey)) "
        "as reference_number",
        f'date_format(l_shipdate, "{ISO}") as movement_datetime',
    )


# ---- click stream ------------------------------------------------------------------------------
def ws_page_events(g: Given) -> DataFrame:
    return g.events.selectExpr(
        f"{SESSION_ID} as session_id",
        "event_id",
        f'date_format({EVENT_TS}, "{ISO}") as event_timestamp',
        "case event_type when 'view' then 'PRODUCT_VIEW' when 'click' then 'ADD_TO_CART' "
        "when 'signup' then 'CHECKOUT_INIT' when 'purchase' then 'PURCHASE' else 'ERROR' end "
        "as event_type_code",
        "case event_type when 'view' then 'CONSIDERATION' when 'click' then 'INTENT' "
        "when 'signup' then 'INTENT' when 'purchase' then 'CONVERSION' else 'AWARENESS' end "
        "as step_id",
        "if(event_type in ('view', 'click', 'purchase'), "
        "concat('P', get_json_object(props, '$.k')), null) as product_sku",
        "cast(floor(value) as int) as time_on_page_secs",
        "if(event_type = 'click', cast(value as decimal(12,2)), null) as cart_value",
        "event_type = 'purchase' as is_conversion_event",
    )


def ws_sessions(g: Given) -> DataFrame:
    return (
        g.events.selectExpr(
            "user_id",
            f"{SESSION_ID} as session_id",
            f"{EVENT_TS} as at",
            "event_type",
            "cast(get_json_object(props, '$.k') as int) as k",
        )
        .groupBy("session_id", "user_id")
        .agg(
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.min("k").alias("k"),
            F.count_if(F.col("event_type") == "view").alias("views"),
            F.count("*").alias("n"),
        )
        .selectExpr(
            "session_id",
            f'date_format(first_at, "{ISO}") as session_start_ts',
            f'date_format(last_at, "{ISO}") as session_end_ts',
            f"if(k < 30, '{CAMPAIGN_TAG}', null) as utm_campaign",
            "if(n > 1, cast(user_id as string), null) as registered_customer_id",
            "if(k % 2 = 0, 'MOBILE', 'DESKTOP') as device_type",
            "if(k < 30, 'PAID', 'ORGANIC') as channel_source",
            "cast(views as int) as total_pageviews",
            "cast(n as int) as total_events",
        )
    )


def dc_carriers(g: Given) -> DataFrame:
    return dc_shipments(g).select("carrier_code").distinct()


def dc_event_types(g: Given) -> DataFrame:
    return dc_delivery_events(g).select("event_type_code").distinct()


def ws_event_types(g: Given) -> DataFrame:
    return ws_page_events(g).select("event_type_code").distinct()


# ---- classifieds -------------------------------------------------------------------------------
def nl_listings(g: Given) -> DataFrame:
    created = "timestamp_ntz'1998-06-01 00:00:00' + make_dt_interval(cast(p_partkey % 90 as int))"
    return g.part.selectExpr(
        "p_partkey as listing_id",
        "concat('NL-', p_partkey) as listing_ref",
        "p_brand as seller_account_id",
        "p_type as category_code",
        "case when p_size <= 20 then 'ACTIVE' when p_size <= 35 then 'SOLD' "
        "when p_size <= 45 then 'EXPIRED' else 'DRAFT' end as status_code",
        "p_name as listing_title",
        "cast(p_retailprice as decimal(12,2)) as asking_price",
        "if(p_size = 50, null, sha2(concat_ws('|', p_name, p_type, p_partkey % 4), 256)) as image_hash",
        "p_size * 3 as views_count",
        "p_size % 5 as favourites_count",
        "if(p_size = 7, 1, 0) as relist_count",
        f'date_format({created}, "{ISO}") as created_at',
        f'date_format({created} + make_dt_interval(p_size), "{ISO}") as updated_at',
    )


def nl_listing_events(g: Given) -> DataFrame:
    return g.events.selectExpr(
        "user_id as listing_id",
        "event_id",
        "case event_type when 'view' then 'VIEW' when 'click' then 'CHAT' "
        "when 'signup' then 'PHN_REVEAL' when 'purchase' then 'SELLER_SOLD' else 'OFFER_ACC' end "
        "as event_type_code",
        f'date_format({EVENT_TS}, "{ISO}") as event_timestamp',
        "if(event_type = 'error', cast(value as decimal(12,2)), null) as offer_amount",
        "get_json_object(props, '$.k') as user_ref",
    )


def nl_user_accounts(g: Given) -> DataFrame:
    """Seller accounts of the classifieds, with the day of their first listing."""
    return g.part.groupBy(F.col("p_brand").alias("account_id")).agg(
        F.date_format(
            F.expr("timestamp_ntz'1998-06-01 00:00:00' + "
                   "make_dt_interval(cast(min(p_partkey % 90) as int))"), ISO
        ).alias("created_at"),
        F.count("*").alias("listings"),
    )


# ---- marketplace sellers -----------------------------------------------------------------------
def pc_products(g: Given) -> DataFrame:
    return g.part.selectExpr(
        "concat('P', p_partkey) as sku",
        "p_name as product_name",
        "p_brand as brand",
        "p_type as category",
        "cast(p_retailprice as decimal(12,2)) as list_price",
        "if(p_type = 'PROMO', null, cast(cast(p_retailprice as decimal(12,2)) * "
        "cast(0.6 as decimal(2,1)) as decimal(12,2))) as cogs",
    )


def ts_seller_listings(g: Given) -> DataFrame:
    """Seller-worded listings: some cite a SKU the catalogue lacks, some none at all."""
    title = (
        "case when p_size <= 3 then concat('phone case ', lower(p_type)) "
        "when p_size <= 20 then replace(p_name, 'e', '3') "
        "when p_size <= 30 then concat(split(p_name, ' ')[1], ' ', split(p_name, ' ')[0]) "
        "else upper(p_name) end"
    )
    return g.part.selectExpr(
        "p_partkey as listing_id",
        "cast(regexp_extract(p_brand, '(\\\\d+)', 1) as bigint) as seller_id",
        "case when p_size = 49 then concat('X', p_partkey) when p_size in (10, 25, 40) then null "
        "else concat('P', p_partkey) end as catalogue_sku_ref",
        f"{title} as seller_product_title",
        "p_type as category",
        "p_brand as brand",
    )


def ts_sellers(g: Given) -> DataFrame:
    return g.supplier.selectExpr(
        "s_suppkey as seller_id",
        "s_name as seller_name",
        "case when s_acctbal < 0 then 'SUSPENDED' when s_acctbal < 1000 then 'pending' "
        "when s_acctbal < 2000 then 'PROBATION' else 'ACTIVE' end as seller_status",
    )


def ts_marketplace_orders(g: Given) -> DataFrame:
    return g.lineitem.selectExpr(
        f"concat('MO-', l_orderkey, '-', {LINE_ID}) as marketplace_order_id",
        "l_orderkey as order_id",
        "l_suppkey as seller_id",
        "l_returnflag = 'R' as is_returned",
        f'date_format(l_shipdate, "{ISO}") as fulfilled_at',
    )


SOURCE_SELLER = "cast(substr(source, 4) as bigint)"


def ts_safety_reports(g: Given) -> DataFrame:
    about = g.documents.selectExpr("doc_id", f"{SOURCE_SELLER} as seller_id")
    return g.labels.filter("toxic = 1").join(about, "doc_id").selectExpr(
        "doc_id as report_id", "doc_id as listing_id", "seller_id"
    )


def ts_risk_signals(g: Given) -> DataFrame:
    about = g.documents.selectExpr("doc_id", f"{SOURCE_SELLER} as seller_id")
    return g.labels.filter("quality = 0").join(about, "doc_id").selectExpr(
        "doc_id as signal_id", "seller_id"
    )


# ---- reviews and support -----------------------------------------------------------------------
def rv_reviews(g: Given) -> DataFrame:
    return g.lineitem.filter("l_returnflag = 'A'").selectExpr(
        f"concat('RV-', l_orderkey, '-', {LINE_ID}) as review_id",
        "1 + l_linenumber % 5 as rating",
        "concat('P', l_partkey) as product_sku",
        "cast(l_orderkey % 150 as string) as customer_id",
        f"{QTY} - 10 as days_post_delivery",
        "if(l_linestatus = 'F', 1, 0) as is_verified_purchase",
        f'date_format(l_shipdate + make_dt_interval({QTY} - 10), "{ISO}") as review_datetime',
    )


def cs_cases(g: Given) -> DataFrame:
    """Support cases. Copies of one text are one incident; the smallest id is the canonical one."""
    docs = g.documents.withColumn("text_hash", F.sha2("text", 256))
    canonical = docs.groupBy("text_hash").agg(F.min("doc_id").alias("canonical_id"))
    created = (
        "timestamp_ntz'1998-08-01 00:00:00' + "
        "make_dt_interval(cast(doc_id % 45 as int), cast(doc_id % 24 as int))"
    )
    return docs.join(canonical, "text_hash").selectExpr(
        "doc_id as case_id",
        "concat('CS-', doc_id) as case_reference",
        "if(canonical_id < doc_id, concat('CS-', canonical_id), null) as canonical_case_ref",
        "if(canonical_id < doc_id, 1, 0) as is_duplicate_flag",
        f"date_format({created}, 'yyyy/MM/dd HH:mm') as created_datetime",
        f"if(lang = 'de', null, date_format({created} + make_dt_interval(0, "
        "cast(n_chars % 200 as int)), 'yyyy/MM/dd HH:mm')) as resolved_datetime",
        "cast(doc_id % 15 as string) as customer_ref",
        "case lang when 'en' then 'EC' when 'fr' then 'STORE' when 'es' then 'CLASSIFIEDS' "
        "else 'carrier pigeon' end as channel_attribution",
        f"{SOURCE_SELLER} as seller_id",
        "concat('CAT-', lang) as category_code",
        "if(lang = 'de', 'OPEN', 'CLOSED') as status_code",
        "if(n_chars > 1000, 'REFUND', 'INFO') as resolution_outcome",
        "if(n_chars > 1000, 'SELLER', 'NONE') as fault_attribution",
        "text_hash",
    )


def cs_case_events(g: Given) -> DataFrame:
    return g.conversations.selectExpr(
        "conv_id as case_id", "turn as event_seq", "role", "conv_id % 20 as seller_id"
    )


# ---- customers ---------------------------------------------------------------------------------
def _address(key: str) -> str:
    return f"concat('unit ', {key}, ' block ', {key} % 97, ' street ', {key} % 13)"


PHONE = "concat('9', lpad(cast({} as string), 9, '0'))"


def cl_customers(g: Given) -> DataFrame:
    return g.customer.selectExpr(
        "'LOYALTY' as source_system",
        "c_custkey as source_id",
        "concat('L', c_custkey) as loyalty_id",
        "concat('customer', c_custkey, '@example.com') as email",
        f"concat('+91', {PHONE.format('c_custkey')}) as phone",
        "c_name as name",
        f"{_address('c_custkey')} as address",
    )


def identity_records(g: Given) -> DataFrame:
    """Loyalty members and the contact details left with every order, in one shape."""
    order = g.orders.selectExpr(
        "'EC' as source_system",
        "o_orderkey as source_id",
        "if(o_orderpriority = '1-URGENT', concat('L', o_custkey), null) as loyalty_id",
        "case when o_orderpriority = '2-HIGH' then concat(' Customer', o_custkey, '@Example.COM ') "
        "when o_orderpriority = '1-URGENT' and o_orderstatus = 'P' then 'not-an-address' end "
        "as email",
        "case when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'O' then '12345' "
        f"when o_orderpriority = '3-MEDIUM' then {PHONE.format('o_custkey')} end as phone",
        "if(o_orderpriority = '5-LOW', "
        "concat('Customer#', lpad(cast(o_custkey as string), 9, '0')), null) as name",
        "case when o_orderpriority <> '5-LOW' then null "
        "when o_orderstatus = 'P' then concat('unit ', o_custkey, ' block ', o_custkey % 97) "
        "when o_orderstatus = 'F' then 'poste restante' "
        f"else {_address('o_custkey')} end as address",
    )
    return cl_customers(g).unionByName(order)


FIRST_LOAD = "date'1995-01-01'"


def cl_customer_loads(g: Given) -> DataFrame:
    """One customer record per quarterly load: the delivery habit may change from load to load."""
    first = g.customer.selectExpr(
        "cast(c_custkey as string) as customer_id", f"{FIRST_LOAD} as load_date", "'0-NONE' as habit"
    )
    later = g.orders.selectExpr(
        "cast(o_custkey as string) as customer_id",
        "cast(date_trunc('QUARTER', o_orderdate) as date) as load_date",
        "o_orderpriority as habit",
    )
    return first.unionByName(later).groupBy("customer_id", "load_date").agg(
        F.max("habit").alias("delivery_habit")
    )


def pc_product_loads(g: Given) -> DataFrame:
    """One product record per quarterly load, with the price list it was on."""
    first = g.part.selectExpr(
        "concat('P', p_partkey) as sku", f"{FIRST_LOAD} as load_date", "'LIST' as price_list"
    )
    later = g.lineitem.selectExpr(
        "concat('P', l_partkey) as sku",
        "cast(date_trunc('QUARTER', l_shipdate) as date) as load_date",
        "if(l_discount >= 0.095, 'PROMO', 'LIST') as price_list",
    )
    return first.unionByName(later).groupBy("sku", "load_date").agg(
        F.max("price_list").alias("price_list")
    )


SOURCES = {
    f.__name__: f
    for f in [
        ec_orders, ec_order_lines, ec_order_status_history, ec_order_status_codes,
        ec_delivery_methods, pg_transactions, pg_instrument_types, pos_stores, pos_transactions,
        pos_transaction_lines, dc_shipments, dc_delivery_events, dc_carriers, dc_event_types, rr_return_requests,
        rr_return_receipts, rr_refund_events, rr_return_reasons, si_inventory_snapshots,
        si_inventory_movements, wh_inventory_snapshots, wh_inventory_movements, ws_page_events,
        ws_sessions, ws_event_types, nl_listings, nl_listing_events, nl_user_accounts, pc_products,
        ts_seller_listings, ts_sellers, ts_marketplace_orders, ts_safety_reports, ts_risk_signals,
        rv_reviews, cs_cases, cs_case_events, cl_customers, identity_records, cl_customer_loads,
        pc_product_loads,
    ]
}
