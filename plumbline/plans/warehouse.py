"""All layers of the warehouse by name, each built from the one below when asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline import vocab
from plumbline.operators import commerce, trust
from plumbline.operators.identity import customer_master, placeholder_ids, resolve_identities
from plumbline.operators.inventory import day_spine, fill_gaps
from plumbline.operators.matching import product_master
from plumbline.operators.quality import Correction, resolve
from plumbline.plans import dims, facts, resolution as r
from plumbline.plans.silver import clean
from plumbline.sources.raw import materialise, write_table
from plumbline.sources.retail import CAMPAIGN_TAG, SOURCES, Given
from plumbline.sources.written import Steps, held

# the order data's campaign year
CAMPAIGN_YEAR = 1998


class Warehouse:
    """Tables are lazy; nothing is computed until a result is asked for.

    `build` and `write` write the corrected tables and facts once, and all later reads take them from there. Where
    neither was called, a fact is its definition down to the given tables, so that a query computes and moves only the
    columns it reads. Only what is small against the work of correcting it (`WRITTEN`) is written at its first use;
    with `lazy` nothing is.

    `stored` may hold tables already written (a layer read back from storage); they take the place
    of their definition.
    """

    def __init__(self, spark: SparkSession, folder: str, stored: dict[str, DataFrame] | None = None, lazy: bool = False):
        self.spark, self.lazy = spark, lazy
        self.given = Given(spark, folder)
        self.campaign = dims.Campaign(CAMPAIGN_YEAR, CAMPAIGN_TAG)
        self._built: dict[str, DataFrame] = dict(stored or {})
        self._given = frozenset(self._built)
        self._needs: dict[str, set[str]] = {}  # by table: the tables it was defined from, directly or not
        self._open: list[str] = []

    def _get(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._built:
            self._needs[name] = set()
            self._open.append(name)
            try:
                self._built[name] = make()
            finally:
                self._open.pop()
        if self._open:
            self._needs[self._open[-1]] |= {name} | self._needs.get(name, set())
        return self._built[name]

    def affected_facts(self, changed: list[str]) -> list[str]:
        """The facts defined from the corrected state of any of these tables."""
        if unknown := [t for t in changed if t not in RESOLVED]:
            raise ValueError(f"nothing is corrected in {unknown}")
        return sorted(t for t, needs in self.corrected_inputs().items() if needs.intersection(changed))

    def corrected_inputs(self) -> dict[str, set[str]]:
        """By fact: the corrected tables it is defined from, directly or not."""
        plan = Warehouse(self.spark, self.given.folder, lazy=True)
        for t in FACTS:
            plan.fact(t)
        return {t: {c for c in RESOLVED if f"resolved.{c}" in plan._needs.get(f"fact.{t}", ())} for t in FACTS}

    # ---- layers ---------------------------------------------------------------------------------
    def source(self, t: str) -> DataFrame:
        return self._get(f"source.{t}", lambda: SOURCES[t](self.given))

    def silver(self, t: str) -> DataFrame:
        return self._get(f"silver.{t}", lambda: clean(t, self.source(t)))

    def resolved(self, t: str) -> DataFrame:
        """The corrected table; the cleaned one where nothing is catalogued against it."""
        if t not in RESOLVED:
            return self.silver(t)
        return self._get(f"resolved.{t}", lambda: self.correct(t))

    def corrected(self, t: str) -> DataFrame:
        """The corrected table that facts and scores are built from: as written, else its definition."""
        if self.lazy or (t not in WRITTEN and f"corrected.{t}" not in self._built):
            return self.resolved(t)
        return self._get(f"corrected.{t}", lambda: materialise(self.resolved(t), f"corrected_{t}"))

    def correct(self, t: str, df: DataFrame | None = None, only: list[Correction] | None = None) -> DataFrame:
        """Prepare and correct one table, or a given state of it, or with some corrections only."""
        prepare, corrections, markers = RESOLVED[t]
        before = self.raw_state(t) if df is None else df
        return resolve(prepare(self, before), only or corrections(self)).drop(*markers)

    def raw_state(self, t: str) -> DataFrame:
        if t == "reconstructed_snapshots":
            return self.reconstructed()
        if t == "identities":
            return self.identities()
        return self.silver(t)

    def dim(self, t: str) -> DataFrame:
        return self._get(f"dim.{t}", lambda: DIMS[t](self))

    def fact(self, t: str) -> DataFrame:
        """The fact with the versions of its product and customer."""
        return self._get(f"fact.{t}", lambda: facts.with_versions(t, FACTS[t](self), self.versions(), vocab.CALENDAR[1]))

    def versions(self) -> dict[str, DataFrame]:
        return {"product": self.product_versions(), "customer": self.customer_versions()}

    def fact_in_steps(
        self, t: str, step: Steps, columns: list[str] | None = None, versions: dict[str, DataFrame] | None = None
    ) -> DataFrame:
        """The fact, or some columns of it and its version keys, written before each of its joins with versions: on
        disk are the shuffle files of one join, not of all. A fact that is stored is read."""
        if t not in facts.VERSIONED or self._given.intersection((f"fact.{t}", f"gold.{t}")) or f"gold.{t}" in self._built:
            out = self.gold(t)
        else:
            df = FACTS[t](self)
            needed = df.columns if columns is None else dict.fromkeys([*columns, *facts.GRAIN[t], *filter(None, facts.VERSIONED[t])])
            out = facts.with_versions(t, df.select(*needed), versions or self.versions(), vocab.CALENDAR[1], step)
        return out if columns is None else out.select(*columns, *[c for c in facts.VERSION_KEYS if c in out.columns])

    @contextmanager
    def gold_held(self, t: str, columns: list[str]) -> Iterator[DataFrame]:
        """Some columns of the fact: as `build` wrote it, else written for as long as the block runs."""
        if f"gold.{t}" in self._built:
            yield self.gold(t).select(*columns)
        else:
            with held(self.gold(t).select(*columns), f"held_{t}") as f:
                yield f

    def product_versions(self) -> DataFrame:
        return self._get("product_versions", lambda: dims.product_versions(self.source("pc_product_loads")))

    def customer_versions(self) -> DataFrame:
        return self._get("customer_versions", lambda: dims.customer_versions(self.source("cl_customer_loads")))

    def gold(self, t: str) -> DataFrame:
        """The fact that checks, views and reports read: as written, else its definition."""
        return self._built[f"gold.{t}"] if f"gold.{t}" in self._built else self.fact(t)

    def build(self, at_once: int = 4) -> Warehouse:
        """Write the corrected tables that facts need, then all facts, several at a time."""
        self._write_all("corrected", [t for t in RESOLVED if any(t in x for x in self.corrected_inputs().values())], self.resolved, at_once)
        self._write_all("gold", list(FACTS), self.fact, at_once)
        return self

    def _write_all(self, layer: str, names: list[str], get: Callable[[str], DataFrame], at_once: int, path: str | None = None) -> None:
        """Tables are defined one by one in this thread; only their jobs run side by side."""
        def written(t: str) -> DataFrame:
            if path is None:
                return materialise(tables[t], f"{layer}_{t}")
            write_table(tables[t], f"{path}/{t}")
            return self.spark.read.schema(tables[t].schema).parquet(f"{path}/{t}")

        tables = {t: get(t) for t in names if f"{layer}.{t}" not in self._built}
        with ThreadPoolExecutor(at_once) as pool:
            for t, df in zip(tables, pool.map(written, tables)):
                self._built[f"{layer}.{t}"] = df

    def write(self, path: str, at_once: int = 4) -> Warehouse:
        """Write the corrected tables, and the facts built from them, under a path; a warehouse that reads them there."""
        root = path.rstrip("/")
        low = Warehouse(self.spark, self.given.folder)
        low._write_all("corrected", list(RESOLVED), self.resolved, at_once, f"{root}/resolved")
        low._built |= {f"resolved.{t}": low._built[f"corrected.{t}"] for t in RESOLVED}
        low._write_all("gold", list(FACTS), low.fact, at_once, f"{root}/fact")
        found = {k: df for k, df in low._built.items() if k.split(".")[0] in ("resolved", "corrected", "gold")}
        found |= {f"fact.{t}": found[f"gold.{t}"] for t in FACTS}
        return Warehouse(self.spark, self.given.folder, found)

    # ---- derived tables between the layers -------------------------------------------------------
    def snapshot_spine(self) -> DataFrame:
        """Every store and product with every day of the observed period."""
        snaps = self.silver("si_inventory_snapshots")
        days = snaps.agg(
            F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day")
        )
        return day_spine(snaps, ["store_id", "product_code"], "snapshot_date", days)

    def reconstructed(self) -> DataFrame:
        return self._get("reconstructed", lambda: fill_gaps(
            self.resolved("si_inventory_snapshots"), ["store_id", "product_code"], "snapshot_date",
            ["physical_qty", "sellable_qty"], self.snapshot_spine(),
        ))

    def identities(self) -> DataFrame:
        return self._get("identities", lambda: resolve_identities(self.source("identity_records")))

    def customer_master(self) -> DataFrame:
        return customer_master(self.identities())

    def product_master(self) -> DataFrame:
        return product_master(self.silver("ts_seller_listings").select(
            "listing_id", "seller_id", "catalogue_sku_ref", "seller_product_title", "category", "brand"
        ), self.silver("pc_products"))

    def promoted_products(self) -> DataFrame:
        return self.source("pc_products").filter(F.col("category") == "PROMO").select("sku")

    def refunds_with_periods(self) -> DataFrame:
        return commerce.refund_periods(self.silver("rr_refund_events"), self.silver("ec_orders"))

    def trust_scores(self) -> DataFrame:
        return self._get("trust", lambda: trust.trust_score(trust.seller_inputs(self.seller_rates())))

    def seller_rates(self) -> list[tuple[str, DataFrame]]:
        """(seller_id, num, den) per rate, each reduced where it lives."""
        def pair(df: DataFrame, num, den=F.lit(1)) -> DataFrame:
            return df.select("seller_id", num.cast("bigint").alias("num"), den.cast("bigint").alias("den"))

        sold = self.silver("ts_marketplace_orders").join(
            self.silver("ec_orders").select("order_id", "order_status", "order_date"), "order_id"
        )
        per_seller = sold.groupBy("seller_id").agg(
            F.count("*").alias("orders"),
            F.count_if(F.col("order_status") == "CANCELLED").alias("cancelled"),
            F.count_if(
                F.col("fulfilled_at") > F.col("order_date").cast("timestamp_ntz")
                + F.make_dt_interval(F.lit(0), F.lit(120))
            ).alias("late"),
            F.count_if("is_returned").alias("returned"),
        )
        orders = F.col("orders")
        base = per_seller.select("seller_id", orders)

        def against(counts: DataFrame, base: DataFrame, den: str) -> DataFrame:
            n = counts.groupBy("seller_id").agg(F.count("*").alias("n"))
            both = base.join(n, "seller_id", "left")
            return pair(both, F.coalesce("n", F.lit(0)), F.col(den))

        listing = self.corrected("nl_listings").select(
            F.regexp_extract("seller_account_id", "(\\d+)", 1).cast("bigint").alias("seller_id"),
            (F.col("excluded_from_gmv") | F.col("fraud_ring_flag")).alias("dup"),
        ).groupBy("seller_id").agg(F.count("*").alias("listings"), F.count_if("dup").alias("dup"))
        talk = self.silver("cs_case_events").groupBy("seller_id").agg(
            F.count_if(F.col("role") == "assistant").alias("a"),
            F.count_if(F.col("role") == "user").alias("q"),
        )
        return [
            ("cancellation", pair(per_seller, F.col("cancelled"), orders)),
            ("late", pair(per_seller, F.col("late"), orders)),
            ("return", pair(per_seller, F.col("returned"), orders)),
            ("complaint", against(self.source("cs_cases").select("seller_id"), base, "orders")),
            ("moderation", against(self.source("ts_risk_signals"), base, "orders")),
            ("duplicate", pair(listing, F.col("dup"), F.col("listings"))),
            ("report", against(self.source("ts_safety_reports"), listing, "listings")),
            ("response", pair(talk, F.least("a", "q"), F.col("q"))),
        ]

    def listing_confidence(self) -> DataFrame:
        return self._get("listing_confidence", lambda: trust.listing_confidence(
            self.corrected("nl_listings"), self.silver("nl_listing_events"),
            self.source("ts_safety_reports"), "excluded_from_gmv", f"{CAMPAIGN_YEAR}-09-14",
        ))

    # ---- rebuilding ------------------------------------------------------------------------------
    def rebuild(self, changed: list[str]) -> dict[str, DataFrame]:
        """Write the facts fed by the changed tables, and only those; returns them as stored."""
        out = {}
        for t in self.affected_facts(changed):
            step = Steps(f"rows_{t}")
            out[t] = materialise(self.fact_in_steps(t, step), f"fact_{t}")
            step.end(self.spark)
        return out


def _as_is(w: Warehouse, df: DataFrame) -> DataFrame:
    return df


# corrected tables of catalogue size whose titles are matched: read from where they are written once
WRITTEN = {"nl_listings"}

# table: how to prepare it, its corrections in order, the helper columns to drop afterwards
RESOLVED: dict[str, tuple] = {
    "ec_orders": (
        lambda w, df: r.prepare_ec_orders(
            df, w.silver("ws_sessions"), w.silver("dc_shipments"), w.silver("dc_delivery_events"),
            w.campaign.tag, placeholder_ids(w.source("ec_orders"), w.source("cl_customers")),
        ),
        lambda w: [
            r.cancelled_revenue(), r.placeholder_customer(),
            r.session_attribution(w.campaign.window), r.uncollected_pickup(),
        ],
        ["in_campaign_session", "was_collected", "is_placeholder_id"],
    ),
    "pg_transactions": (
        lambda w, df: r.prepare_pg_transactions(
            df.drop("cancelled_ts"), w.silver("ec_orders"), w.silver("ec_order_status_history")
        ),
        lambda w: [r.payment_after_cancel()],
        [],
    ),
    "pos_transaction_lines": (
        lambda w, df: r.prepare_pos_lines(df), lambda w: [r.tax_basis()], [],
    ),
    "nl_listing_events": (
        _as_is, lambda w: [r.seller_marked_sold(), r.value_signals()], [],
    ),
    "wh_inventory_snapshots": (_as_is, lambda w: [r.promised_without_stock()], []),
    "si_inventory_snapshots": (_as_is, lambda w: [r.negative_stock()], []),
    "rr_return_receipts": (_as_is, lambda w: [r.restocked_early(), r.opened_as_new()], []),
    "reconstructed_snapshots": (_as_is, lambda w: [r.reconstructed_day()], []),
    "wh_inventory_movements": (_as_is, lambda w: [r.missing_reference()], []),
    "rr_refund_events": (
        lambda w, df: commerce.refund_periods(
            df.drop("sold_on", "original_month", "refund_month"), w.silver("ec_orders")
        ),
        lambda w: [r.partial_refund_period()],
        [],
    ),
    "ts_seller_listings": (
        lambda w, df: r.prepare_seller_listings(df, w.silver("pc_products")),
        lambda w: [r.title_mismatch()],
        [],
    ),
    "nl_listings": (
        lambda w, df: r.prepare_nl_listings(
            df.drop("is_relisted", "in_ring", "b4_match_confidence"), w.silver("pc_products")
        ),
        lambda w: [r.relisted_after_sold(), r.picture_ring(), r.catalogue_match()],
        ["is_relisted", "in_ring"],
    ),
    "dc_delivery_events": (
        lambda w, df: r.prepare_delivery_events(df, w.silver("dc_shipments")),
        lambda w: [r.delivered_before_pickup()],
        ["transit_hours"],
    ),
    "rv_reviews": (_as_is, lambda w: [r.review_before_delivery()], []),
    "cs_cases": (_as_is, lambda w: [r.duplicate_case()], []),
    "identities": (_as_is, lambda w: [r.ambiguous_identity()], []),
    "ts_sellers": (
        lambda w, df: r.prepare_sellers(df, w.trust_scores()),
        lambda w: [r.high_risk_seller()],
        [],
    ),
}


def _calendar(w: Warehouse) -> DataFrame:
    """From the January of the first order to the second December after the last shipment: deliveries,
    receipts and refunds follow it. Never beyond the project's years, whatever dates the data hold."""
    spans = w.given.orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).unionByName(
        w.given.lineitem.agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    )
    first, last = (F.lit(d).cast("date") for d in vocab.CALENDAR)
    return spans.agg(
        F.greatest(first, F.trunc(F.min("a").cast("date"), "year")).alias("first_day"),
        F.least(last, F.date_sub(F.add_months(F.trunc(F.max("b").cast("date"), "year"), 36), 1)).alias("last_day"),
    )


DIMS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "date": lambda w: dims.dim_date(_calendar(w), w.campaign),
    "channel": lambda w: dims.dim_channel(w.spark),
    "step": lambda w: dims.dim_step(w.spark),
    "seller_risk_tier": lambda w: dims.dim_seller_risk_tier(w.spark),
    "payment_method": lambda w: dims.dim_payment_method(w.source("pg_instrument_types")),
    "delivery_method": lambda w: dims.dim_delivery_method(w.source("ec_delivery_methods")),
    "return_reason": lambda w: dims.dim_return_reason(w.source("rr_return_reasons")),
    "listing_condition": lambda w: dims.dim_listing_condition(w.resolved("rr_return_receipts")),
    "promotion": lambda w: dims.dim_promotion(w.silver("ec_orders"), w.silver("ws_sessions"), w.silver("pos_transactions")),
    "store": lambda w: dims.dim_store(w.source("pos_stores"), w.silver("si_inventory_movements")),
    "seller": lambda w: dims.dim_seller(
        w.silver("ts_sellers"), w.trust_scores(), w.source("nl_user_accounts")),
    "product": lambda w: dims.dim_product(w.product_versions(), w.source("pc_products")),
    "customer": lambda w: dims.dim_customer(w.customer_versions(), w.identities()),
}

# dimension: surrogate key and natural key
DIM_KEYS = {
    "date": ("date_key", "date_iso"),
    "channel": ("channel_key", "channel_code"),
    "step": ("step_key", "step_code"),
    "seller_risk_tier": ("seller_risk_tier_key", "risk_tier"),
    "payment_method": ("payment_method_key", "type_code"),
    "delivery_method": ("delivery_method_key", "method_code"),
    "return_reason": ("return_reason_key", "reason_code"),
    "listing_condition": ("listing_condition_key", "condition_code"),
    "promotion": ("promotion_key", "promo_code"),
    "store": ("store_key", "store_id"),
    "seller": ("seller_key", "seller_code"),
    "product": ("product_key", "sku"),
    "customer": ("customer_key", "customer_id"),
}

FACTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "ecommerce_order_line": lambda w: facts.ecommerce_order_line(
        w.silver("ec_order_lines"), w.corrected("ec_orders"), w.promoted_products(), w.campaign.window),
    "order_fulfilment": lambda w: facts.order_fulfilment(
        w.corrected("ec_orders"), w.corrected("pg_transactions"), w.silver("dc_shipments"),
        w.corrected("dc_delivery_events"), w.silver("rr_return_requests")),
    "store_inventory_snapshot": lambda w: facts.store_inventory_snapshot(
        w.corrected("si_inventory_snapshots"), w.corrected("reconstructed_snapshots")),
    "warehouse_inventory_snapshot": lambda w: facts.warehouse_inventory_snapshot(
        w.corrected("wh_inventory_snapshots")),
    "inventory_transaction": lambda w: facts.inventory_transaction(
        w.silver("si_inventory_movements"), w.corrected("wh_inventory_movements")),
    "web_session": lambda w: facts.web_session(w.silver("ws_sessions")),
    "web_page_event": lambda w: facts.web_page_event(w.silver("ws_page_events")),
    "classified_listing_snapshot": lambda w: facts.classified_listing_snapshot(w.corrected("nl_listings")),
    "classified_listing_event": lambda w: facts.classified_listing_event(w.corrected("nl_listing_events")),
    "customer_review": lambda w: facts.customer_review(w.corrected("rv_reviews")),
    "customer_complaint": lambda w: facts.customer_complaint(w.corrected("cs_cases")),
    "store_sale_line": lambda w: facts.store_sale_line(
        w.corrected("pos_transaction_lines"), w.silver("pos_transactions"), w.source("pc_products")),
    "return_line": lambda w: facts.return_line(
        w.silver("rr_return_requests"), w.corrected("rr_return_receipts"), w.corrected("rr_refund_events"),
        w.corrected("ec_orders")),
    "seller_performance_snapshot": lambda w: facts.seller_performance_snapshot(
        w.silver("ts_marketplace_orders"), w.silver("ec_orders"), w.silver("cs_cases"),
        w.corrected("nl_listings"), w.source("ts_safety_reports"), w.silver("nl_listing_events"),
        w.trust_scores(), F.regexp_extract("seller_account_id", "(\\d+)", 1)),
}
