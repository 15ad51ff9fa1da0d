"""From gross value to net confirmed revenue, and why each team's number differed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.exprs import has_code, with_one_row
from plumbline.operators import checks
from plumbline.operators.quality import union_all
from plumbline.plans import facts
from plumbline.plans.marts import EC, LE, LS, STORE, VIEWS, WH, channel_values, with_phase
from plumbline.plans.warehouse import Warehouse


def waterfall(w: Warehouse) -> DataFrame:
    """Ordered steps from GSV to NCR with a running total; the last step must equal it."""
    ec = w.gold(EC).agg(
        F.sum("line_subtotal_excl_tax").cast("decimal(30,4)").alias("gross"),
        F.sum("confirmed_revenue_excl_tax").cast("decimal(30,4)").alias("confirmed"))
    store = w.gold(STORE).agg(
        F.sum("gross_amount").cast("decimal(30,4)").alias("s_gross"),
        F.sum("discount_amount").cast("decimal(30,4)").alias("s_disc"),
        F.sum("net_amount").cast("decimal(30,4)").alias("s_net"))
    steps = with_one_row(ec, store).select(F.inline(F.array(
        F.struct(F.lit(1).alias("step"), F.lit("GROSS_SALE_VALUE").alias("item"),
                 (F.col("gross") + F.col("s_gross")).alias("amount")),
        F.struct(F.lit(2).alias("step"), F.lit("CANCELLED_ONLINE_REVENUE").alias("item"),
                 (F.col("confirmed") - F.col("gross")).alias("amount")),
        F.struct(F.lit(3).alias("step"), F.lit("STORE_LINE_DISCOUNTS").alias("item"),
                 (-F.col("s_disc")).alias("amount")),
        F.struct(F.lit(4).alias("step"), F.lit("NET_CONFIRMED_REVENUE").alias("item"),
                 (F.col("confirmed") + F.col("s_net")).alias("amount")),
    )))
    # four rows
    run = F.sum(F.when(F.col("step") < 4, F.col("amount"))).over(Window.orderBy("step"))
    return steps.withColumn("running_total", run).withColumn(
        "ties_out", (F.col("step") < 4) | (F.col("amount") == F.col("running_total")))


def assert_ties_out(steps: DataFrame) -> None:
    open_steps = steps.filter("not ties_out").take(4)
    if open_steps:
        raise AssertionError(f"the waterfall does not close: {open_steps}")


def team_divergence(w: Warehouse) -> DataFrame:
    """What a team counted, what the warehouse confirms, and the difference."""
    line, listing = w.gold(EC), w.gold(LS)
    sold = (
        w.gold(LE).filter(F.col("event_type_code") == "SELLER_SOLD").groupBy("listing_id").agg(
            F.count("*").alias("n"))
        .join(listing.select("listing_id", "asking_price"), "listing_id")
        .agg(F.sum(F.col("n") * F.col("asking_price")).cast("double").alias("raw"))
    )

    def row(team: str, df: DataFrame, claimed: Column, reconciled: Column) -> DataFrame:
        return df.select(
            F.lit(team).alias("team"), claimed.cast("double").alias("claimed"),
            reconciled.cast("double").alias("reconciled"))

    sales = line.agg(F.sum("line_subtotal_excl_tax").alias("g"), F.sum("confirmed_revenue_excl_tax").alias("c"))
    both = with_one_row(sales, sold)
    cases = w.gold("customer_complaint").agg(
        F.count("*").alias("n"), F.countDistinct("canonical_case_key").alias("d"))
    pickups = w.gold("order_fulfilment").agg(
        F.count_if(F.col("order_status") == "DELIVERED").alias("n"),
        F.count_if((F.col("order_status") == "DELIVERED")
                   & ~has_code("anomaly_reason_code", "BOPIS_NO_PICKUP_EVENT")).alias("d"))
    stock = w.gold(WH).agg(
        F.count_if(F.col("physical_qty") > 0).alias("d"),
        F.count_if((F.col("atp_qty") > 0) | has_code("anomaly_reason_code", "ATP_POSITIVE_PHYSICAL_ZERO")).alias("n"))
    dup = listing.agg(
        F.count("*").alias("n"),
        F.count_if(~has_code("anomaly_reason_code", "RELISTED_AFTER_SOLD")
                   & ~has_code("anomaly_reason_code", "IMAGE_HASH_REUSED")).alias("d"))
    out = union_all([
        row("Sales", both, F.col("g").cast("double") + F.col("raw"), F.col("c")),
        row("Finance", sales, F.col("c"), F.col("c")),
        row("Marketplace", dup, F.col("n"), F.col("d")),
        row("Inventory", stock, F.col("n"), F.col("d")),
        row("Store operations", pickups, F.col("n"), F.col("d")),
        row("Support", cases, F.col("n"), F.col("d")),
    ])
    return out.select(
        "team", F.round("claimed", 2).alias("claimed"), F.round("reconciled", 2).alias("reconciled"),
        F.round(F.col("claimed") - F.col("reconciled"), 2).alias("difference"))


def daily_run_rate(w: Warehouse) -> DataFrame:
    """Confirmed revenue per calendar day in the campaign and in the ramp, and the uplift."""
    v = with_phase(w, channel_values(w, "confirmed_revenue_excl_tax", "net_amount", "v"))

    def of(phase: str, c: str) -> Column:
        return F.sum(F.when(F.col("campaign_phase") == phase, F.col(c))).cast("double")

    total = v.agg(of("CAMPAIGN", "v").alias("c"), of("PRE_RAMP", "v").alias("p"))
    days = w.dim("date").withColumn("one", F.lit(1)).agg(
        of("CAMPAIGN", "one").alias("cd"), of("PRE_RAMP", "one").alias("pd"))
    c, p = F.try_divide(F.col("c"), F.col("cd")), F.try_divide(F.col("p"), F.col("pd"))
    return with_one_row(total, days).select(
        F.round(c, 2).alias("campaign_per_day"), F.round(p, 2).alias("pre_ramp_per_day"),
        F.round(F.try_divide(c - p, p), 4).alias("uplift"))


def decision_sensitivity(w: Warehouse) -> DataFrame:
    """The amount each judgement call moves: with the decision, and with the alternative."""
    def row(name: str, df: DataFrame, chosen: Column, other: Column) -> DataFrame:
        return df.agg(
            F.coalesce(chosen.cast("double"), F.lit(0.0)).alias("with_decision"),
            F.coalesce(other.cast("double"), F.lit(0.0)).alias("with_alternative"),
        ).select(F.lit(name).alias("decision"), F.round("with_decision", 2).alias("with_decision"),
                 F.round("with_alternative", 2).alias("with_alternative"),
                 F.round(F.col("with_decision") - F.col("with_alternative"), 2).alias("difference"))

    line = w.gold(EC)
    c = F.col("confirmed_revenue_excl_tax")
    rule = F.col("attribution_rule")
    refund = w.resolved("rr_refund_events")
    moved = has_code("anomaly_reason_code", "REFUND_PARTIAL_PERIOD_AMBIGUITY")
    moves = w.resolved("wh_inventory_movements")
    unref = has_code("anomaly_reason_code", "MOVEMENT_NULL_REF")
    ids = w.identities()
    orders = w.resolved("ec_orders")
    unscanned = F.col("b_classification") == "TREAT_AS_FULFILLED"
    return union_all([
        row("SESSION_ATTRIBUTION", line, F.sum(F.when(rule.isNotNull(), c)),
            F.sum(F.when(rule == "PROMO_CODE", c))),
        row("PARTIAL_REFUND_IN_RETURN_PERIOD", refund,
            F.sum(F.when(moved, F.lit(0)).otherwise(F.col("revenue_impact_original_period"))),
            F.sum("revenue_impact_original_period")),
        row("NULL_REFERENCE_IS_NOT_SHRINKAGE", moves,
            F.sum(F.when(unref, F.lit(0)).otherwise(F.col("quantity_change"))), F.sum("quantity_change")),
        row("IDENTITY_MERGE_FROM_090", ids,
            F.count_if(F.col("identity_confidence") >= 0.90), F.count_if(F.col("identity_confidence") >= 0.70)),
        row("UNSCANNED_PICKUP_IS_FULFILLED", orders,
            F.count_if(F.col("order_status") == "DELIVERED"),
            F.count_if((F.col("order_status") == "DELIVERED") & ~F.coalesce(unscanned, F.lit(False)))),
    ])


def funnel_by_phase(w: Warehouse) -> DataFrame:
    """Sessions and events per funnel stage and phase."""
    step = w.dim("step").select("step_key", "step_code", "sequence_number")
    pe = with_phase(w, w.gold("web_page_event").select("session_id", "date_key", "step_key"))
    return (
        pe.groupBy("step_key", "campaign_phase", "session_id").agg(F.count("*").alias("n"))
        .groupBy("step_key", "campaign_phase")
        .agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))
        .join(F.broadcast(step), "step_key")  # five rows
        .select("step_code", "sequence_number", "campaign_phase", "sessions", "events")
    )


PHASES = ["BASELINE", "PRE_RAMP", "CAMPAIGN", "POST_CAMPAIGN", "OUT_OF_SCOPE"]


def by_phase(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One column per phase, for any view that has the phase among its keys."""
    wide = df.groupBy(*keys).pivot("campaign_phase", PHASES).agg(F.sum(value))
    return wide.withColumnsRenamed({p: p.lower() for p in PHASES})


def kpi_catalogue(w: Warehouse) -> DataFrame:
    """Every view with group, certainty, keys and sources, and how many rows feed it."""
    rows = [
        (n, v.group, v.certainty, ",".join(v.keys), v.semi_additive, f)
        for n, v in VIEWS.items() for f in v.facts
    ]
    cat = w.spark.createDataFrame(
        rows, "view_name string, kpi_group string, certainty string, view_keys string, "
              "is_semi_additive boolean, source_table string")
    used = sorted({f for v in VIEWS.values() for f in v.facts})
    sizes = union_all([
        (w.dim("seller") if t == "dim_seller" else w.gold(t)).agg(F.count("*").alias("source_rows"))
        .select(F.lit(t).alias("source_table"), "source_rows")
        for t in used
    ])
    return cat.join(F.broadcast(sizes), "source_table")  # one row per fact


def bus_matrix(w: Warehouse) -> DataFrame:
    """Per declared link: rows, rows with a key, distinct keys, and keys the dimension lacks."""
    used, known = linked_tables(w)
    for fact, fk, dim, pk in facts.LINKS:
        if fk not in used[fact].columns or pk not in known[dim].columns:
            raise ValueError(f"{fact}.{fk} -> {dim}.{pk} is declared but not built")
    has = F.col("key").isNotNull()
    return checks.per_link(
        used, checks.known_keys(known, facts.LINKS), facts.LINKS,
        F.sum("fact_rows").alias("fact_rows"),
        F.coalesce(F.sum(F.when(has, F.col("fact_rows"))), F.lit(0)).alias("linked_rows"),
        F.count_if(has).alias("distinct_keys"),
        F.count_if(has & ~F.col("found")).alias("orphan_keys"),
    )


def linked_tables(w: Warehouse) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Facts and dimensions that take part in a declared link."""
    return (
        {f: w.gold(f) for f in dict.fromkeys(f for f, *_ in facts.LINKS)},
        {d: w.dim(d) for d in dict.fromkeys(d for _, _, d, _ in facts.LINKS)},
    )


def campaign_rules(w: Warehouse) -> DataFrame:
    """Campaign revenue by the rule that attributes it: promo code, prior session, pickup of an
    eligible product in the window."""
    return w.gold(EC).groupBy(F.coalesce("attribution_rule", F.lit("ORGANIC")).alias("rule")).agg(
        F.count("*").alias("order_lines"),
        F.sum("confirmed_revenue_excl_tax").cast("double").alias("confirmed_revenue"))
