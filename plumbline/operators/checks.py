"""Validation checks. Each returns offenders; a suite turns them into one report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.keys import pack, unpack
from plumbline.operators.aggregates import first_and_last
from plumbline.sources.written import one_by_one


def completeness(tables: dict[str, DataFrame]) -> DataFrame:
    return one_by_one((
        df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in tables.items()
    ), "completeness")


def known_keys(dims: dict[str, DataFrame], keys: list[tuple[str, str, str, str]]) -> DataFrame:
    """(dimension, key) of every dimension with a declared link, written once for all facts."""
    return one_by_one((
        dims[d].select(F.lit(d).alias("dimension"), F.col(pk).alias("key")).distinct()
        for d, pk in dict.fromkeys((d, pk) for _, _, d, pk in keys)
    ), "known_keys")


def link_usage(fact: str, df: DataFrame, known: DataFrame, keys: list[tuple[str, str, str, str]]) -> DataFrame:
    """Every distinct key of every declared (fact, fact key, dimension, dimension key) of one fact with the rows
    that use it and whether the dimension has it (`known_keys`).

    The fact is read once for all its links, and its rows are counted per key before they meet the
    dimensions, so a hot key is one row by then. Until then a link is a number and a key is packed.
    """
    mine = [(fk, dim) for f, fk, dim, _ in keys if f == fact]
    pairs = ", ".join(f"struct({i} AS i, {fk} AS key)" for i, (fk, _) in enumerate(mine, 1))
    link, dimension = (F.element_at(F.array(*map(F.lit, names)), F.col("i")) for names in (
        [f"{fact}.{fk}" for fk, _ in mine], [dim for _, dim in mine]))
    used = (
        df.selectExpr(f"inline(array({pairs}))").transform(pack, "key")
        .groupBy("i", "key").agg(F.count("*").alias("fact_rows")).transform(unpack, "key")
        .select(link.alias("link"), dimension.alias("dimension"), "key", "fact_rows")
    )
    there = known.filter(F.col("dimension").isin([dim for _, dim in mine])).withColumn("found", F.lit(True))
    return used.join(there, ["dimension", "key"], "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def per_link(
    facts: dict[str, DataFrame], known: DataFrame, keys: list[tuple[str, str, str, str]], *counts: Column
) -> DataFrame:
    """Counts over the used keys of every declared link, one fact after the other."""
    return one_by_one((
        link_usage(fact, df, known, keys).groupBy("link", "dimension").agg(*counts) for fact, df in facts.items()
    ), "links")


def orphans(facts: dict[str, DataFrame], known: DataFrame, keys: list[tuple[str, str, str, str]]) -> DataFrame:
    """Rows per declared link whose key the dimension lacks."""
    lost = F.col("key").isNotNull() & ~F.col("found")
    return per_link(
        facts, known, keys, F.coalesce(F.sum(F.when(lost, F.col("fact_rows"))), F.lit(0)).alias("orphan_rows")
    ).select(F.col("link").alias("fk"), "orphan_rows")


def grain_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Keys that occur more than once, per table with its declared grain."""
    return one_by_one((
        pack(df, *keys).groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n > 1")
        .agg(F.count("*").alias("dup_groups"))
        .select(F.lit(n).alias("table_name"), "dup_groups")
        for n, (df, keys) in tables.items()
    ), "grain")


def assert_grain(name: str, df: DataFrame, keys: list[str]) -> None:
    """Stop when a key occurs twice. One grouped pass instead of two counts."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").take(3)
    if twice:
        raise AssertionError(f"{name} is not unique by {keys}: {twice}")


def broken_identity(df: DataFrame, left: Column, right: Column, tolerance: str) -> DataFrame:
    return df.agg(
        F.count_if(F.abs(left - right) > F.lit(tolerance).cast("decimal(6,4)")).alias("broken_rows")
    )


def null_certainty(tables: dict[str, DataFrame]) -> DataFrame:
    return one_by_one((
        df.agg(F.count_if(F.col("metric_certainty_level").isNull()).alias("null_certainty"))
        .select(F.lit(n).alias("table_name"), "null_certainty")
        for n, df in tables.items()
    ), "null_certainty")


def window_coverage(
    facts: dict[str, tuple[DataFrame, str]], calendar: DataFrame, window: tuple[str, str]
) -> DataFrame:
    """Rows per fact inside the window. This check passes when every count is positive."""
    days = calendar.select(F.col("date_key").alias("__k"), "date_day").filter(
        F.col("date_day").between(F.lit(window[0]).cast("date"), F.lit(window[1]).cast("date"))
    )
    return one_by_one((
        df.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("__n"))
        .join(days, "__k", "left_semi")
        .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_in_window"))
        .select(F.lit(n).alias("table_name"), "rows_in_window")
        for n, (df, key) in facts.items()
    ), "coverage")


def stock_balance(
    snapshots: DataFrame, movements: DataFrame, window: tuple[str, str]
) -> DataFrame:
    """Pairs whose stock change over the window is not the net movement after the opening day."""
    first, last = (F.lit(w).cast("date") for w in window)
    pair = ["store_id", "product_code"]
    bounds = first_and_last(
        snapshots.filter(F.col("snapshot_date").between(first, last)), pair,
        "snapshot_date", "physical_qty",
    )
    daily = (
        movements.filter((F.col("node_type") == "STORE") & F.col("mdate").between(first, last))
        .groupBy(F.col("node_id").alias("store_id"), "product_code", "mdate")
        .agg(F.sum("quantity_delta").alias("d"))
    )
    moved = (
        bounds.join(daily, pair, "left")
        .groupBy(*pair, "first_at", "last_at", "first_value", "last_value")
        .agg(
            F.coalesce(
                F.sum(F.when(
                    (F.col("mdate") > F.col("first_at")) & (F.col("mdate") <= F.col("last_at")),
                    F.col("d"),
                )),
                F.lit(0),
            ).alias("net_movement")
        )
    )
    change = F.col("last_value") - F.col("first_value")
    return moved.filter(change != F.col("net_movement")).select(
        *pair,
        F.col("first_value").alias("opening_qty"),
        F.col("last_value").alias("closing_qty"),
        "net_movement",
        change.alias("observed_change"),
    )


def certainty_segregation(views: dict[str, DataFrame], estimated: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose confirmed revenue is only estimated, and rows behind an estimate that are not
    marked so. views: fact rows with the column `confirmed`, the amount a finance view takes from them."""
    est = F.col("metric_certainty_level") == "ESTIMATED"
    parts = [
        df.agg(F.count_if(est & (F.col("confirmed") != 0)).alias("bad_rows")).select(F.lit(n).alias("fact"), "bad_rows")
        for n, df in views.items()
    ] + [
        df.agg(F.count_if(~est).alias("bad_rows")).select(F.lit(n).alias("fact"), "bad_rows")
        for n, df in estimated.items()
    ]
    return one_by_one(parts, "certainty")


def uncorrected_delivery(fulfilment: DataFrame, hours: int) -> DataFrame:
    h = F.col("picked_to_delivered_hours")
    return fulfilment.agg(
        F.count_if(
            (h < 0) & (F.abs(h) <= hours)
        ).alias("uncorrected_violations")
    )


def suite(results: dict[str, tuple[DataFrame, Column, bool]], run_id: str) -> DataFrame:
    """One row per check: offenders and verdict.

    Each entry is (check output, offender expression, passes_when_zero). A check with the opposite
    polarity counts the rows that fall short.
    """
    parts = []
    for name, (df, offenders, zero) in results.items():
        total = df.agg(F.coalesce(F.sum(offenders), F.lit(0)).cast("bigint").alias("offenders"))
        parts.append(total.select(
            F.lit(run_id).alias("run_id"), F.lit(name).alias("check_name"), "offenders",
            (F.col("offenders") == 0 if zero else F.col("offenders") > 0).alias("passed"),
        ))
    return one_by_one(parts, "checks")
