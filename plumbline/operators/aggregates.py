"""Aggregation helpers: guarded sums, session funnels, ratios kept as pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

ADDITIVITY = "additivity"


def semi_additive(df: DataFrame, columns: list[str], over: str) -> DataFrame:
    """Mark stock columns: they add up over anything but `over`."""
    return _mark(df, columns, {ADDITIVITY: "semi", "over": over})


def non_additive(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mark prices, scores and rates: they never add up."""
    return _mark(df, columns, {ADDITIVITY: "none"})


def _mark(df: DataFrame, columns: list[str], meta: dict) -> DataFrame:
    for c in columns:
        df = df.withMetadata(c, meta)
    return df


def aggregate(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Sum columns by keys, refusing sums that the columns are declared not to allow."""
    for c in sums:
        meta = df.schema[c].metadata
        if meta.get(ADDITIVITY) == "none":
            raise ValueError(f"{c} is not additive")
        if meta.get(ADDITIVITY) == "semi" and meta["over"] not in keys:
            raise ValueError(f"{c} must not be summed across {meta['over']}")
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def group_flags(df: DataFrame, keys: list[str], flags: dict[str, Column]) -> DataFrame:
    """One row per group with, for every flag, whether any row of the group has it."""
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in flags.items()]
    )


def first_and_last(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Value on the first and on the last position of every group, without sorting the group."""
    at = F.struct(F.col(order), F.col(value))
    return df.groupBy(*keys).agg(F.min(at).alias("__f"), F.max(at).alias("__l")).select(
        *keys,
        F.col("__f")[order].alias("first_at"),
        F.col("__f")[value].alias("first_value"),
        F.col("__l")[order].alias("last_at"),
        F.col("__l")[value].alias("last_value"),
    )


RANGES = 256


def grouped_ranks(
    df: DataFrame, key: str, value: Column, ranks: dict[str, Callable[[Column], Column]], ranges: int = RANGES
) -> DataFrame:
    """One row per key with, for every name, the value at a rank (from 1) among the key's values in order.

    A rank is a function of the number of values. Equal values are counted first. A sketch of a key's distinct values
    gives the borders of its ranges, exact counts per range tell the range that holds a rank, and only that range is
    sorted: a task sees the ranges of a key or the values of one range, never all values of a key. The borders
    decide how even the ranges are, not the result. Keys without a value are left out; a null key is a key.
    """
    counts = df.select(F.col(key).alias("__k"), value.alias("__v")).filter("__v is not null").groupBy("__k", "__v").agg(
        F.count("*").alias("__n"))
    borders = counts.groupBy(F.col("__k").alias("__b")).agg(
        F.percentile_approx("__v", [i / ranges for i in range(1, ranges)], 16 * ranges).alias("__borders"))
    steps = ", ".join(str(1 << i) for i in reversed(range(ranges.bit_length())))
    # the number of borders below the value, by halving steps
    place = f"aggregate(array({steps}), 0, (i, s) -> if(i + s < {ranges} and get(__borders, i + s - 1) < __v, i + s, i))"
    placed = counts.join(borders, F.col("__k").eqNullSafe(F.col("__b"))).select("__k", "__v", "__n", F.expr(place).alias("__r"))
    run = Window.partitionBy("__k")
    upto = F.sum("__n").over(run.orderBy("__r"))
    totals = placed.groupBy("__k", "__r").agg(F.sum("__n").alias("__n")).select(
        "__k", "__r", "__n", upto.alias("__upto"), F.sum("__n").over(run).alias("__all"))
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), rank(F.col("__all")).alias("rank")) for n, rank in ranks.items()]))
    holding = totals.select("*", asked.alias("__a")).filter("__a.rank > __upto - __n and __a.rank <= __upto").select(
        F.col("__k").alias("__hk"), F.col("__r").alias("__hr"), F.expr("__upto - __n").alias("__before"), "__a")
    met = placed.join(holding, F.col("__k").eqNullSafe(F.col("__hk")) & (F.col("__r") == F.col("__hr")))
    here = F.sum("__n").over(Window.partitionBy("__k", "__r", "__a.name").orderBy("__v"))
    reached = met.withColumn("__here", here).filter("__before + __here >= __a.rank")
    return reached.groupBy(F.col("__k").alias(key)).agg(
        *[F.min(F.when(F.col("__a.name") == n, F.col("__v"))).alias(n) for n in ranks])


def grouped_quantiles(df: DataFrame, key: str, value: Column, quantiles: dict[str, float], ranges: int = RANGES) -> DataFrame:
    """Exact quantiles of a value per key: the smallest value with at least this share of the values up to it."""
    def rank(q: float) -> Callable[[Column], Column]:
        return lambda n: F.greatest(F.lit(1), F.ceil(n * F.lit(q).cast("decimal(18,9)")))

    return grouped_ranks(df, key, value, {name: rank(q) for name, q in quantiles.items()}, ranges)


def grouped_median(df: DataFrame, key: str, value: Column, name: str, ranges: int = RANGES) -> DataFrame:
    """Exact median of a value per key: the middle value or the mean of the two in the middle."""
    middle = {"__low": lambda n: F.floor((n + 1) / 2), "__high": lambda n: F.floor(n / 2) + 1}
    return grouped_ranks(df, key, value, middle, ranges).select(key, ((F.col("__low") + F.col("__high")) / 2).alias(name))
