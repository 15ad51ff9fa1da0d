"""Missing snapshot days: found, and filled by interpolation or from the movement ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.exprs import with_one_row
from plumbline.operators.joins import brackets
from plumbline.operators.quality import Rule, add_anomaly_columns, flag


def day_spine(df: DataFrame, keys: list[str], day: str, every_day_of: DataFrame | None = None) -> DataFrame:
    """Every key with every calendar day between its first and last one.

    With `every_day_of`, the span is the one row (first_day, last_day) of another table.
    """
    spans = (
        df.groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
        if every_day_of is None
        else with_one_row(df.select(*keys).distinct(), every_day_of)
    )
    return spans.select(
        *keys, F.explode(F.sequence("first_day", "last_day")).alias(day)
    )


def missing_days(df: DataFrame, keys: list[str], day: str, spine: DataFrame | None = None) -> DataFrame:
    """Key and day combinations of the spine that were not observed."""
    spine = day_spine(df, keys, day) if spine is None else spine
    return spine.join(df.select(*keys, day).distinct(), [*keys, day], "left_anti")


def fill_gaps(
    df: DataFrame, keys: list[str], day: str, values: list[str], spine: DataFrame | None = None
) -> DataFrame:
    """Reconstructed rows for the missing days.

    Between two observed days values run in a straight line, rounded to whole units; after the last
    observed day the last value is carried forward. Days before the first one are not invented.
    """
    spine = day_spine(df, keys, day) if spine is None else spine
    b = brackets(spine, df.select(*keys, day, *values), keys, day, values).filter(
        F.col("observed").isNull() & F.col("left_side").isNotNull()
    )
    left, right = F.col("left_side"), F.col("right_side")
    span = F.date_diff(right["__d"], left["__d"])
    passed = F.date_diff(F.col(day), left["__d"])

    def between(v: str) -> Column:
        return F.round(
            left[v] + F.coalesce(right[v] - left[v], F.lit(0)) * F.coalesce(passed / span, F.lit(0.0))
        ).cast("int")

    out = b.select(
        *keys,
        day,
        *[between(v).alias(v) for v in values],
        F.when(right.isNotNull(), "LINEAR_INTERP").otherwise("LOCF").alias("recon_method"),
        F.lit(True).alias("is_reconstructed"),
    )
    out = add_anomaly_columns(out, "RECONSTRUCTED", "INFERRED")
    return flag(out, [
        Rule("RECONSTRUCTED_SNAPSHOT", F.lit(True)),
        Rule("MISSING_SNAPSHOT_DAY", F.lit(True), "RECONSTRUCTED", "INFERRED"),
    ])


def fill_from_movements(
    snapshots: DataFrame,
    movements: DataFrame,
    keys: list[str],
    day: str,
    qty: str,
    movement_day: str,
    delta: str,
    spine: DataFrame | None = None,
) -> DataFrame:
    """Missing days as the last count plus the signed movements since then.

    Movements are summed per key and day before anything is sorted, so a busy key costs one row
    per calendar day.
    """
    spine = day_spine(snapshots, keys, day) if spine is None else spine
    net = movements.groupBy(*keys, F.col(movement_day).alias(day)).agg(F.sum(delta).alias("__net"))
    df = (
        spine.join(snapshots.select(*keys, day, F.col(qty).alias("__q")), [*keys, day], "left")
        .join(net, [*keys, day], "left")
        .withColumn("__net", F.coalesce("__net", F.lit(0)))
    )
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    running = df.withColumn("__run", F.sum("__net").over(w))
    base = F.last(
        F.when(F.col("__q").isNotNull(), F.struct(F.col("__q"), F.col("__run"))), ignorenulls=True
    ).over(w)
    out = running.withColumn("__base", base).filter(
        F.col("__q").isNull() & F.col("__base").isNotNull()
    ).select(
        *keys, day,
        (F.col("__base.__q") + F.col("__run") - F.col("__base.__run")).cast("int").alias(qty),
        F.lit("MOVEMENT_SUM").alias("recon_method"),
        F.lit(True).alias("is_reconstructed"),
    )
    out = add_anomaly_columns(out, "RECONSTRUCTED", "INFERRED")
    return flag(out, [Rule("RECONSTRUCTED_SNAPSHOT", F.lit(True))])
