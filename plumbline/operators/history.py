"""Versions of a slowly changing record: from all loads, load by load, and as of a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.keys import surrogate_key
from plumbline.operators.joins import left_join_spread

OPEN_END = "9999-12-31"  # fixed value


def versions(loads: DataFrame, key: str, attributes: list[str], load_day: str) -> DataFrame:
    """One row per version: valid_from, valid_to, is_current, version_number.

    A version starts where an attribute differs from the load before; an unchanged reload adds
    none, a change back adds one. Loads of one day are one load, so a key has at most one row per
    load day. Computed from all loads every time, so a re-run gives the same versions.
    """
    daily = loads.groupBy(key, load_day).agg(
        F.max(F.struct(*attributes)).alias("__a")
    ).select(key, load_day, "__a.*")
    w = Window.partitionBy(key).orderBy(load_day)
    changed = daily.withColumn("__h", F.xxhash64(*attributes)).withColumn(
        "__new", F.lag("__h").over(w).isNull() | (F.lag("__h").over(w) != F.col("__h"))
    ).filter("__new")
    nxt = F.lead(load_day).over(w)
    return changed.select(
        key,
        *attributes,
        F.col(load_day).alias("valid_from"),
        F.coalesce(F.date_sub(nxt, 1), F.lit(OPEN_END).cast("date")).alias("valid_to"),
        nxt.isNull().alias("is_current"),
        F.row_number().over(w).alias("version_number"),
    ).withColumn("version_key", surrogate_key(key, "version_number"))


def version_at(df: DataFrame, dim: DataFrame, key: str, dim_key: str, day: Column, name: str, last_day: str,
               spread_by: list[str] | None = None) -> DataFrame:
    """Add the version_key of the version valid on a day: valid_from <= day <= valid_to; null where none is.

    A version is carried into every year it is valid in, up to the year of `last_day`, so that a key and year have
    at most one version per day of that year, however long a history is. The rows meet them in one equi-join on
    key and year, which keeps their number; days and versions after `last_day` count into its year. Rows without a key or a day
    spread over the partitions.
    """
    last = F.year(F.lit(last_day).cast("date"))
    span = F.sequence(F.least(F.year("valid_from"), last), F.least(F.year("valid_to"), last))
    version = F.struct("valid_from", "valid_to", "version_key")
    years = dim.filter(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("__vk"), F.explode(span).alias("__vy"), version.alias("__v"))
    years = years.groupBy("__vk", "__vy").agg(F.collect_list("__v").alias("__vs"))
    placed = df.withColumn("__day", day.cast("date")).withColumn("__year", F.least(F.year("__day"), last))
    met = left_join_spread(placed, years, [key, "__year"], ["__vk", "__vy"], spread_by)
    fits = F.filter("__vs", lambda v: (v["valid_from"] <= F.col("__day")) & (F.col("__day") <= v["valid_to"]))
    return met.withColumn(name, F.get(fits, 0)["version_key"]).drop("__vs", "__day", "__year")


def merge_load(dim: DataFrame, load: DataFrame, key: str, attributes: list[str], load_day: str) -> DataFrame:
    """The dimension after one more load, without its history: rows of versions that are closed stay as they are.

    `load` has the records of one day, later than all before. A record whose attributes are those of its open
    version changes nothing; one that differs closes the open version the day before and opens the next number; a
    new key opens number one. Keys the load does not name stay open. Records of one key are one, as in `versions`.
    """
    fresh = load.filter(F.col(key).isNotNull()).groupBy(key, load_day).agg(F.max(F.struct(*attributes)).alias("__new"))
    fresh = fresh.select(F.col(key).alias("__k"), F.col(load_day).alias("__on"), "__new")
    closed, open_ = dim.filter(~F.col("is_current")), dim.filter("is_current")
    met = open_.join(fresh, F.col(key) == F.col("__k"), "full_outer")
    known, differs = F.col(key).isNotNull(), ~F.struct(*attributes).eqNullSafe(F.col("__new"))
    ends = known & F.col("__k").isNotNull() & differs
    opens = F.col("__k").isNotNull() & (~known | differs)
    kept = met.filter(known).withColumns({
        "valid_to": F.when(ends, F.date_sub("__on", 1)).otherwise(F.col("valid_to")), "is_current": ~ends,
    }).select(dim.columns)
    opened = met.filter(opens).select(
        F.col("__k").alias(key), *[F.col("__new")[a].alias(a) for a in attributes], F.col("__on").alias("valid_from"),
        F.lit(OPEN_END).cast("date").alias("valid_to"), F.lit(True).alias("is_current"),
        (F.coalesce("version_number", F.lit(0)) + 1).alias("version_number"),
    ).withColumn("version_key", surrogate_key(key, "version_number")).select(dim.columns)
    return closed.unionByName(kept).unionByName(opened)
