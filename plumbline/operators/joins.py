"""Join shapes the warehouse needs beyond a plain equi-join.

None of them emits all pairs of a group. Time-bounded matches use fixed-width time buckets: a match
within `width` of a row lies in the row's own bucket or in the neighbouring one, so the far side is
reduced to one row per key and bucket before it is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.dates import epoch_seconds
from plumbline.functions.exprs import holds


def mark_exists(
    df: DataFrame, other: DataFrame, on: dict[str, str], name: str, spread_by: list[str] | None = None
) -> DataFrame:
    """Add a boolean: does `other` have a row with the same key? `on` maps df to other columns.

    A null key matches nothing and is given a private value, so that rows without a key spread
    over the partitions instead of meeting in one.
    """
    keys = {f"__k{i}": F.col(c) for i, c in enumerate(on.values())}
    seen = (
        other.select(*[e.alias(k) for k, e in keys.items()])
        .dropna()
        .distinct()
        .withColumn("__seen", F.lit(True))
    )
    return (
        left_join_spread(df, seen, list(on), list(keys), spread_by)
        .withColumn(name, holds(F.col("__seen")))
        .drop("__seen")
    )


def left_join_spread(
    df: DataFrame, other: DataFrame, left_keys: list[str], right_keys: list[str], spread_by: list[str] | None = None
) -> DataFrame:
    """Left join whose null keys do not pile up in one shuffle partition. Drops the right keys.

    spread_by: the columns that tell rows without a key apart; all of them, if not given. They have to reach the
    join, so naming a few lets a query that reads few columns move no others.
    """
    some_null = F.lit(False)
    for k in left_keys:
        some_null = some_null | F.col(k).isNull()
    # rows without a key get a value of their own to be shuffled by; 0 for all others
    spread = F.when(some_null, F.xxhash64(*[F.col(c) for c in spread_by or df.columns])).otherwise(F.lit(0))
    left = df.withColumns({
        "__spread": spread,
        **{f"__l{i}": F.col(k) for i, k in enumerate(left_keys)},
    })
    right = other.withColumn("__rspread", F.lit(0).cast("bigint"))
    cond = F.col("__spread") == F.col("__rspread")
    for i, rk in enumerate(right_keys):
        cond = cond & (F.col(f"__l{i}") == F.col(rk))
    return left.join(right, cond, "left").drop(
        "__spread", "__rspread", *right_keys, *[f"__l{i}" for i in range(len(left_keys))]
    )


def bucket_of(ts: Column, width_seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(width_seconds))


def mark_within(
    df: DataFrame,
    other: DataFrame,
    keys: list[str],
    ts: str,
    other_ts: str,
    width_seconds: int,
    name: str,
    after: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Add a boolean: does `other` have a row of the same key at most `width` after (or before) `ts`?

    Exact: in the row's own bucket the latest (earliest) time decides, in the next (previous)
    bucket the earliest (latest) one. `strict` leaves out the very same instant.
    """
    b = bucket_of(F.col(other_ts), width_seconds)
    own = F.max(other_ts) if after else F.min(other_ts)
    far = F.min(other_ts) if after else F.max(other_ts)
    step = -1 if after else 1
    edges = (
        other.filter(F.col(other_ts).isNotNull())
        .groupBy(*keys, b.alias("__b"))
        .agg(own.alias("__own"), far.alias("__far"))
    )
    none = F.lit(None).cast(dict(edges.dtypes)["__own"])
    # each bucket tells its own rows one edge and the neighbouring bucket's rows the other
    sides = edges.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("__b"), F.col("__own"), none.alias("__far")),
                F.struct((F.col("__b") + step).alias("__b"), none.alias("__own"), F.col("__far")),
            )
        ).alias("__s"),
    ).select(*keys, "__s.*")
    sides = sides.groupBy(*keys, "__b").agg(
        F.max("__own").alias("__own"), F.max("__far").alias("__far")
    )
    sides = sides.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)],
                         F.col("__b").alias("__rb"), "__own", "__far")

    row = F.col(ts)
    width = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(width_seconds).cast("decimal(18,6)"))
    if after:
        near = F.col("__own") > row if strict else F.col("__own") >= row
        next_ = F.col("__far") <= row + width
    else:
        near = F.col("__own") < row if strict else F.col("__own") <= row
        next_ = F.col("__far") >= row - width
    left = df.withColumn("__lb", bucket_of(row, width_seconds))
    return (
        left_join_spread(
            left, sides, [*keys, "__lb"], [*[f"__r{i}" for i in range(len(keys))], "__rb"]
        )
        .withColumn(name, holds(near) | holds(next_))
        .drop("__own", "__far", "__lb")
    )


def latest_before(
    df: DataFrame,
    other: DataFrame,
    keys: list[str],
    ts: str,
    other_ts: str,
    take: list[str],
    width_seconds: int,
) -> DataFrame:
    """As-of join: the latest row of `other` at or before `ts`, no older than `width`.

    Both sides meet in one sorted pass per key and time bucket; the last row of the previous bucket
    is carried over by a join of one row per bucket. `take` columns are null when nothing matches.
    """
    value = F.struct(F.col(other_ts).alias("__t"), *[F.col(c) for c in take])
    right = other.filter(F.col(other_ts).isNotNull()).select(
        *keys, F.col(other_ts).alias("__ts"), value.alias("__v"),
        bucket_of(F.col(other_ts), width_seconds).alias("__b"),
    )
    carried = right.groupBy(*keys, (F.col("__b") + 1).alias("__b")).agg(
        F.max("__v").alias("__carry")
    )
    left = df.withColumns({
        "__row": F.struct(*[F.col(c) for c in df.columns]),
        "__ts": F.col(ts),
        "__b": bucket_of(F.col(ts), width_seconds),
    }).select(*keys, "__ts", "__b", "__row")
    vtype, rtype = right.schema["__v"].dataType, left.schema["__row"].dataType
    both = left.withColumn("__v", F.lit(None).cast(vtype)).unionByName(
        right.withColumn("__row", F.lit(None).cast(rtype))
    )
    # at one instant the far side comes first, and of several the largest value wins
    order = [F.col("__ts"), F.col("__row").isNotNull(), F.col("__v")]
    w = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    seen = both.withColumn("__near", F.last("__v", ignorenulls=True).over(w)).filter(
        F.col("__row").isNotNull()
    )
    joined = seen.drop("__v").join(carried, [*keys, "__b"], "left")
    best = F.coalesce("__near", "__carry")
    width = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(width_seconds).cast("decimal(18,6)"))
    fresh = F.when(best["__t"] >= F.col("__ts") - width, best)
    return joined.select("__row.*", *[fresh[c].alias(c) for c in take])


def brackets(
    spine: DataFrame, seen: DataFrame, keys: list[str], day: str, values: list[str]
) -> DataFrame:
    """For every spine day: the value on it, and the last one before and the first one after it.

    A group holds one row per calendar day, so its size is bounded by the calendar, not the data.
    """
    marked = seen.select(*keys, day, F.struct(F.col(day).alias("__d"), *values).alias("__v"))
    df = spine.join(marked, [*keys, day], "left")
    w = Window.partitionBy(*keys).orderBy(day)
    before = F.last("__v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("__v", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumns({"left_side": before, "right_side": after}).withColumnRenamed(
        "__v", "observed"
    )


def per_day(df: DataFrame, ts: str) -> Column:
    return F.col(ts).cast("date")
