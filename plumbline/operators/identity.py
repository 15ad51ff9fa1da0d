"""Who is who: identity records of several systems resolved to one customer key.

Four passes in strict order, each looking only at records the passes before left over:
loyalty id, e-mail, phone, then name and address. What is left shares the anonymous key.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.exprs import with_one_row
from plumbline.functions.keys import anonymous_key, surrogate_key
from plumbline.functions.text import email_norm, phone_e164, tokens
from plumbline.operators.joins import left_join_spread
from plumbline.operators.quality import Rule, add_anomaly_columns, flag
from plumbline.sources.raw import materialise

CONFIDENCE = {1: 1.00, 2: 0.95, 3: 0.90}  # fixed values
JACCARD_FROM, JACCARD_BELOW = 0.70, 0.90


def _leaders(known: DataFrame, key: str) -> DataFrame:
    """One customer key per identifier value: the smallest key of those who carry it."""
    return known.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__id")).agg(
        F.min("customer_key").alias("__leader")
    )


def _adopt(rest: DataFrame, known: DataFrame, key: str, step: int) -> tuple[DataFrame, DataFrame]:
    """Split `rest` into rows that have the identifier (resolved) and rows that do not."""
    have = rest.filter(F.col(key).isNotNull())
    joined = have.drop("customer_key", "identity_confidence", "match_pass").join(
        _leaders(known, key), F.col(key) == F.col("__id"), "left"
    )
    resolved = joined.withColumns({
        "customer_key": F.coalesce("__leader", surrogate_key(key)),
        "identity_confidence": F.lit(CONFIDENCE[step]),
        "match_pass": F.lit(step),
    }).drop("__id", "__leader")
    return resolved, rest.filter(F.col(key).isNull())


def prefix_size(n: Column, m: Column, threshold: float) -> Column:
    """How many of the rarest tokens of a set of n must be looked at to miss no set of m tokens this similar."""
    return n - F.ceil((n + m) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9)) + 1


def candidate_sets(left: DataFrame, right: DataFrame, threshold: float = JACCARD_FROM) -> DataFrame:
    """(__a, __b, customer_key): pairs of token sets that can be similar enough, some of them several times.

    Two sets that share as many tokens as their sizes ask for share one of their rarest ones. How many of those have
    to be looked at follows from both sizes, so sets meet by token and sizes: exact, and a frequent word brings sets
    together only where the rare ones leave too few.
    """
    freq = (
        left.select(F.explode("__t").alias("__tok"))
        .unionByName(right.select(F.explode("__t").alias("__tok")))
        .groupBy("__tok")
        .agg(F.count("*").alias("__f"))
    )

    def rarest(df: DataFrame, other: DataFrame, extra: list[str]) -> DataFrame:
        ranked = (
            df.select("*", F.explode("__t").alias("__tok"))
            .join(freq, "__tok")
            .groupBy("__t", *extra)
            .agg(F.array_sort(F.collect_list(F.struct("__f", "__tok"))).alias("__o"))
        )
        n, m = F.size("__t").cast("bigint"), F.col("__m")
        sizes = F.sequence(F.ceil(n * F.lit(threshold) - F.lit(1e-9)), F.floor(n / F.lit(threshold) + F.lit(1e-9)))
        there = other.select(F.size("__t").cast("bigint").alias("__m")).distinct()  # at most one row per size
        return ranked.withColumn("__m", F.explode(sizes)).join(F.broadcast(there), "__m").select(
            "__t", n.alias("__n"), m, *extra, F.explode(F.slice("__o", F.lit(1), prefix_size(n, m, threshold).cast("int"))).alias("__p")
        ).select("__t", "__n", "__m", *extra, F.col("__p.__tok").alias("__tok"))

    a = rarest(left, right, []).withColumnRenamed("__t", "__a")
    b = rarest(right, left, ["customer_key"]).select(
        F.col("__t").alias("__b"), F.col("__n").alias("__m"), F.col("__m").alias("__n"), "customer_key", "__tok")
    return a.join(b, ["__tok", "__n", "__m"]).select("__a", "__b", "customer_key")


def similar_sets(
    left: DataFrame, right: DataFrame, threshold: float = JACCARD_FROM
) -> DataFrame:
    """Best right-hand match of every distinct left token set, if its Jaccard reaches the threshold.

    Both inputs hold distinct token sets in `__t`, the right one its key in `customer_key`.
    """
    both = F.size(F.array_intersect("__a", "__b"))
    return (
        candidate_sets(left, right, threshold)
        .withColumn("__s", both / (F.size("__a") + F.size("__b") - both))
        .filter(F.col("__s") >= F.lit(threshold))
        .groupBy("__a")
        .agg(F.min(F.struct((-F.col("__s")).alias("s"), F.col("customer_key").alias("k"))).alias("m"))
        .select(
            F.col("__a").alias("__t"), F.col("m.k").alias("__leader"), (-F.col("m.s")).alias("__s")
        )
    )


def resolve_identities(records: DataFrame) -> DataFrame:
    """One row per identity record with its customer key, confidence and the pass that found it."""
    base = records.withColumns({
        "email_norm": email_norm("email"),
        "phone_e164": phone_e164("phone"),
        "customer_key": F.lit(None).cast("string"),
        "identity_confidence": F.lit(None).cast("double"),
        "match_pass": F.lit(None).cast("int"),
    })
    # every pass reads what the ones before left, so each is written once instead of derived again
    base = materialise(base, "identity_records")
    one = base.filter(F.col("loyalty_id").isNotNull()).withColumns({
        "customer_key": surrogate_key("loyalty_id"),
        "identity_confidence": F.lit(CONFIDENCE[1]),
        "match_pass": F.lit(1),
    })
    rest = base.filter(F.col("loyalty_id").isNull())
    two, rest = _adopt(rest, one, "email_norm", 2)
    two = materialise(two, "identity_by_mail")
    three, rest = _adopt(rest, one.unionByName(two), "phone_e164", 3)
    three = materialise(three, "identity_by_phone")

    words = F.array_sort(F.array_union(tokens("name"), tokens("address")))
    rest = rest.withColumn("__t", words)
    known = (
        one.unionByName(two).unionByName(three).withColumn("__t", words).filter(F.size("__t") > 0)
        .groupBy("__t").agg(F.min("customer_key").alias("customer_key"))
    )
    wanted = rest.filter(F.size("__t") > 0).select("__t").distinct()
    best = similar_sets(wanted, known).withColumnRenamed("__t", "__bt")
    # rows without any word would all meet in one partition: keep them out of the join
    worded = left_join_spread(
        rest.withColumn("__k", F.when(F.size("__t") > 0, F.array_join("__t", " "))),
        best.withColumn("__bk", F.array_join("__bt", " ")).drop("__bt"),
        ["__k"], ["__bk"],
    )
    hit = F.col("__leader").isNotNull()
    four = worded.withColumns({
        "customer_key": F.coalesce("__leader", anonymous_key()),
        # a fuzzy match never outranks an exact identifier
        "identity_confidence": F.when(
            hit, F.least(F.round(F.col("__s"), 4), F.lit(JACCARD_BELOW - 0.01))
        ).otherwise(F.lit(0.0)),
        "match_pass": F.when(hit, 4).otherwise(0),
    }).drop("__t", "__k", "__leader", "__s")

    out = add_anomaly_columns(
        one.unionByName(two).unionByName(three).unionByName(four)
    )
    conf = F.col("identity_confidence")
    return flag(out, [
        Rule("IDENTITY_AMBIGUOUS", (conf >= JACCARD_FROM) & (conf < JACCARD_BELOW)),
        Rule("FUZZY_MATCH_LOW_CONF", F.col("match_pass") == 0),
        Rule("EMAIL_MALFORMED", F.col("email").isNotNull() & F.col("email_norm").isNull()),
        Rule("PHONE_NORMALISATION_FAIL",
             F.col("phone").isNotNull() & F.col("phone_e164").isNull()),
    ])


def identity_bridge(resolved: DataFrame) -> DataFrame:
    """Every identifier a customer is known by: (kind, value) to customer key."""
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("identifier_type"), F.col(c).alias("identifier"))
            for kind, c in [("LOYALTY", "loyalty_id"), ("EMAIL", "email_norm"), ("PHONE", "phone_e164")]
        ]
    )
    return (
        resolved.filter("match_pass > 0")
        .select("customer_key", "identity_confidence", F.explode(kinds).alias("i"))
        .select("customer_key", "identity_confidence", "i.*")
        .filter("identifier is not null")
        .groupBy("identifier_type", "identifier", "customer_key")
        .agg(F.max("identity_confidence").alias("identity_confidence"))
    )


def customer_master(resolved: DataFrame) -> DataFrame:
    """One row per customer: details from the most certain record, records counted per customer."""
    rank = F.struct(
        F.col("identity_confidence"), F.col("source_system"), -F.col("source_id")
    )
    return resolved.groupBy("customer_key").agg(
        F.max("identity_confidence").alias("identity_confidence"),
        F.min("identity_confidence").alias("lowest_confidence"),
        F.max_by("match_pass", rank).alias("match_pass_used"),
        F.max_by("email_norm", rank).alias("email"),
        F.max_by("phone_e164", rank).alias("phone"),
        F.max_by("name", rank).alias("name"),
        F.max_by("address", rank).alias("address"),
        F.count("*").alias("identity_records"),
    )


def placeholder_ids(
    orders: DataFrame, members: DataFrame, times_median: float = 20.0
) -> DataFrame:
    """Customer ids used far more often than the median id and also owned by a real member."""
    used = orders.filter("customer_id is not null").groupBy("customer_id").agg(
        F.count("*").alias("orders")
    )
    typical = used.agg(F.median("orders").alias("typical"))
    real = members.select(F.col("source_id").cast("string").alias("customer_id")).distinct()
    return (
        with_one_row(used, typical)
        .filter(F.col("orders") > F.col("typical") * times_median)
        .join(real, "customer_id", "left_semi")
        .select("customer_id", "orders", "typical")
    )
