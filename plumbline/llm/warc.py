"""Fixity audit of archived records with Merkle trees.

Pages are WARC records, laid out one after another in files of a fixed number of records. A replica is
the list of the hashes found at those places. Over each replica a tree is built: a leaf per record, and
over every sixteen neighbours in offset order a node that hashes their hashes, up to one root. Two
replicas are compared at the root; only below nodes that differ are their children compared, down to
the records. Sound data costs one comparison however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.shared import stored, text_of

PER_FILE = 1024
FAN_BITS = 4  # sixteen children


def record_of(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a page's WARC record."""
    eol = "\r\n"
    head = [
        F.lit(f"WARC/1.0{eol}WARC-Type: resource{eol}WARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(f">{eol}WARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit(f"{eol}Content-Type: text/html{eol}Content-Length: "),
        F.octet_length(html).cast("string"), F.lit(eol * 2),
    ]
    return F.encode(F.concat(*head, html, F.lit(eol * 2)), "UTF-8")


def laid_out(records: DataFrame, *order: str, per_file: int = PER_FILE) -> DataFrame:
    """The records with ordinal, file_id and record_offset, in the given order.

    Needs the column record_length. The order is a range partitioning with the row's place as the
    last key, so that equal keys do not meet in one task; files are bounded, so is the window.
    """
    keys = [*order, "row"]
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        records.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        .withColumn("at", F.monotonically_increasing_id()).drop("row")
    )
    placed = stored(placed, "placed").withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ordinal = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.join(parts, "part").withColumn("ordinal", ordinal).drop("part", "before", "at")
    numbered = numbered.withColumn("file_id", F.floor(F.col("ordinal") / per_file))
    in_file = Window.partitionBy("file_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.withColumn("record_offset", F.coalesce(F.sum("record_length").over(in_file), F.lit(0)))


def merkle_levels(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Tables (at, hash) from the leaves (ordinal, hash) up to one root at `height`.

    A node's hash covers its children's places and hashes, so a record that is gone or moved changes it.
    """
    level = stored(leaves.select(F.col("ordinal").alias("at"), "hash"), "leaves")
    levels = [level]
    for k in range(height):
        children = F.sort_array(F.collect_list(F.struct("at", "hash")))  # sixteen at most
        joined = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["at"], c["hash"])), "\n")
        level = level.groupBy(F.shiftright("at", FAN_BITS).alias("up")).agg(F.sha2(joined, 256).alias("hash")).select(F.col("up").alias("at"), "hash")
        level = stored(level, f"nodes-{k + 1}")
        levels.append(level)
    return levels


def height_for(places: int) -> int:
    h = 0
    while places > 1 << FAN_BITS * h:
        h += 1
    return h


def damaged_places(expected: DataFrame, found: DataFrame, places: int) -> DataFrame:
    """(ordinal, expected, found) of every place in which two replicas (ordinal, hash) differ; null
    where a replica has no record. places: one more than the largest ordinal of either."""
    height = height_for(places)
    a, b = merkle_levels(expected, height), merkle_levels(found, height)
    suspects = None
    for x, y in zip(reversed(a), reversed(b)):
        if suspects is not None:
            x, y = (t.join(suspects, F.shiftright(t.at, FAN_BITS) == suspects.up, "left_semi") for t in (x, y))
        x, y = x.withColumnRenamed("hash", "expected"), y.withColumnRenamed("hash", "found")
        differ = stored(x.join(y, "at", "full_outer").filter("not expected <=> found"), "differ")
        suspects = differ.select(F.col("at").alias("up"))
    return differ.withColumnRenamed("at", "ordinal")


def decayed(record: Column, sha256: Column) -> Column:
    """The bytes of a record in a replica that has suffered: by the first two digits of its hash one
    byte is changed (00), the end is cut off (01), or the record is lost, null (02)."""
    kind = F.substring(sha256, 1, 2)
    half = F.floor(F.octet_length(record) / 2).cast("int")
    return (
        F.when(kind == "00", F.overlay(record, F.encode(F.lit("\x00"), "UTF-8"), half))
        .when(kind == "01", F.substring(record, F.lit(1), half))
        .when(kind != "02", record)
    )


def fixity_audit(pages: DataFrame, replica: Column | None = None) -> DataFrame:
    """One row per record: page_id, url, file_id, record_offset, record_length, sha256, status.

    Audits the pages (page_id, url, html) as a primary against a replica, by default one that has
    decayed. replica: its bytes, from the columns record and sha256; null is a lost record. status is
    intact, corrupt or missing. A null url, id or html is empty in the record; repeated pages are
    records of their own. An empty table gives an empty result. Other columns are not read.
    """
    own = pages.select(F.col("page_id"), F.col("url"), text_of("html").alias("html"))
    own = own.select("page_id", "url", record_of(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    own = own.withColumn("sha256", F.sha2("record", 256))
    copy = decayed(F.col("record"), F.col("sha256")) if replica is None else replica
    hashed = own.select("page_id", "url", F.octet_length("record").cast("long").alias("record_length"), "sha256", F.sha2(copy, 256).alias("found"))
    index = stored(laid_out(hashed, "page_id", "url", "sha256"), "index")
    places = index.agg(F.max("ordinal")).first()[0]
    here = index.select("ordinal", F.col("sha256").alias("hash"))
    there = index.filter("found is not null").select("ordinal", F.col("found").alias("hash"))
    damage = damaged_places(here, there, 0 if places is None else places + 1)
    status = F.when(F.col("expected").isNull(), "intact").when(F.col("d.found").isNull(), "missing").otherwise("corrupt")
    return index.alias("i").join(damage.alias("d"), "ordinal", "left").select(
        "page_id", "url", "file_id", "record_offset", "record_length", "sha256", status.alias("status")
    )
