import time

from pyspark.sql import functions as F

from plumbline.llm.shared import CLEANUP, stored


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles().iterator()
    found = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def test_stored_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n")).repartition(3, "n")
    kept = stored(rows, "sums")
    until = time.monotonic() + 5  # executors delete them a moment later
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert sorted(r.n for r in kept.collect()) == sorted(sum(range(k, 1000, 7)) for k in range(7))


def test_the_sessions_setting_stays(spark):
    stored(spark.range(3), "three")
    assert spark.conf.get(CLEANUP, None) in (None, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        stored(spark.range(3), "three")
        assert spark.conf.get(CLEANUP) == "true"
    finally:
        spark.conf.unset(CLEANUP)
