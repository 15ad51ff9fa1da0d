"""Tables written to the cluster's shared folder on the way, and shuffle files that go as soon as a write ends."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

#: Makes Spark delete the shuffle files of an SQL execution when it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = threading.Lock()
_inside: dict[str, tuple[int, str | None]] = {}  # by application: blocks running now, the session's setting before them


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; one of our own only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What runs to its end inside leaves no shuffle files. The session's setting is put back by the last of the
    blocks that run side by side."""
    app = spark.sparkContext.applicationId
    with _lock:
        running, before = _inside.get(app, (0, None))
        if not running:
            before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _inside[app] = (running + 1, before)
    try:
        yield
    finally:
        with _lock:
            running, before = _inside.pop(app)
            if running > 1:
                _inside[app] = (running - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def _write(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with shuffles_deleted(spark):
        df.write.option("compression", "zstd").parquet(path)  # keys are hex digits, half of their bytes
    return spark.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to a new place in the shared folder and read from there.

    This is how a table replaces one it was read from, and how a long lineage is cut: an executor
    lost later costs a re-read, not a re-run.
    """
    return _kept(df, new_path(df.sparkSession, name))


def _kept(df: DataFrame, path: str) -> DataFrame:
    out = _write(df, path)
    place, files = _place(df.sparkSession, path)
    files.deleteOnExit(place)  # goes when the application ends
    return out


class Steps:
    """Writes one state of a table after the other; a state goes once the next one is written from it, the last one
    with `end`, else when the application ends."""

    def __init__(self, name: str):
        self.name, self.last = name, None

    def __call__(self, df: DataFrame) -> DataFrame:
        path = new_path(df.sparkSession, self.name)
        out = _kept(df, path)
        self.end(df.sparkSession)
        self.last = path
        return out

    def end(self, spark: SparkSession) -> None:
        if self.last:
            delete(spark, self.last)
        self.last = None


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The table as written, for as long as the block runs."""
    path = new_path(df.sparkSession, name)
    try:
        yield _write(df, path)
    finally:
        delete(df.sparkSession, path)


def one_by_one(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Small results under each other, each computed and written on its own: the shuffle files on disk are those of
    one part, not of all."""
    return reduce(DataFrame.unionByName, [materialise(p, name) for p in parts])
