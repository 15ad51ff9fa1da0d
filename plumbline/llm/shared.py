"""Written tables in the cluster's shared folder, and the text conventions the operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space of all contracts: space and the ASCII controls tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. On this machine alone (a local master) one of our own where none is
    named; a cluster must name one that all its machines see."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="plumbline-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


#: Makes Spark delete the shuffle files of an SQL execution when it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; the session's setting is put back."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


_scopes: list[list[str]] = [[]]


def stored(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage and shuffle files end there.

    The files go with the innermost `scratch` they are written in (outer: the one around it), else when the
    application ends; until then a lost executor costs a re-read only.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_deleted(spark):
        df.write.parquet(path)
    _scopes[max(len(_scopes) - 1 - outer, 0)].append(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


def with_places(docs: DataFrame) -> DataFrame:
    """The rows, columns named c0, c1, ..., with (file, at), their place in the files they are read from: the same in
    every read. What is not read from files is written first."""
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    names = [f"c{i}" for i in range(len(docs.columns))]
    try:
        return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], *place)
    except AnalysisException:
        return stored(docs.toDF(*names), "documents").select(*names, *place)


def deleted(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at its end; what is needed afterwards is stored with outer=True."""
    _scopes.append([])
    try:
        yield
    finally:
        deleted(spark, _scopes.pop())


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """The paths of tables stored inside are added to the list; they stay."""
    _scopes.append([])
    try:
        yield
    finally:
        paths.extend(_scopes.pop())


def text_of(column: str) -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def each(a: Column, b: Column, f) -> Column:
    return F.zip_with(a, b, f)


def head(a: Column, n: Column) -> Column:
    """The first n elements; none for n below 0."""
    return F.slice(a, 1, F.greatest(n, F.lit(0)))


def tail(a: Column, start: int, n: Column) -> Column:
    return F.slice(a, start, F.greatest(n, F.lit(0)))
