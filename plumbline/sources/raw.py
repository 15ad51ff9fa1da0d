"""Landing raw tables, reading them back, writing results, and the checks around ingestion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plumbline.functions.keys import surrogate_key
from plumbline.operators.quality import union_all
from plumbline.sources.written import materialise, new_path, work_folder  # noqa: F401

META = ["_source_table", "_ingestion_timestamp", "_source_row_number"]


def read_source(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options
) -> DataFrame:
    """Any batch format `spark.read` knows: parquet, csv, json, orc, jdbc."""
    reader = spark.read.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path) if fmt != "jdbc" else reader.load()


def read_table(
    source: DataFrame, select: list[str] | None = None, where: str | Column | None = None
) -> DataFrame:
    """Projection and predicate stated up front; both reach the file scan."""
    df = source if where is None else source.filter(where)
    return df if select is None else df.select(*select)


def source_row_number(scan: DataFrame) -> DataFrame:
    """Number the rows of a file scan 1..n by their place in the source, without moving them.

    The scan knows the row's index in its file; the rows of the files before it are added from a
    table of one row per file, which is broadcast: a join by file would bring a file's rows to one task. Needs a
    direct scan of parquet files.
    """
    df = scan.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy("__file")
        .agg(F.count("*").alias("__n"))
        .select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    return df.join(F.broadcast(offsets), "__file").select(
        *scan.columns, (F.col("__offset") + F.col("__row") + 1).alias("_source_row_number")
    )


def ingest_raw(df: DataFrame, table: str, run_ts: Column | None = None) -> DataFrame:
    """A scanned table unchanged plus where it came from, when, and a row number."""
    return source_row_number(df).select(
        *df.columns,
        F.lit(table).alias("_source_table"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("_ingestion_timestamp"),
        "_source_row_number",
    )


def discover(spark: SparkSession, folder: str, expected: int | None = None) -> list[str]:
    """Names of the tables in a folder, by listing its files; stop when their number is not the expected
    one. The listing is a distributed scan that opens no file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    name = F.regexp_extract("path", r"/([^/]+)\.parquet(?:/[^/]+)?$", 1)
    rows = files.select(name.alias("name")).filter("name <> ''").distinct().orderBy("name").collect()
    found = [r.name for r in rows]
    if expected is not None and len(found) != expected:
        raise AssertionError(f"expected {expected} source tables, found {len(found)}: {found}")
    return found


def land_all(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]], run_ts: Column | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write every table with where it came from; the landed tables, and a log with one row per table:
    rows landed, outcome, error, run time. A table that fails is logged and does not stop the others."""
    landed, log = {}, []
    for name, read in tables.items():
        try:
            landed[name] = materialise(ingest_raw(read(), name, run_ts), f"landed_{name}")
            rows = landed[name].count()
            log.append((name, rows, "OK" if rows else "OK_EMPTY", None))
        except Exception as e:  # whatever is wrong with one table belongs in the log
            log.append((name, None, "FAILED", f"{type(e).__name__}: {str(e).splitlines()[0]}"))
    entries = spark.createDataFrame(log, "source_table string, row_count bigint, status string, error string")
    return landed, entries.withColumn("ingestion_timestamp", F.current_timestamp() if run_ts is None else run_ts)


def reconcile_counts(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Tables whose landed row count is not the expected one, or that only one side knows."""
    return (
        expected.select("source_table", F.col("row_count").alias("expected_rows"))
        .join(
            actual.select("source_table", F.col("row_count").alias("actual_rows")),
            "source_table",
            "full_outer",
        )
        .filter(~F.col("expected_rows").eqNullSafe(F.col("actual_rows")))
        .withColumn(
            "difference",
            F.coalesce("actual_rows", F.lit(0)) - F.coalesce("expected_rows", F.lit(0)),
        )
    )


def assert_counts(actual: DataFrame, expected: DataFrame) -> None:
    wrong = reconcile_counts(actual, expected)
    if n := wrong.count():
        raise AssertionError(f"row counts of {n} tables differ, among them: {wrong.take(100)}")


def write_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Replace the table at `path`; running it twice leaves the same table."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def empty_like(spark: SparkSession, schema) -> DataFrame:
    """A source table without rows still lands, with its real types."""
    return spark.createDataFrame([], schema)


def static_rows(spark: SparkSession, rows: list[tuple], schema: str, key: str, code: str) -> DataFrame:
    """Reference rows kept in code, keyed like any other dimension."""
    return spark.createDataFrame(rows, schema).withColumn(key, surrogate_key(code))
