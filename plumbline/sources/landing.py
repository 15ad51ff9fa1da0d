"""Landing under a contract: what a delivery should hold is written down when it arrives, and held against what landed.

The contract of a delivery has one row per table and file: rows, as the file's own footer counts them, and the
columns with their types. It is stored with the delivery and never computed from the landed tables. A file that came
short, went missing or appeared afterwards differs in its count; a column that came, went or changed its type is
drift. Tables without rows land with their columns and are read back like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.operators.quality import union_all
from plumbline.sources.store import TableStore

CONTRACT = "delivery_contract"
NO_FILE = ""


def columns_of(df: DataFrame) -> list[str]:
    return [f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields]


def delivered(tables: dict[str, DataFrame]) -> DataFrame:
    """(source_table, file, rows, columns) of file scans; one row without a file for a table that has none. Only the
    rows' number is asked for, so that no column of the files is read."""
    def one(name: str, df: DataFrame) -> DataFrame:
        columns = F.array(*[F.lit(c) for c in columns_of(df)])
        if not df.inputFiles():
            return df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("source_table"), F.lit(NO_FILE).alias("file"), "rows", columns.alias("columns"))
        file = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+(?:/[^/]+)?)$", 1)
        return df.groupBy(file.alias("file")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("source_table"), "file", "rows", columns.alias("columns"))

    return union_all([one(n, df) for n, df in tables.items()])


class Landing:
    """Tables of a delivery in a store, with the contract they came under."""

    def __init__(self, store: TableStore):
        self.store = store

    def announce(self, tables: dict[str, DataFrame]) -> None:
        """Store the contract of a delivery."""
        self.store.replace(CONTRACT, delivered(tables), ["source_table", "file"], 1)

    def land(self, spark: SparkSession, tables: dict[str, Callable[[], DataFrame]]) -> DataFrame:
        """Land the tables and report on each: expected and landed rows, files that differ, drift, status.

        A table that fails lands nothing and does not stop the others; one the contract does not name is reported as
        not announced, and one that is announced but not there as missing.
        """
        log, seen = [], {}
        for name, read in tables.items():
            try:
                df = read()
                m = self.store.replace(f"landed.{name}", df, df.columns[:1], 8)
                seen[name] = df
                log.append((name, sum(x["rows"] for x in m["folders"].values()), columns_of(df), None))
            except Exception as e:  # whatever is wrong with one table belongs in the report
                log.append((name, None, None, f"{type(e).__name__}: {str(e).splitlines()[0]}"))
        found = spark.createDataFrame(log, "source_table string, landed_rows long, landed_columns array<string>, error string")
        contract = self.store.read(CONTRACT)
        expected = contract.groupBy("source_table").agg(F.sum("rows").alias("expected_rows"), F.first("columns").alias("columns"))
        files = self._files(contract, seen) if seen else None
        out = expected.join(found, "source_table", "full_outer")
        out = out.join(files, "source_table", "left") if files is not None else out.withColumn("files_differing", F.lit(0))
        none = F.array().cast("array<string>")
        had, has = F.coalesce("columns", none), F.coalesce("landed_columns", none)
        listed = lambda c: F.array_join(F.array_sort(c), ", ")
        drift = F.when(F.col("columns").isNotNull() & F.col("landed_columns").isNotNull(), listed(F.array_union(
            F.transform(F.array_except(had, has), lambda c: F.concat(F.lit("-"), c)), F.transform(F.array_except(has, had), lambda c: F.concat(F.lit("+"), c)))))
        rows = F.coalesce("landed_rows", F.lit(0)) - F.coalesce("expected_rows", F.lit(0))
        status = (
            F.when(F.col("error").isNotNull(), "FAILED").when(F.col("expected_rows").isNull(), "NOT_ANNOUNCED").when(F.col("landed_columns").isNull(), "MISSING")
            .when(drift != "", "DRIFT").when((rows != 0) | (F.coalesce("files_differing", F.lit(0)) > 0), "DIFFERS")
            .when(F.col("landed_rows") == 0, "OK_EMPTY").otherwise("OK")
        )
        return out.select(
            "source_table", "expected_rows", F.col("landed_rows").alias("actual_rows"), rows.alias("difference"),
            F.coalesce("files_differing", F.lit(0)).cast("long").alias("files_differing"), F.coalesce(drift, F.lit("")).alias("drift"), status.alias("status"),
        )

    def _files(self, contract: DataFrame, seen: dict[str, DataFrame]) -> DataFrame:
        """Per table: files whose rows are not those announced, or that one side knows only."""
        now = delivered(seen).select("source_table", "file", F.col("rows").alias("now"))
        met = contract.select("source_table", "file", "rows").join(now, ["source_table", "file"], "full_outer")
        return met.filter(~F.col("rows").eqNullSafe(F.col("now"))).groupBy("source_table").agg(F.count("*").alias("files_differing"))

    def landed(self, name: str) -> DataFrame:
        return self.store.read(f"landed.{name}")


class RunLog:
    """Results of validation runs, appended run by run and never changed."""

    def __init__(self, store: TableStore, name: str = "validation_runs"):
        self.store, self.name = store, name

    def append(self, run: int, report: DataFrame) -> None:
        """Add the report of a run with a number above all before. The log's partitions are runs' own folders of
        a handful of rows, one per check."""
        rows = report.select(F.lit(run).alias("run"), "check_name", "offenders", "passed")
        if not self.store.version(self.name):
            self.store.replace(self.name, rows, ["run"], 1)
            return
        past = self.store.read(self.name)
        last = past.agg(F.max("run")).first()[0]
        if last is not None and run <= last:
            raise ValueError(f"run {run} is not after run {last}")
        self.store.replace(self.name, past.unionByName(rows), ["run"], 1)

    def history(self) -> DataFrame:
        """Every result with the one of the run before it: by how much offenders changed, and the verdict's turn."""
        from pyspark.sql import Window

        w = Window.partitionBy("check_name").orderBy("run")  # one row per run
        before, was = F.lag("offenders").over(w), F.lag("passed").over(w)
        turn = F.when(was.isNull(), "FIRST").when(was == F.col("passed"), "SAME").when(F.col("passed"), "MENDED").otherwise("BROKEN")
        return self.store.read(self.name).select("run", "check_name", "offenders", "passed", (F.col("offenders") - before).alias("change"), turn.alias("turn"))
