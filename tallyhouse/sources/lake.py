"""Versioned tables as plain parquet folders: a published base, small change batches, a ledger of both.

A full load writes new base folders and publishes them together in one ledger append, so readers
never see a half-finished load. Incremental batches add one folder each; running a batch again
overwrites its own folder. One writer at a time is assumed, as the jobs never overlap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.latest import latest_rows, newest, overlay

BATCH_COLUMN = "apply_batch"
# Rows of one order lie together, so stored tables hold long runs of equal keys and dates.
CODEC = "zstd"


class Ledger:
    """Append-only control tables; the state of a key is its last row."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def read(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/{table}")

    def add(self, table: str, schema: str, *rows: tuple) -> None:
        """Append a few rows made by the driver, such as the outcome of a run."""
        self.append(table, self.spark.createDataFrame(list(rows), schema).coalesce(1))

    def latest(self, table: str, keys: Sequence[str], order: str) -> DataFrame | None:
        rows = self.read(table)
        return None if rows is None else newest(rows, keys, [F.desc(order)])


class Lake:
    """Tables under one folder, each read as base overlaid with its change batches."""

    PUBLISHED = "table_name string, folder string, version long"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.ledger = Ledger(spark, f"{root}/ledger")
        self._folders: dict[str, str] | None = None

    def refresh(self) -> None:
        """Look at the ledger again; jobs do so when they start, as other jobs may have published since."""
        self._folders = None

    # Versions come from the ledger, not from clocks, so a later write always wins.
    def next_version(self) -> int:
        used = [rows.select("version") for rows in map(self.ledger.read, ("published", "batches")) if rows is not None]
        newest_used = reduce(DataFrame.unionByName, used).agg(F.max("version")).first()[0] if used else 0
        return 1 + newest_used

    def reserve_version(self, batch_id: str) -> int:
        version = self.next_version()
        self.ledger.add("batches", "batch_id string, version long", (batch_id, version))
        return version

    def version_of(self, batch_id: str) -> int:
        """The version of a batch; a batch that runs again keeps the one it had."""
        batches = self.ledger.read("batches")
        known = None if batches is None else batches.where(F.col("batch_id") == batch_id).agg(F.min("version")).first()[0]
        return self.reserve_version(batch_id) if known is None else known

    def write_base(self, table: str, rows: DataFrame, version: int) -> DataFrame:
        """Write an unpublished base and return it as read back, with its lineage cut."""
        folder = f"{self.root}/{table}/v{version}/base"
        rows.write.mode("overwrite").parquet(folder, compression=CODEC)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def publish(self, version: int, *tables: str) -> None:
        """Make the bases of this version current, all at once; their earlier change batches are left behind."""
        rows = [(table, f"{table}/v{version}", version) for table in tables]
        self.ledger.add("published", self.PUBLISHED, *rows)
        self.refresh()

    def folders(self) -> dict[str, str]:
        """Current folder of every published table; the ledger has a handful of rows per table."""
        if self._folders is None:
            published = self.ledger.read("published")
            if published is None:
                return {}
            current = published.groupBy("table_name").agg(F.max_by("folder", "version").alias("folder"))
            self._folders = {row.table_name: f"{self.root}/{row.folder}" for row in current.collect()}
        return self._folders

    def tables(self) -> list[str]:
        return sorted(self.folders())

    def folder(self, table: str) -> str:
        folders = self.folders()
        if table not in folders:
            raise LookupError(f"table {table} was never published")
        return folders[table]

    def base(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder(table)}/base")

    def append(self, table: str, rows: DataFrame, batch_id: str) -> DataFrame:
        """Add one batch of new row versions and read it back. The same batch id replaces what it wrote before."""
        target = f"{self.folder(table)}/changes/{BATCH_COLUMN}={batch_id}"
        rows.write.mode("overwrite").parquet(target, compression=CODEC)
        return self.spark.read.schema(rows.schema).parquet(target)

    def parts(self, table: str) -> tuple[DataFrame, DataFrame | None]:
        """Base and change batches of a table; the batches keep their id in `apply_batch`."""
        folder = self.folder(table)
        base = self.spark.read.parquet(f"{folder}/base")
        try:
            return base, self.spark.read.parquet(f"{folder}/changes")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return base, None

    def changes(self, table: str) -> DataFrame | None:
        changes = self.parts(table)[1]
        return None if changes is None else changes.drop(BATCH_COLUMN)

    def history(self, table: str) -> DataFrame:
        """Every stored version of every row."""
        base, changes = self.parts(table)
        return base if changes is None else base.unionByName(changes.drop(BATCH_COLUMN))

    def latest(self, table: str, keys: Sequence[str], resolve: Callable = latest_rows) -> DataFrame:
        """Newest version of each key, tombstones included.

        A base holds one row per key and every change is newer than the base, so only the
        change batches need ranking. Without change batches this is a plain scan.
        """
        base, changes = self.parts(table)
        return base if changes is None else overlay(base, resolve(changes.drop(BATCH_COLUMN), keys), keys)

    def compact(self, tables: dict[str, Iterable[str]]) -> int:
        """Fold the change batches of these tables (name -> keys) into new bases. A batch that arrives meanwhile is not lost:
        the bases are written again with it before they are published."""
        while True:
            version, seen = self.reserve_version("compact"), self._batches(tables)
            for table, keys in tables.items():
                self.write_base(table, self.latest(table, list(keys)), version)
            if self._batches(tables) == seen:
                self.publish(version, *tables)
                return version

    def _batches(self, tables: Iterable[str]) -> list[tuple[str, str]]:
        """Change batches of these tables, by name."""
        found = []
        for table in tables:
            changes = self.parts(table)[1]
            if changes is not None:
                found += [(table, str(r[0])) for r in changes.select(BATCH_COLUMN).distinct().collect()]
        return sorted(found)
