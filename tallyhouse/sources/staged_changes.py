"""Applied change batches of staged tables, kept by log position and apart from the snapshots.

A snapshot names the log position it holds, and readers apply the changes after that position. So a new snapshot neither drops
what is taken in while it is read, nor lets changes it already holds undo it.

Each batch is a folder of its own that a replay overwrites; a folder counts once its write is complete. Folding writes
the last change of each key aside and then names the folded batches in one ledger append, so readers see the batches, or
the batches and what they fold into (the same rows twice, which changes nothing), or the latter alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.lake import BATCH_COLUMN, Ledger


class StagedChanges:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.ledger = Ledger(spark, f"{root}/ledger")

    def _files(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def write(self, table: str, rows: DataFrame, batch: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/{BATCH_COLUMN}={batch}")

    def _folded(self, table: str) -> dict[str, str]:
        """Folded batch -> the batch that holds it now. One row per batch ever taken."""
        known = self.ledger.read("folded")
        return {} if known is None else {r.batch: r.into for r in known.where(F.col("table_name") == table).collect()}

    def batches(self, table: str) -> list[str]:
        """Complete batches that are not folded."""
        files, path = self._files(table)
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        complete = [n for n in names if n.startswith(f"{BATCH_COLUMN}=") and files.exists(self._files(table, n, "_SUCCESS")[1])]
        folded = self._folded(table)
        return sorted(b for b in (n.split("=", 1)[1] for n in complete) if b not in folded)

    def _read(self, table: str, batches: list[str]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.root}/{table}/{BATCH_COLUMN}={b}" for b in batches))

    def read(self, table: str) -> DataFrame | None:
        batches = self.batches(table)
        return self._read(table, batches) if batches else None

    def fold(self, table: str, keys: Sequence[str], after_lsn: str, resolve: Callable) -> None:
        """Fold the batches there are now, without the changes up to `after_lsn`, which the snapshot holds. Batches that arrive
        meanwhile stay as they are. Folders that an earlier fold replaced go: their readers are done by then."""
        earlier, batches = self._folded(table), self.batches(table)
        if len(batches) < 2:
            return
        into = f"fold-{uuid.uuid4()}"
        self.write(table, resolve(self._read(table, batches).where(F.col("start_lsn") > after_lsn), list(keys)), into)
        self.ledger.add("folded", "table_name string, batch string, into string", *((table, b, into) for b in batches))
        for batch in earlier:
            files, path = self._files(table, f"{BATCH_COLUMN}={batch}")
            files.delete(path, True)
