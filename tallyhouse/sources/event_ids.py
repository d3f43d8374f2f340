"""Identities of logged events by position range, so that a batch is compared with the ranges it touches and not with the whole log.

Layout: `lsn_range=<first digits of the position>/apply_batch=<batch>`. A batch that runs again replaces its own folders. A range holds
what was logged in it and never grows once the log has moved on, so the files a batch reads do not grow with the log.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.changes import EVENT_IDENTITY
from tallyhouse.sources.lake import BATCH_COLUMN

RANGE = "lsn_range"
MANY_RANGES = 1000  # more than these are found by a join with the folders' names


class EventIds:
    """`digits`: how many leading digits of the 20 of a log position name its range."""

    def __init__(self, spark: SparkSession, root: str, digits: int = 12):
        self.spark, self.root, self.digits = spark, root, digits

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def ranged(self, events: DataFrame) -> DataFrame:
        # "0x" and 20 digits; letters of both cases are one range.
        return events.withColumn(RANGE, F.concat(F.lit("r"), F.upper(F.substring("start_lsn", 3, self.digits))))

    def write(self, events: DataFrame, batch: str | None = None) -> None:
        """Add the identities of a batch's events; without a batch, those of `events` by their own `apply_batch`."""
        rows = events if batch is None else events.withColumn(BATCH_COLUMN, F.lit(batch))
        rows = self.ranged(rows.select(*EVENT_IDENTITY, BATCH_COLUMN))
        # One writer per range and batch would make a hot range one task; the files stay few, as a batch has few ranges.
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE, BATCH_COLUMN).parquet(self.root)

    def near(self, events: DataFrame, batch: str) -> DataFrame | None:
        """Identities that other batches logged in the ranges that `events` touch; None if there are none."""
        touched = self.ranged(events).select(RANGE).distinct()
        names = [r[0] for r in touched.limit(MANY_RANGES + 1).collect()]
        if len(names) > MANY_RANGES:
            known = self._read([self.root])
            known = None if known is None else known.join(touched, RANGE, "left_semi")
        else:
            known = self._read([f"{self.root}/{RANGE}={name}" for name in names])
        return None if known is None else known.where(F.col(BATCH_COLUMN) != batch).select(*EVENT_IDENTITY)

    def _read(self, folders: list[str]) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()
        there = [f for f in folders if path(f).getFileSystem(conf).exists(path(f))]
        if not there:
            return None
        try:
            return self.spark.read.option("basePath", self.root).parquet(*there)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return None
