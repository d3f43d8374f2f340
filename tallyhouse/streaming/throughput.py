"""Events per window of a stream, with late rows kept.

Windows close when the watermark, the latest time of earlier batches less a delay, has passed their end. A row behind that is late: it
is written to a side table, and the closed window gets a correction. So a closed window is reported once, and what is reported plus
the corrections is the count of all rows. The state is one small row per window and batch, in folders a replayed batch overwrites.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.plans.full_load import Warehouse

COUNTS, LATE, MARKS = "throughput_counts", "throughput_late", "throughput_marks"


def _folder(house: Warehouse, table: str, stream: str, batch: int) -> str:
    return f"{house.root}/control/{table}/stream={stream}/batch={batch}"


def watermark(house: Warehouse, stream: str, delay: str, before: int | None = None):
    """Latest time that the batches of a stream have seen (those before a batch number), less the delay."""
    marks = house.control.read(MARKS)
    if marks is None:
        return None
    mine = marks.where(F.col("stream") == stream)
    mine = mine if before is None else mine.where(F.col("batch") < before)
    return mine.agg(F.max("seen") - F.expr(f"INTERVAL {delay}")).first()[0]


def take_batch(house: Warehouse, events: DataFrame, stream: str, batch: int, delay: str, window: str) -> None:
    """Count one batch of events (received_at and others) and keep its late rows."""
    events = events.withColumn("received_at", F.col("received_at").cast("timestamp"))
    mark = watermark(house, stream, delay, batch)
    ends = F.window("received_at", window)["end"]
    late = F.lit(False) if mark is None else F.coalesce(ends <= F.lit(mark), F.lit(False))
    counts = events.groupBy(F.window("received_at", window).alias("w"), late.alias("late")).agg(F.count("*").alias("events"))
    counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "late", "events").write.mode("overwrite").parquet(
        _folder(house, COUNTS, stream, batch)
    )
    events.where(late).write.mode("overwrite").parquet(_folder(house, LATE, stream, batch))
    # Last: until then the batch counts with what earlier ones had seen.
    events.agg(F.max("received_at").alias("seen")).write.mode("overwrite").parquet(_folder(house, MARKS, stream, batch))


def start_throughput(
    house: Warehouse, events: DataFrame, checkpoint: str, delay: str, window: str = "1 minute", every: str | None = None
) -> StreamingQuery:
    """Count a stream: all that is available once, or every interval such as `1 minute`."""
    streams: list[str] = []

    def take(rows: DataFrame, batch: int) -> None:
        if not streams:
            streams.append(json.loads(house.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        take_batch(house, rows, streams[0], batch, delay, window)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take).trigger(**trigger).start()


def windows(house: Warehouse, stream: str, delay: str) -> DataFrame:
    """window_start, events (reported when the window closed, or so far), corrections, total and closed of each window."""
    counts = house.control.read(COUNTS).where(F.col("stream") == stream)
    mark = watermark(house, stream, delay)
    summed = lambda c: F.coalesce(F.sum(F.when(c, F.col("events"))), F.lit(0))
    return counts.groupBy("window_start", "window_end").agg(
        summed(~F.col("late")).alias("events"), summed(F.col("late")).alias("corrections"), F.sum("events").alias("total")
    ).select("window_start", "events", "corrections", "total", (F.coalesce(F.col("window_end") <= F.lit(mark), F.lit(False))).alias("closed"))


def late_rows(house: Warehouse, stream: str) -> DataFrame:
    """Rows behind the watermark of their batch, with the batch's number."""
    return house.control.read(LATE).where(F.col("stream") == stream)
