"""Change messages -> raw log, staged changes, dead letters and offsets, batch by batch.

Each micro-batch writes folders named after its id. Replaying a batch after a failure rewrites the
same folders, and events seen before are left out, so delivery at least once has the effect
of exactly once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators import changes
from tallyhouse.plans.full_load import Warehouse, utc_now
from tallyhouse.sources.lake import BATCH_COLUMN
from tallyhouse.sources.schemas import CAPTURES

LOG_TABLE, LETTER_TABLE, OFFSET_TABLE, PIPELINE_LOG = "raw_events", "dead_letters", "offsets", "pipeline_logs"
POSITION_TABLE, SERVICE = "log_positions", "cdc-consumer"
EMPTY_LOG = (
    "event_id string, capture_instance string, start_lsn string, seqval string, operation_code int, "
    "operation_type string, event_time timestamp, business_key string, payload string, topic string, "
    "partition int, offset long, received_at timestamp, processed_at timestamp, processing_error string, "
    "log_version long"
)


def prepare(house: Warehouse) -> None:
    """Create the empty event log once, before the first batch."""
    if LOG_TABLE not in house.events.tables():
        version = house.events.reserve_version("prepare")
        house.events.write_base(LOG_TABLE, house.spark.createDataFrame([], EMPTY_LOG), version)
        house.events.publish(version, LOG_TABLE)


def _logged(house: Warehouse, events: DataFrame, batch: str) -> DataFrame | None:
    """Log rows that may equal events of this batch: other batches, in the position ranges that the batch touches."""
    if not house.event_ids.exists():
        # A log from before there was this index.
        base, others = house.events.parts(LOG_TABLE)
        house.event_ids.write(base.withColumn(BATCH_COLUMN, F.lit("base")))
        if others is not None:
            house.event_ids.write(others)
    return house.event_ids.near(events, batch)


def apply_batch(house: Warehouse, messages: DataFrame, batch_id: int | str) -> None:
    """Take one batch of messages. Dead letters are written before anything else moves on."""
    batch = f"b{batch_id}"
    house.refresh()
    root = house.root
    parsed = house.aside(f"parsed-{batch}", changes.parse_messages(messages))

    letters = changes.dead_letters(parsed, F.current_timestamp())
    letters.write.mode("overwrite").parquet(f"{root}/control/{LETTER_TABLE}/{BATCH_COLUMN}={batch}")

    events = changes.accepted(parsed)
    new = changes.unseen(events, _logged(house, events, batch)).withColumns(
        {
            "processed_at": F.current_timestamp(),
            "processing_error": F.lit(None).cast("string"),
            "log_version": F.lit(house.events.version_of(batch)).cast("long"),
        }
    )
    logged = house.events.append(LOG_TABLE, new, batch)
    house.event_ids.write(logged, batch)
    for capture in CAPTURES:
        house.staged_changes.write(capture.staged, changes.row_changes(logged, capture), batch)
    # Before the end of the batch: a snapshot begun from here on holds these positions.
    positions = logged.agg(F.max("start_lsn").alias("start_lsn"), F.count("*").alias("events"))
    positions.write.mode("overwrite").parquet(f"{root}/control/{POSITION_TABLE}/{BATCH_COLUMN}={batch}")

    offsets = parsed.groupBy("topic", "partition").agg(F.max("offset").alias("offset"), F.count("*").alias("messages"))
    offsets.withColumn("updated_at", F.current_timestamp()).write.mode("overwrite").parquet(
        f"{root}/control/{OFFSET_TABLE}/{BATCH_COLUMN}={batch}"
    )
    counts = batch_counts(parsed, logged)
    log_rows(counts).write.mode("overwrite").parquet(f"{root}/control/{PIPELINE_LOG}/{BATCH_COLUMN}={batch}")


def batch_counts(parsed: DataFrame, logged: DataFrame) -> DataFrame:
    """Processed, duplicate and refused messages of a batch."""
    seen = parsed.agg(
        F.count_if(F.col("reject_reason").isNull()).alias("accepted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("dead_letters"),
        F.lit(1).alias("_one"),
    )
    new = logged.agg(F.count("*").alias("processed"), F.lit(1).alias("_one"))
    return seen.join(new, "_one").select(
        "processed", (F.col("accepted") - F.col("processed")).alias("duplicates"), "dead_letters"
    )


def log_rows(counts: DataFrame, service: str = SERVICE) -> DataFrame:
    """Pipeline-log entries of a batch: time, service, level, event, message and details as JSON."""
    level = F.when(F.col("dead_letters") > 0, "ERROR").otherwise("INFO")
    return counts.select(
        F.current_timestamp().alias("timestamp"),
        F.lit(service).alias("service"),
        level.alias("level"),
        F.lit("batch_processed").alias("event"),
        F.concat(F.col("processed").cast("string"), F.lit(" change events applied")).alias("message"),
        F.to_json(F.struct(*counts.columns)).alias("details"),
    )


def offset_state(house: Warehouse) -> DataFrame:
    """Highest applied offset of each topic partition."""
    return house.control.read(OFFSET_TABLE).groupBy("topic", "partition").agg(F.max("offset").alias("offset"))


def start_ingest(
    house: Warehouse, messages: DataFrame, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Run the ingest: all available messages once, or every interval such as `1 minute`."""
    prepare(house)
    streams: list[str] = []

    def take(rows: DataFrame, batch_id: int) -> None:
        # Batch numbers begin again with every new checkpoint, so a batch is named by its stream too.
        if not streams:
            metadata = house.spark.read.text(f"{checkpoint}/metadata").first()[0]
            streams.append(json.loads(metadata)["id"])
        apply_batch(house, rows, f"{streams[0]}-{batch_id}")

    writer = messages.writeStream.queryName(SERVICE).option("checkpointLocation", checkpoint).foreachBatch(take)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    house.record_service(SERVICE, "running", {"started": str(utc_now())})
    return writer.trigger(**trigger).start()


def distinct_events(messages: DataFrame, delay: str) -> DataFrame:
    """Accepted events of a stream, each once; copies must arrive within the delay, which bounds the state."""
    events = changes.accepted(changes.parse_messages(messages))
    return events.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(list(changes.EVENT_IDENTITY))


def throughput(events: DataFrame, delay: str, window: str = "1 minute") -> DataFrame:
    """Events per minute of a stream; a minute is emitted once the watermark has passed it."""
    counted = (
        events.withColumn("received_at", F.col("received_at").cast("timestamp"))
        .withWatermark("received_at", delay)
        .groupBy(F.window("received_at", window).alias("w"))
        .agg(F.count("*").alias("events"))
    )
    return counted.select(F.col("w.start").alias("minute"), "events")
