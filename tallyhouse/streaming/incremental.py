"""Incremental facts driven by the event log as a stream: its checkpoint, not a mark, tells what was taken.

The stream reads the position files that the ingest writes last of all for a batch, so a log batch is taken once its staged changes are
there, too. Each micro-batch opens the folders of the log batches it names and runs the same step as `run_incremental`. A micro-batch
that failed runs again under its name, and events with a final state are left out, so an ingest batch that was run again, or one
that `run_incremental` took, changes nothing. Dead events that `redrive` made pending again are taken by `run_incremental`.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.changes import EVENT_IDENTITY, pending
from tallyhouse.plans.full_load import Warehouse
from tallyhouse.plans.incremental_load import SERVICE, STATES, Outcome, take_events, with_states
from tallyhouse.sources.lake import BATCH_COLUMN
from tallyhouse.streaming.ingest import LOG_TABLE, POSITION_TABLE, prepare

POSITION_SCHEMA = f"start_lsn string, events long, {BATCH_COLUMN} string"


def logged_batches(house: Warehouse, per_trigger: int = 100) -> DataFrame:
    """A stream of the log batches whose staged changes are written: name, number of events and last position."""
    folder = f"{house.root}/control/{POSITION_TABLE}"
    path = house.spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(house.spark._jsc.hadoopConfiguration()).mkdirs(path)
    return house.spark.readStream.schema(POSITION_SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def take_batch(house: Warehouse, batches: DataFrame, batch_id: str, isolate: bool = False) -> Outcome:
    """Take the open events of these log batches (`apply_batch`) into the facts."""
    house.refresh()
    # At most `per_trigger` names.
    names = [r[0] for r in batches.where("events > 0").select(BATCH_COLUMN).distinct().collect()]
    base, logged = house.events.parts(LOG_TABLE)
    events = base.limit(0) if logged is None or not names else logged.where(F.col(BATCH_COLUMN).isin(names)).drop(BATCH_COLUMN)
    events = house.aside(f"{batch_id}-logged", events.dropDuplicates(list(EVENT_IDENTITY)))
    first, last = events.agg(F.min("log_version"), F.max("log_version")).first()
    states = house.control.read(STATES)
    known = with_states(events, None if states is None or first is None else states.where(F.col("log_version").between(first, last)))
    return take_events(house, house.aside(batch_id, pending(known.where(~F.col("dw_dead")))), batch_id, isolate)


def start_incremental(
    house: Warehouse, checkpoint: str, every: str | None = None, isolate: bool = False, per_trigger: int = 100
) -> StreamingQuery:
    """Take all logged events once, or every interval such as `1 minute`; at most `per_trigger` log batches at a time."""
    prepare(house)
    streams: list[str] = []

    def take(rows: DataFrame, number: int) -> None:
        if not streams:
            metadata = house.spark.read.text(f"{checkpoint}/metadata").first()[0]
            streams.append(json.loads(metadata)["id"])
        take_batch(house, rows, f"{streams[0]}-{number}", isolate)

    writer = logged_batches(house, per_trigger).writeStream.queryName(SERVICE).option("checkpointLocation", checkpoint).foreachBatch(take)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
