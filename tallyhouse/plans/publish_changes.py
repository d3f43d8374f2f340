"""Publishing job: change tables -> stream records, poll by poll, with durable marks per captured instance.

A poll first writes down the ranges it will read, then the records, and appends the marks of all instances last, in one file. A
poll that failed anywhere before its marks runs again under its number, with the ranges written down and not with new
ones: a file sink replaces its own folder, so each event is there once; a stream sink may get records twice, with the event ids
by which consumers know them (`changes.unseen`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import envelope
from tallyhouse.operators.latest import newest
from tallyhouse.plans.full_load import Warehouse, utc_now
from tallyhouse.sources.schemas import CAPTURES, CHANGE_ORDER, CaptureSource
from tallyhouse.streaming.sources import write_kafka

SERVICE = "cdc-producer"
MARKS = "publish_marks"
MARK_SCHEMA = "capture_instance string, last_start_lsn string, last_seqval string, last_commit_time timestamp"
Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Poll:
    number: int
    published: int


class FileSink:
    """Records as Parquet, one folder a poll."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, records: DataFrame, poll: int) -> None:
        records.write.mode("overwrite").parquet(f"{self.folder}/poll={poll}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.folder)


def kafka_sink(servers: str) -> Sink:
    """Records to the topic of each captured table."""

    def send(records: DataFrame, poll: int) -> None:
        for capture in CAPTURES:
            write_kafka(records.where(F.col("topic") == capture.topic).drop("topic"), servers, capture.topic)

    return send


def current_marks(house: Warehouse) -> DataFrame:
    """Last mark of each instance."""
    marks = house.control.read(MARKS)
    if marks is None:
        return house.spark.createDataFrame([], MARK_SCHEMA)
    return newest(marks, ["capture_instance"], [F.desc("poll")]).select("capture_instance", "last_start_lsn", "last_seqval", "last_commit_time")


def _next_poll(house: Warehouse) -> int:
    marks = house.control.read(MARKS)
    return 1 + (marks.agg(F.max("poll")).first()[0] if marks is not None else 0)


def _ranges(house: Warehouse, number: int, log: DataFrame, start_mode: str) -> DataFrame:
    """The ranges of a poll, as it wrote them down when it first ran."""
    folder = f"publish_ranges/poll={number}"
    if house.control.read(folder) is None:
        found = envelope.resolve_ranges(log, current_marks(house), start_mode, envelope.INSTANCES)
        found.coalesce(1).write.mode("overwrite").parquet(f"{house.root}/control/{folder}")
    return house.control.read(folder)


def _records(rows: DataFrame, capture: CaptureSource) -> DataFrame:
    position = ["capture_instance", *CHANGE_ORDER, "event_time"]
    return envelope.build_envelopes(rows, capture, position).withColumn("topic", F.lit(capture.topic))


def _poll(house: Warehouse, tables: Callable[[str], DataFrame], sink: Sink, start_mode: str) -> Poll:
    number = _next_poll(house)
    logs = {c: tables(c.instance).withColumn("capture_instance", F.lit(c.instance)) for c in CAPTURES}
    log = reduce(DataFrame.unionByName, [rows.select("capture_instance", "start_lsn") for rows in logs.values()])
    ranges = _ranges(house, number, log, start_mode)
    records = reduce(DataFrame.unionByName, [_records(envelope.changes_in(rows, ranges), c) for c, rows in logs.items()])
    # Written aside: the change tables are read once, for the sink and for the marks.
    records = house.aside(f"publish-{number}", records)
    marks = envelope.advance_marks(ranges, current_marks(house), records, F.lit(utc_now()).cast("timestamp"))
    published = records.count()
    if published:
        sink(records.select("key", "value", "headers", "topic"), number)
    house.control.append(MARKS, marks.withColumn("poll", F.lit(number)).coalesce(1))
    return Poll(number, published)


def publish_changes(house: Warehouse, tables: Callable[[str], DataFrame], sink: Sink, start_mode: str = "latest") -> Poll:
    """One poll of all captured tables. `tables(instance)` has the meta columns, LSNs as text, and the table's columns under their
    source names."""
    try:
        poll = _poll(house, tables, sink, start_mode)
    except Exception as error:
        house.record_service(SERVICE, "error", {}, f"{type(error).__name__}: {error}")
        raise
    house.record_service(SERVICE, "running" if poll.published else "idle", {"poll": poll.number, "published": poll.published})
    return poll
