"""Change extraction: LSN ranges, ordered change reads and event envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.lsn import lsn_to_text, operation_name
from tallyhouse.sources.schemas import CHANGE_ORDER, LINES_INSTANCE, ORDERS_INSTANCE, CaptureSource

SCHEMA_VERSION = 1
META_COLUMNS = ("start_lsn", "seqval", "operation_code", "update_mask", "event_time")

# What a poll of one captured table does.
SKIP_TO_LATEST, READ, RESET, IDLE = "skip_to_latest", "read", "reset", "idle"


INSTANCES = (ORDERS_INSTANCE, LINES_INSTANCE)
# Before all positions of a log: the mark of a table polled while the log was empty.
BEFORE_LOG = "0x" + "0" * 20


def resolve_ranges(log: DataFrame, marks: DataFrame, start_mode: str = "latest", instances=()) -> DataFrame:
    """Range each captured instance must read: everything after its mark up to the end of the log.

    Captured `instances` (INSTANCES, where all are) without rows in the log have a range like any other,
    so their poll is recorded and their first change is not skipped later.

    `log`: capture_instance, start_lsn. `marks`: capture_instance, last_start_lsn.
    The range is (after_lsn, to_lsn]; `from_start` includes the first position itself, which is
    the case without a mark or with one older than the log's retention.
    """
    known = log.sparkSession.createDataFrame([(name,) for name in instances], "capture_instance string")
    ends = log.groupBy("capture_instance").agg(F.min("start_lsn").alias("first_lsn"), F.max("start_lsn").alias("last_lsn"))
    # The log's end is shared by all instances; there is one row per captured table here.
    newest_lsn = ends.agg(F.max("last_lsn").alias("to_lsn")).select("to_lsn", F.lit(1).alias("_one"))
    mark = F.col("last_start_lsn")
    action = (
        F.when(mark.isNull(), SKIP_TO_LATEST if start_mode == "latest" else READ)
        .when(mark < F.col("first_lsn"), READ)
        .when(mark > F.col("to_lsn"), RESET)
        .when(mark == F.col("to_lsn"), IDLE)
        .otherwise(READ)
    )
    joined = (
        known.join(ends, "capture_instance", "full_outer").join(marks, "capture_instance", "left").withColumn("_one", F.lit(1)).join(newest_lsn, "_one").drop("_one")
    )
    return joined.select(
        "capture_instance",
        action.alias("action"),
        (mark.isNull() | F.coalesce(mark < F.col("first_lsn"), F.lit(False))).alias("from_start"),
        mark.alias("after_lsn"),
        "to_lsn",
    )


def changes_in(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """Change rows of the ranges to read. Order stays in the LSN columns; see `in_log_order`."""
    # One row per captured table, however long the log: broadcasting it keeps the log where it is.
    reading = F.broadcast(ranges.where(F.col("action") == READ))
    later = F.col("from_start") | (F.col("start_lsn") > F.col("after_lsn"))
    return (
        log.join(reading, "capture_instance")
        .where(later & (F.col("start_lsn") <= F.col("to_lsn")))
        .select(*log.columns)
    )


def in_log_order(changes: DataFrame) -> DataFrame:
    return changes.orderBy(*CHANGE_ORDER)


def advance_marks(ranges: DataFrame, marks: DataFrame, published: DataFrame, polled_at: Column) -> DataFrame:
    """Marks after a successful publish: the range end, the last published change and the row count.

    Polls that found nothing are recorded too. Append the result to the offset ledger.
    """
    position = F.struct(*CHANGE_ORDER)
    done = published.groupBy("capture_instance").agg(
        F.count("*").alias("published"),
        F.max_by("seqval", position).alias("published_seqval"),
        F.max_by("event_time", position).alias("published_time"),
    )
    moved = F.col("action").isin(SKIP_TO_LATEST, RESET)
    return (
        ranges.join(marks, "capture_instance", "left")
        .join(done, "capture_instance", "left")
        .select(
            "capture_instance",
            # An empty log has no end; the next poll then reads from its start.
            F.coalesce("to_lsn", "last_start_lsn", F.lit(BEFORE_LOG)).alias("last_start_lsn"),
            F.when(~moved, F.coalesce("published_seqval", "last_seqval")).alias("last_seqval"),
            F.coalesce("published_time", "last_commit_time").alias("last_commit_time"),
            F.lit("running").alias("status"),
            F.coalesce("published", F.lit(0)).cast("long").alias("last_event_count"),
            polled_at.alias("last_polled_at"),
        )
    )


def json_safe(rows: DataFrame, columns) -> list[Column]:
    """Columns as JSON holds them: times in ISO form, decimals as text, bytes as hex."""

    def encode(name: str) -> Column:
        data_type, column = rows.schema[name].dataType, F.col(name)
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            fraction = F.when(F.date_format(column, "SSSSSS") == "000000", "").otherwise(
                F.concat(F.lit("."), F.date_format(column, "SSSSSS"))
            )
            return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss"), fraction).alias(name)
        if isinstance(data_type, (T.DecimalType, T.DateType)):
            return column.cast("string").alias(name)
        if isinstance(data_type, T.BinaryType):
            return lsn_to_text(column).alias(name)
        return column.alias(name)

    return [encode(name) for name in columns]


def build_envelopes(changes: DataFrame, capture: CaptureSource, carried=()) -> DataFrame:
    """Stream records (key, value, headers, and the columns `carried`) of change rows of one captured table.

    `changes` has the meta columns, LSNs as text, and the table's columns under their source
    names. The record key is the order id, so all changes of an order stay in one partition.
    """
    payload = [c for c in changes.columns if c not in META_COLUMNS and c != "capture_instance"]
    identity = F.concat_ws(":", F.lit(capture.instance), *CHANGE_ORDER)
    envelope = F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        identity.alias("event_id"),
        F.lit(capture.instance).alias("capture_instance"),
        F.lit(capture.source_table).alias("source_table"),
        F.col("operation_code"),
        operation_name(F.col("operation_code")).alias("operation_type"),
        *json_safe(changes, ["event_time"]),
        F.struct(*json_safe(changes, capture.key_fields)).alias("business_key"),
        F.struct(*json_safe(changes, payload)).alias("payload"),
        F.struct("start_lsn", "seqval", *json_safe(changes, ["update_mask"])).alias("metadata"),
    )
    return changes.select(
        F.coalesce(F.col(capture.key_fields[0]).cast("string"), identity).alias("key"),
        F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"),
        F.array(
            F.struct(
                F.lit("capture_instance").alias("key"), F.lit(capture.instance).cast("binary").alias("value")
            )
        ).alias("headers"),
        *carried,
    )
