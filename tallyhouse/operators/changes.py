"""Change events: validation, typed decoding, idempotent logging and application to staged tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.lsn import DELETE, INSERT, OPERATION_NAMES, UPDATE_AFTER, UPDATE_BEFORE, operation_name
from tallyhouse.operators.latest import newest
from tallyhouse.sources.schemas import (
    BY_NAME,
    CAPTURES,
    CHANGE_ORDER,
    CaptureSource,
    TableSpec,
)

EVENT_IDENTITY = ("capture_instance", *CHANGE_ORDER)

# Why a message is refused, in the order the reasons are checked.
EMPTY_VALUE = "message value is empty"
INVALID_JSON = "invalid JSON message"
NOT_AN_OBJECT = "message is not a JSON object"
UNSUPPORTED_INSTANCE = "unsupported capture instance"
INVALID_OPERATION = "invalid operation_code"
UNSUPPORTED_OPERATION = "unsupported operation_code"
KEY_NOT_OBJECT = "business_key must be an object"
PAYLOAD_NOT_OBJECT = "payload must be an object"
METADATA_NOT_OBJECT = "metadata must be an object"
NO_START_LSN = "metadata.start_lsn is missing"
NO_SEQVAL = "metadata.seqval is missing"
INVALID_PAYLOAD = "invalid event payload"

# Outline of a message. Values of another type read as NULL, field by field.
ENVELOPE = {
    "capture_instance": "string",
    "operation_code": "int",
    "operation_type": "string",
    "event_time": "string",
    "metadata": "struct<start_lsn:string,seqval:string>",
}

# Parts of a message that are objects, and kept as JSON text.
DOCUMENTS = ("business_key", "payload")

# Payload columns an upsert cannot do without; a delete needs its key columns.
REQUIRED_COLUMNS = {
    "orders": ("order_id",),
    "order_details": ("order_id", "product_id", "unit_price", "quantity", "discount"),
}


def _is_object(json: Column) -> Column:
    """Whether JSON text is an object, told by its first character: text in quotes is a string."""
    return F.coalesce(json.rlike(r"^\s*\{"), F.lit(False))


def _row_type(spec: TableSpec, columns=None, as_text: bool = False) -> str:
    """Struct type of a payload; source times carry no zone, so their wall time is kept as written."""

    def json_type(field: T.StructField) -> str:
        if as_text:
            return "string"
        return "timestamp_ntz" if isinstance(field.dataType, T.TimestampType) else field.dataType.simpleString()

    fields = [f"{spec.source_name(f.name)}:{json_type(f)}" for f in spec.schema if columns is None or f.name in columns]
    return f"struct<{','.join(fields)}>"


def _row(document: Column, spec: TableSpec, columns=None, as_text: bool = False, path: str = "$") -> Column:
    """The document at `path` as a row; fields that are missing or do not convert are NULL."""
    return F.try_variant_get(document, path, _row_type(spec, columns, as_text))


def _incomplete(row: Column, spec: TableSpec, columns) -> Column:
    return reduce(Column.__or__, [row[spec.source_name(c)].isNull() for c in columns])


def _unconverted(row: Column, text: Column, spec: TableSpec) -> Column:
    names = map(spec.source_name, spec.schema.names)
    return reduce(Column.__or__, [row[n].isNull() & text[n].isNotNull() for n in names])


def parse_messages(messages: DataFrame) -> DataFrame:
    """Read stream messages and say why each refused one is refused (`reject_reason` NULL = accepted).

    Input: key, value, topic, partition, offset, received_at.
    """
    text = F.col("value").cast("string")
    position = ("key", "value", "topic", "partition", "offset", "received_at")
    documents = messages.select(*position, F.try_parse_json(F.when(F.is_valid_utf8(text), text)).alias("event"))
    event = F.col("event")
    head = {name: F.try_variant_get(event, f"$.{name}", kind).alias(f"head_{name}") for name, kind in ENVELOPE.items()}
    outline = documents.select(*position, "event", *head.values())
    fields = outline.select(
        *position,
        "event",
        *[F.col(f"head_{name}").alias(name) for name in ("capture_instance", "operation_code", "metadata")],
        F.col("head_operation_type").alias("given_type"),
        F.col("head_event_time").alias("event_time_text"),
        # As text for those who read them; what is judged is read from the event.
        *[F.to_json(F.try_variant_get(event, f"$.{name}", "variant")).alias(name) for name in DOCUMENTS],
        *[F.try_variant_get(event, f"$.{name}", "struct<>").alias(f"{name}_object") for name in DOCUMENTS],
        F.nullif(F.col("head_metadata.start_lsn"), F.lit("")).alias("start_lsn"),
        F.nullif(F.col("head_metadata.seqval"), F.lit("")).alias("seqval"),
    )
    operation = F.col("operation_code")
    typed, bad_payload = {"event_time": F.col("event_time_text").try_cast("timestamp")}, F.lit(False)
    for capture in CAPTURES:
        spec = BY_NAME[capture.staged]
        this = F.col("capture_instance") == capture.instance
        row, key = f"{spec.name}_row", f"{spec.name}_key"
        upsert, delete = this & operation.isin(INSERT, UPDATE_AFTER), this & (operation == DELETE)
        typed[row] = F.when(upsert, _row(event, spec, path="$.payload"))
        typed[f"{row}_text"] = F.when(upsert, _row(event, spec, as_text=True, path="$.payload"))
        typed[key] = F.when(delete, _row(event, spec, spec.keys, path="$.business_key"))
        bad_row = _incomplete(F.col(row), spec, REQUIRED_COLUMNS[spec.name]) | _unconverted(
            F.col(row), F.col(f"{row}_text"), spec
        )
        bad_payload = bad_payload | (upsert & bad_row) | (delete & _incomplete(F.col(key), spec, spec.keys))
    bad_payload = bad_payload | (F.col("event_time").isNull() & F.col("event_time_text").isNotNull())
    known = F.coalesce(F.col("capture_instance").isin(*[c.instance for c in CAPTURES]), F.lit(False))
    reason = (
        F.when(F.col("value").isNull(), EMPTY_VALUE)
        .when(event.isNull(), INVALID_JSON)
        .when(~_is_object(text), NOT_AN_OBJECT)
        .when(~known, UNSUPPORTED_INSTANCE)
        .when(operation.isNull(), INVALID_OPERATION)
        .when(~operation.isin(*OPERATION_NAMES), UNSUPPORTED_OPERATION)
        .when(F.col("business_key_object").isNull(), KEY_NOT_OBJECT)
        .when(F.col("payload_object").isNull(), PAYLOAD_NOT_OBJECT)
        .when(F.col("metadata").isNull(), METADATA_NOT_OBJECT)
        .when(F.col("start_lsn").isNull(), NO_START_LSN)
        .when(F.col("seqval").isNull(), NO_SEQVAL)
        .when(bad_payload, INVALID_PAYLOAD)
    )
    # Laid out through a generator: a filter on the reason then stays above the parsing
    # instead of being copied, with all the parsing in it, below every step. Texts go beside it, as it gives all its columns.
    parsed = F.struct(
        *EVENT_IDENTITY,
        F.coalesce("given_type", operation_name(operation)).alias("operation_type"),
        "event_time",
        reason.alias("reject_reason"),
    )
    rows = fields.withColumns(typed).select(*position, *[F.col(n).alias(f"text_{n}") for n in DOCUMENTS], F.inline(F.array(parsed)))
    texts = [F.col(f"text_{n}").alias(n) for n in DOCUMENTS]
    return rows.select(*position, *EVENT_IDENTITY, "operation_type", "event_time", *texts, "reject_reason")


def accepted(parsed: DataFrame) -> DataFrame:
    """Events for the raw log, identified by instance and LSN triple."""
    return parsed.where("reject_reason IS NULL").select(
        F.concat_ws(":", *EVENT_IDENTITY).alias("event_id"),
        *EVENT_IDENTITY,
        "operation_type",
        "event_time",
        "business_key",
        "payload",
        "topic",
        "partition",
        "offset",
        "received_at",
    )


def dead_letters(parsed: DataFrame, failed_at: Column) -> DataFrame:
    """Refused messages with their stream position, raw text and reason."""
    return parsed.where("reject_reason IS NOT NULL").select(
        failed_at.alias("failed_at"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.make_valid_utf8(F.col("key").cast("string")).alias("key"),
        F.make_valid_utf8(F.col("value").cast("string")).alias("raw_value"),
        F.col("reject_reason").alias("error"),
    )


def dead_letter_json(letters: DataFrame) -> DataFrame:
    """Dead letters as stream records (key, value)."""
    return letters.select("key", F.to_json(F.struct(*letters.columns)).alias("value"))


def unseen(events: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Events not logged before, once each; of copies, the first stream position is kept."""
    first = newest(events, EVENT_IDENTITY, [F.asc("topic"), F.asc("partition"), F.asc("offset")])
    if log is None:
        return first
    return first.join(log.select(*EVENT_IDENTITY), list(EVENT_IDENTITY), "left_anti")


def row_changes(events: DataFrame, capture: CaptureSource) -> DataFrame:
    """Typed row changes of one captured table: staged columns, order columns and `is_deleted`.

    Before-images stay in the log only. A delete carries its key, the other columns are NULL.
    """
    spec = BY_NAME[capture.staged]
    deleted = F.col("operation_code") == DELETE
    rows = events.where(
        (F.col("capture_instance") == capture.instance) & (F.col("operation_code") != UPDATE_BEFORE)
    ).select(
        *CHANGE_ORDER,
        F.when(deleted, _row(F.try_parse_json("business_key"), spec, spec.keys)).alias("key"),
        F.when(~deleted, _row(F.try_parse_json("payload"), spec)).alias("row"),
    )

    def column(field: T.StructField) -> Column:
        name = spec.source_name(field.name)
        value = F.col("row")[name].cast(field.dataType)
        if field.name in spec.trimmed:
            value = F.regexp_replace(value, r"\s+$", "")
        if field.name in spec.keys:
            value = F.coalesce(value, F.col("key")[name])
        return value.alias(field.name)

    return rows.select(*map(column, spec.schema), *CHANGE_ORDER, deleted.cast("short").alias("is_deleted"))


def last_change(changes: DataFrame, keys) -> DataFrame:
    """Last change per key by log position, whatever order the events arrived in."""
    return newest(changes, keys, [F.desc(c) for c in CHANGE_ORDER])


def apply_changes(base: DataFrame, changes: DataFrame, keys, after_lsn: str = "") -> DataFrame:
    """Staged table after the changes: upserts replace rows, deletes remove them.

    Only log positions decide, so applying events in one batch, in many, twice or out of
    order gives the same rows. `after_lsn` is the position the base snapshot already contains.
    """
    final = last_change(changes.where(F.col("start_lsn") > after_lsn), keys)
    kept = base.join(final.select(*keys), list(keys), "left_anti")
    return kept.unionByName(final.where("is_deleted = 0").select(*base.columns))


def event_keys(events: DataFrame) -> DataFrame:
    """Order and product id of each event, from its key and otherwise from its payload."""

    def number(field: str) -> Column:
        path = f"$.{field}"
        return F.coalesce(
            F.get_json_object("business_key", path), F.get_json_object("payload", path)
        ).try_cast("long")

    return events.withColumns({"order_id": number("OrderID"), "product_id": number("ProductID")})


def pending(events: DataFrame, limit: int | None = None, order=CHANGE_ORDER) -> DataFrame:
    """Events the warehouse has not taken yet, oldest first up to `limit`."""
    waiting = events.where("processed_at IS NOT NULL AND processing_error IS NULL AND dw_processed_at IS NULL")
    return waiting if limit is None else waiting.orderBy(*order).limit(limit)


