"""Incremental load: pending change events -> new fact versions -> event states.

With `isolate`, each event of a batch is judged on its own in one pass: those that cannot be applied go to the dead letters of the
warehouse, with the reason, and the rest go on. A dead event holds up neither the batch nor the mark; `redrive` makes
dead events pending again, once their cause is gone.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import incremental as step
from tallyhouse.operators import quality
from tallyhouse.operators.changes import EVENT_IDENTITY, event_keys, pending
from tallyhouse.operators.dimensions import PRODUCT, Load
from tallyhouse.operators.facts import Lookups
from tallyhouse.plans import history as kept
from tallyhouse.plans.full_load import Warehouse, utc_now
from tallyhouse.sources.lake import BATCH_COLUMN
from tallyhouse.sources.schemas import CHANGE_ORDER

SERVICE = "incremental-transform"
STATES, LETTERS = "event_states", "event_dead_letters"
MARK_SCHEMA = "log_version long, set_at long"
NO_ORDER_ID, UNKNOWN_PRODUCT, TRIED_OFTEN = "no valid order id", "unknown product in the order", "too many attempts"


@dataclass(frozen=True)
class Outcome:
    batch_id: str
    events_read: int
    rows_written: int
    events_dead: int = 0


def event_states(events: DataFrame, batch_id: str, error: str | None = None) -> DataFrame:
    """One appended row per event of a batch: done, or the error it failed with."""
    return _states(events, batch_id, F.lit(error).cast("string"), F.lit(False))


def _states(events: DataFrame, batch_id: str, error: Column, dead: Column) -> DataFrame:
    return events.select(
        *EVENT_IDENTITY,
        *[c for c in ("log_version",) if c in events.columns],
        F.lit(batch_id).alias("dw_batch_id"),
        F.when(error.isNull() & ~dead, F.current_timestamp()).alias("dw_processed_at"),
        error.alias("dw_processing_error"),
        dead.alias("dw_dead"),
        F.current_timestamp().alias("dw_recorded_at"),
    )


def outcome_states(judged: DataFrame, batch_id: str) -> DataFrame:
    """States of judged events (`dead_reason`, NULL for good ones): done, or dead with the reason."""
    return _states(judged, batch_id, F.col("dead_reason"), F.col("dead_reason").isNotNull())


def judged_events(events: DataFrame, orders: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Events with `order_id`, `product_id` and why each cannot be applied (`dead_reason`, NULL if it can).

    An order one of whose staged lines (`orders`, `lines`) names a product outside `products` (product_id) cannot be rebuilt
    whole, so all its events wait in the dead letters; events of other orders go on.
    """
    keyed = event_keys(events)
    touched = lines.join(step.affected_orders(keyed), "order_id", "left_semi").join(orders.select("order_id"), "order_id", "left_semi")
    broken = touched.join(products.select("product_id"), "product_id", "left_anti").select("order_id").distinct().withColumn("_broken", F.lit(True))
    reason = F.when(F.col("order_id").isNull(), NO_ORDER_ID).when(F.col("_broken"), UNKNOWN_PRODUCT)
    return keyed.join(broken, "order_id", "left").withColumn("dead_reason", reason).select(*keyed.columns, "dead_reason")


def with_states(events: DataFrame, states: DataFrame | None) -> DataFrame:
    """Events with their warehouse state: done once any batch took them, else the last error."""
    if states is None:
        return events.withColumns(
            {
                "dw_processed_at": F.lit(None).cast("timestamp"),
                "dw_batch_id": F.lit(None).cast("string"),
                "dw_processing_error": F.lit(None).cast("string"),
                "dw_attempt_count": F.lit(0).cast("long"),
                "dw_dead": F.lit(False),
            }
        )
    done = F.col("dw_processed_at").isNotNull()
    summary = states.groupBy(*EVENT_IDENTITY).agg(
        F.max("dw_processed_at").alias("dw_processed_at"),
        F.max_by("dw_batch_id", F.struct(done, F.col("dw_processed_at"), F.col("dw_batch_id"))).alias("dw_batch_id"),
        F.when(~F.bool_or(done), F.max_by("dw_processing_error", F.struct("dw_recorded_at", "dw_processing_error"))).alias(
            "dw_processing_error"
        ),
        F.count("dw_batch_id").alias("dw_attempt_count"),
        # The last word counts: a dead event can be made pending again.
        F.max_by("dw_dead", F.struct("dw_recorded_at", "dw_dead")).alias("dw_dead"),
    )
    return events.join(summary, list(EVENT_IDENTITY), "left").withColumns(
        {"dw_attempt_count": F.coalesce("dw_attempt_count", F.lit(0)), "dw_dead": F.coalesce("dw_dead", F.lit(False))}
    )


def event_log(house: Warehouse, since: int = 0) -> DataFrame:
    """Logged events with their warehouse state, from a log version on.

    Versions grow with every logged batch, and the ledger names the batch of each, so the folders of settled batches are
    not opened; the filter prunes the rest.
    """
    base, others = house.events.parts("raw_events")
    if others is not None:
        ledger = house.events.ledger.read("batches").groupBy("batch_id").agg(F.min("version").alias("version"))
        recent = [r.batch_id for r in ledger.where(F.col("version") >= since).collect()]
        base = base.unionByName(others.where(F.col(BATCH_COLUMN).isin(recent)).drop(BATCH_COLUMN))
    events = base.where(F.col("log_version") >= since)
    states = house.control.read(STATES)
    return with_states(events, None if states is None else states.where(F.col("log_version") >= since))


def settled_before(house: Warehouse) -> int:
    """Log version before which the warehouse has taken every event, or set it aside."""
    marks = house.control.read("event_marks")
    return 0 if marks is None else marks.agg(F.max_by("log_version", "set_at")).first()[0]


def _advance_mark(house: Warehouse, since: int) -> None:
    """Move the mark to the first version with events left, or past all logged ones."""
    open_ = F.col("dw_processed_at").isNull() & F.col("processing_error").isNull() & ~F.col("dw_dead")
    left = F.min(F.when(open_, F.col("log_version")))
    first_left, last = event_log(house, since).agg(left, F.max("log_version")).first()
    mark = first_left if first_left is not None else last + 1
    if mark > since:
        house.control.add("event_marks", MARK_SCHEMA, (mark, time.time_ns()))


def set_aside(house: Warehouse, judged: DataFrame, batch_id: str) -> None:
    """Dead letters of a batch, with the reason; a batch that runs again replaces its own."""
    bad = judged.where("dead_reason IS NOT NULL").select(
        F.current_timestamp().alias("failed_at"), *EVENT_IDENTITY, "log_version", "business_key", "payload", F.col("dead_reason").alias("error")
    )
    bad.write.mode("overwrite").parquet(f"{house.root}/control/{LETTERS}/dead_batch={batch_id}")


def redrive(house: Warehouse, error: str | None = None) -> int:
    """Make dead events pending again, all or those with one reason. The mark goes back to the oldest of them."""
    dead = event_log(house).where("dw_dead AND dw_processed_at IS NULL")
    dead = house.aside(f"redrive-{uuid.uuid4()}", dead if error is None else dead.where(F.col("dw_processing_error") == error))
    count, first = dead.agg(F.count("*"), F.min("log_version")).first()
    if count:
        states = _states(dead, "", F.lit("made pending again"), F.lit(False)).withColumn("dw_batch_id", F.lit(None).cast("string"))
        house.control.append(STATES, states)
        house.control.add("event_marks", MARK_SCHEMA, (first, time.time_ns()))
    return count


def _record(house: Warehouse, states: DataFrame, batch_id: str, expected: int) -> None:
    """Append the states of a batch, if there is one for each event that was read."""
    states = house.aside(f"{batch_id}-states", states)
    marked = states.count()
    if marked != expected:
        raise quality.QualityError(f"{marked} event states for {expected} events read")
    house.control.append(STATES, states)


def run_incremental(
    house: Warehouse, batch_size: int | None = None, max_attempts: int | None = None, isolate: bool = False
) -> Outcome:
    """Take pending events into the fact table: all of them, or the `batch_size` oldest.

    The batch is written down first, so every later step, and a retry after lost executors, reads
    the same events. Without `isolate` a failed batch stays pending with its error; with `max_attempts` events that failed
    that often are dead, too.
    """
    batch_id = str(uuid.uuid4())
    house.refresh()
    since = settled_before(house)
    waiting = event_log(house, since).where(~F.col("dw_dead"))
    tired = 0
    if max_attempts is not None:
        often = pending(waiting.where(F.col("dw_attempt_count") >= max_attempts))
        often = house.aside(f"{batch_id}-tired", often.withColumn("dead_reason", F.lit(TRIED_OFTEN)))
        tired = often.count()
        if tired:
            set_aside(house, often, f"{batch_id}-tired")
            _record(house, outcome_states(often, batch_id), f"{batch_id}-tired", tired)
            _advance_mark(house, since)
        waiting = waiting.where(F.col("dw_attempt_count") < max_attempts)
    events = house.aside(batch_id, pending(waiting, batch_size))
    return take_events(house, events, batch_id, isolate, tired, lambda: _advance_mark(house, since))


def take_events(
    house: Warehouse, events: DataFrame, batch_id: str, isolate: bool = False, tired: int = 0, settled: Callable[[], None] | None = None
) -> Outcome:
    """Take one batch, written down already, into the facts and record a state for each of its events; then call `settled`.

    A batch that runs again under its id replaces the rows it wrote.
    """
    span = events.agg(
        F.count("*").alias("events"), F.min("start_lsn").alias("first_lsn"), F.max("start_lsn").alias("last_lsn")
    ).first()
    details = {"batch_id": batch_id, "events_read": span.events, "rows_written": 0, "events_dead": tired}
    if not span.events:
        house.record_service(SERVICE, "idle", details)
        return Outcome(batch_id, 0, 0, tired)
    details.update(first_lsn=span.first_lsn, last_lsn=span.last_lsn)
    house.record_service(SERVICE, "running", details)
    try:
        good, dead = events, 0
        states = event_states(events, batch_id)
        if isolate:
            products = Lookups.current(house.latest).product.withColumnRenamed(PRODUCT.natural, "product_id")
            judged = house.aside(f"{batch_id}-judged", judged_events(events, house.staged("orders"), house.staged("order_details"), products))
            good, dead = judged.where("dead_reason IS NULL").select(*events.columns), judged.where("dead_reason IS NOT NULL").count()
            states = outcome_states(judged, batch_id)
            set_aside(house, judged, batch_id)
        rows = _apply(house, good, batch_id) if dead < span.events else 0
        _record(house, states, batch_id, span.events)
    except Exception as error:
        message = f"{type(error).__name__}: {error}"
        house.control.append(STATES, event_states(events, batch_id, message))
        house.record_service(SERVICE, "failed", details, message)
        raise
    if settled:
        settled()
    house.record_service(SERVICE, "success", {**details, "rows_written": rows, "events_dead": tired + dead})
    return Outcome(batch_id, span.events, rows, tired + dead)


def _apply(house: Warehouse, events: DataFrame, batch_id: str) -> int:
    """Write the rebuilt rows aside, check them, resolve them against tombstones and append the winners.

    Each step reads what the one before wrote, so nothing expensive is planned or run twice.
    """
    events = event_keys(events)
    bad = quality.invalid_keys(events).first()[0]
    if bad:
        raise quality.QualityError(f"{bad} change events without a valid order id")
    lake = house.star_lake
    load = Load(batch_id, utc_now(), lake.reserve_version(batch_id))
    lookups = Lookups.current(house.latest)
    orders, lines, facts = (
        step.of_touched(rows, events)
        for rows in (house.staged("orders"), house.staged("order_details"), house.star.facts)
    )
    upserts = house.aside(f"{batch_id}-upserts", step.rebuilt_facts(events, orders, lines, lookups))
    house.gate(batch_id, "fact lookups", quality.lookup_loss(orders, lines, upserts))
    columns = [c for c in upserts.columns if c not in CHANGE_ORDER]
    tombstones = step.batch_tombstones(events, lookups, facts, columns)
    # Aside first: the append must not read facts and add to them in one plan.
    output = house.aside(f"{batch_id}-facts", load.stamp(step.winning_rows(upserts, *tombstones)))
    rows = output.count()
    if kept.is_kept(lake):
        # Before the facts: those who read facts find the versions of their orders.
        for name, found in kept.versions(lake, orders, lines).items():
            lake.append(name, load.stamp(found), batch_id)
    if rows:
        lake.append("fact_orders", output, batch_id)
    return rows
