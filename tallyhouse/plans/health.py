"""Reports on the change stream and the control tables. Time ranges filter `received_at`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import elapsed_ms, elapsed_seconds, in_range, minute_of
from tallyhouse.operators.changes import pending
from tallyhouse.operators.latest import newest, top_rows


def _within(events: DataFrame, start, end) -> DataFrame:
    return events.where(in_range(F.col("received_at"), start, end))


def _count(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count("*").alias(name))


def _average_or_zero(value: Column) -> Column:
    return F.coalesce(F.round(F.avg(value), 2), F.lit(0.0))


def events_in_range(events: DataFrame, start=None, end=None) -> DataFrame:
    return _count(_within(events, start, end), "events")


def pending_consumer(events: DataFrame) -> DataFrame:
    return _count(events.where("processed_at IS NULL"), "pending_consumer")


def pending_warehouse(events: DataFrame) -> DataFrame:
    return _count(pending(events), "pending_warehouse")


def processing_errors(events: DataFrame) -> DataFrame:
    return _count(events.where("processing_error IS NOT NULL OR dw_processing_error IS NOT NULL"), "errors")


def consumer_latency(events: DataFrame, start=None, end=None) -> DataFrame:
    done = _within(events, start, end).where("processed_at IS NOT NULL")
    latency = elapsed_ms(F.col("received_at"), F.col("processed_at"))
    return done.agg(_average_or_zero(latency).alias("consumer_latency_ms"))


def warehouse_latency(events: DataFrame, start=None, end=None) -> DataFrame:
    done = _within(events, start, end).where("processed_at IS NOT NULL AND dw_processed_at IS NOT NULL")
    latency = elapsed_seconds(F.col("processed_at"), F.col("dw_processed_at"))
    return done.agg(_average_or_zero(latency).alias("dw_latency_seconds"))


def throughput_per_minute(events: DataFrame, start=None, end=None) -> DataFrame:
    minutes = _within(events, start, end).groupBy(minute_of(F.col("received_at")).alias("minute"))
    return minutes.agg(F.count("*").alias("events")).orderBy("minute")


def events_by_operation(events: DataFrame, start=None, end=None) -> DataFrame:
    rows = _within(events, start, end).groupBy(F.col("operation_type").alias("operation"))
    return rows.agg(F.count("*").alias("events")).orderBy(F.desc("events"), "operation")


def events_by_instance(events: DataFrame, start=None, end=None) -> DataFrame:
    rows = _within(events, start, end).groupBy(F.col("capture_instance").alias("instance"))
    return rows.agg(F.count("*").alias("events")).orderBy(F.desc("events"), "instance")


def service_state(history: DataFrame) -> DataFrame:
    """Last state of each service out of its append-only history."""
    state = newest(history, ["service_name"], [F.desc("sequence")])
    return state.select("service_name", "status", "last_heartbeat", "last_error", "updated_at").orderBy("service_name")


def recent_runs(runs: DataFrame, count: int = 25) -> DataFrame:
    return top_rows(runs, count, F.desc("started_at"), F.desc("run_id"))


def latest_events(events: DataFrame, count: int = 50, start=None, end=None) -> DataFrame:
    rows = _within(events, start, end).select(
        "event_id", "capture_instance", "operation_type", "business_key", "received_at", "processed_at",
        "dw_processed_at", F.coalesce("processing_error", "dw_processing_error").alias("error"),
    )
    return top_rows(rows, count, F.desc("event_id"))


def latest_quality_results(results: DataFrame, count: int = 30) -> DataFrame:
    return top_rows(results, count, F.desc("checked_at"), F.desc("result_id"))
