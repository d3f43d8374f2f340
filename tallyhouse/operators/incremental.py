"""Incremental facts: new versions for the orders a batch of change events touched."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.lsn import DELETE
from tallyhouse.operators.changes import event_keys
from tallyhouse.operators.dimensions import PRODUCT
from tallyhouse.operators.facts import FACT_KEYS, Lookups, order_facts
from tallyhouse.operators.latest import newest
from tallyhouse.sources.schemas import CHANGE_ORDER, LINES_INSTANCE, ORDERS_INSTANCE


def newest_first():
    return [F.desc(c) for c in CHANGE_ORDER]


@dataclass(frozen=True)
class FactBatch:
    """Row sets of one incremental batch. `output` holds one winner per fact key, unstamped."""

    events: DataFrame
    upserts: DataFrame
    line_tombstones: DataFrame
    order_tombstones: DataFrame
    output: DataFrame


def affected_orders(events: DataFrame) -> DataFrame:
    return events.select("order_id").distinct()


def latest_event_per_order(events: DataFrame) -> DataFrame:
    return newest(events, ["order_id"], newest_first()).select("order_id", *CHANGE_ORDER)


def deleted_lines(events: DataFrame, lookups: Lookups) -> DataFrame:
    """Last delete of each (order, product), under the product's current key."""
    deletes = events.where(
        (F.col("capture_instance") == LINES_INSTANCE)
        & (F.col("operation_code") == DELETE)
        & F.col("product_id").isNotNull()
    )
    last = newest(deletes, ["order_id", "product_id"], newest_first())
    products = lookups.product.withColumnRenamed(PRODUCT.natural, "product_id")
    return last.join(products, "product_id").select(*FACT_KEYS, *CHANGE_ORDER)


def deleted_orders(events: DataFrame) -> DataFrame:
    deletes = events.where((F.col("capture_instance") == ORDERS_INSTANCE) & (F.col("operation_code") == DELETE))
    return newest(deletes, ["order_id"], newest_first()).select("order_id", *CHANGE_ORDER)


def _tombstones(facts: DataFrame, deletes: DataFrame, keys) -> DataFrame:
    """Live facts marked deleted, with the log position of the delete."""
    return facts.join(deletes, list(keys)).withColumns(
        {"is_deleted": F.lit(1).cast("short"), "source_lsn": F.col("start_lsn")}
    )


def of_touched(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Rows of the orders a batch touched. Spark chooses the join by the measured size of the ids."""
    return rows.join(affected_orders(events), "order_id", "left_semi")


def rebuilt_facts(
    events: DataFrame, orders: DataFrame, details: DataFrame, lookups: Lookups, key_method: str = "xxhash64"
) -> DataFrame:
    """Facts of touched orders out of current staging, with the position of the order's last event."""
    facts = order_facts(orders, details, lookups, key_method)
    return facts.join(latest_event_per_order(events), "order_id").withColumn("source_lsn", F.col("start_lsn"))


def winning_rows(*candidates: DataFrame) -> DataFrame:
    """One row per fact key: the newest event, and of one event current staging before its tombstone."""
    rows = reduce(DataFrame.unionByName, candidates)
    return newest(rows, FACT_KEYS, [*newest_first(), F.asc("is_deleted")]).drop(*CHANGE_ORDER)


def batch_tombstones(events: DataFrame, lookups: Lookups, live_facts: DataFrame, columns) -> tuple[DataFrame, DataFrame]:
    """Tombstones of the batch's line deletes and of its order deletes, over live facts of touched orders."""
    facts = live_facts.select(*columns)
    by_line = _tombstones(facts, deleted_lines(events, lookups), FACT_KEYS)
    return by_line, _tombstones(facts, deleted_orders(events), ["order_id"])


def incremental_facts(
    events: DataFrame,
    orders: DataFrame,
    details: DataFrame,
    lookups: Lookups,
    live_facts: DataFrame,
    key_method: str = "xxhash64",
) -> FactBatch:
    """Fact rows to append for a batch of events.

    `orders` and `details` are current staging, `live_facts` the live warehouse rows.
    """
    events = event_keys(events)
    orders, details, live_facts = (of_touched(rows, events) for rows in (orders, details, live_facts))
    upserts = rebuilt_facts(events, orders, details, lookups, key_method)
    columns = [c for c in upserts.columns if c not in CHANGE_ORDER]
    tombstones = batch_tombstones(events, lookups, live_facts, columns)
    return FactBatch(events, upserts, *tombstones, winning_rows(upserts, *tombstones))
