"""Version resolution: the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VERSION_COLUMNS = ("_version", "_loaded_at")


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark puts a group limit below the shuffle, so each task sends at most one row per key
    and a hot key does not gather its whole history in one task.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest version per key by version and load time; plain de-duplication when there is neither."""
    order = [F.desc(c) for c in VERSION_COLUMNS if c in rows.columns]
    return newest(rows, keys, order) if order else rows.dropDuplicates(list(keys))


def live_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest versions that are not tombstones. Deletes are filtered after resolution, never before."""
    return latest_rows(rows, keys).where("is_deleted = 0")


def overlay(base: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base rows replaced by the changed rows of the same key; `changed` holds one row per key.

    The base is only probed with the changed keys, so it is not shuffled while those are few.
    """
    untouched = base.join(changed.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(changed)


def current_lookup(dimension: DataFrame, natural_key: str, surrogate_key: str) -> DataFrame:
    """Natural key -> current surrogate key, typed for joining."""
    rows = latest_rows(dimension, [natural_key])
    if "is_current" in rows.columns:
        rows = rows.where("is_current = 1")
    return rows.select(natural_key, F.col(surrogate_key).cast("long").alias(surrogate_key))


def top_rows(rows: DataFrame, count: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(count)
