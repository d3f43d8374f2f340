"""Fact tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import clean_text, date_key, geography_key, or_zero
from tallyhouse.operators.dimensions import CUSTOMER, EMPLOYEE, PRODUCT, SHIPPER, TERRITORY, Dimension, Load
from tallyhouse.operators.latest import current_lookup

FACT_KEYS = ("order_id", "product_key")
BRIDGE_KEYS = ("employee_key", "territory_key")
_SHIP_PLACE = ("ship_country", "ship_region", "ship_city", "ship_postal_code", "ship_address")
_DATES = ("order_date", "required_date", "shipped_date")


@dataclass(frozen=True)
class Lookups:
    """Current natural -> surrogate keys of the dimensions facts refer to."""

    product: DataFrame
    customer: DataFrame
    employee: DataFrame
    shipper: DataFrame

    DIMENSIONS: ClassVar = (PRODUCT, CUSTOMER, EMPLOYEE, SHIPPER)

    @classmethod
    def current(cls, read: Callable[[str], DataFrame]) -> Lookups:
        """Out of stored dimensions, which may hold several versions of a member."""
        return cls(*[current_lookup(read(d.table), d.natural, d.surrogate) for d in cls.DIMENSIONS])

    @classmethod
    def fresh(cls, build: Callable[[str], DataFrame]) -> Lookups:
        """Out of dimensions just built from a snapshot: one row per member."""
        return cls(*[build(d.table).select(d.natural, d.surrogate) for d in cls.DIMENSIONS])


def resolve(rows: DataFrame, column: str, lookup: DataFrame, dimension: Dimension, required: bool = False) -> DataFrame:
    """Replace a natural key by the surrogate key.

    A required lookup drops rows without a match, which a count check must notice; an optional
    one gives key 0. Spark broadcasts the lookup only while its measured size is under the
    session's threshold, and otherwise splits hot keys of the sort-merge join.
    """
    keys = lookup.select(
        F.col(dimension.natural).alias("_natural"), F.col(dimension.surrogate).alias("_surrogate")
    )
    typed = F.col(column).cast(keys.schema["_natural"].dataType)
    joined = rows.join(keys, typed == F.col("_natural"), "inner" if required else "left")
    return joined.withColumn(dimension.surrogate, or_zero(F.col("_surrogate"), "long")).drop("_natural", "_surrogate")


def order_headers(orders: DataFrame, lookups: Lookups, key_method: str) -> DataFrame:
    """Header part of the fact: keys are looked up once per order, before lines multiply the rows. Addresses become a key
    before the lookups, which may shuffle the rows; date keys are made of the dates after the last shuffle."""
    rows = orders.select(
        F.col("order_id").cast("long").alias("order_id"),
        geography_key(*map(F.col, _SHIP_PLACE), method=key_method).alias("geography_key"),
        "customer_id",
        "employee_id",
        "ship_via",
        or_zero(F.col("freight"), "decimal(19,4)").alias("freight"),
        clean_text(F.col("ship_name")).alias("ship_name"),
        *[F.col(c).cast("timestamp").alias(c) for c in _DATES],
    )
    rows = resolve(rows, "customer_id", lookups.customer, CUSTOMER)
    rows = resolve(rows, "employee_id", lookups.employee, EMPLOYEE)
    rows = resolve(rows, "ship_via", lookups.shipper, SHIPPER)
    return rows.select("order_id", "geography_key", "customer_key", "employee_key", "shipper_key", "freight", "ship_name", *_DATES)


def order_lines(details: DataFrame, lookups: Lookups) -> DataFrame:
    return resolve(details, "product_id", lookups.product, PRODUCT, required=True).select(
        F.col("order_id").cast("long").alias("order_id"),
        "product_key",
        or_zero(F.col("unit_price"), "decimal(19,4)").alias("unit_price"),
        or_zero(F.col("quantity"), "long").alias("quantity"),
        or_zero(F.col("discount"), "decimal(9,6)").alias("discount"),
    )


def order_facts(
    orders: DataFrame,
    details: DataFrame,
    lookups: Lookups,
    key_method: str = "xxhash64",
    source_lsn: Column | None = None,
) -> DataFrame:
    """One live row per order line, without load stamps."""
    headers = order_headers(orders, lookups, key_method)
    lines = order_lines(details, lookups)
    return headers.join(lines, "order_id").select(
        "order_id", "geography_key", "customer_key", "employee_key", "shipper_key",
        *[date_key(F.col(c)).alias(f"{c}_key") for c in _DATES],
        "freight", "ship_name", *_DATES,
        "product_key", "unit_price", "quantity", "discount",
        F.lit(0).cast("short").alias("is_deleted"),
        (F.lit("") if source_lsn is None else source_lsn).alias("source_lsn"),
    )


def employee_territory_facts(bridge: DataFrame, employee_dim: DataFrame, territory_dim: DataFrame) -> DataFrame:
    """Bridge of employees and territories; pairs without both dimension rows are dropped."""
    rows = resolve(bridge, "employee_id", employee_dim, EMPLOYEE, required=True)
    rows = resolve(rows, "territory_id", territory_dim, TERRITORY, required=True)
    return rows.select(
        *BRIDGE_KEYS, F.lit(0).cast("short").alias("is_deleted"), F.lit("").alias("source_lsn")
    )


def full_order_facts(orders: DataFrame, details: DataFrame, lookups: Lookups, load: Load) -> DataFrame:
    return load.stamp(order_facts(orders, details, lookups, load.key_method))
