"""Access to the star schema for reports: live facts and current dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tallyhouse.operators.dimensions import DATE_TABLE, DIMENSIONS, GEOGRAPHY_TABLE
from tallyhouse.operators.facts import BRIDGE_KEYS, FACT_KEYS

TABLE_KEYS = {
    DATE_TABLE: ("date_key",),
    GEOGRAPHY_TABLE: ("geography_key",),
    **{d.table: (d.surrogate,) for d in DIMENSIONS.values()},
    "fact_employee_territories": BRIDGE_KEYS,
    "fact_orders": FACT_KEYS,
}


class Star:
    """Star schema over any `latest(table)` reader: newest row per key, tombstones included."""

    def __init__(self, latest: Callable[[str], DataFrame]):
        self.latest = latest

    @property
    def facts(self) -> DataFrame:
        return self.latest("fact_orders").where("is_deleted = 0")

    @property
    def bridge(self) -> DataFrame:
        return self.latest("fact_employee_territories").where("is_deleted = 0")

    def current(self, table: str) -> DataFrame:
        return self.latest(table).where("is_current = 1")

    @property
    def customers(self) -> DataFrame:
        return self.current("dim_customer")

    @property
    def employees(self) -> DataFrame:
        return self.current("dim_employee")

    @property
    def suppliers(self) -> DataFrame:
        return self.current("dim_supplier")

    @property
    def products(self) -> DataFrame:
        return self.current("dim_product")

    @property
    def territories(self) -> DataFrame:
        return self.current("dim_territory")

    @property
    def shippers(self) -> DataFrame:
        return self.latest("dim_shipper")

    @property
    def places(self) -> DataFrame:
        return self.latest("dim_geography")

    @property
    def dates(self) -> DataFrame:
        return self.latest("dim_date")
