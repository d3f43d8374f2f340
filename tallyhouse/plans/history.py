"""History in the load: versions of dimension members, and the version each order met.

Facts refer to the current row of a member, as reports count members by it. Beside them, `order_versions` and `line_versions` hold
the key of the version that was valid at the order's date. The tables are published together with the star; incremental
batches add the versions of the orders they touch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import or_zero
from tallyhouse.operators.dimensions import CUSTOMER, EMPLOYEE, PRODUCT, Dimension
from tallyhouse.operators.scd2 import scd2_merge, versions_at
from tallyhouse.sources.lake import Lake

KEPT = (CUSTOMER, EMPLOYEE, PRODUCT)
ORDER_VERSIONS, LINE_VERSIONS = "order_versions", "line_versions"


def history_table(dimension: Dimension) -> str:
    return f"{dimension.table}_history"


def version_key(dimension: Dimension) -> str:
    return dimension.surrogate.replace("_key", "_version_key")


HISTORY_KEYS = {
    **{history_table(d): (d.surrogate, "start_date") for d in KEPT},
    ORDER_VERSIONS: ("order_id",),
    LINE_VERSIONS: ("order_id", "product_id"),
}


def is_kept(lake: Lake) -> bool:
    return ORDER_VERSIONS in lake.tables()


def merged_history(lake: Lake, dimension: Dimension, snapshot: DataFrame, as_of: datetime) -> DataFrame:
    """History of a dimension after its newly built rows; members that are gone are closed."""
    if history_table(dimension) not in lake.tables():
        return snapshot
    return scd2_merge(lake.base(history_table(dimension)), snapshot, dimension, F.lit(as_of), close_missing=True)


def _with_version(rows: DataFrame, column: str, history: DataFrame, dimension: Dimension) -> DataFrame:
    name = version_key(dimension)
    found = versions_at(rows, column, "order_date", history, dimension, {name: dimension.surrogate})
    return found.withColumn(name, or_zero(F.col(name), "long"))


def order_versions(orders: DataFrame, customers: DataFrame, employees: DataFrame) -> DataFrame:
    """Per order the versions of its customer and employee at its date; 0 where there is none."""
    rows = orders.select("order_id", "order_date", "customer_id", "employee_id")
    rows = _with_version(rows, "customer_id", customers, CUSTOMER)
    rows = _with_version(rows, "employee_id", employees, EMPLOYEE)
    return rows.select(F.col("order_id").cast("long").alias("order_id"), version_key(CUSTOMER), version_key(EMPLOYEE))


def line_versions(orders: DataFrame, details: DataFrame, products: DataFrame) -> DataFrame:
    """Per order line the version of its product at the order's date; 0 where there is none."""
    rows = details.select("order_id", "product_id").join(orders.select("order_id", "order_date"), "order_id")
    rows = _with_version(rows, "product_id", products, PRODUCT)
    return rows.select(
        F.col("order_id").cast("long").alias("order_id"), F.col("product_id").cast("long").alias("product_id"), version_key(PRODUCT)
    )


def versions(lake: Lake, orders: DataFrame, details: DataFrame, histories: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Both version tables of these orders and lines, by published histories or given ones."""
    of = lambda d: histories[history_table(d)] if histories else lake.base(history_table(d))
    return {
        ORDER_VERSIONS: order_versions(orders, of(CUSTOMER), of(EMPLOYEE)),
        LINE_VERSIONS: line_versions(orders, details, of(PRODUCT)),
    }


def version_rows(history: DataFrame, dimension: Dimension) -> DataFrame:
    """One row per version key: a member that changes back has the same key again, and the same attributes."""
    return history.dropDuplicates([dimension.surrogate]).withColumnRenamed(dimension.surrogate, version_key(dimension))
