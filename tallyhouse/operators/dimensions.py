"""Dimensions: what each one holds, what its hash covers and how its rows are derived."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import (
    base64_text,
    calendar_columns,
    calendar_days,
    clean_text,
    content_hash,
    geography_key,
    or_zero,
    surrogate_key,
)


@dataclass(frozen=True)
class Load:
    """Identity of one load: stamps its rows and fixes how keys are hashed."""

    batch_id: str
    loaded_at: datetime
    version: int
    key_method: str = "xxhash64"

    def stamp(self, rows: DataFrame, versioned: bool = True) -> DataFrame:
        stamps = {"_batch_id": F.lit(self.batch_id), "_loaded_at": F.lit(self.loaded_at).cast("timestamp")}
        if versioned:
            stamps["_version"] = F.lit(self.version).cast("long")
        return rows.withColumns(stamps)


@dataclass(frozen=True)
class Dimension:
    """Shape of a dimension table.

    `hashed` lists the attributes whose change makes a new row version. Dimensions with history
    put the hash into the surrogate key, so a changed row has a new key.
    """

    table: str
    namespace: str
    surrogate: str
    natural: str
    attributes: tuple[str, ...]
    hashed: tuple[str, ...]
    history: bool = True

    def with_keys(self, rows: DataFrame, method: str) -> DataFrame:
        natural = F.col(self.natural)
        parts = (natural, F.col("source_hash")) if self.history else (natural,)
        hashed = rows.withColumn("source_hash", content_hash(*map(F.col, self.hashed)))
        return hashed.withColumn(self.surrogate, surrogate_key(self.namespace, *parts, method=method))

    def finish(self, keyed: DataFrame, load: Load) -> DataFrame:
        columns: list[Column] = [F.col(c) for c in (self.surrogate, self.natural, *self.attributes)]
        if self.history:
            columns += [
                F.lit(load.loaded_at).cast("timestamp").alias("start_date"),
                F.lit(None).cast("timestamp").alias("end_date"),
                F.lit(1).cast("short").alias("is_current"),
            ]
        return load.stamp(keyed.select(*columns, "source_hash"))

    def build(self, rows: DataFrame, load: Load) -> DataFrame:
        return self.finish(self.with_keys(rows, load.key_method), load)


# Attributes of each dimension and the order in which its hash covers them.
_CONTACT = ("company_name", "contact_name", "contact_title", "phone", "fax")
_PLACE = ("country", "region", "city", "postal_code", "address")
_STOCK = ("unit_price", "units_in_stock", "units_on_order", "reorder_level", "discontinued")
_PERSON = (
    "first_name", "last_name", "title", "title_of_courtesy", "birth_date", "hire_date", "home_phone", "extension",
)

CUSTOMER = Dimension(
    "dim_customer", "customer", "customer_key", "customer_alternate_key",
    attributes=("geography_key", *_CONTACT), hashed=(*_CONTACT, "geography_key"),
)
EMPLOYEE = Dimension(
    "dim_employee", "employee", "employee_key", "employee_alternate_key",
    attributes=("parent_employee_key", "reports_to", "geography_key", *_PERSON, "photo_base64", "notes", "photo_path"),
    hashed=("reports_to", "geography_key", *_PERSON, "notes", "photo_path"),
)
SUPPLIER = Dimension(
    "dim_supplier", "supplier", "supplier_key", "supplier_alternate_key",
    attributes=("geography_key", *_CONTACT, "home_page"), hashed=("geography_key", *_CONTACT, "home_page"),
)
PRODUCT = Dimension(
    "dim_product", "product", "product_key", "product_alternate_key",
    attributes=("supplier_key", "product_name", "category_name", "quantity_per_unit", *_STOCK),
    hashed=("supplier_key", "product_name", "category_name", "quantity_per_unit", *_STOCK),
)
SHIPPER = Dimension(
    "dim_shipper", "shipper", "shipper_key", "shipper_alternate_key",
    attributes=("company_name", "phone"), hashed=("company_name", "phone"), history=False,
)
TERRITORY = Dimension(
    "dim_territory", "territory", "territory_key", "territory_alternate_key",
    attributes=("region_description", "territory_description"),
    hashed=("region_description", "territory_description"),
)

DIMENSIONS = {d.table: d for d in (CUSTOMER, EMPLOYEE, SUPPLIER, PRODUCT, SHIPPER, TERRITORY)}
DATE_TABLE, GEOGRAPHY_TABLE = "dim_date", "dim_geography"
PHOTO_FOLDER = "/data-lake/curated/employee-photos"


def _texts(*names: str) -> list[Column]:
    return [clean_text(F.col(n)).alias(n) for n in names]


def _place_key(method: str, prefix: str = "") -> Column:
    return geography_key(*[F.col(prefix + part) for part in _PLACE], method=method).alias("geography_key")


def customer_dimension(customers: DataFrame, load: Load) -> DataFrame:
    rows = customers.select(
        F.col("customer_id").alias(CUSTOMER.natural), *_texts(*_CONTACT), _place_key(load.key_method)
    )
    return CUSTOMER.build(rows, load)


def supplier_dimension(suppliers: DataFrame, load: Load) -> DataFrame:
    rows = suppliers.select(
        F.col("supplier_id").cast("long").alias(SUPPLIER.natural),
        *_texts(*_CONTACT, "home_page"),
        _place_key(load.key_method),
    )
    return SUPPLIER.build(rows, load)


def shipper_dimension(shippers: DataFrame, load: Load) -> DataFrame:
    rows = shippers.select(F.col("shipper_id").cast("long").alias(SHIPPER.natural), *_texts("company_name", "phone"))
    return SHIPPER.build(rows, load)


def employee_dimension(employees: DataFrame, load: Load, photos: DataFrame | None = None) -> DataFrame:
    """Employees with their manager's key, one level up.

    `photos` is the asset manifest (employee_id, curated_path); without it the conventional path is used.
    """
    conventional = F.concat(F.lit(f"{PHOTO_FOLDER}/employee_"), F.col("employee_id"), F.lit(".bmp"))
    path = conventional
    if photos is not None:
        employees = employees.join(photos.select("employee_id", "curated_path"), "employee_id", "left")
        path = F.coalesce("curated_path", conventional)
    rows = employees.select(
        F.col("employee_id").cast("long").alias(EMPLOYEE.natural),
        F.col("reports_to").cast("long").alias("reports_to"),
        _place_key(load.key_method),
        *_texts("first_name", "last_name", "title", "title_of_courtesy", "home_phone", "extension", "notes"),
        F.col("birth_date").cast("date").alias("birth_date"),
        F.col("hire_date").cast("date").alias("hire_date"),
        base64_text(F.col("photo")).alias("photo_base64"),
        path.alias("photo_path"),
    )
    keyed = EMPLOYEE.with_keys(rows, load.key_method)
    managers = keyed.select(
        F.col(EMPLOYEE.natural).alias("reports_to"), F.col(EMPLOYEE.surrogate).alias("manager_key")
    )
    with_manager = keyed.join(managers, "reports_to", "left").withColumn(
        "parent_employee_key", or_zero(F.col("manager_key"), "long")
    )
    return EMPLOYEE.finish(with_manager, load)


def product_dimension(products: DataFrame, categories: DataFrame, supplier_dim: DataFrame, load: Load) -> DataFrame:
    """Products with their category name and current supplier key (0 = unknown supplier)."""
    supplier_keys = supplier_dim.select(F.col(SUPPLIER.natural).alias("supplier_id"), SUPPLIER.surrogate)
    rows = (
        products.withColumn("supplier_id", F.col("supplier_id").cast("long"))
        .join(categories.select("category_id", "category_name"), "category_id", "left")
        .join(supplier_keys, "supplier_id", "left")
        .select(
            F.col("product_id").cast("long").alias(PRODUCT.natural),
            or_zero(F.col("supplier_key"), "long").alias("supplier_key"),
            *_texts("product_name", "category_name", "quantity_per_unit"),
            or_zero(F.col("unit_price"), "decimal(19,4)").alias("unit_price"),
            *[or_zero(F.col(c), "int").alias(c) for c in ("units_in_stock", "units_on_order", "reorder_level")],
            or_zero(F.col("discontinued").cast("int"), "short").alias("discontinued"),
        )
    )
    return PRODUCT.build(rows, load)


def territory_dimension(territories: DataFrame, regions: DataFrame, load: Load) -> DataFrame:
    rows = territories.join(regions, "region_id", "left").select(
        F.col("territory_id").alias(TERRITORY.natural), *_texts("region_description", "territory_description")
    )
    return TERRITORY.build(rows, load)


def geography_dimension(
    customers: DataFrame, employees: DataFrame, suppliers: DataFrame, orders: DataFrame, load: Load
) -> DataFrame:
    """Every distinct address of the four roles. De-duplication combines map-side before its shuffle."""

    def addresses(rows: DataFrame, prefix: str = "") -> DataFrame:
        return rows.select(*[clean_text(F.col(prefix + part)).alias(part) for part in _PLACE])

    roles = [addresses(customers), addresses(employees), addresses(suppliers), addresses(orders, "ship_")]
    places = reduce(DataFrame.unionByName, roles).distinct()
    return load.stamp(
        places.select(
            _place_key(load.key_method), *_PLACE, content_hash(*map(F.col, _PLACE)).alias("source_hash")
        )
    )


def date_dimension(orders: DataFrame, load: Load) -> DataFrame:
    days = calendar_days(orders, "order_date", "required_date", "shipped_date")
    return load.stamp(days.select(*calendar_columns(F.col("day"))), versioned=False)
