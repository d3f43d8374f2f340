"""Source tables: column names, types, keys and the columns trimmed on read."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """One source table. `columns` is DDL for the staged names; `source_names` maps them to the source."""

    name: str
    columns: str
    keys: tuple[str, ...]
    source_table: str = ""
    source_names: dict[str, str] = field(default_factory=dict)
    trimmed: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    def source_name(self, column: str) -> str:
        return self.source_names.get(column, pascal_case(column))


def pascal_case(column: str) -> str:
    """order_id -> OrderID, ship_postal_code -> ShipPostalCode."""
    return "".join("ID" if part == "id" else part.capitalize() for part in column.split("_"))


# The staged schema of each source table.
_ADDRESS = "address string, city string, region string, postal_code string, country string"

SPECS = (
    TableSpec(
        "customers",
        "customer_id string, company_name string, contact_name string, contact_title string, "
        f"{_ADDRESS}, phone string, fax string",
        keys=("customer_id",),
        trimmed=("customer_id",),
    ),
    TableSpec(
        "employees",
        "employee_id int, last_name string, first_name string, title string, title_of_courtesy string, "
        f"birth_date timestamp, hire_date timestamp, {_ADDRESS}, home_phone string, extension string, "
        "photo binary, notes string, reports_to int, photo_path string",
        keys=("employee_id",),
    ),
    TableSpec(
        "suppliers",
        "supplier_id int, company_name string, contact_name string, contact_title string, "
        f"{_ADDRESS}, phone string, fax string, home_page string",
        keys=("supplier_id",),
    ),
    TableSpec(
        "categories",
        "category_id int, category_name string, description string, picture binary",
        keys=("category_id",),
    ),
    TableSpec(
        "products",
        "product_id int, product_name string, supplier_id int, category_id int, quantity_per_unit string, "
        "unit_price decimal(19,4), units_in_stock short, units_on_order short, reorder_level short, "
        "discontinued boolean",
        keys=("product_id",),
    ),
    TableSpec("shippers", "shipper_id int, company_name string, phone string", keys=("shipper_id",)),
    TableSpec(
        "regions",
        "region_id int, region_description string",
        keys=("region_id",),
        source_table="Region",
        trimmed=("region_description",),
    ),
    TableSpec(
        "territories",
        "territory_id string, territory_description string, region_id int",
        keys=("territory_id",),
        trimmed=("territory_description",),
    ),
    TableSpec(
        "employee_territories",
        "employee_id int, territory_id string",
        keys=("employee_id", "territory_id"),
    ),
    TableSpec(
        "orders",
        "order_id long, customer_id string, employee_id int, order_date timestamp, required_date timestamp, "
        "shipped_date timestamp, ship_via int, freight decimal(19,4), ship_name string, ship_address string, "
        "ship_city string, ship_region string, ship_postal_code string, ship_country string",
        keys=("order_id",),
        trimmed=("customer_id",),
    ),
    TableSpec(
        "order_details",
        "order_id long, product_id int, unit_price decimal(19,4), quantity int, discount float",
        keys=("order_id", "product_id"),
        source_table="Order Details",
    ),
)

BY_NAME = {spec.name: spec for spec in SPECS}


@dataclass(frozen=True)
class CaptureSource:
    """One captured table: its change-log instance, source name, staged table, key columns and topic."""

    instance: str
    source_table: str
    staged: str
    key_fields: tuple[str, ...]
    topic: str


# Capture instances and key fields of the change format.
CAPTURES = (
    CaptureSource("dbo_Orders", "dbo.Orders", "orders", ("OrderID",), "orders.cdc"),
    CaptureSource(
        "dbo_Order_Details", "dbo.Order Details", "order_details", ("OrderID", "ProductID"), "order_details.cdc"
    ),
)
ORDERS_INSTANCE, LINES_INSTANCE = (c.instance for c in CAPTURES)

# Stamps every staged row carries. The LSN triple orders rows of one key; snapshot rows sort first.
STAGING_STAMPS = "_batch_id string, _loaded_at timestamp"
CHANGE_ORDER = ("start_lsn", "seqval", "operation_code")
