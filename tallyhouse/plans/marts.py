"""Business reports over the star schema.

Facts are aggregated by surrogate key before they meet a dimension: each task sends one row per key, so hot
keys do not skew the join, and the join works on aggregates. Distinct orders are counted over an
(order, key) pre-aggregate for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import (
    days_between,
    discount_band,
    label,
    money,
    month_of,
    net_revenue,
    percent,
    ratio,
    revenue_segment,
    year_label,
)
from tallyhouse.operators.latest import top_rows
from tallyhouse.plans.star import Star

UNCATEGORIZED, UNKNOWN = "Uncategorized", "Unknown"
DATED = "order_date IS NOT NULL"
SHIPPED = "order_date IS NOT NULL AND shipped_date IS NOT NULL"


def _line_days() -> Column:
    return days_between(F.col("order_date"), F.col("shipped_date"))


def _on_time() -> Column:
    return F.col("shipped_date") <= F.col("required_date")


def _revenue() -> Column:
    return F.sum(net_revenue())


def _full_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name")


def _by_key(facts: DataFrame, *keys: str) -> DataFrame:
    """Revenue and units per key."""
    return facts.groupBy(*keys).agg(_revenue().alias("revenue"), F.sum("quantity").alias("units"))


def _orders_by_key(facts: DataFrame, *keys: str) -> DataFrame:
    """Per key: distinct orders, units, revenue and the sum and count of line shipping days, counted in two
    steps so that the distinct count needs no expansion of the facts."""
    per_order = facts.groupBy("order_id", *keys).agg(
        _revenue().alias("revenue"),
        F.sum("quantity").alias("units"),
        F.sum(_line_days()).alias("days"),
        F.count(_line_days()).alias("day_lines"),
        F.max("order_date").alias("last_order"),
        F.max(F.coalesce(_on_time(), F.lit(False)).cast("int")).alias("on_time"),
    )
    return per_order.groupBy(*keys).agg(
        F.count("*").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("units").alias("units"),
        F.sum("days").alias("days"),
        F.sum("day_lines").alias("day_lines"),
        F.max("last_order").alias("last_order"),
        F.sum("on_time").alias("on_time_orders"),
    )


def _merge_orders(rows: DataFrame, *labels: Column) -> DataFrame:
    """Combine `_orders_by_key` rows whose keys share a label; valid as an order has one such key."""
    return rows.groupBy(*labels).agg(
        F.sum("orders").alias("orders"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.sum("days").alias("days"),
        F.sum("day_lines").alias("day_lines"),
        F.max("last_order").alias("last_order"),
        F.sum("on_time_orders").alias("on_time_orders"),
    )


def _revenue_by(rows: DataFrame, *labels: Column) -> DataFrame:
    return rows.groupBy(*labels).agg(money(F.sum("revenue")).alias("revenue"))


def _category(products: DataFrame) -> DataFrame:
    return products.withColumn("category", label(F.col("category_name"), UNCATEGORIZED))


def _product_sales(star: Star) -> DataFrame:
    return _by_key(star.facts, "product_key").join(star.products, "product_key")


def _place_sales(star: Star) -> DataFrame:
    return _by_key(star.facts, "geography_key").join(star.places, "geography_key", "left")


# --- overview ---------------------------------------------------------------------------------


def total_revenue(star: Star) -> DataFrame:
    return star.facts.agg(money(_revenue()).alias("total_revenue"))


def unique_orders(star: Star) -> DataFrame:
    return star.facts.agg(F.count_distinct("order_id").alias("orders"))


def active_customers(star: Star) -> DataFrame:
    known = F.when(F.col("customer_key") != 0, F.col("customer_key"))
    return star.facts.agg(F.count_distinct(known).alias("customers"))


def average_order_value(star: Star) -> DataFrame:
    per_order = star.facts.groupBy("order_id").agg(_revenue().alias("revenue"))
    return per_order.agg(ratio(F.sum("revenue"), F.count("*")).alias("average_order_value"))


def monthly_revenue(star: Star) -> DataFrame:
    rows = star.facts.where(DATED).groupBy(month_of(F.col("order_date")).alias("month"))
    return rows.agg(money(_revenue()).alias("revenue")).orderBy("month")


def revenue_by_category(star: Star) -> DataFrame:
    rows = _revenue_by(_category(_product_sales(star)), F.col("category"))
    return rows.orderBy(F.desc("revenue"), "category")


def top_products_by_revenue(star: Star, count: int = 10) -> DataFrame:
    rows = _revenue_by(_product_sales(star), F.col("product_name").alias("product"))
    return top_rows(rows, count, F.desc("revenue"), F.asc("product"))


def top_shipping_countries(star: Star, count: int = 12) -> DataFrame:
    rows = _revenue_by(_place_sales(star), label(F.col("country"), UNKNOWN).alias("country"))
    return top_rows(rows, count, F.desc("revenue"), F.asc("country"))


def latest_orders(star: Star, count: int = 15) -> DataFrame:
    rows = star.facts.groupBy("order_id").agg(
        F.min("ship_name").alias("ship_name"),
        F.min("order_date").alias("order_date"),
        F.sum("quantity").alias("units"),
        money(_revenue()).alias("net_revenue"),
    )
    return top_rows(rows, count, F.desc("order_date"), F.desc("order_id"))


# --- sales trends -----------------------------------------------------------------------------


def units_sold(star: Star) -> DataFrame:
    return star.facts.agg(F.sum("quantity").alias("units"))


def average_discount(star: Star) -> DataFrame:
    return star.facts.agg(percent(F.sum("discount"), F.count("discount")).alias("discount"))


def shipped_orders(star: Star) -> DataFrame:
    shipped = F.when(F.col("shipped_date").isNotNull(), F.col("order_id"))
    return star.facts.agg(F.count_distinct(shipped).alias("shipped_orders"))


def average_fulfilment_days(star: Star) -> DataFrame:
    return star.facts.where(SHIPPED).agg(ratio(F.sum(_line_days()), F.count("*")).alias("days"))


def monthly_revenue_and_orders(star: Star) -> DataFrame:
    per_order = star.facts.where(DATED).groupBy(month_of(F.col("order_date")).alias("month"), "order_id")
    rows = per_order.agg(_revenue().alias("revenue")).groupBy("month")
    return rows.agg(money(F.sum("revenue")).alias("revenue"), F.count("*").alias("orders")).orderBy("month")


def revenue_by_year(star: Star) -> DataFrame:
    rows = star.facts.where(DATED).groupBy(year_label(F.col("order_date")).alias("year"))
    return rows.agg(money(_revenue()).alias("revenue")).orderBy("year")


def _calendar_sales(star: Star) -> DataFrame:
    return _by_key(star.facts, "order_date_key").join(star.dates, F.col("order_date_key") == F.col("date_key"))


def revenue_by_month_name(star: Star) -> DataFrame:
    rows = _revenue_by(_calendar_sales(star), F.col("month_number_of_year"), F.col("month_name").alias("month"))
    return rows.orderBy("month_number_of_year").select("month", "revenue")


def revenue_by_weekday(star: Star) -> DataFrame:
    rows = _revenue_by(_calendar_sales(star), F.col("day_of_week"), F.col("day_of_week_name").alias("weekday"))
    return rows.orderBy("day_of_week").select("weekday", "revenue")


def revenue_by_discount_band(star: Star) -> DataFrame:
    rows = star.facts.groupBy(discount_band(F.col("discount")).alias("discount_band"))
    return rows.agg(money(_revenue()).alias("revenue")).orderBy(F.desc("revenue"), "discount_band")


def monthly_fulfilment_days(star: Star) -> DataFrame:
    rows = star.facts.where(SHIPPED).groupBy(month_of(F.col("order_date")).alias("month"))
    return rows.agg(ratio(F.sum(_line_days()), F.count("*")).alias("average_days")).orderBy("month")


def yearly_summary(star: Star) -> DataFrame:
    per_order = star.facts.where(DATED).groupBy(F.year("order_date").alias("year"), "order_id").agg(
        _revenue().alias("revenue"),
        F.sum("quantity").alias("units"),
        F.sum("discount").alias("discounts"),
        F.count("discount").alias("lines"),
    )
    return per_order.groupBy("year").agg(
        F.count("*").alias("orders"),
        F.sum("units").alias("units"),
        money(F.sum("revenue")).alias("revenue"),
        percent(F.sum("discounts"), F.sum("lines")).alias("avg_discount_percent"),
    ).orderBy("year")


# --- products ---------------------------------------------------------------------------------


def current_products(star: Star) -> DataFrame:
    return star.products.agg(F.count("*").alias("products"))


def category_count(star: Star) -> DataFrame:
    return star.products.agg(F.count_distinct("category_name").alias("categories"))


def units_in_stock(star: Star) -> DataFrame:
    return star.products.agg(F.sum("units_in_stock").alias("stock_units"))


def inventory_value(star: Star) -> DataFrame:
    return star.products.agg(money(F.sum(F.col("unit_price") * F.col("units_in_stock"))).alias("inventory_value"))


def top_products_by_units(star: Star, count: int = 15) -> DataFrame:
    rows = _product_sales(star).groupBy(F.col("product_name").alias("product")).agg(F.sum("units").alias("units"))
    return top_rows(rows, count, F.desc("units"), F.asc("product"))


def top_suppliers(star: Star, count: int = 12) -> DataFrame:
    """Products without a supplier are reported under an empty name."""
    sales = _product_sales(star).groupBy("supplier_key").agg(F.sum("revenue").alias("revenue"))
    named = sales.join(star.suppliers, "supplier_key", "left")
    rows = _revenue_by(named, label(F.col("company_name"), "").alias("supplier"))
    return top_rows(rows, count, F.desc("revenue"), F.asc("supplier"))


def inventory_by_category(star: Star) -> DataFrame:
    rows = _category(star.products).groupBy("category").agg(F.sum("units_in_stock").alias("units_in_stock"))
    return rows.orderBy(F.desc("units_in_stock"), "category")


def reorder_list(star: Star) -> DataFrame:
    return (
        _category(star.products)
        .where("units_in_stock <= reorder_level")
        .select(
            F.col("product_alternate_key").alias("product_id"),
            F.col("product_name").alias("product"),
            "category",
            F.col("units_in_stock").alias("in_stock"),
            F.col("units_on_order").alias("on_order"),
            "reorder_level",
            "discontinued",
        )
        .orderBy("in_stock", "product", "product_id")
    )


def product_performance(star: Star, count: int = 30) -> DataFrame:
    """Best products. Rows of one product id share its name and category, whatever its versions."""
    labels = ["product_id", "product", "category"]
    named = _category(star.products).select(
        "product_key",
        F.col("product_alternate_key").alias("product_id"),
        F.col("product_name").alias("product"),
        "category",
    )
    rows = _orders_by_key(star.facts, "product_key").join(named, "product_key").groupBy(*labels)
    rows = rows.agg(
        F.sum("orders").alias("orders"), F.sum("units").alias("units"), money(F.sum("revenue")).alias("revenue")
    )
    return top_rows(rows, count, F.desc("revenue"), F.asc("product_id"))


# --- customers and geography ------------------------------------------------------------------


def current_customers(star: Star) -> DataFrame:
    return star.customers.agg(F.count("*").alias("customers"))


def customer_countries(star: Star) -> DataFrame:
    places = star.customers.select("geography_key").distinct().join(star.places, "geography_key", "left")
    return places.agg(F.count_distinct("country").alias("countries"))


def revenue_per_customer(star: Star) -> DataFrame:
    """All revenue over known customers: revenue without a customer counts, its customer does not."""
    per_customer = star.facts.groupBy("customer_key").agg(_revenue().alias("revenue"))
    known = F.count_if(F.col("customer_key") != 0)
    return per_customer.agg(ratio(F.sum("revenue"), known).alias("revenue_per_customer"))


def repeat_customers(star: Star) -> DataFrame:
    orders = star.facts.where("customer_key != 0").select("customer_key", "order_id").distinct()
    counts = orders.groupBy("customer_key").agg(F.count("*").alias("orders")).where("orders > 1")
    return counts.agg(F.count("*").alias("repeat_customers"))


def _customer_sales(star: Star) -> DataFrame:
    return _by_key(star.facts, "customer_key").join(star.customers, "customer_key")


def top_customers(star: Star, count: int = 15) -> DataFrame:
    rows = _revenue_by(_customer_sales(star), F.col("company_name").alias("customer"))
    return top_rows(rows, count, F.desc("revenue"), F.asc("customer"))


def top_shipping_cities(star: Star, count: int = 15) -> DataFrame:
    place = F.concat_ws(", ", label(F.col("city"), UNKNOWN), label(F.col("country"), UNKNOWN))
    rows = _revenue_by(_place_sales(star), place.alias("location"))
    return top_rows(rows, count, F.desc("revenue"), F.asc("location"))


def customers_by_segment(star: Star) -> DataFrame:
    revenue = star.facts.where("customer_key != 0").groupBy("customer_key").agg(_revenue().alias("revenue"))
    rows = revenue.groupBy(revenue_segment(F.col("revenue")).alias("segment")).agg(F.count("*").alias("customers"))
    return rows.orderBy(F.desc("customers"), "segment")


def customer_sales_detail(star: Star) -> DataFrame:
    places = star.places.select("geography_key", label(F.col("country"), UNKNOWN).alias("country"))
    customers = star.customers.join(places, "geography_key", "left").select(
        "customer_key",
        F.col("customer_alternate_key").alias("customer_id"),
        F.col("company_name").alias("customer"),
        label(F.col("country"), UNKNOWN).alias("country"),
    )
    labels = [F.col(c) for c in ("customer_id", "customer", "country")]
    rows = _merge_orders(_orders_by_key(star.facts, "customer_key").join(customers, "customer_key"), *labels)
    return rows.select(
        "customer_id", "customer", "country", "orders", "units", money(F.col("revenue")).alias("revenue"), "last_order"
    ).orderBy(F.desc("revenue"), "customer_id")


# --- employees and shipping -------------------------------------------------------------------


def current_employees(star: Star) -> DataFrame:
    return star.employees.agg(F.count("*").alias("employees"))


def shipper_count(star: Star) -> DataFrame:
    return star.shippers.agg(F.count("*").alias("shippers"))


def on_time_rate(star: Star) -> DataFrame:
    both = F.col("shipped_date").isNotNull() & F.col("required_date").isNotNull()
    per_order = star.facts.groupBy("order_id").agg(
        F.max(both.cast("int")).alias("dated"), F.max((both & _on_time()).cast("int")).alias("on_time")
    )
    return per_order.agg(percent(F.sum("on_time"), F.sum("dated")).alias("on_time_rate"))


def employee_revenue(star: Star) -> DataFrame:
    sales = _by_key(star.facts, "employee_key").join(star.employees, "employee_key")
    return _revenue_by(sales, _full_name().alias("employee")).orderBy(F.desc("revenue"), "employee")


def _shipper_name() -> Column:
    return label(F.col("company_name"), "").alias("shipper")


def orders_by_shipper(star: Star) -> DataFrame:
    """Distinct orders per shipper; orders without a known shipper come under an empty name."""
    counts = star.facts.select("shipper_key", "order_id").distinct().groupBy("shipper_key").agg(F.count("*").alias("orders"))
    rows = counts.join(star.shippers, "shipper_key", "left").groupBy(_shipper_name()).agg(F.sum("orders").alias("orders"))
    return rows.orderBy(F.desc("orders"), "shipper")


def shipping_days_by_shipper(star: Star) -> DataFrame:
    sums = star.facts.where(SHIPPED).groupBy("shipper_key").agg(
        F.sum(_line_days()).alias("days"), F.count("*").alias("day_lines")
    )
    rows = sums.join(star.shippers, "shipper_key", "left").groupBy(_shipper_name()).agg(
        ratio(F.sum("days"), F.sum("day_lines")).alias("average_days")
    )
    return rows.orderBy(F.desc("average_days"), "shipper")


def employee_performance(star: Star) -> DataFrame:
    labels = [
        F.col("employee_alternate_key").alias("employee_id"),
        _full_name().alias("employee"),
        label(F.col("title"), "").alias("title"),
    ]
    sales = _orders_by_key(star.facts, "employee_key").join(star.employees, "employee_key")
    return _merge_orders(sales, *labels).select(
        "employee_id", "employee", "title", "orders", "units",
        money(F.col("revenue")).alias("revenue"),
        ratio(F.col("days"), F.col("day_lines")).alias("avg_shipping_days"),
    ).orderBy(F.desc("revenue"), "employee_id")


def employee_territories(star: Star) -> DataFrame:
    return (
        star.bridge.join(star.employees, "employee_key")
        .join(star.territories, "territory_key")
        .select(
            F.col("employee_alternate_key").alias("employee_id"),
            _full_name().alias("employee"),
            F.col("territory_alternate_key").alias("territory_id"),
            label(F.col("territory_description"), "").alias("territory"),
            label(F.col("region_description"), "").alias("region"),
        )
        .orderBy("employee", "territory", "employee_id", "territory_id")
    )


def shipper_service_levels(star: Star) -> DataFrame:
    facts = star.facts.where("shipped_date IS NOT NULL AND required_date IS NOT NULL")
    sales = _orders_by_key(facts, "shipper_key").join(star.shippers, "shipper_key", "left")
    return _merge_orders(sales, _shipper_name()).select(
        "shipper",
        "orders",
        "on_time_orders",
        percent(F.col("on_time_orders"), F.col("orders")).alias("on_time_percent"),
        ratio(F.col("days"), F.col("day_lines")).alias("avg_shipping_days"),
    ).orderBy(F.desc("orders"), "shipper")


# --- audits -----------------------------------------------------------------------------------


def top_products_all_versions(star: Star, count: int = 10) -> DataFrame:
    """Best product names over every product version, current or not."""
    sales = _by_key(star.facts, "product_key").join(star.latest("dim_product"), "product_key")
    rows = sales.groupBy("product_name").agg(F.sum("units").alias("units_sold"), money(F.sum("revenue")).alias("net_sales"))
    return top_rows(rows, count, F.desc("net_sales"), F.asc("product_name"))
