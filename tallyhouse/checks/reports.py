"""Registered business, audit and health reports."""

from __future__ import annotations

from tallyhouse.checks.prelude import DAYS, MONEY, day, exact_ratio, moment, revenue_ratio, with_prelude
from tallyhouse.checks.registry import register
from tallyhouse.operators import quality
from tallyhouse.plans import health, marts
from tallyhouse.plans.star import TABLE_KEYS


def _mart(name, build, sql):
    register(name, lambda inputs: build(inputs.star), with_prelude(sql))


def _top(select: str, source: str, group: str, order: str, limit: int) -> str:
    return f"SELECT {select} FROM {source} GROUP BY {group} ORDER BY {order} LIMIT {limit}"


_CATEGORY = "coalesce(category_name, 'Uncategorized')"
_COUNTRY = "coalesce(ship_country, 'Unknown')"
_MONTH = day("date_trunc('month', order_date)")
_SHIPPED = "order_date IS NOT NULL AND shipped_date IS NOT NULL"
_EMPLOYEE = "e.first_name || ' ' || e.last_name"
_STAFF = "facts f JOIN stg_employees e ON e.employee_id = f.employee_id"

_mart("b01_total_revenue", marts.total_revenue, f"SELECT {MONEY} AS total_revenue FROM facts")
_mart("b02_unique_orders", marts.unique_orders, "SELECT count(DISTINCT order_id) AS orders FROM facts")
_mart("b03_active_customers", marts.active_customers, "SELECT count(DISTINCT customer_id) AS customers FROM facts")
_mart(
    "b04_average_order_value", marts.average_order_value,
    f"SELECT {revenue_ratio('count(DISTINCT order_id)')} AS average_order_value FROM facts",
)
_mart("b05_monthly_revenue", marts.monthly_revenue, f"SELECT {_MONTH} AS month, {MONEY} AS revenue FROM facts GROUP BY 1")
_CATEGORY_SALES = f"SELECT {_CATEGORY} AS category, {MONEY} AS revenue FROM facts GROUP BY 1"
_mart("b06_revenue_by_category", marts.revenue_by_category, _CATEGORY_SALES)
_PRODUCT_TOP = f"product_name AS product, {MONEY} AS revenue"
_mart(
    "b07_top_10_products", marts.top_products_by_revenue,
    _top(_PRODUCT_TOP, "facts", "1", "revenue DESC, product", 10),
)
_mart(
    "b08_top_shipping_countries", marts.top_shipping_countries,
    _top(f"{_COUNTRY} AS country, {MONEY} AS revenue", "facts", "1", "revenue DESC, 1", 12),
)
_mart(
    "b09_latest_orders", marts.latest_orders,
    f"""SELECT order_id, min(ship_name) AS ship_name, {moment("min(order_date)")} AS order_date,
        sum(quantity)::BIGINT AS units, {MONEY} AS net_revenue
        FROM facts GROUP BY order_id ORDER BY min(facts.order_date) DESC, order_id DESC LIMIT 15""",
)
_mart("b10_units_sold", marts.units_sold, "SELECT sum(quantity)::BIGINT AS units FROM facts")
_DISCOUNT = exact_ratio("sum(discount) * 100000000", "count(*)", 1000000)
_mart("b11_average_discount", marts.average_discount, f"SELECT {_DISCOUNT} AS discount FROM facts")
_mart(
    "b12_shipped_orders", marts.shipped_orders,
    "SELECT count(DISTINCT order_id) FILTER (shipped_date IS NOT NULL) AS shipped_orders FROM facts",
)
_AVERAGE_DAYS = exact_ratio(f"sum({DAYS})", "count(*)")
_mart(
    "b13_average_fulfilment_days", marts.average_fulfilment_days,
    f"SELECT {_AVERAGE_DAYS} AS days FROM facts WHERE {_SHIPPED}",
)
_mart(
    "b14_monthly_revenue_and_orders", marts.monthly_revenue_and_orders,
    f"SELECT {_MONTH} AS month, {MONEY} AS revenue, count(DISTINCT order_id) AS orders FROM facts GROUP BY 1",
)
_mart(
    "b15_revenue_by_year", marts.revenue_by_year,
    f"SELECT year(order_date)::VARCHAR AS year, {MONEY} AS revenue FROM facts GROUP BY 1",
)
_mart(
    "b16_revenue_by_month_name", marts.revenue_by_month_name,
    f"SELECT monthname(order_date) AS month, {MONEY} AS revenue FROM facts GROUP BY 1",
)
_mart(
    "b17_revenue_by_weekday", marts.revenue_by_weekday,
    f"SELECT dayname(order_date) AS weekday, {MONEY} AS revenue FROM facts GROUP BY 1",
)
_BAND = """CASE WHEN discount = 0 THEN 'No Discount' WHEN discount <= 0.10 THEN 'Up to 10%'
           WHEN discount <= 0.20 THEN '10-20%' ELSE 'Over 20%' END"""
_mart(
    "b18_revenue_by_discount_band", marts.revenue_by_discount_band,
    f"SELECT {_BAND} AS discount_band, {MONEY} AS revenue FROM facts GROUP BY 1",
)
_mart(
    "b19_monthly_fulfilment_days", marts.monthly_fulfilment_days,
    f"SELECT {_MONTH} AS month, {_AVERAGE_DAYS} AS average_days FROM facts WHERE {_SHIPPED} GROUP BY 1",
)
_mart(
    "b20_yearly_summary", marts.yearly_summary,
    f"""SELECT year(order_date)::BIGINT AS year, count(DISTINCT order_id) AS orders, sum(quantity)::BIGINT AS units,
        {MONEY} AS revenue, {_DISCOUNT} AS avg_discount_percent FROM facts GROUP BY 1""",
)
_mart("b21_current_products", marts.current_products, "SELECT count(*) AS products FROM stg_products")
_mart("b22_categories", marts.category_count, "SELECT count(DISTINCT category_name) AS categories FROM products")
_mart("b23_units_in_stock", marts.units_in_stock, "SELECT sum(units_in_stock)::BIGINT AS stock_units FROM products")
_mart(
    "b24_inventory_value", marts.inventory_value,
    "SELECT round(sum(unit_price * units_in_stock::DECIMAL(10,0)), 2)::DOUBLE AS inventory_value FROM products",
)
_mart(
    "b25_top_15_products", lambda star: marts.top_products_by_revenue(star, 15),
    _top(_PRODUCT_TOP, "facts", "1", "revenue DESC, product", 15),
)
_mart(
    "b26_top_15_products_by_units", marts.top_products_by_units,
    _top("product_name AS product, sum(quantity)::BIGINT AS units", "facts", "1", "units DESC, product", 15),
)
_mart("b27_category_revenue_mix", marts.revenue_by_category, _CATEGORY_SALES)
_mart(
    "b28_top_suppliers", marts.top_suppliers,
    _top(f"coalesce(supplier_name, '') AS supplier, {MONEY} AS revenue", "facts", "1", "revenue DESC, supplier", 12),
)
_mart(
    "b29_inventory_by_category", marts.inventory_by_category,
    f"SELECT {_CATEGORY} AS category, sum(units_in_stock)::BIGINT AS units_in_stock FROM products GROUP BY 1",
)
_mart(
    "b30_reorder_list", marts.reorder_list,
    f"""SELECT product_id, product_name AS product, {_CATEGORY} AS category, units_in_stock AS in_stock,
        units_on_order AS on_order, reorder_level, discontinued FROM products WHERE units_in_stock <= reorder_level""",
)
_mart(
    "b31_product_performance", marts.product_performance,
    f"""SELECT product_id, product_name AS product, {_CATEGORY} AS category, count(DISTINCT order_id) AS orders,
        sum(quantity)::BIGINT AS units, {MONEY} AS revenue FROM facts GROUP BY 1, 2, 3
        ORDER BY revenue DESC, product_id LIMIT 30""",
)
_mart("b32_current_customers", marts.current_customers, "SELECT count(*) AS customers FROM stg_customers")
_mart("b33_customer_countries", marts.customer_countries, "SELECT count(DISTINCT country) AS countries FROM stg_customers")
_mart(
    "b34_revenue_per_customer", marts.revenue_per_customer,
    f"SELECT {revenue_ratio('count(DISTINCT customer_id)')} AS revenue_per_customer FROM facts",
)
_mart(
    "b35_repeat_customers", marts.repeat_customers,
    """SELECT count(*) AS repeat_customers FROM (SELECT customer_id FROM facts WHERE customer_id IS NOT NULL
       GROUP BY 1 HAVING count(DISTINCT order_id) > 1)""",
)
_mart(
    "b36_top_customers", marts.top_customers,
    f"""SELECT customer, {MONEY} AS revenue FROM facts WHERE customer_id IS NOT NULL GROUP BY 1
        ORDER BY revenue DESC, customer LIMIT 15""",
)
_mart(
    "b37_shipping_countries", lambda star: marts.top_shipping_countries(star, 15),
    _top(f"{_COUNTRY} AS country, {MONEY} AS revenue", "facts", "1", "revenue DESC, 1", 15),
)
_mart(
    "b38_top_shipping_cities", marts.top_shipping_cities,
    _top(
        f"coalesce(ship_city, 'Unknown') || ', ' || {_COUNTRY} AS location, {MONEY} AS revenue",
        "facts", "1", "revenue DESC, location", 15,
    ),
)
_mart(
    "b39_customers_by_segment", marts.customers_by_segment,
    """SELECT CASE WHEN revenue >= 50000 THEN 'VIP' WHEN revenue >= 20000 THEN 'High Value'
         WHEN revenue >= 5000 THEN 'Medium Value' ELSE 'Standard' END AS segment, count(*) AS customers
       FROM (SELECT customer_id, sum(rev) AS revenue FROM facts WHERE customer_id IS NOT NULL GROUP BY 1) GROUP BY 1""",
)
_mart(
    "b40_customer_sales_detail", marts.customer_sales_detail,
    f"""SELECT f.customer_id, customer, coalesce(c.country, 'Unknown') AS country, count(DISTINCT order_id) AS orders,
        sum(quantity)::BIGINT AS units, {MONEY} AS revenue, {moment("max(order_date)")} AS last_order
        FROM facts f JOIN stg_customers c ON c.customer_id = f.customer_id GROUP BY 1, 2, 3""",
)
_mart("b41_current_employees", marts.current_employees, "SELECT count(*) AS employees FROM stg_employees")
_mart("b42_shippers", marts.shipper_count, "SELECT count(*) AS shippers FROM stg_shippers")
_ON_TIME = "count(DISTINCT order_id) FILTER (shipped_date <= required_date)"
_DATED = "count(DISTINCT order_id) FILTER (shipped_date IS NOT NULL AND required_date IS NOT NULL)"
_mart("b43_on_time_rate", marts.on_time_rate, f"SELECT {exact_ratio(f'100 * {_ON_TIME}', _DATED)} AS on_time_rate FROM facts")
_mart(
    "b44_average_shipping_days", marts.average_fulfilment_days,
    f"SELECT {_AVERAGE_DAYS} AS days FROM facts WHERE {_SHIPPED}",
)
_mart("b45_employee_revenue", marts.employee_revenue, f"SELECT {_EMPLOYEE} AS employee, {MONEY} AS revenue FROM {_STAFF} GROUP BY 1")
_mart(
    "b46_orders_by_shipper", marts.orders_by_shipper,
    "SELECT coalesce(shipper, '') AS shipper, count(DISTINCT order_id) AS orders FROM facts GROUP BY 1",
)
_mart(
    "b47_shipping_days_by_shipper", marts.shipping_days_by_shipper,
    f"SELECT coalesce(shipper, '') AS shipper, {_AVERAGE_DAYS} AS average_days FROM facts WHERE {_SHIPPED} GROUP BY 1",
)
_mart(
    "b48_employee_performance", marts.employee_performance,
    f"""SELECT e.employee_id, {_EMPLOYEE} AS employee, coalesce(e.title, '') AS title, count(DISTINCT order_id) AS orders,
        sum(quantity)::BIGINT AS units, {MONEY} AS revenue, {exact_ratio(f"sum({DAYS})", f"count({DAYS})")} AS avg_shipping_days
        FROM {_STAFF} GROUP BY 1, 2, 3""",
)
_mart(
    "b49_employee_territories", marts.employee_territories,
    f"""SELECT e.employee_id, {_EMPLOYEE} AS employee, t.territory_id, coalesce(t.territory_description, '') AS territory,
        coalesce(r.region_description, '') AS region FROM stg_employee_territories b
        JOIN stg_employees e USING (employee_id) JOIN stg_territories t USING (territory_id)
        LEFT JOIN stg_regions r USING (region_id)""",
)
_mart(
    "b50_shipper_service_levels", marts.shipper_service_levels,
    f"""SELECT coalesce(shipper, '') AS shipper, count(DISTINCT order_id) AS orders, {_ON_TIME} AS on_time_orders,
        {exact_ratio("100 * on_time_orders", "orders")} AS on_time_percent, {_AVERAGE_DAYS} AS avg_shipping_days
        FROM facts WHERE shipped_date IS NOT NULL AND required_date IS NOT NULL GROUP BY 1""",
)

# --- audits -----------------------------------------------------------------------------------

_PLACES = """(SELECT DISTINCT nullif(trim(country), '') AS country, nullif(trim(region), '') AS region,
  nullif(trim(city), '') AS city, postal_code FROM (
    SELECT country, region, city, postal_code FROM stg_customers UNION ALL
    SELECT country, region, city, postal_code FROM stg_employees UNION ALL
    SELECT country, region, city, postal_code FROM stg_suppliers UNION ALL
    SELECT ship_country, ship_region, ship_city, ship_postal_code FROM stg_orders))"""
_COUNTS = {
    "dim_customer": "stg_customers",
    "dim_date": """(SELECT unnest(generate_series((SELECT least(min(order_date), min(required_date), min(shipped_date))::DATE - 365 FROM stg_orders),
        (SELECT greatest(max(order_date), max(required_date), max(shipped_date))::DATE + 365 FROM stg_orders), INTERVAL 1 DAY)))""",
    "dim_employee": "stg_employees",
    "dim_geography": _PLACES,
    "dim_product": "stg_products",
    "dim_shipper": "stg_shippers",
    "dim_supplier": "stg_suppliers",
    "dim_territory": "stg_territories",
    "fact_employee_territories": "stg_employee_territories",
    "fact_orders": "facts",
}
_mart(
    "v01_table_counts",
    lambda star: quality.table_counts({t: star.latest(t) for t in TABLE_KEYS}).orderBy("table_name"),
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in _COUNTS.items()),
)
_mart(
    "v02_missing_lookups",
    lambda star: quality.unknown_members(star.latest("fact_orders")),
    """SELECT count(*) AS fact_rows, count(*) FILTER (product_id IS NULL) AS missing_product_lookup,
       count(*) FILTER (customer_id IS NULL) AS missing_customer_lookup, count(*) FILTER (employee_id IS NULL) AS missing_employee_lookup,
       count(*) FILTER (shipper_id IS NULL) AS missing_shipper_lookup, 0::BIGINT AS missing_geography_lookup,
       count(*) FILTER (shipped_date IS NULL) AS not_yet_shipped_lines FROM facts""",
)
_mart(
    "v03_orphan_keys",
    lambda star: quality.orphan_keys(
        star.latest("fact_orders"), {t: star.latest(t) for t, _ in quality.FACT_LOOKUPS.values()}
    ),
    f"""SELECT count(*) FILTER (product_id NOT IN (SELECT product_id FROM stg_products)) AS orphan_product_keys,
       count(*) FILTER (customer_id NOT IN (SELECT customer_id FROM stg_customers)) AS orphan_customer_keys,
       count(*) FILTER (employee_id NOT IN (SELECT employee_id FROM stg_employees)) AS orphan_employee_keys,
       count(*) FILTER (shipper_id NOT IN (SELECT shipper_id FROM stg_shippers)) AS orphan_shipper_keys,
       count(*) FILTER (NOT EXISTS (SELECT 1 FROM {_PLACES} g WHERE g.country IS NOT DISTINCT FROM nullif(trim(ship_country), '')
         AND g.region IS NOT DISTINCT FROM nullif(trim(ship_region), '') AND g.city IS NOT DISTINCT FROM ship_city
         AND g.postal_code IS NOT DISTINCT FROM ship_postal_code)) AS orphan_geography_keys FROM facts""",
)
_mart(
    "v04_top_products_all_versions", marts.top_products_all_versions,
    _top(f"product_name, sum(quantity)::BIGINT AS units_sold, {MONEY} AS net_sales", "facts", "1", "net_sales DESC, product_name", 10),
)

# --- change stream and control tables ---------------------------------------------------------

# Report range of the time-filtered queries; the last days of the events lie outside.
START, END = "2024-01-03 00:00:00", "2024-01-25 12:00:00"
_RANGE = f"received_at BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


def _health(name, build, sql):
    register(name, lambda inputs: build(inputs.adapter), with_prelude(sql, events=True, staging=False))


_health("h01_events_in_range", lambda a: health.events_in_range(a.raw_events(), START, END), f"SELECT count(*) AS events FROM raw_events WHERE {_RANGE}")
_health("h02_pending_consumer", lambda a: health.pending_consumer(a.raw_events()), "SELECT count(*) AS pending_consumer FROM raw_events WHERE processed_at IS NULL")
_health(
    "h03_pending_warehouse", lambda a: health.pending_warehouse(a.raw_events()),
    """SELECT count(*) AS pending_warehouse FROM raw_events
       WHERE processed_at IS NOT NULL AND processing_error IS NULL AND dw_processed_at IS NULL""",
)
_health(
    "h04_processing_errors", lambda a: health.processing_errors(a.raw_events()),
    "SELECT count(*) AS errors FROM raw_events WHERE processing_error IS NOT NULL OR dw_processing_error IS NOT NULL",
)
_health(
    "h05_consumer_latency", lambda a: health.consumer_latency(a.raw_events(), START, END),
    f"""SELECT coalesce({exact_ratio("sum(epoch_us(processed_at) - epoch_us(received_at))", "count(*)", 1000)}, 0) AS consumer_latency_ms
        FROM raw_events WHERE processed_at IS NOT NULL AND {_RANGE}""",
)
_health(
    "h06_warehouse_latency", lambda a: health.warehouse_latency(a.raw_events(), START, END),
    f"""SELECT coalesce({exact_ratio("sum(epoch_us(dw_processed_at) - epoch_us(processed_at))", "count(*)", 1000000)}, 0) AS dw_latency_seconds
        FROM raw_events WHERE processed_at IS NOT NULL AND dw_processed_at IS NOT NULL AND {_RANGE}""",
)
_health(
    "h07_throughput_per_minute", lambda a: health.throughput_per_minute(a.raw_events(), START, END),
    f"SELECT {moment("date_trunc('minute', received_at)")} AS minute, count(*) AS events FROM raw_events WHERE {_RANGE} GROUP BY 1",
)
_health(
    "h08_events_by_operation", lambda a: health.events_by_operation(a.raw_events(), START, END),
    f"SELECT operation_type AS operation, count(*) AS events FROM raw_events WHERE {_RANGE} GROUP BY 1",
)
_health(
    "h09_events_by_instance", lambda a: health.events_by_instance(a.raw_events(), START, END),
    f"SELECT capture_instance AS instance, count(*) AS events FROM raw_events WHERE {_RANGE} GROUP BY 1",
)
_health(
    "h10_service_state", lambda a: health.service_state(a.service_history()),
    f"""SELECT service_name, status, {moment("last_heartbeat")} AS last_heartbeat, last_error, {moment("updated_at")} AS updated_at
        FROM (SELECT CASE event_id % 3 WHEN 0 THEN 'cdc-consumer' WHEN 1 THEN 'cdc-producer' ELSE 'incremental-transform' END AS service_name,
          CASE WHEN processing_error IS NOT NULL THEN 'error' ELSE 'running' END AS status, received_at AS last_heartbeat,
          processing_error AS last_error, coalesce(processed_at, received_at) AS updated_at,
          row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id DESC) AS rn FROM raw_events) WHERE rn = 1""",
)
_health(
    "h11_recent_runs", lambda a: health.recent_runs(a.pipeline_runs()),
    f"""SELECT run_id, 'daily' AS pipeline_name, 'cdc' AS run_type, CASE WHEN failures > 3 THEN 'failed' ELSE 'success' END AS status,
        {moment("started_at")} AS started_at, {moment("finished_at")} AS finished_at, rows_read, rows_written,
        CASE WHEN failures > 3 THEN failures || ' events failed' END AS error_message
        FROM runs ORDER BY runs.started_at DESC, run_id DESC LIMIT 25""",
)
_health(
    "h12_latest_events",
    lambda a: health.latest_events(a.raw_events(), start=START, end=END),
    f"""SELECT event_id, capture_instance, operation_type,
        '{{"OrderID":' || order_id || CASE WHEN event_id % 2 = 1 THEN ',"ProductID":' || product_number ELSE '' END || '}}' AS business_key,
        {moment("received_at")} AS received_at, {moment("processed_at")} AS processed_at, {moment("dw_processed_at")} AS dw_processed_at,
        coalesce(processing_error, dw_processing_error) AS error
        FROM raw_events WHERE raw_events.{_RANGE} ORDER BY event_id DESC LIMIT 50""",
)
_health(
    "h13_latest_quality_results", lambda a: health.latest_quality_results(a.quality_results()),
    f"""SELECT run_id * 10 AS result_id, run_id, 'source_target_row_count' AS check_name, 'raw_events' AS table_name,
        CASE WHEN rows_read = rows_written THEN 'passed' ELSE 'failed' END AS status, rows_read::VARCHAR AS expected_value,
        rows_written::VARCHAR AS actual_value, {moment("finished_at")} AS checked_at FROM runs ORDER BY finished_at DESC, result_id DESC LIMIT 30""",
)
