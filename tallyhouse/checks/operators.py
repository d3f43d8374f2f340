"""Registered operators below the reports: functions, dimensions, facts, change handling and checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import functions as fn
from tallyhouse import session
from tallyhouse.checks.prelude import (
    canon,
    clean,
    day,
    moment,
    place_key,
    sha_hash,
    sha_key,
    with_prelude,
)
from tallyhouse.checks.registry import Inputs, register
from tallyhouse.operators import assets, changes, envelope, incremental, latest, quality, scd2
from tallyhouse.operators import dimensions as dims
from tallyhouse.operators.facts import Lookups
from tallyhouse.plans import publish_changes
from tallyhouse.plans.full_load import COUNT_GATES, Warehouse, expected_counts
from tallyhouse.plans.incremental_load import event_states, judged_events, outcome_states, with_states
from tallyhouse.plans.star import TABLE_KEYS
from tallyhouse.sources.bucketed import BucketedTable
from tallyhouse.sources.schemas import BY_NAME, CAPTURES
from tallyhouse.sources.snapshot import conform, stage
from tallyhouse.streaming import throughput

ORDERS, LINES = CAPTURES


def _add(name, build, sql=None, events=False):
    register(name, build, None if sql is None else with_prelude(sql, events=events))


# --- sources ----------------------------------------------------------------------------------


def _conformed(inputs: Inputs) -> DataFrame:
    """Territories under their source names, with the padding a fixed-width column has, read back."""
    spec = BY_NAME["territories"]
    source = inputs.staged("territories").toDF(*[spec.source_name(c) for c in spec.schema.names])
    return conform(source, spec)


_add(
    "s01_snapshot_read", _conformed,
    "SELECT territory_id, rtrim(territory_description) AS territory_description, region_id FROM stg_territories",
)
_add(
    "s07_staged_rows",
    lambda i: stage(i.staged("orders"), "batch", "2024-01-01 00:00:00").groupBy("_batch_id", "_loaded_at").agg(
        F.count("*").alias("rows"), F.count("shipped_date").alias("shipped"), F.sum("freight").alias("freight")
    ),
    """SELECT 'batch' AS _batch_id, '2024-01-01 00:00:00.000000' AS _loaded_at, count(*) AS rows,
       count(shipped_date) AS shipped, sum(freight)::DOUBLE AS freight FROM stg_orders""",
)

# --- functions --------------------------------------------------------------------------------

_add(
    "p01_canonical",
    lambda i: i.staged("customers").select("customer_id", *[fn.canonical(F.col(c)).alias(c) for c in ("contact_name", "region", "fax")]),
    f"SELECT customer_id, {canon('contact_name')} AS contact_name, {canon('region')} AS region, {canon('fax')} AS fax FROM stg_customers",
)
_add(
    "p02_clean_text",
    lambda i: i.staged("customers").select("customer_id", *[fn.clean_text(F.col(c)).alias(c) for c in ("contact_name", "region", "fax")]),
    f"SELECT customer_id, {clean('contact_name')} AS contact_name, {clean('region')} AS region, {clean('fax')} AS fax FROM stg_customers",
)
_add(
    "p03_surrogate_key",
    lambda i: i.staged("products").select(
        "product_id", fn.surrogate_key("product", F.col("product_id"), F.col("category_id"), method="sha2").alias("key")
    ),
    f"SELECT product_id, {sha_key('product', 'product_id', 'category_id')} AS key FROM stg_products",
)
# The default hash has no SQL twin: this one shows that keys are positive and do not collide here.
_add(
    "p03_default_key_range",
    lambda i: i.staged("orders").select(fn.surrogate_key("order", F.col("order_id")).alias("key")).agg(
        F.count("*").alias("rows"), F.count_distinct("key").alias("keys"), (F.min("key") > 0).alias("positive")
    ),
    "SELECT count(*) AS rows, count(DISTINCT order_id) AS keys, true AS positive FROM stg_orders",
)
_add(
    "p04_row_hash",
    lambda i: i.staged("products").select(
        "product_id", fn.content_hash(*map(F.col, ("product_name", "unit_price", "supplier_id"))).alias("hash")
    ),
    f"SELECT product_id, {sha_hash('product_name', 'unit_price', 'supplier_id')} AS hash FROM stg_products",
)
_SHIP = ("country", "region", "city", "postal_code", "address")
_add(
    "p05_geography_key",
    lambda i: i.staged("orders").select(
        "order_id", fn.geography_key(*[F.col(f"ship_{c}") for c in _SHIP], method="sha2").alias("geography_key")
    ),
    f"SELECT order_id, {place_key('ship_')} AS geography_key FROM stg_orders",
)


def _sql_date_key(column: str) -> str:
    return f"coalesce(strftime({column}, '%Y%m%d')::BIGINT, 0) AS {column}_key"


_add(
    "p06_date_key",
    lambda i: i.staged("orders").select("order_id", *[fn.date_key(F.col(c)).alias(f"{c}_key") for c in ("order_date", "shipped_date")]),
    f"SELECT order_id, {_sql_date_key('order_date')}, {_sql_date_key('shipped_date')} FROM stg_orders",
)
_add(
    "p08_defaults",
    lambda i: i.staged("products").select(
        "product_id",
        fn.or_zero(F.col("supplier_id"), "long").alias("supplier_id"),
        fn.or_zero(F.col("unit_price"), "decimal(19,4)").alias("unit_price"),
        fn.or_zero(F.col("discontinued").cast("int"), "short").alias("discontinued"),
    ),
    """SELECT product_id, coalesce(supplier_id, 0) AS supplier_id, unit_price::DOUBLE AS unit_price, discontinued FROM stg_products""",
)
_add(
    "p09_base64",
    lambda i: i.staged("employees").select("employee_id", fn.base64_text(F.col("photo")).alias("photo_base64")),
    "SELECT employee_id, coalesce(base64(photo), '') AS photo_base64 FROM stg_employees",
)
_add(
    "p13_month_minute_year",
    lambda i: i.adapter.raw_events().groupBy(
        fn.month_of(F.col("received_at")).alias("month"), fn.year_label(F.col("received_at")).alias("year")
    ).agg(F.count_distinct(fn.minute_of(F.col("received_at"))).alias("minutes")),
    f"""SELECT {day("date_trunc('month', received_at)")} AS month, year(received_at)::VARCHAR AS year,
        count(DISTINCT date_trunc('minute', received_at)) AS minutes FROM raw_events GROUP BY 1, 2""",
    events=True,
)
_add(
    "p16_days_and_latencies",
    lambda i: i.adapter.raw_events().groupBy("capture_instance").agg(
        F.sum(fn.days_between(F.col("received_at"), F.col("dw_processed_at"))).alias("days"),
        F.max(fn.elapsed_ms(F.col("received_at"), F.col("processed_at"))).alias("max_ms"),
        F.max(fn.elapsed_seconds(F.col("processed_at"), F.col("dw_processed_at"))).alias("max_seconds"),
    ),
    """SELECT capture_instance, sum(date_diff('day', received_at, dw_processed_at))::BIGINT AS days,
       max(epoch_us(processed_at) - epoch_us(received_at)) / 1000.0 AS max_ms,
       max(epoch_us(dw_processed_at) - epoch_us(processed_at)) / 1000000.0 AS max_seconds FROM raw_events GROUP BY 1""",
    events=True,
)
_BANDS = """CASE WHEN band = 0 THEN 'No Discount' WHEN band <= 0.10 THEN 'Up to 10%' WHEN band <= 0.20 THEN '10-20%' ELSE 'Over 20%' END"""
_add(
    "p18_bands",
    lambda i: i.staged("orders").select(
        fn.discount_band((F.col("order_id") % 27).cast("decimal(9,6)") / 100).alias("band"),
        fn.revenue_segment(F.col("freight") * 1000).alias("segment"),
    ).groupBy("band", "segment").agg(F.count("*").alias("orders")),
    f"""SELECT {_BANDS} AS band, CASE WHEN revenue >= 50000 THEN 'VIP' WHEN revenue >= 20000 THEN 'High Value'
        WHEN revenue >= 5000 THEN 'Medium Value' ELSE 'Standard' END AS segment, count(*) AS orders
        FROM (SELECT (order_id % 27)::DECIMAL(9,6) / 100 AS band, freight * 1000 AS revenue FROM stg_orders) GROUP BY 1, 2""",
)
_add(
    "p19_safe_ratio",
    lambda i: i.staged("products").groupBy("supplier_id").agg(
        fn.ratio(F.sum("units_in_stock"), F.sum(F.when(F.col("units_on_order") > 50, 1).otherwise(0))).alias("ratio")
    ),
    """SELECT supplier_id, CASE WHEN n = 0 THEN NULL ELSE ((s * 200 + n) // (2 * n))::DOUBLE / 100 END AS ratio FROM
       (SELECT supplier_id, sum(units_in_stock) AS s, count(*) FILTER (units_on_order > 50) AS n FROM stg_products GROUP BY 1)""",
)
_add(
    "p20_json_keys",
    lambda i: changes.event_keys(i.adapter.raw_events()).select("event_id", "order_id", "product_id"),
    "SELECT event_id, order_id, product_id FROM raw_events",
    events=True,
)
_add(
    "p21_operation_names",
    lambda i: i.adapter.raw_events().select(
        (F.col("event_id") % 6).alias("code"), fn.operation_name(F.col("event_id") % 6).alias("name")
    ).groupBy("code", "name").agg(F.count("*").alias("events")),
    """SELECT event_id % 6 AS code, CASE event_id % 6 WHEN 1 THEN 'DELETE' WHEN 2 THEN 'INSERT' WHEN 3 THEN 'UPDATE_BEFORE'
       WHEN 4 THEN 'UPDATE_AFTER' ELSE 'UNKNOWN' END AS name, count(*) AS events FROM raw_events GROUP BY 1, 2""",
    events=True,
)
_add(
    "p22_lsn_text",
    lambda i: i.adapter.raw_events().select(
        "event_id", fn.lsn_to_text(fn.text_to_lsn(F.lower("start_lsn"))).alias("lsn"), F.length(fn.text_to_lsn(F.col("start_lsn"))).alias("bytes")
    ),
    "SELECT event_id, start_lsn AS lsn, 10 AS bytes FROM raw_events",
    events=True,
)


def _envelopes(inputs: Inputs) -> DataFrame:
    """Line changes as stream records, with the fields of the envelope read back out of its JSON."""
    rows = inputs.adapter.raw_events().where(F.col("capture_instance") == LINES.instance)
    payload = F.from_json("payload", "OrderID long, ProductID int, UnitPrice string")
    change_rows = rows.withColumn("p", payload).select(
        "start_lsn", "seqval", "operation_code", F.unhex(F.lit("1F")).alias("update_mask"), "event_time",
        "p.OrderID", "p.ProductID", F.col("p.UnitPrice").cast("decimal(19,4)").alias("UnitPrice"),
    )
    records = envelope.build_envelopes(change_rows, LINES)

    def part(path: str, name: str):
        return F.get_json_object("value", f"$.{path}").alias(name)

    return records.select(
        "key", part("event_id", "event_id"), part("source_table", "source_table"), part("operation_type", "operation_type"),
        part("event_time", "event_time"), part("business_key", "business_key"), part("payload.UnitPrice", "unit_price"),
        part("metadata.update_mask", "update_mask"), F.element_at("headers", 1)["key"].alias("header"),
        F.element_at("headers", 1)["value"].cast("string").alias("header_value"),
    )


_add(
    "p23_envelopes", _envelopes,
    """SELECT order_id::VARCHAR AS key, 'dbo_Order_Details:' || start_lsn || ':' || start_lsn || ':' || operation_code AS event_id,
       'dbo.Order Details' AS source_table, operation_type,
       strftime(received_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(received_at) % 1000000 = 0 THEN '' ELSE strftime(received_at, '.%f') END AS event_time,
       '{"OrderID":' || order_id || ',"ProductID":' || product_number || '}' AS business_key, amount::VARCHAR AS unit_price,
       '0x1F' AS update_mask, 'capture_instance' AS header, 'dbo_Order_Details' AS header_value
       FROM raw_events WHERE capture_instance = 'dbo_Order_Details'""",
    events=True,
)

# --- dimensions and facts ---------------------------------------------------------------------

_PLACES = f"""places_all AS (
  SELECT DISTINCT {clean("country")} AS country, {clean("region")} AS region, {clean("city")} AS city,
    {clean("postal_code")} AS postal_code, {clean("address")} AS address FROM (
    SELECT country, region, city, postal_code, address FROM stg_customers UNION ALL
    SELECT country, region, city, postal_code, address FROM stg_employees UNION ALL
    SELECT country, region, city, postal_code, address FROM stg_suppliers UNION ALL
    SELECT ship_country, ship_region, ship_city, ship_postal_code, ship_address FROM stg_orders))"""
_PLACE = ("country", "region", "city", "postal_code", "address")
_CONTACT = ("company_name", "contact_name", "contact_title", "phone", "fax")


def _cleaned(*names: str) -> str:
    return ", ".join(f"{clean(n)} AS {n}" for n in names)


def _dim(name, table, sql):
    _add(name, lambda inputs: inputs.checked_table(table), sql)


_dim(
    "m01_dim_geography", "dim_geography",
    f"WITH {_PLACES} SELECT {sha_key('geography', *_PLACE)} AS geography_key, *, {sha_hash(*_PLACE)} AS source_hash FROM places_all",
)
_KEYED_CUSTOMERS = f"""customers_keyed AS (SELECT *, {sha_hash(*_CONTACT, "geography_key")} AS source_hash FROM (
    SELECT customer_id AS customer_alternate_key, {place_key()} AS geography_key, {_cleaned(*_CONTACT)} FROM stg_customers)),
  dim_customer AS (SELECT {sha_key("customer", "customer_alternate_key", "source_hash")} AS customer_key, *, 1 AS is_current FROM customers_keyed)"""
_dim("m02_dim_customer", "dim_customer", f"WITH {_KEYED_CUSTOMERS} SELECT * FROM dim_customer")
_PERSON = ("first_name", "last_name", "title", "title_of_courtesy", "birth_date", "hire_date", "home_phone", "extension")
_KEYED_EMPLOYEES = f"""employees_hashed AS (
    SELECT *, {sha_hash("reports_to", "geography_key", *_PERSON, "notes", "photo_path")} AS source_hash FROM (
      SELECT employee_id AS employee_alternate_key, reports_to, {place_key()} AS geography_key,
        {_cleaned("first_name", "last_name", "title", "title_of_courtesy", "home_phone", "extension", "notes")}, birth_date, hire_date,
        coalesce(base64(photo), '') AS photo_base64,
        '/data-lake/curated/employee-photos/employee_' || employee_id || '.bmp' AS photo_path FROM stg_employees)),
  employees_keyed AS (SELECT *, {sha_key("employee", "employee_alternate_key", "source_hash")} AS employee_key FROM employees_hashed),
  dim_employee AS (SELECT e.*, coalesce(m.employee_key, 0) AS parent_employee_key, 1 AS is_current
    FROM employees_keyed e LEFT JOIN employees_keyed m ON m.employee_alternate_key = e.reports_to)"""
_dim(
    "m03_dim_employee", "dim_employee",
    f"""WITH {_KEYED_EMPLOYEES} SELECT * REPLACE ({day("birth_date")} AS birth_date, {day("hire_date")} AS hire_date) FROM dim_employee""",
)
_KEYED_SUPPLIERS = f"""suppliers_hashed AS (
    SELECT *, {sha_hash("geography_key", *_CONTACT, "home_page")} AS source_hash FROM (
      SELECT supplier_id AS supplier_alternate_key, {place_key()} AS geography_key, {_cleaned(*_CONTACT, "home_page")} FROM stg_suppliers)),
  dim_supplier AS (SELECT {sha_key("supplier", "supplier_alternate_key", "source_hash")} AS supplier_key, *, 1 AS is_current FROM suppliers_hashed)"""
_dim("m04_dim_supplier", "dim_supplier", f"WITH {_KEYED_SUPPLIERS} SELECT * FROM dim_supplier")
_STOCK = ("unit_price", "units_in_stock", "units_on_order", "reorder_level", "discontinued")
_KEYED_PRODUCTS = f"""products_hashed AS (
    SELECT *, {sha_hash("supplier_key", "product_name", "category_name", "quantity_per_unit", *_STOCK)} AS source_hash FROM (
      SELECT product_id AS product_alternate_key, coalesce(s.supplier_key, 0) AS supplier_key,
        {_cleaned("product_name", "category_name", "quantity_per_unit")}, {", ".join(_STOCK)}
      FROM stg_products LEFT JOIN stg_categories USING (category_id)
      LEFT JOIN dim_supplier s ON s.supplier_alternate_key = supplier_id)),
  dim_product AS (SELECT {sha_key("product", "product_alternate_key", "source_hash")} AS product_key, *, 1 AS is_current FROM products_hashed)"""
_dim(
    "m05_dim_product", "dim_product",
    f"WITH {_KEYED_SUPPLIERS}, {_KEYED_PRODUCTS} SELECT * REPLACE (unit_price::DOUBLE AS unit_price) FROM dim_product",
)
_KEYED_SHIPPERS = f"""dim_shipper AS (SELECT {sha_key("shipper", "shipper_alternate_key")} AS shipper_key, *, {sha_hash("company_name", "phone")} AS source_hash
    FROM (SELECT shipper_id AS shipper_alternate_key, {_cleaned("company_name", "phone")} FROM stg_shippers))"""
_dim("m06_dim_shipper", "dim_shipper", f"WITH {_KEYED_SHIPPERS} SELECT * FROM dim_shipper")
_TERRITORY = ("region_description", "territory_description")
_KEYED_TERRITORIES = f"""territories_hashed AS (SELECT *, {sha_hash(*_TERRITORY)} AS source_hash FROM (
    SELECT territory_id AS territory_alternate_key, {_cleaned(*_TERRITORY)} FROM stg_territories LEFT JOIN stg_regions USING (region_id))),
  dim_territory AS (SELECT {sha_key("territory", "territory_alternate_key", "source_hash")} AS territory_key, *, 1 AS is_current FROM territories_hashed)"""
_dim("m07_dim_territory", "dim_territory", f"WITH {_KEYED_TERRITORIES} SELECT * FROM dim_territory")
_dim(
    "m08_dim_date", "dim_date",
    f"""WITH days AS (SELECT unnest(generate_series(
          (SELECT least(min(order_date), min(required_date), min(shipped_date))::DATE - 365 FROM stg_orders),
          (SELECT greatest(max(order_date), max(required_date), max(shipped_date))::DATE + 365 FROM stg_orders), INTERVAL 1 DAY)) AS d)
        SELECT strftime(d, '%Y%m%d')::BIGINT AS date_key, {day("d")} AS full_date_alternate_key, year(d) AS calendar_year,
          quarter(d) AS calendar_season, 'Q' || quarter(d) AS season_name, month(d) AS month_number_of_year, monthname(d) AS month_name,
          day(d) AS day_number_of_month, dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_of_week_name,
          CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend FROM days""",
)
_dim(
    "m09_fact_orders", "fact_orders",
    f"""WITH {_KEYED_CUSTOMERS}, {_KEYED_EMPLOYEES}, {_KEYED_SUPPLIERS}, {_KEYED_PRODUCTS}, {_KEYED_SHIPPERS}
        SELECT o.order_id, {place_key("ship_")} AS geography_key, coalesce(c.customer_key, 0) AS customer_key,
          coalesce(e.employee_key, 0) AS employee_key, coalesce(s.shipper_key, 0) AS shipper_key,
          {_sql_date_key("order_date")}, {_sql_date_key("required_date")}, {_sql_date_key("shipped_date")},
          o.freight::DOUBLE AS freight, {clean("o.ship_name")} AS ship_name, {moment("o.order_date")} AS order_date,
          {moment("o.required_date")} AS required_date, {moment("o.shipped_date")} AS shipped_date, p.product_key,
          d.unit_price::DOUBLE AS unit_price, d.quantity, d.discount::DOUBLE AS discount, 0 AS is_deleted, '' AS source_lsn
        FROM stg_orders o JOIN stg_order_details d USING (order_id) JOIN dim_product p ON p.product_alternate_key = d.product_id
        LEFT JOIN dim_customer c ON c.customer_alternate_key = o.customer_id
        LEFT JOIN dim_employee e ON e.employee_alternate_key = o.employee_id
        LEFT JOIN dim_shipper s ON s.shipper_alternate_key = o.ship_via""".replace(
        "coalesce(strftime(order_date", "coalesce(strftime(o.order_date"
    ).replace("strftime(required_date", "strftime(o.required_date").replace("strftime(shipped_date", "strftime(o.shipped_date"),
)
_dim(
    "m10_fact_employee_territories", "fact_employee_territories",
    f"""WITH {_KEYED_EMPLOYEES}, {_KEYED_TERRITORIES} SELECT e.employee_key, t.territory_key, 0 AS is_deleted, '' AS source_lsn
        FROM stg_employee_territories b JOIN dim_employee e ON e.employee_alternate_key = b.employee_id
        JOIN dim_territory t ON t.territory_alternate_key = b.territory_id""",
)


def _versions(inputs: Inputs) -> DataFrame:
    """Events as row versions of orders: the event number is the version, some versions are closed."""
    return inputs.adapter.raw_events().select(
        F.get_json_object("business_key", "$.OrderID").cast("long").alias("order_id"),
        F.col("event_id").alias("_version"),
        F.col("received_at").alias("_loaded_at"),
        (F.col("operation_code") == 1).cast("short").alias("is_deleted"),
        (F.col("operation_code") != 3).cast("short").alias("is_current"),
    )


_LATEST = """SELECT * FROM (SELECT order_id, event_id AS _version, received_at, operation_code,
    row_number() OVER (PARTITION BY order_id ORDER BY event_id DESC) AS rn FROM raw_events) WHERE rn = 1"""
_add(
    "m11_current_lookup",
    lambda i: latest.current_lookup(_versions(i).withColumn("key", F.col("_version") + 1), "order_id", "key"),
    f"SELECT order_id, _version + 1 AS key FROM ({_LATEST}) WHERE operation_code <> 3",
    events=True,
)
_add(
    "w01_latest_rows",
    lambda i: latest.latest_rows(_versions(i), ["order_id"]).select("order_id", "_version", "is_deleted"),
    f"SELECT order_id, _version, (operation_code = 1)::INT AS is_deleted FROM ({_LATEST})",
    events=True,
)
_add(
    "c07_live_rows",
    lambda i: latest.live_rows(_versions(i), ["order_id"]).select("order_id", "_version"),
    f"SELECT order_id, _version FROM ({_LATEST}) WHERE operation_code <> 1",
    events=True,
)


def _bucketed_latest(inputs: Inputs) -> DataFrame:
    """The older half of the versions as a bucketed base, the others as changes to it."""
    rows = _versions(inputs)
    middle = rows.agg((F.min("_version") + F.max("_version")) / 2).first()[0]
    newer = F.coalesce(F.col("_version") > F.lit(middle), F.lit(False))
    base, changes = rows.where(~newer), rows.where(newer)
    table = BucketedTable(inputs.spark, f"order_versions_{uuid.uuid4().hex[:12]}", f"{inputs.house.root}/bucketed", ["order_id"], 32)
    table.write(latest.latest_rows(base, ["order_id"]))
    return table.latest(changes).select("order_id", "_version", "is_deleted")


_add(
    "c07_bucketed_latest",
    _bucketed_latest,
    f"SELECT order_id, _version, (operation_code = 1)::INT AS is_deleted FROM ({_LATEST})",
    events=True,
)


def _history(inputs: Inputs) -> DataFrame:
    """Customers at one time, then changed, missing and new ones, merged twice."""
    before = dims.Load("before", "2024-01-01 00:00:00", 1, "sha2")
    after = dims.Load("after", "2024-02-01 00:00:00", 2, "sha2")
    customers = inputs.staged("customers")
    key = F.col("customer_id").cast("long")
    renamed = F.when(key % 7 == 0, F.concat("company_name", F.lit(" Ltd"))).otherwise(F.col("company_name"))
    fresh = customers.where(key % 5 == 0).withColumn("customer_id", F.concat(F.lit("N"), "customer_id"))
    snapshot = customers.where(key % 11 != 0).withColumn("company_name", renamed).unionByName(fresh)
    as_of = F.lit("2024-02-01 00:00:00")
    merged = dims.customer_dimension(customers, before)
    for _ in range(2):
        merged = scd2.scd2_merge(merged, dims.customer_dimension(snapshot, after), dims.CUSTOMER, as_of, close_missing=True)
    return merged.select("customer_alternate_key", "company_name", "start_date", "end_date", "is_current")


_T0, _T1 = "'2024-01-01 00:00:00.000000'", "'2024-02-01 00:00:00.000000'"
_add(
    "m12_scd2_merge", _history,
    f"""WITH k AS (SELECT *, customer_id::BIGINT AS n FROM stg_customers)
        SELECT customer_id AS customer_alternate_key, company_name, {_T0} AS start_date,
          CASE WHEN n % 7 = 0 OR n % 11 = 0 THEN {_T1} END AS end_date, CASE WHEN n % 7 = 0 OR n % 11 = 0 THEN 0 ELSE 1 END AS is_current FROM k
        UNION ALL SELECT customer_id, company_name || ' Ltd', {_T1}, NULL, 1 FROM k WHERE n % 7 = 0 AND n % 11 <> 0
        UNION ALL SELECT 'N' || customer_id, company_name, {_T1}, NULL, 1 FROM k WHERE n % 5 = 0""",
)


def _orders_with_versions(inputs: Inputs) -> DataFrame:
    """Orders with the customer's name and first day at the order's date: three loads, the second and third with changes."""
    days = ("1993-01-01", "1995-06-17", "1997-03-01")
    customers, key = inputs.staged("customers"), F.col("customer_id").cast("long")
    ltd = F.when(key % 7 == 0, F.concat("company_name", F.lit(" Ltd"))).otherwise(F.col("company_name"))
    snapshots = [
        customers.where(key % 13 != 0),
        customers.where(key % 11 != 0).withColumn("company_name", ltd),
        # Back to the old name, but for every third of the renamed; those that were gone are back.
        customers.withColumn("company_name", F.when(key % 3 == 0, ltd).otherwise(F.col("company_name"))),
    ]
    history = None
    for number, (moment, snapshot) in enumerate(zip(days, snapshots)):
        rows = dims.customer_dimension(snapshot, dims.Load("b", f"{moment} 00:00:00", number, "sha2"))
        history = rows if history is None else scd2.scd2_merge(history, rows, dims.CUSTOMER, F.lit(moment), close_missing=True)
    orders = inputs.staged("orders").select("order_id", "customer_id", "order_date")
    found = scd2.versions_at(
        orders, "customer_id", "order_date", history, dims.CUSTOMER, {"company_name": "company_name", "since": "start_date"}
    )
    return found.select("order_id", "company_name", "since")


_DAY0, _DAY1, _DAY2 = (f"'{d} 00:00:00.000000'" for d in ("1993-01-01", "1995-06-17", "1997-03-01"))
_add(
    "m12_versions_at_order_date", _orders_with_versions,
    f"""WITH k AS (SELECT *, customer_id::BIGINT AS n FROM stg_customers),
        spans AS (
          SELECT customer_id, company_name, {_DAY0} AS since, '' AS lo,
            CASE WHEN n % 11 = 0 OR n % 7 = 0 THEN {_DAY1} ELSE '9999' END AS hi FROM k WHERE n % 13 <> 0
          UNION ALL SELECT customer_id, company_name || CASE WHEN n % 7 = 0 THEN ' Ltd' ELSE '' END, {_DAY1},
            CASE WHEN n % 13 = 0 THEN '' ELSE {_DAY1} END, CASE WHEN n % 7 = 0 AND n % 3 <> 0 THEN {_DAY2} ELSE '9999' END
          FROM k WHERE n % 11 <> 0 AND (n % 13 = 0 OR n % 7 = 0)
          UNION ALL SELECT customer_id, company_name || CASE WHEN n % 7 = 0 AND n % 3 = 0 THEN ' Ltd' ELSE '' END, {_DAY2},
            CASE WHEN n % 11 = 0 AND n % 13 = 0 THEN '' ELSE {_DAY2} END, '9999'
          FROM k WHERE n % 11 = 0 OR (n % 7 = 0 AND n % 3 <> 0))
        SELECT o.order_id, s.company_name, s.since FROM stg_orders o LEFT JOIN spans s ON s.customer_id = o.customer_id
          AND strftime(o.order_date, '%Y-%m-%d %H:%M:%S.%f') >= s.lo AND strftime(o.order_date, '%Y-%m-%d %H:%M:%S.%f') < s.hi""",
)

_ASSETS = """WITH docs AS (SELECT doc_id, doc_id % 7 AS kind, encode(text) AS body, encode(repeat('w', 78)) AS wrapper FROM documents),
  assets AS (SELECT doc_id, kind, CASE kind
      WHEN 0 THEN unhex('89504E470D0A1A0A') || body WHEN 1 THEN unhex('FFD8FF') || body || unhex('FFD9')
      WHEN 2 THEN unhex('474946383761') || body
      WHEN 3 THEN unhex('424D3C000000000000003600000028000000' || repeat('00', 36)) || encode('pixels') END AS image,
    CASE kind WHEN 0 THEN wrapper || unhex('89504E470D0A1A0A') || body WHEN 1 THEN wrapper || unhex('FFD8FF') || body || unhex('FFD9') || wrapper
      WHEN 2 THEN unhex('474946383761') || body
      WHEN 3 THEN wrapper || unhex('424D3C000000000000003600000028000000' || repeat('00', 36)) || encode('pixels') || body
      WHEN 4 THEN body WHEN 5 THEN encode(repeat('w', 5000)) || unhex('89504E470D0A1A0A') || body END AS payload FROM docs)"""


def _carved(inputs: Inputs, search_window: int | None = None) -> DataFrame:
    return assets.carve_images(inputs.adapter.wrapped_images(), "payload", search_window)


# m13_carved_images and q11_asset_counts have the explicit window of the reference; the queries on whole payloads are by their side.
_WINDOW = 4096


_add(
    "m13_carved_images",
    lambda i: _carved(i, _WINDOW).select(
        "doc_id", "format", "extension", "signature_offset", F.octet_length("image").alias("image_bytes"), F.sha2("image", 256).alias("image_sha256")
    ),
    f"""{_ASSETS} SELECT doc_id, CASE WHEN kind = 6 THEN NULL ELSE ['png', 'jpeg', 'gif', 'bmp', 'unknown', 'unknown'][kind + 1] END AS format,
        CASE WHEN kind = 6 THEN NULL ELSE ['png', 'jpg', 'gif', 'bmp', 'bin', 'bin'][kind + 1] END AS extension,
        CASE WHEN kind = 6 THEN NULL WHEN kind IN (0, 1, 3) THEN 78 ELSE 0 END AS signature_offset,
        octet_length(coalesce(image, payload)) AS image_bytes, sha256(coalesce(image, payload)) AS image_sha256 FROM assets""",
)
_add(
    "m14_asset_manifest",
    lambda i: assets.asset_manifest(
        assets.carve_images(i.staged("employees"), "photo"), "employee_id", "photo", "employee-photos", ("last_name",)
    ).select("employee_id", "last_name", "raw_path", "curated_path", "format", "source_bytes", "source_sha256"),
    """SELECT employee_id, last_name, '/data-lake/raw/employee-photos/employee_' || employee_id || '.bin' AS raw_path,
       '/data-lake/curated/employee-photos/employee_' || employee_id || '.' || ['gif', 'png', 'jpg', 'bin'][(employee_id - 1) % 5 + 1] AS curated_path,
       ['gif', 'png', 'jpeg', 'unknown'][(employee_id - 1) % 5 + 1] AS format, octet_length(photo) AS source_bytes, sha256(photo) AS source_sha256
       FROM stg_employees WHERE photo IS NOT NULL""",
)
_add(
    "q11_asset_counts",
    lambda i: assets.assets_accepted(assets.asset_counts(_carved(i, _WINDOW), "payload")),
    f"""{_ASSETS} SELECT count(*) AS asset_rows, count(payload) AS raw_photos, count(*) FILTER (kind < 4) AS curated_images,
        count(*) FILTER (kind = 6) AS missing_photos, count(*) FILTER (kind IN (4, 5)) AS unknown_formats, false AS passed FROM assets""",
)
_add(
    "m13_whole_payload_images",
    lambda i: _carved(i).select(
        "doc_id", "format", "extension", "signature_offset", F.octet_length("image").alias("image_bytes"), F.sha2("image", 256).alias("image_sha256")
    ),
    f"""{_ASSETS}, whole AS (SELECT doc_id, kind, payload, CASE kind WHEN 5 THEN payload[5001:] ELSE coalesce(image, payload) END AS image FROM assets)
        SELECT doc_id, CASE WHEN kind = 6 THEN NULL ELSE ['png', 'jpeg', 'gif', 'bmp', 'unknown', 'png'][kind + 1] END AS format,
        CASE WHEN kind = 6 THEN NULL ELSE ['png', 'jpg', 'gif', 'bmp', 'bin', 'png'][kind + 1] END AS extension,
        CASE WHEN kind = 6 THEN NULL WHEN kind IN (0, 1, 3) THEN 78 WHEN kind = 5 THEN 5000 ELSE 0 END AS signature_offset,
        octet_length(image) AS image_bytes, sha256(image) AS image_sha256 FROM whole""",
)
_add(
    "q11_whole_payload_counts",
    lambda i: assets.assets_accepted(assets.asset_counts(_carved(i), "payload")),
    f"""{_ASSETS} SELECT count(*) AS asset_rows, count(payload) AS raw_photos, count(*) FILTER (kind IN (0, 1, 2, 3, 5)) AS curated_images,
        count(*) FILTER (kind = 6) AS missing_photos, count(*) FILTER (kind = 4) AS unknown_formats, false AS passed FROM assets""",
)

# --- change extraction ------------------------------------------------------------------------


def _log(inputs: Inputs) -> DataFrame:
    return inputs.adapter.raw_events().select("capture_instance", "start_lsn", "seqval", "operation_code", "event_time")


def _offset_marks(inputs: Inputs) -> DataFrame:
    """Marks as a past run left them: the middle of the log for orders, none for lines."""
    events = inputs.adapter.raw_events()
    done = events.where((F.col("capture_instance") == ORDERS.instance) & (F.col("received_at") < F.lit("2024-01-15").cast("timestamp")))
    return done.groupBy("capture_instance").agg(
        F.max("start_lsn").alias("last_start_lsn"),
        F.max_by("seqval", "start_lsn").alias("last_seqval"),
        F.max_by("event_time", "start_lsn").alias("last_commit_time"),
    )


_MARK = "(SELECT max(start_lsn) FROM raw_events WHERE capture_instance = 'dbo_Orders' AND received_at < TIMESTAMP '2024-01-15')"
_END = "(SELECT max(start_lsn) FROM raw_events)"
_READING = f"(capture_instance = 'dbo_Order_Details' OR start_lsn > {_MARK})"
_add(
    "c01_change_ranges",
    lambda i: envelope.resolve_ranges(_log(i), _offset_marks(i), "earliest"),
    f"""SELECT 'dbo_Orders' AS capture_instance, 'read' AS action, false AS from_start, {_MARK} AS after_lsn, {_END} AS to_lsn
        UNION ALL SELECT 'dbo_Order_Details', 'read', true, NULL, {_END}""",
    events=True,
)
_add(
    "c02_changes_in_order",
    lambda i: envelope.in_log_order(
        envelope.changes_in(_log(i), envelope.resolve_ranges(_log(i), _offset_marks(i), "earliest"))
    ),
    f"""SELECT capture_instance, start_lsn, start_lsn AS seqval, operation_code, {moment("received_at")} AS event_time
        FROM raw_events WHERE {_READING}""",
    events=True,
)


def _advanced(inputs: Inputs) -> DataFrame:
    log, marks = _log(inputs), _offset_marks(inputs)
    ranges = envelope.resolve_ranges(log, marks, "earliest")
    polled = F.lit("2024-03-01 00:00:00").cast("timestamp")
    return envelope.advance_marks(ranges, marks, envelope.changes_in(log, ranges), polled)


_add(
    "c03_advanced_marks", _advanced,
    f"""SELECT capture_instance, {_END} AS last_start_lsn, max(start_lsn) AS last_seqval, {moment("max(received_at)")} AS last_commit_time,
        'running' AS status, count(*) AS last_event_count, '2024-03-01 00:00:00.000000' AS last_polled_at
        FROM raw_events WHERE {_READING} GROUP BY 1""".replace("max(received_at)", "max_by(received_at, start_lsn)"),
    events=True,
)

_CUT = "(SELECT max(start_lsn) FROM raw_events WHERE received_at < TIMESTAMP '2024-01-15')"
_POLLED = ("first", "expired", "reset", "idle", "read", "quiet")


def _poll_log(inputs: Inputs) -> DataFrame:
    """The log dealt to five instances; `quiet` has no rows in it."""
    names = F.array(*map(F.lit, _POLLED[:5]))
    return inputs.adapter.raw_events().withColumn("capture_instance", F.element_at(names, (F.col("event_id") % 5 + 1).cast("int")))


def _poll_marks(inputs: Inputs) -> DataFrame:
    """No mark for `first`; the others' before the log, past its end, at its end, and within it."""
    log = _poll_log(inputs)
    part = log.where(F.col("received_at") < F.lit("2024-01-15").cast("timestamp")).agg(F.max("start_lsn").alias("mid"))
    ends = log.agg(F.max("start_lsn").alias("last")).join(part)
    marks = {"expired": F.lit(envelope.BEFORE_LOG), "reset": F.concat(F.lit("0x1"), F.substring("last", 4, 19)), "idle": F.col("last"), "read": F.col("mid"), "quiet": F.col("mid")}
    rows = F.array(*(F.struct(F.lit(k).alias("capture_instance"), v.alias("last_start_lsn"), F.lit("s").alias("last_seqval"), F.lit("2024-01-01").cast("timestamp").alias("last_commit_time")) for k, v in marks.items()))
    return ends.select(F.inline(rows))


def _poll_ranges(inputs: Inputs) -> DataFrame:
    return envelope.resolve_ranges(_poll_log(inputs).select("capture_instance", "start_lsn"), _poll_marks(inputs), "latest", _POLLED)


_POLLS = """m AS (SELECT max(start_lsn) AS last, max(start_lsn) FILTER (received_at < TIMESTAMP '2024-01-15') AS mid FROM raw_events),
    polls AS (SELECT unnest(['first', 'expired', 'reset', 'idle', 'read', 'quiet']) AS capture_instance,
      unnest(['skip_to_latest', 'read', 'reset', 'idle', 'read', 'read']) AS action, unnest([true, true, false, false, false, false]) AS from_start,
      unnest([NULL, '0x' || repeat('0', 20), '0x1' || last[4:], last, mid, mid]) AS after_lsn, last AS to_lsn FROM m)"""
_add(
    "c01_poll_actions", _poll_ranges,
    f"WITH {_POLLS} SELECT * FROM polls",
    events=True,
)
_add(
    "c03_poll_marks",
    lambda i: envelope.advance_marks(
        _poll_ranges(i), _poll_marks(i), envelope.changes_in(_poll_log(i), _poll_ranges(i)), F.lit("2024-03-01 00:00:00").cast("timestamp")
    ),
    f"""WITH {_POLLS}, read AS (SELECT capture_instance, count(*) AS n, max(start_lsn) AS seqval, max_by(received_at, event_id) AS seen
        FROM raw_events e JOIN polls p ON p.capture_instance = ['first', 'expired', 'reset', 'idle', 'read'][e.event_id % 5 + 1]
        WHERE action = 'read' AND (from_start OR start_lsn > after_lsn) GROUP BY 1)
        SELECT p.capture_instance, to_lsn AS last_start_lsn, CASE WHEN action IN ('read', 'idle') THEN coalesce(seqval, 's') END AS last_seqval,
        {moment("coalesce(seen, CASE WHEN p.capture_instance <> 'first' THEN TIMESTAMP '2024-01-01' END)")} AS last_commit_time, 'running' AS status,
        coalesce(n, 0) AS last_event_count, '2024-03-01 00:00:00.000000' AS last_polled_at FROM polls p LEFT JOIN read r USING (capture_instance)""".replace(
        "(SELECT capture_instance, count", "(SELECT p.capture_instance, count"
    ),
    events=True,
)


def _source_changes(inputs: Inputs, instance: str) -> DataFrame:
    """Change rows of a captured table under its source names."""
    rows = inputs.adapter.raw_events().where(F.col("capture_instance") == instance)
    fields = "OrderID long, CustomerID string, Freight string" if instance == ORDERS.instance else "OrderID long, ProductID int, UnitPrice string"
    meta = ["start_lsn", "seqval", "operation_code", F.unhex(F.lit("1F")).alias("update_mask"), "event_time"]
    return rows.withColumn("p", F.from_json("payload", fields)).select(*meta, "p.*")


def _published(inputs: Inputs) -> DataFrame:
    """What the publishing job leaves in its sink: the log in two parts as it grows, and an idle poll."""
    house = Warehouse(inputs.spark, f"{session.shared_folder(inputs.spark)}/publish-{uuid.uuid4().hex}")
    sink = publish_changes.FileSink(inputs.spark, f"{house.root}/records")
    half = inputs.adapter.raw_events().where(F.col("received_at") < F.lit("2024-01-15").cast("timestamp")).agg(F.max("start_lsn")).first()[0]
    for end in (half, None, None):
        publish_changes.publish_changes(
            house, lambda instance, end=end: _source_changes(inputs, instance).where(F.lit(True) if end is None else F.col("start_lsn") <= end), sink, "earliest"
        )
    value = lambda path: F.get_json_object("value", f"$.{path}")
    return sink.read().select(
        "poll", "topic", "key", value("event_id").alias("event_id"), value("operation_type").alias("operation_type"),
        value("business_key").alias("business_key"), F.element_at("headers", 1)["value"].cast("string").alias("instance"),
    )


_add(
    "s09_published_records", _published,
    f"""SELECT CASE WHEN start_lsn <= {_CUT} THEN 1 ELSE 2 END AS poll, CASE capture_instance WHEN 'dbo_Orders' THEN 'orders.cdc' ELSE 'order_details.cdc' END AS topic,
        order_id::VARCHAR AS key, capture_instance || ':' || start_lsn || ':' || start_lsn || ':' || operation_code AS event_id, operation_type,
        '{{"OrderID":' || order_id || CASE capture_instance WHEN 'dbo_Orders' THEN '' ELSE ',"ProductID":' || product_number END || '}}' AS business_key,
        capture_instance AS instance FROM raw_events""",
    events=True,
)

# --- change application -----------------------------------------------------------------------

_MESSAGES = """messages AS (SELECT *, CASE WHEN event_id % 53 = 0 THEN 'message value is empty' WHEN event_id % 31 = 0 THEN 'invalid JSON message'
    WHEN event_id % 37 = 0 THEN 'message is not a JSON object' WHEN event_id % 41 = 0 THEN 'unsupported capture instance'
    WHEN event_id % 43 = 0 THEN 'unsupported operation_code' WHEN event_id % 47 = 0 THEN 'metadata.start_lsn is missing' END AS reason,
    unnest([event_id * 2, event_id * 2 + 1]) AS pos FROM raw_events)"""


def _parsed(inputs: Inputs) -> DataFrame:
    return changes.parse_messages(inputs.adapter.messages())


_add(
    "c04_reject_reasons",
    lambda i: _parsed(i).groupBy("reject_reason").agg(F.count("*").alias("messages")),
    f"WITH {_MESSAGES} SELECT reason AS reject_reason, count(*) AS messages FROM messages GROUP BY 1",
    events=True,
)
_add(
    "s10_dead_letters",
    lambda i: changes.dead_letters(_parsed(i), F.lit("2024-03-01 00:00:00").cast("timestamp")).select(
        "failed_at", "source_topic", "source_offset", "key", "error", F.col("raw_value").isNull().alias("empty")
    ),
    f"""WITH {_MESSAGES} SELECT '2024-03-01 00:00:00.000000' AS failed_at,
        CASE WHEN event_id % 2 = 0 THEN 'orders.cdc' ELSE 'order_details.cdc' END AS source_topic, pos AS source_offset,
        event_id::VARCHAR AS key, reason AS error, event_id % 53 = 0 AS empty FROM messages WHERE reason IS NOT NULL""",
    events=True,
)
_add(
    "c06_unseen_events",
    lambda i: changes.unseen(
        changes.accepted(_parsed(i)), i.adapter.raw_events().where(F.col("received_at") < F.lit("2024-01-10").cast("timestamp"))
    ).select("event_id", "operation_type", "offset", "event_time"),
    f"""WITH {_MESSAGES} SELECT capture_instance || ':' || start_lsn || ':' || start_lsn || ':' || operation_code AS event_id, operation_type,
        event_id * 2 AS offset, {moment("date_trunc('second', received_at)")} AS event_time FROM messages
        WHERE reason IS NULL AND pos % 2 = 0 AND received_at >= TIMESTAMP '2024-01-10'""",
    events=True,
)


def _batch(inputs: Inputs) -> DataFrame:
    return inputs.adapter.raw_events().where("processed_at IS NOT NULL AND processing_error IS NULL")


def _batch_aside(inputs: Inputs) -> DataFrame:
    """The batch as the incremental load keeps it: written once, as its parts are read many times."""
    return inputs.aside("batch", lambda: _batch(inputs).select(*changes.EVENT_IDENTITY, "business_key", "payload"))


def _orders_now(inputs: Inputs, events: DataFrame | None = None) -> DataFrame:
    events = _batch(inputs) if events is None else events
    return changes.apply_changes(inputs.staged("orders"), changes.row_changes(events, ORDERS), ["order_id"])


def _lines_now(inputs: Inputs, events: DataFrame | None = None) -> DataFrame:
    events, staged = _batch(inputs) if events is None else events, BY_NAME["order_details"]
    return changes.apply_changes(inputs.staged("order_details"), changes.row_changes(events, LINES), staged.keys)


_NOW = """batch AS (SELECT * FROM raw_events WHERE processed_at IS NOT NULL AND processing_error IS NULL),
  order_changes AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_id DESC) AS rn
    FROM batch WHERE capture_instance = 'dbo_Orders' AND operation_code <> 3) WHERE rn = 1),
  line_changes AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY event_id DESC) AS rn
    FROM batch WHERE capture_instance = 'dbo_Order_Details' AND operation_code <> 3) WHERE rn = 1),
  orders_now AS (SELECT order_id, customer_id, employee_id, ship_via, freight, ship_name, order_date FROM stg_orders
      WHERE order_id NOT IN (SELECT order_id FROM order_changes)
    UNION ALL SELECT order_id, (order_id % 50)::VARCHAR, product_number % 9 + 1, product_number % 5 + 1, amount, 'Changed',
      date_trunc('second', received_at) FROM order_changes WHERE operation_code <> 1),
  lines_now AS (SELECT d.* FROM stg_order_details d LEFT JOIN line_changes c ON c.order_id = d.order_id AND c.product_id = d.product_id
      WHERE c.order_id IS NULL
    UNION ALL SELECT order_id, product_id, amount, product_number % 20 + 1, ((product_number % 5) / 20)::DECIMAL(9,6)
      FROM line_changes WHERE operation_code <> 1)"""
_add(
    "p25_decoded_changes",
    lambda i: changes.row_changes(_batch(i), ORDERS).select(
        "start_lsn", "operation_code", "is_deleted", "order_id", "customer_id", "employee_id", "order_date", "freight"
    ),
    f"""WITH {_NOW} SELECT start_lsn, operation_code, (operation_code = 1)::INT AS is_deleted, order_id,
        CASE WHEN operation_code <> 1 THEN (order_id % 50)::VARCHAR END AS customer_id,
        CASE WHEN operation_code <> 1 THEN product_number % 9 + 1 END AS employee_id,
        CASE WHEN operation_code <> 1 THEN {moment("date_trunc('second', received_at)")} END AS order_date,
        CASE WHEN operation_code <> 1 THEN amount::DOUBLE END AS freight
        FROM batch WHERE capture_instance = 'dbo_Orders' AND operation_code <> 3""",
    events=True,
)
_add(
    "c08_orders_after_changes",
    lambda i: _orders_now(i).select("order_id", "customer_id", "employee_id", "ship_via", "freight", "ship_name", "order_date"),
    f"WITH {_NOW} SELECT * REPLACE (freight::DOUBLE AS freight, {moment('order_date')} AS order_date) FROM orders_now",
    events=True,
)
_add(
    "c08_lines_after_changes",
    lambda i: _lines_now(i).withColumn("discount", F.col("discount").cast("decimal(9,6)")),
    f"WITH {_NOW} SELECT * REPLACE (unit_price::DOUBLE AS unit_price, discount::DOUBLE AS discount) FROM lines_now",
    events=True,
)
def _lines_after_cut(inputs: Inputs) -> DataFrame:
    """Lines of a snapshot that holds the log up to a position: older changes are in it already and are not applied again."""
    batch = _batch(inputs)
    cut = inputs.adapter.raw_events().where(F.col("received_at") < F.lit("2024-01-15").cast("timestamp")).agg(F.max("start_lsn")).first()[0]
    rows = changes.apply_changes(inputs.staged("order_details"), changes.row_changes(batch, LINES), BY_NAME["order_details"].keys, cut or "")
    return rows.withColumn("discount", F.col("discount").cast("decimal(9,6)"))


_add(
    "c09_lines_after_snapshot", _lines_after_cut,
    f"WITH {_NOW.replace('processing_error IS NULL),', f'processing_error IS NULL AND start_lsn > {_CUT}),', 1)} "
    "SELECT * REPLACE (unit_price::DOUBLE AS unit_price, discount::DOUBLE AS discount) FROM lines_now",
    events=True,
)
_add(
    "c11_pending_events",
    lambda i: changes.pending(i.adapter.raw_events()).select("event_id", "capture_instance", "start_lsn"),
    """SELECT event_id, capture_instance, start_lsn FROM raw_events
       WHERE processed_at IS NOT NULL AND processing_error IS NULL AND dw_processed_at IS NULL""",
    events=True,
)
_add(
    "o03_bounded_batch",
    lambda i: changes.pending(i.adapter.raw_events(), 500).select("event_id", "start_lsn"),
    """SELECT event_id, start_lsn FROM raw_events WHERE processed_at IS NOT NULL AND processing_error IS NULL
       AND dw_processed_at IS NULL ORDER BY event_id LIMIT 500""",
    events=True,
)
_add(
    "c12_invalid_keys",
    lambda i: quality.invalid_keys(changes.event_keys(i.adapter.raw_events())),
    "SELECT count(*) FILTER (order_id IS NULL) AS invalid_events FROM raw_events",
    events=True,
)
_add(
    "c13_affected_orders",
    lambda i: incremental.affected_orders(changes.event_keys(_batch(i))),
    f"WITH {_NOW} SELECT DISTINCT order_id FROM batch",
    events=True,
)
_add(
    "j07_orders_of_affected",
    lambda i: i.staged("orders").join(incremental.affected_orders(changes.event_keys(_batch(i))), "order_id", "left_semi").select("order_id", "freight"),
    f"WITH {_NOW} SELECT order_id, freight::DOUBLE AS freight FROM stg_orders WHERE order_id IN (SELECT order_id FROM batch)",
    events=True,
)
_add(
    "w02_latest_event_per_order",
    lambda i: incremental.latest_event_per_order(changes.event_keys(_batch(i))).select("order_id", "start_lsn"),
    f"WITH {_NOW} SELECT order_id, max(start_lsn) AS start_lsn FROM batch GROUP BY 1",
    events=True,
)
_add(
    "w03_deleted_orders",
    lambda i: incremental.deleted_orders(changes.event_keys(_batch(i))).select("order_id", "start_lsn"),
    f"""WITH {_NOW} SELECT order_id, max(start_lsn) AS start_lsn FROM batch
        WHERE capture_instance = 'dbo_Orders' AND operation_code = 1 GROUP BY 1""",
    events=True,
)


def _product_ids(inputs: Inputs, rows: DataFrame) -> DataFrame:
    """Fact rows under their product id instead of its key."""
    products = inputs.star_table("dim_product").selectExpr("product_key", "product_alternate_key AS product_id")
    return rows.join(products, "product_key").select(
        "order_id", "product_id", "unit_price", "quantity", "discount", "freight", "ship_name", "is_deleted", "source_lsn"
    )


def _fact_batch(inputs: Inputs) -> incremental.FactBatch:
    lookups = Lookups.current(inputs.star_table)
    events = _batch_aside(inputs)
    return incremental.incremental_facts(
        events, _orders_now(inputs, events), _lines_now(inputs, events), lookups, inputs.star.facts
    )


_INCREMENT = f"""WITH {_NOW},
  upserts AS (SELECT o.order_id, l.product_id, l.unit_price, l.quantity, l.discount, o.freight, o.ship_name, 0 AS is_deleted, e.last_event AS event
    FROM orders_now o JOIN lines_now l USING (order_id) JOIN stg_products USING (product_id)
    JOIN (SELECT order_id, max(event_id) AS last_event FROM batch GROUP BY 1) e USING (order_id)),
  line_tombstones AS (SELECT f.order_id, f.product_id, f.unit_price, f.quantity, f.discount, f.freight, f.ship_name, 1 AS is_deleted, d.event
    FROM facts f JOIN (SELECT order_id, product_id, max(event_id) AS event FROM batch
      WHERE capture_instance = 'dbo_Order_Details' AND operation_code = 1 GROUP BY 1, 2) d ON d.order_id = f.order_id AND d.product_id = f.product_id),
  order_tombstones AS (SELECT f.order_id, f.product_id, f.unit_price, f.quantity, f.discount, f.freight, f.ship_name, 1 AS is_deleted, d.event
    FROM facts f JOIN (SELECT order_id, max(event_id) AS event FROM batch
      WHERE capture_instance = 'dbo_Orders' AND operation_code = 1 GROUP BY 1) d ON d.order_id = f.order_id),
  winners AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY event DESC, is_deleted) AS rn FROM (
    SELECT * FROM upserts UNION ALL SELECT * FROM line_tombstones UNION ALL SELECT * FROM order_tombstones)) WHERE rn = 1)"""


def _increment(name, part, table):
    _add(
        name,
        lambda i: _product_ids(i, getattr(_fact_batch(i), part)),
        f"""{_INCREMENT} SELECT order_id, product_id, unit_price::DOUBLE AS unit_price, quantity, discount::DOUBLE AS discount,
            freight::DOUBLE AS freight, ship_name, is_deleted, '0x' || printf('%020X', event) AS source_lsn FROM {table}""",
        events=True,
    )


_increment("c14_upserts", "upserts", "upserts")
_increment("c15_line_tombstones", "line_tombstones", "line_tombstones")
_increment("c16_order_tombstones", "order_tombstones", "order_tombstones")
_increment("c17_winners", "output", "winners")


def _event_state(inputs: Inputs) -> DataFrame:
    """Two failed tries of early events, then success of a part of them."""
    events = inputs.adapter.raw_events().drop("dw_processed_at", "dw_processing_error")
    early = events.where(F.col("received_at") < F.lit("2024-01-10").cast("timestamp"))
    states = event_states(early, "b1", "boom").unionByName(event_states(early.where("event_id % 3 = 0"), "b2"))
    rows = with_states(events, states)
    return rows.select("event_id", "dw_batch_id", "dw_processing_error", "dw_attempt_count", F.col("dw_processed_at").isNotNull().alias("done"))


_add(
    "c18_event_states", _event_state,
    """SELECT event_id, CASE WHEN early AND event_id % 3 = 0 THEN 'b2' WHEN early THEN 'b1' END AS dw_batch_id,
       CASE WHEN early AND event_id % 3 <> 0 THEN 'boom' END AS dw_processing_error,
       CASE WHEN early AND event_id % 3 = 0 THEN 2 WHEN early THEN 1 ELSE 0 END AS dw_attempt_count, early AND event_id % 3 = 0 AS done
       FROM (SELECT event_id, received_at < TIMESTAMP '2024-01-10' AS early FROM raw_events)""",
    events=True,
)


def _outcomes(inputs: Inputs) -> DataFrame:
    """What becomes of each event where some name no order and a seventh of the products is not known."""
    damaged = F.col("event_id") % 89 == 0
    events = _batch(inputs).drop("dw_processed_at", "dw_processing_error").withColumns(
        {c: F.when(damaged, "{}").otherwise(F.col(c)) for c in ("business_key", "payload")}
    )
    products = inputs.staged("products").where("product_id % 7 <> 0").select("product_id")
    judged = judged_events(events, _orders_now(inputs), _lines_now(inputs), products)
    rows = with_states(events, outcome_states(judged, "b1"))
    return rows.select("event_id", "dw_processing_error", "dw_dead", F.col("dw_processed_at").isNotNull().alias("done"), "dw_attempt_count")


_add(
    "c18_event_outcomes", _outcomes,
    f"""WITH {_NOW}, broken AS (SELECT DISTINCT order_id FROM lines_now JOIN orders_now USING (order_id)
          WHERE product_id NOT IN (SELECT product_id FROM stg_products WHERE product_id % 7 <> 0)),
        judged AS (SELECT event_id, CASE WHEN event_id % 89 = 0 THEN 'no valid order id'
          WHEN order_id IN (SELECT order_id FROM broken) THEN 'unknown product in the order' END AS reason FROM batch)
        SELECT event_id, reason AS dw_processing_error, reason IS NOT NULL AS dw_dead, reason IS NULL AS done, 1 AS dw_attempt_count FROM judged""",
    events=True,
)
_add(
    "q13_stream_positions",
    lambda i: _parsed(i).groupBy("topic", "partition").agg(F.max("offset").alias("offset"), F.count("*").alias("messages")),
    f"""WITH {_MESSAGES} SELECT CASE WHEN event_id % 2 = 0 THEN 'orders.cdc' ELSE 'order_details.cdc' END AS topic, order_id % 4 AS partition,
        max(pos) AS offset, count(*) AS messages FROM messages GROUP BY 1, 2""",
    events=True,
)



def _corrected(inputs: Inputs) -> DataFrame:
    """Events per hour of a stream whose batches overlap in time, so that many rows come late; corrections included."""
    house = Warehouse(inputs.spark, f"{session.shared_folder(inputs.spark)}/throughput-{uuid.uuid4().hex}")
    events = inputs.adapter.raw_events().select("event_id", "received_at")
    for part in range(4):
        throughput.take_batch(house, events.where(F.col("event_id") % 4 == part), "s", part, "2 days", "1 hour")
    found = throughput.windows(house, "s", "2 days")
    late = throughput.late_rows(house, "s").groupBy(F.date_trunc("hour", "received_at").alias("window_start")).agg(F.count("*").alias("late_rows"))
    return found.join(late, "window_start", "left").select("window_start", "events", "corrections", "total", F.coalesce("late_rows", F.lit(0)).alias("late_rows"), "closed")


_add(
    "c21_corrected_throughput", _corrected,
    f"""WITH r AS (SELECT event_id % 4 AS part, received_at, date_trunc('hour', received_at)::TIMESTAMP AS w FROM raw_events),
        marks AS (SELECT p AS part, (SELECT max(received_at) - INTERVAL 2 DAY FROM r WHERE part < p) AS mark FROM range(4) x(p)),
        f AS (SELECT w, count(*) AS total, count(*) FILTER (w + INTERVAL 1 HOUR <= mark) AS late FROM r JOIN marks USING (part) GROUP BY w)
        SELECT {moment("w")} AS window_start, total - late AS events, late AS corrections, total, late AS late_rows,
        w + INTERVAL 1 HOUR <= (SELECT max(received_at) - INTERVAL 2 DAY FROM r) AS closed FROM f""",
    events=True,
)

# --- joins and checks -------------------------------------------------------------------------

_add(
    "j01_header_lines",
    lambda i: i.staged("orders").join(i.staged("order_details"), "order_id").groupBy("ship_country").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("quantity")
    ),
    """SELECT ship_country, count(*) AS lines, sum(quantity)::BIGINT AS quantity
       FROM stg_orders JOIN stg_order_details USING (order_id) GROUP BY 1""",
)
_GATED = {
    "customers": "dim_customer", "products": "dim_product", "suppliers": "dim_supplier", "employees": "dim_employee",
    "order_details": "fact_orders",
}
_add(
    "q01_reconciled_counts",
    lambda i: quality.reconcile(
        {target: i.staged(source) for source, target in _GATED.items()}, {t: i.star_table(t) for t in _GATED.values()}
    ),
    " UNION ALL ".join(
        f"""SELECT 'source_target_row_count' AS check_name, '{target}' AS table_name, 'passed' AS status,
            count(*)::VARCHAR AS expected_value, count(*)::VARCHAR AS actual_value FROM stg_{source}"""
        for source, target in _GATED.items()
    ),
)


def _star_counts(inputs: Inputs) -> DataFrame:
    """The gate of all ten star tables, of which two have lost rows and one has too many."""
    tables = {name: inputs.star_table(name) for name in TABLE_KEYS}
    tables["fact_orders"] = tables["fact_orders"].where("order_id % 7 <> 0")
    tables["dim_geography"] = tables["dim_geography"].where("country <> 'ASIA'")
    tables["dim_date"] = tables["dim_date"].unionByName(tables["dim_date"].where("date_key % 100 = 31"))
    return quality.compare_counts(expected_counts(inputs.staged, list(TABLE_KEYS)), quality.table_counts(tables))


_SAME = {t: f"stg_{s}" for t, s in COUNT_GATES.items() if t != "fact_orders"}
_add(
    "q03_star_row_counts", _star_counts,
    f"""WITH {_PLACES}, days AS (SELECT min(least(order_date, required_date, coalesce(shipped_date, order_date)))::DATE AS a,
          max(greatest(order_date, required_date, coalesce(shipped_date, order_date)))::DATE AS b FROM stg_orders),
        spine AS (SELECT unnest(generate_series(a - INTERVAL 365 DAY, b + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS d FROM days),
        c AS ({" UNION ALL ".join(f"SELECT '{t}' AS t, (SELECT count(*) FROM {s}) AS e, (SELECT count(*) FROM {s}) AS a" for t, s in _SAME.items())}
          UNION ALL SELECT 'fact_orders', (SELECT count(*) FROM stg_order_details), (SELECT count(*) FROM stg_order_details WHERE order_id % 7 <> 0)
          UNION ALL SELECT 'dim_geography', (SELECT count(*) FROM places_all), (SELECT count(*) FROM places_all WHERE country <> 'ASIA')
          UNION ALL SELECT 'dim_date', (SELECT count(*) FROM spine), (SELECT count(*) + count(*) FILTER (day(d) = 31) FROM spine))
        SELECT 'source_target_row_count' AS check_name, t AS table_name, CASE WHEN e = a THEN 'passed' ELSE 'failed' END AS status,
          e::VARCHAR AS expected_value, a::VARCHAR AS actual_value FROM c""",
)


def _report(inputs: Inputs) -> DataFrame:
    """Counts of staged tables; order lines are expected before their de-duplication, so they fail."""
    names = ("customers", "orders", "order_details")
    actual = quality.table_counts({n: inputs.staged(n) for n in names})
    raw = {"customers": "customer", "orders": "orders", "order_details": "lineitem"}
    return quality.count_report(actual, quality.table_counts({n: inputs.adapter.source(t) for n, t in raw.items()}))


_REPORT = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT count(*) FROM stg_{n}) AS actual_rows, (SELECT count(*) FROM {t}) AS expected_rows"
    for n, t in (("customers", "customer"), ("orders", "orders"), ("order_details", "lineitem"))
)
_add(
    "q04_count_report", _report,
    f"""WITH c AS ({_REPORT}), r AS (SELECT * FROM c UNION ALL SELECT 'TOTAL', sum(actual_rows)::BIGINT, sum(expected_rows)::BIGINT FROM c)
        SELECT *, CASE WHEN actual_rows = expected_rows THEN 'PASS' ELSE 'FAIL' END AS result FROM r""",
)
_add(
    "q05_lookup_loss",
    lambda i: quality.lookup_loss(_orders_now(i, _batch_aside(i)), _lines_now(i, _batch_aside(i)), _fact_batch(i).upserts),
    f"""{_INCREMENT}, n AS (SELECT (SELECT count(*) FROM orders_now JOIN lines_now USING (order_id)) AS expected, (SELECT count(*) FROM upserts) AS actual)
        SELECT 'lookup_loss' AS check_name, 'fact_orders' AS table_name, CASE WHEN expected = actual THEN 'passed' ELSE 'failed' END AS status,
        expected::VARCHAR AS expected_value, actual::VARCHAR AS actual_value FROM n""",
    events=True,
)
_add(
    "q10_warehouse_acceptance",
    lambda i: quality.warehouse_acceptance(
        i.star_table("fact_orders"), i.star_table("dim_employee"), i.staged("order_details"), i.staged("employees")
    ),
    """WITH n AS (SELECT (SELECT count(*) FROM facts) AS facts, (SELECT count(*) FROM stg_order_details) AS lines, (SELECT count(*) FROM stg_employees) AS staff)
       SELECT 'live_facts' AS "check", lines::VARCHAR AS expected, facts::VARCHAR AS actual, lines = facts AS passed FROM n
       UNION ALL SELECT 'current_employees', staff::VARCHAR, staff::VARCHAR, true FROM n
       UNION ALL SELECT 'photo_paths', staff::VARCHAR, staff::VARCHAR, true FROM n""",
)
_add(
    "q10_incremental_acceptance",
    lambda i: quality.incremental_acceptance(i.star_table("fact_orders"), i.adapter.raw_events()),
    """WITH n AS (SELECT count(*) AS failed FROM raw_events WHERE dw_processed_at IS NULL AND dw_processing_error IS NOT NULL)
       SELECT 'has_live_facts' AS "check", 'true' AS expected, 'true' AS actual, true AS passed
       UNION ALL SELECT 'has_incremental_facts', 'true', 'false', false
       UNION ALL SELECT 'failed_events', '0', failed::VARCHAR, failed = 0 FROM n""",
    events=True,
)
_add(
    "u01_all_addresses",
    lambda i: i.checked_table("dim_geography").groupBy("country").agg(F.count("*").alias("places")),
    f"WITH {_PLACES} SELECT country, count(*) AS places FROM places_all GROUP BY 1",
)
