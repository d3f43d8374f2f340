"""The adapter's staging tables and the joined facts as SQL, shared by all oracle queries."""

from __future__ import annotations


def canon(value: str) -> str:
    return f"coalesce(trim(({value})::VARCHAR), '<NULL>')"


def clean(value: str) -> str:
    return f"nullif(trim(({value})::VARCHAR), '')"


def sha_key(namespace: str, *values: str) -> str:
    parts = ", ".join([f"'{namespace}'", *map(canon, values)])
    return f"(('0x' || substr(sha256(concat_ws('||', {parts})), 1, 15))::BIGINT + 1)"


def sha_hash(*values: str) -> str:
    return f"sha256(concat_ws('||', {', '.join(map(canon, values))}))"


def place_key(prefix: str = "") -> str:
    parts = ("country", "region", "city", "postal_code", "address")
    return sha_key("geography", *[clean(prefix + p) for p in parts])


def moment(value: str) -> str:
    """Timestamp as text, in the form the registry gives timestamps."""
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%f')"


def day(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d')"


def exact_ratio(numerator: str, denominator: str, scale: int = 1) -> str:
    """numerator / (denominator * scale) rounded half up to two places, in whole numbers."""
    top, bottom = f"({numerator})::HUGEINT", f"({denominator})::HUGEINT * {scale}"
    return f"CASE WHEN ({denominator}) = 0 THEN NULL ELSE (({top} * 200 + {bottom}) // (2 * {bottom}))::DOUBLE / 100 END"


def revenue_ratio(denominator: str) -> str:
    return exact_ratio("(round(sum(rev), 4) * 10000)", denominator, 10000)


REVENUE = "unit_price::DECIMAL(15,4) * quantity::DECIMAL(10,0) * (1 - discount::DECIMAL(9,6))"
MONEY = "round(sum(rev), 2)::DOUBLE"
DAYS = "date_diff('day', order_date, shipped_date)"

_BLANK = "CASE WHEN {k} % 3 = 0 THEN '' WHEN {k} % 3 = 1 THEN '  ' END AS region, ({k} % 40)::VARCHAR AS postal_code"

STAGING = f"""
places AS (SELECT n_nationkey, n_name AS city, r_name AS country FROM nation JOIN region ON n_regionkey = r_regionkey),
stg_customers AS (
  SELECT c_custkey::VARCHAR AS customer_id, c_name AS company_name, ' ' || c_mktsegment AS contact_name,
         NULL::VARCHAR AS contact_title, NULL::VARCHAR AS address, city, {_BLANK.format(k="c_custkey")}, country,
         c_acctbal::DECIMAL(19,4)::VARCHAR AS phone, NULL::VARCHAR AS fax
  FROM customer JOIN places ON c_nationkey = n_nationkey),
stg_suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS company_name, NULL::VARCHAR AS contact_name,
         NULL::VARCHAR AS contact_title, NULL::VARCHAR AS address, city, {_BLANK.format(k="s_suppkey")}, country,
         NULL::VARCHAR AS phone, NULL::VARCHAR AS fax, NULL::VARCHAR AS home_page
  FROM supplier JOIN places ON s_nationkey = n_nationkey),
stg_employees AS (
  SELECT s_suppkey + 1 AS employee_id, s_name AS last_name, 'Rep' AS first_name,
         CASE WHEN s_suppkey % 4 <> 0 THEN 'Account Manager' END AS title, NULL::VARCHAR AS title_of_courtesy,
         NULL::DATE AS birth_date, (DATE '1990-01-01' + (s_suppkey % 1000)::INT)::DATE AS hire_date,
         NULL::VARCHAR AS address, city, {_BLANK.format(k="s_suppkey")}, country, NULL::VARCHAR AS home_phone,
         NULL::VARCHAR AS extension, NULL::VARCHAR AS notes,
         CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 + 1 END AS reports_to,
         CASE WHEN s_suppkey % 5 < 4 THEN
           encode('wrapper:' || s_name)
           || unhex(CASE s_suppkey % 5 WHEN 0 THEN '474946383961' WHEN 1 THEN '89504E470D0A1A0A' WHEN 2 THEN 'FFD8FF' ELSE '00' END)
           || encode(s_name || ':body')
           || unhex(CASE WHEN s_suppkey % 5 = 2 THEN 'FFD9007461696C' ELSE '' END) END AS photo
  FROM supplier JOIN places ON s_nationkey = n_nationkey),
stg_categories AS (
  SELECT DISTINCT ('0x' || substr(sha256(p_type), 1, 7))::INT AS category_id, p_type AS category_name FROM part),
stg_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         CASE WHEN p_partkey % 13 <> 0 THEN p_partkey % 10 END AS supplier_id,
         CASE WHEN p_partkey % 11 <> 0 THEN ('0x' || substr(sha256(p_type), 1, 7))::INT END AS category_id,
         p_brand AS quantity_per_unit, p_retailprice::DECIMAL(19,4) AS unit_price, p_size AS units_in_stock,
         (p_partkey % 7) * 10 AS units_on_order, p_partkey % 30 AS reorder_level, (p_partkey % 10 = 0)::INT AS discontinued
  FROM part),
stg_shippers AS (
  SELECT DISTINCT substr(o_orderpriority, 1, 1)::INT AS shipper_id, substr(o_orderpriority, 3) AS company_name,
         NULL::VARCHAR AS phone FROM orders),
stg_regions AS (SELECT r_regionkey AS region_id, r_name AS region_description FROM region),
stg_territories AS (
  SELECT 'T' || lpad(n_nationkey::VARCHAR, 2, '0') AS territory_id, n_name AS territory_description,
         CASE WHEN n_nationkey % 9 = 8 THEN 99 ELSE n_regionkey END AS region_id FROM nation),
stg_employee_territories AS (
  SELECT DISTINCT employee_id, 'T' || lpad(home::VARCHAR, 2, '0') AS territory_id FROM (
    SELECT s_suppkey + 1 AS employee_id, unnest([s_nationkey::BIGINT, (s_suppkey * 7 + 3) % 25]) AS home FROM supplier)),
stg_orders AS (
  SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 29 <> 0 THEN o_custkey::VARCHAR END AS customer_id,
         CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey % 9 + 1 END AS employee_id, o_orderdate AS order_date,
         o_orderdate + to_days(28) AS required_date,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days((o_orderkey % 45)::INT) END AS shipped_date,
         CASE WHEN o_orderkey % 17 <> 0 THEN substr(o_orderpriority, 1, 1)::INT END AS ship_via,
         (o_totalprice::DECIMAL(19,4) % 100)::DECIMAL(19,4) AS freight, c.company_name AS ship_name, c.address AS ship_address,
         c.city AS ship_city, c.region AS ship_region, c.postal_code AS ship_postal_code, c.country AS ship_country
  FROM orders LEFT JOIN stg_customers c ON c.customer_id = o_custkey::VARCHAR),
stg_order_details AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, p_retailprice::DECIMAL(19,4) AS unit_price,
         l_quantity::BIGINT AS quantity, l_discount::DECIMAL(9,6) AS discount
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey, l_quantity,
          l_extendedprice, l_discount, l_tax, l_shipdate) AS rn FROM lineitem)
  LEFT JOIN part ON p_partkey = l_partkey WHERE rn = 1),
products AS (
  SELECT p.* EXCLUDE (supplier_id), c.category_name, s.supplier_id, s.company_name AS supplier_name
  FROM stg_products p LEFT JOIN stg_categories c USING (category_id) LEFT JOIN stg_suppliers s USING (supplier_id)),
facts AS (
  SELECT o.* EXCLUDE (customer_id, employee_id, ship_via), c.customer_id, c.company_name AS customer, e.employee_id,
         s.shipper_id, s.company_name AS shipper, p.product_id, p.product_name, p.category_name, p.supplier_id,
         p.supplier_name, d.unit_price, d.quantity, d.discount, {REVENUE.replace("unit_price", "d.unit_price", 1)} AS rev
  FROM stg_orders o JOIN stg_order_details d USING (order_id) JOIN products p USING (product_id)
  LEFT JOIN stg_customers c ON c.customer_id = o.customer_id LEFT JOIN stg_employees e ON e.employee_id = o.employee_id
  LEFT JOIN stg_shippers s ON s.shipper_id = o.ship_via)
"""

EVENTS = """
raw_base AS (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'dbo_Orders' ELSE 'dbo_Order_Details' END AS capture_instance,
         '0x' || printf('%020X', event_id) AS start_lsn,
         CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3 ELSE 4 END AS operation_code,
         ts AS received_at, user_id AS order_number, json_extract_string(props, '$.k')::INT AS product_number,
         value::DECIMAL(19,4) AS amount,
         CASE WHEN event_id % 50 <> 0 THEN ts + to_milliseconds(event_id % 900) END AS processed_at
  FROM events),
raw_events AS (
  SELECT *, CASE operation_code WHEN 1 THEN 'DELETE' WHEN 2 THEN 'INSERT' WHEN 3 THEN 'UPDATE_BEFORE' ELSE 'UPDATE_AFTER' END AS operation_type,
         CASE WHEN event_id % 2 = 1 THEN product_number END AS product_id, order_number AS order_id,
         CASE WHEN event_id % 97 = 0 THEN 'decode failed' END AS processing_error,
         CASE WHEN event_id % 10 <> 0 THEN processed_at + to_seconds(event_id % 60) END AS dw_processed_at,
         CASE WHEN event_id % 101 = 0 THEN 'batch failed' END AS dw_processing_error
  FROM raw_base),
runs AS (
  SELECT strftime(date_trunc('day', received_at), '%Y%m%d')::BIGINT AS run_id, date_trunc('day', received_at)::TIMESTAMP AS started_at,
         max(processed_at) AS finished_at, count(*) AS rows_read, count(processed_at) AS rows_written,
         count(processing_error) AS failures
  FROM raw_events GROUP BY 1, 2)
"""


def with_prelude(query: str, events: bool = False, staging: bool = True) -> str:
    parts = ([STAGING.strip()] if staging else []) + ([EVENTS.strip()] if events else [])
    query = query.strip()
    if query.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + query[5:]
    return "WITH " + ",\n".join(parts) + "\n" + query
