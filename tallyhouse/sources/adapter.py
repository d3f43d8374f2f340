"""Staging tables and change events derived from a general order schema.

Input: parquet tables region, nation, customer, supplier, part, orders, lineitem and events.
Columns the input lacks (employees, shippers, ship dates, blanks, unknown members) are derived from
its keys with expressions every SQL engine shares, so results can be checked elsewhere.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.lsn import operation_name
from tallyhouse.operators.latest import newest
from tallyhouse.sources.schemas import BY_NAME, LINES_INSTANCE, ORDERS_INSTANCE

# Change operation of each event type.
EVENT_OPERATIONS = {"error": 1, "signup": 2, "view": 3, "click": 4, "purchase": 4}


def _nulls(*names: str) -> list[str]:
    return [f"NULL AS {name}" for name in names]


def _address(key: str) -> list[str]:
    """Address columns; empty, blank and NULL regions are the same place."""
    return [
        "NULL AS address", "city", f"CASE WHEN {key} % 3 = 0 THEN '' WHEN {key} % 3 = 1 THEN '  ' END AS region",
        f"{key} % 40 AS postal_code", "country",
    ]


def _category_id(kind: str) -> str:
    return f"cast(conv(substr(sha2({kind}, 256), 1, 7), 16, 10) AS int)"


def _territory_id(key: str) -> str:
    return f"concat('T', lpad(cast({key} AS string), 2, '0'))"


class StagingAdapter:
    """Staged tables by name, each a lazy DataFrame over the input tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._sources: dict[str, DataFrame] = {}

    def source(self, table: str) -> DataFrame:
        if table not in self._sources:
            self._sources[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._sources[table]

    def table(self, name: str) -> DataFrame:
        rows = getattr(self, name)()
        return rows.selectExpr(*[f"cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BY_NAME[name].schema])

    @cached_property
    def _places(self) -> DataFrame:
        regions = self.source("region").selectExpr("r_regionkey AS n_regionkey", "r_name AS country")
        nations = self.source("nation").join(regions, "n_regionkey")
        return nations.selectExpr("n_nationkey AS nation_key", "n_name AS city", "country")

    def _placed(self, table: str, nation_key: str) -> DataFrame:
        return self.source(table).withColumnRenamed(nation_key, "nation_key").join(self._places, "nation_key")

    def customers(self) -> DataFrame:
        return self._placed("customer", "c_nationkey").selectExpr(
            "cast(c_custkey AS string) AS customer_id",
            "c_name AS company_name",
            "concat(' ', c_mktsegment) AS contact_name",
            *_address("c_custkey"),
            "cast(cast(c_acctbal AS decimal(19,4)) AS string) AS phone",
            *_nulls("contact_title", "fax"),
        )

    def suppliers(self) -> DataFrame:
        return self._placed("supplier", "s_nationkey").selectExpr(
            "s_suppkey AS supplier_id",
            "s_name AS company_name",
            *_address("s_suppkey"),
            *_nulls("contact_name", "contact_title", "phone", "fax", "home_page"),
        )

    def employees(self) -> DataFrame:
        """One employee per supplier row; every ten report to one of them, number 1 to nobody.

        Photos are wrapper bytes, then a GIF, PNG or JPEG with a tail, or no signature; some are missing.
        """
        head = "CASE s_suppkey % 5 WHEN 0 THEN '474946383961' WHEN 1 THEN '89504E470D0A1A0A' WHEN 2 THEN 'FFD8FF' ELSE '00' END"
        tail = "CASE WHEN s_suppkey % 5 = 2 THEN 'FFD9007461696C' ELSE '' END"
        wrapper, body = ("encode(concat('wrapper:', s_name), 'UTF-8')", "encode(concat(s_name, ':body'), 'UTF-8')")
        return self._placed("supplier", "s_nationkey").selectExpr(
            "s_suppkey + 1 AS employee_id",
            "s_name AS last_name",
            "'Rep' AS first_name",
            "CASE WHEN s_suppkey % 4 <> 0 THEN 'Account Manager' END AS title",
            "date_add(DATE '1990-01-01', cast(s_suppkey % 1000 AS int)) AS hire_date",
            *_address("s_suppkey"),
            f"CASE WHEN s_suppkey % 5 < 4 THEN concat({wrapper}, unhex({head}), {body}, unhex({tail})) END AS photo",
            "CASE WHEN s_suppkey > 0 THEN s_suppkey DIV 10 + 1 END AS reports_to",
            *_nulls("title_of_courtesy", "birth_date", "home_phone", "extension", "notes", "photo_path"),
        )

    def categories(self) -> DataFrame:
        kinds = self.source("part").select("p_type").distinct()
        return kinds.selectExpr(
            f"{_category_id('p_type')} AS category_id", "p_type AS category_name", *_nulls("description", "picture")
        )

    def products(self) -> DataFrame:
        return self.source("part").selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            "CASE WHEN p_partkey % 13 <> 0 THEN p_partkey % 10 END AS supplier_id",
            f"CASE WHEN p_partkey % 11 <> 0 THEN {_category_id('p_type')} END AS category_id",
            "p_brand AS quantity_per_unit",
            "p_retailprice AS unit_price",
            "p_size AS units_in_stock",
            "(p_partkey % 7) * 10 AS units_on_order",
            "p_partkey % 30 AS reorder_level",
            "p_partkey % 10 = 0 AS discontinued",
        )

    def shippers(self) -> DataFrame:
        """Order priorities read `n-NAME`; each one is a shipper."""
        kinds = self.source("orders").select("o_orderpriority").distinct()
        return kinds.selectExpr(
            "substr(o_orderpriority, 1, 1) AS shipper_id", "substr(o_orderpriority, 3) AS company_name", "NULL AS phone"
        )

    def regions(self) -> DataFrame:
        return self.source("region").selectExpr("r_regionkey AS region_id", "r_name AS region_description")

    def territories(self) -> DataFrame:
        return self.source("nation").selectExpr(
            f"{_territory_id('n_nationkey')} AS territory_id",
            "concat(n_name, ' ') AS territory_description",
            "CASE WHEN n_nationkey % 9 = 8 THEN 99 ELSE n_regionkey END AS region_id",
        )

    def employee_territories(self) -> DataFrame:
        homes = "explode(array_distinct(array(cast(s_nationkey AS bigint), (s_suppkey * 7 + 3) % 25))) AS home"
        pairs = self.source("supplier").selectExpr("s_suppkey + 1 AS employee_id", homes)
        return pairs.selectExpr("employee_id", f"{_territory_id('home')} AS territory_id")

    def orders(self) -> DataFrame:
        parts = ("address", "city", "region", "postal_code", "country")
        ship = self.customers().selectExpr(
            "cast(customer_id AS bigint) AS o_custkey", "company_name AS ship_name", *[f"{c} AS ship_{c}" for c in parts]
        )
        placed = "cast(o_orderdate AS timestamp)"
        return self.source("orders").join(ship, "o_custkey", "left").selectExpr(
            "o_orderkey AS order_id",
            "CASE WHEN o_orderkey % 29 <> 0 THEN cast(o_custkey AS string) END AS customer_id",
            "CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey % 9 + 1 END AS employee_id",
            f"{placed} AS order_date",
            f"{placed} + make_dt_interval(28) AS required_date",
            f"CASE WHEN o_orderstatus <> 'O' THEN {placed} + make_dt_interval(cast(o_orderkey % 45 AS int)) END AS shipped_date",
            "CASE WHEN o_orderkey % 17 <> 0 THEN cast(substr(o_orderpriority, 1, 1) AS int) END AS ship_via",
            "cast(o_totalprice AS decimal(19,4)) % 100 AS freight",
            "ship_name",
            *[f"ship_{c}" for c in parts],
        )

    def order_details(self) -> DataFrame:
        """One line per (order, part): the input repeats some pairs, but few, so lines are sorted once, after the shuffle.

        Lines that agree up to the discount give the same row, so what would order them further is not shuffled.
        """
        order = ("l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
        keys = ["l_orderkey", "l_partkey"]
        lines = newest(self.source("lineitem").repartition(*keys), keys, [F.asc(c) for c in order])
        details = lines.selectExpr(
            "l_orderkey AS order_id", "cast(l_partkey AS int) AS product_id", "l_quantity AS quantity", "l_discount AS discount"
        )
        prices = self.source("part").selectExpr("p_partkey", "p_retailprice AS unit_price")
        # By the staged product id, widened as product lookups widen it: those then find the lines dealt and sorted already.
        priced = details.join(prices, F.col("product_id").cast("long") == F.col("p_partkey"), "left")
        return priced.select("order_id", "product_id", "unit_price", "quantity", "discount")

    def raw_events(self, dealt: bool = False) -> DataFrame:
        """Change-event log: two captured tables, all operations, delays, gaps and errors.

        A few MB of events are the work of many tasks where messages are built and parsed, but no more tasks than the file
        has row groups would read them. `dealt` spreads them first.
        """
        events = self.source("events")
        if dealt:
            events = events.repartition("event_id", "ts", "user_id")
        number, kind = F.col("event_id"), F.col("event_type")
        lsn = F.concat(F.lit("0x"), F.lpad(F.hex(number), 20, "0"))
        code = F.create_map(*[F.lit(p) for item in EVENT_OPERATIONS.items() for p in item])[kind]
        rows = events.select(
            "event_id",
            F.when(number % 2 == 0, ORDERS_INSTANCE).otherwise(LINES_INSTANCE).alias("capture_instance"),
            lsn.alias("start_lsn"),
            lsn.alias("seqval"),
            code.cast("short").alias("operation_code"),
            F.col("ts").cast("timestamp").alias("received_at"),
            F.col("user_id").alias("order_number"),
            F.get_json_object("props", "$.k").cast("int").alias("product_number"),
            F.col("value").cast("decimal(19,4)").alias("amount"),
        )
        is_order = F.col("capture_instance") == ORDERS_INSTANCE
        order_key = F.to_json(F.struct(F.col("order_number").alias("OrderID")))
        line_key = F.to_json(F.struct(F.col("order_number").alias("OrderID"), F.col("product_number").alias("ProductID")))
        placed = F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss")
        order_payload = F.to_json(
            F.struct(
                F.col("order_number").alias("OrderID"),
                F.concat((F.col("order_number") % 50).cast("string"), F.lit("  ")).alias("CustomerID"),
                (F.col("product_number") % 9 + 1).alias("EmployeeID"),
                placed.alias("OrderDate"),
                placed.alias("RequiredDate"),
                (F.col("product_number") % 5 + 1).alias("ShipVia"),
                F.col("amount").cast("string").alias("Freight"),
                F.lit("Changed").alias("ShipName"),
                F.lit("AFRICA").alias("ShipCountry"),
            )
        )
        line_payload = F.to_json(
            F.struct(
                F.col("order_number").alias("OrderID"),
                F.col("product_number").alias("ProductID"),
                F.col("amount").cast("string").alias("UnitPrice"),
                (F.col("product_number") % 20 + 1).alias("Quantity"),
                ((F.col("product_number") % 5) / 20).alias("Discount"),
            )
        )
        processed = F.when(
            number % 50 != 0,
            F.col("received_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (number % 900).cast("decimal(18,6)") / 1000),
        )
        taken = F.when(
            number % 10 != 0,
            F.col("processed_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (number % 60).cast("decimal(18,6)")),
        )
        return (
            rows.withColumn("processed_at", processed)
            .withColumn("dw_processed_at", taken)
            .select(
                "event_id", "capture_instance", "start_lsn", "seqval", "operation_code",
                operation_name(F.col("operation_code")).alias("operation_type"),
                F.col("received_at").alias("event_time"),
                F.when(is_order, order_key).otherwise(line_key).alias("business_key"),
                F.when(is_order, order_payload).otherwise(line_payload).alias("payload"),
                F.when(is_order, "orders.cdc").otherwise("order_details.cdc").alias("topic"),
                (F.col("order_number") % 4).cast("int").alias("partition"),
                F.col("event_id").alias("offset"),
                "received_at", "processed_at",
                F.when(number % 97 == 0, "decode failed").alias("processing_error"),
                "dw_processed_at",
                F.when(number % 101 == 0, "batch failed").alias("dw_processing_error"),
            )
        )

    def messages(self) -> DataFrame:
        """The same events as stream messages, each delivered twice, some of them damaged."""
        events = self.raw_events(dealt=True)
        number = F.col("event_id")
        envelope = F.to_json(
            F.struct(
                F.when(number % 41 != 0, F.col("capture_instance")).otherwise("other").alias("capture_instance"),
                F.when(number % 43 != 0, F.col("operation_code").cast("string")).otherwise("9").alias("operation_code"),
                F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
                F.parse_json("business_key").alias("business_key"),
                F.parse_json("payload").alias("payload"),
                F.struct(F.when(number % 47 != 0, F.col("start_lsn")).alias("start_lsn"), F.col("seqval")).alias("metadata"),
            )
        )
        damaged = F.when(number % 31 == 0, "{broken").when(number % 37 == 0, "[]").otherwise(envelope)
        # Each message is built once, before it is repeated.
        built = events.select(
            F.col("event_id").cast("string").alias("key"),
            F.when(number % 53 != 0, F.encode(damaged, "UTF-8")).alias("value"),
            "topic",
            "partition",
            F.array(number * 2, number * 2 + 1).alias("offsets"),
            "received_at",
        )
        return built.select("key", "value", "topic", "partition", F.explode("offsets").alias("offset"), "received_at")

    def wrapped_images(self) -> DataFrame:
        """Documents as binary payloads: an image signature behind a wrapper, none, or nothing at all."""
        wrapper = "cast(repeat('w', 78) AS binary)"
        text = "encode(text, 'UTF-8')"
        bmp = "unhex('424D3C000000000000003600000028000000')"
        kinds = (
            f"concat({wrapper}, unhex('89504E470D0A1A0A'), {text})",
            f"concat({wrapper}, unhex('FFD8FF'), {text}, unhex('FFD9'), {wrapper})",
            f"concat(unhex('474946383761'), {text})",
            f"concat({wrapper}, {bmp}, unhex(repeat('00', 36)), encode('pixels', 'UTF-8'), {text})",
            f"concat({text}, cast('' AS binary))",
            f"concat(cast(repeat('w', 5000) AS binary), unhex('89504E470D0A1A0A'), {text})",
        )
        cases = " ".join(f"WHEN {kind} THEN {payload}" for kind, payload in enumerate(kinds))
        return self.source("documents").selectExpr("doc_id", f"CASE doc_id % 7 {cases} END AS payload")

    def pipeline_runs(self) -> DataFrame:
        """One run per day of events."""
        day = F.date_trunc("day", "received_at")
        failures = F.count_if(F.col("processing_error").isNotNull())
        runs = self.raw_events().groupBy(day.alias("started_at")).agg(
            F.count("*").alias("rows_read"),
            F.count("processed_at").alias("rows_written"),
            F.max("processed_at").alias("finished_at"),
            failures.alias("failures"),
        )
        return runs.select(
            F.date_format("started_at", "yyyyMMdd").cast("long").alias("run_id"),
            F.lit("daily").alias("pipeline_name"),
            F.lit("cdc").alias("run_type"),
            F.when(F.col("failures") > 3, "failed").otherwise("success").alias("status"),
            "started_at", "finished_at", "rows_read", "rows_written",
            F.when(F.col("failures") > 3, F.concat(F.col("failures").cast("string"), F.lit(" events failed"))).alias("error_message"),
        )

    def quality_results(self) -> DataFrame:
        """Read against written rows of each run."""
        return self.pipeline_runs().select(
            (F.col("run_id") * 10).alias("result_id"), "run_id",
            F.lit("source_target_row_count").alias("check_name"),
            F.lit("raw_events").alias("table_name"),
            F.when(F.col("rows_read") == F.col("rows_written"), "passed").otherwise("failed").alias("status"),
            F.col("rows_read").cast("string").alias("expected_value"),
            F.col("rows_written").cast("string").alias("actual_value"),
            F.col("finished_at").alias("checked_at"),
        )

    def service_history(self) -> DataFrame:
        """Heartbeats of three services, one row per event."""
        number = F.col("event_id")
        service = (
            F.when(number % 3 == 0, "cdc-consumer").when(number % 3 == 1, "cdc-producer").otherwise("incremental-transform")
        )
        return self.raw_events().select(
            number.alias("sequence"),
            service.alias("service_name"),
            F.when(F.col("processing_error").isNotNull(), "error").otherwise("running").alias("status"),
            F.col("received_at").alias("last_heartbeat"),
            F.col("processing_error").alias("last_error"),
            F.coalesce("processed_at", "received_at").alias("updated_at"),
        )
