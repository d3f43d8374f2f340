import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from fixtures import messages, order_event, staging
from tallyhouse.operators.dimensions import CUSTOMER, PRODUCT
from tallyhouse.operators.quality import QualityError
from tallyhouse.operators.scd2 import versions_at
from tallyhouse.plans import history as kept
from tallyhouse.plans.full_load import Warehouse, load_staging, load_star, run_full
from tallyhouse.plans.incremental_load import run_incremental
from tallyhouse.streaming import ingest

DAY = datetime(2024, 1, 1)


def test_versions_match_a_plain_search(spark):
    """Gaps, moments on a border, unknown and NULL members, NULL moments, repeated rows, clashing names."""
    rng = random.Random(3)
    spans = []
    for member in ("a", "b", "c", "hot"):
        at = 0
        for number in range(rng.randint(1, 6)):
            start = at + rng.choice((0, 0, 3))
            at = start + rng.randint(1, 9)
            spans.append((member, start, at, f"{member}{number}"))
    # The last version of all members but one is open.
    lasts = {m: max(i for i, s in enumerate(spans) if s[0] == m) for m in ("a", "b", "hot")}
    spans = [(m, s, None if i in lasts.values() else e, v) for i, (m, s, e, v) in enumerate(spans)]
    at = lambda n: None if n is None else DAY + timedelta(days=n)
    history = spark.createDataFrame(
        [(m, at(s), at(e), v) for m, s, e, v in spans],
        "customer_alternate_key string, start_date timestamp, end_date timestamp, version string",
    )
    asked = [(k, rng.choice(("a", "b", "c", "d", "hot", "hot", "hot", None)), rng.choice((None, *range(-3, 50)))) for k in range(400)]
    rows = spark.createDataFrame([(k, m, at(n), m) for k, m, n in asked + asked[:5]], "id long, who string, at timestamp, customer_alternate_key string")
    found = versions_at(rows.withColumn("version.x", F.lit(1)), "who", "at", history, CUSTOMER, {"met": "version"})
    assert found.columns == ["id", "who", "at", "customer_alternate_key", "version.x", "met"]

    def plain(member, n):
        mine = sorted((s for s in spans if s[0] == member), key=lambda s: s[1])
        before = [s for i, s in enumerate(mine) if i == 0 or n is None or s[1] <= n]
        return before[-1][3] if before and (before[-1][2] is None or (n is not None and n < before[-1][2])) else None

    assert rows_of(found, "id", "met") == sorted(((k, plain(m, n)) for k, m, n in asked + asked[:5]), key=str)
    assert versions_at(rows.limit(0), "who", "at", history, CUSTOMER, {"met": "version"}).isEmpty()
    assert versions_at(rows, "who", "at", history.limit(0), CUSTOMER, {"met": "version"}).where("met IS NOT NULL").isEmpty()


def test_a_hot_member_is_one_row_per_moment_before_the_window(spark):
    history = spark.createDataFrame([("a", DAY, None, 1)], "customer_alternate_key string, start_date timestamp, end_date timestamp, customer_key long")
    rows = spark.range(1000).selectExpr("cast(id % 3 AS string) AS who", "timestamp_seconds(id) AS at")
    plan = versions_at(rows, "who", "at", history, CUSTOMER, {"k": "customer_key"})._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("HashAggregate") >= 2


def met(house):
    """(order, customer's name, product's name) by the versions the orders met."""
    lake = house.star_lake
    customers = kept.version_rows(lake.base("dim_customer_history"), CUSTOMER).select("customer_version_key", "company_name")
    products = kept.version_rows(lake.base("dim_product_history"), PRODUCT).select("product_version_key", "product_name")
    lines = house.latest(kept.LINE_VERSIONS).join(house.latest(kept.ORDER_VERSIONS), "order_id")
    named = lines.join(customers, "customer_version_key", "left").join(products, "product_version_key", "left")
    return rows_of(named, "order_id", "company_name", "product_name")


def test_loads_keep_the_versions_that_orders_met(spark, tmp_path):
    house, tables = Warehouse(spark, str(tmp_path / "house")), staging(spark)
    run_full(house, tables.__getitem__, history=True)
    first = [(1, "Alpha", "Axe"), (1, "Alpha", "Saw"), (2, "Beta", "Axe"), (3, None, "Axe")]
    assert met(house) == first

    # A customer and a product change, a customer goes; an order of later days meets the new versions.
    late = {"order_id": 4, "customer_id": "C1", "order_date": datetime(2100, 1, 1), "ship_country": "Peru"}
    gone = {**late, "order_id": 5, "customer_id": "C3"}
    undated = {**late, "order_id": 6, "order_date": None}
    schema = tables["orders"].schema
    extra = spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in (late, gone, undated)], schema)
    lines = tables["order_details"].where("order_id = 1 AND product_id = 1")
    renamed = lambda column, key, old: F.when(F.col(key) == old, "New").otherwise(F.trim(F.col(column)))
    changed = {
        **tables,
        "customers": tables["customers"].where("customer_id <> 'C3'").withColumn("company_name", renamed("company_name", "customer_id", "C1")),
        "products": tables["products"].withColumn("product_name", renamed("product_name", "product_id", 1)),
        "orders": tables["orders"].unionByName(extra),
        "order_details": tables["order_details"].unionByName(
            lines.withColumn("order_id", F.explode(F.array(*map(F.lit, (4, 5, 6))).cast("array<int>")))
        ),
    }
    run_full(house, changed.__getitem__)
    assert met(house) == [*first, (4, "New", "New"), (5, None, "New"), (6, "New", "New")]
    spans = house.star_lake.base("dim_customer_history").where("customer_alternate_key IN ('C1', 'C3')")
    assert rows_of(spans, "customer_alternate_key", "company_name", "is_current") == [("C1", "Alpha", 0), ("C1", "New", 1), ("C3", "Gamma", 0)]
    # Facts refer to the current rows, as before.
    now = house.star.facts.join(house.star.customers, "customer_key")
    assert rows_of(now.where("order_id IN (1, 4)"), "order_id", "company_name") == [(1, "New"), (1, "New"), (4, "New")]

    # Changes of an order: its versions follow.
    ingest.prepare(house)
    ingest.apply_batch(house, messages(spark, order_event(1, 4, 2, CustomerID="C4", OrderDate="2024-01-02T00:00:00")), 0)
    run_incremental(house)
    assert (2, "Delta", "Axe") in met(house) and (1, "Alpha", "Axe") in met(house)
    checks = house.control.read("data_quality_results").where("check_name = 'source_target_row_count' AND table_name = 'line_versions'")
    assert rows_of(checks, "expected_value", "status") == [("4", "passed"), ("7", "passed")]


def test_a_failed_history_publishes_nothing(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "house"))
    load_staging(house, staging(spark).__getitem__)
    write = house.star_lake.write_base
    monkeypatch.setattr(house.star_lake, "write_base", lambda t, rows, v: write(t, rows.limit(1) if t == kept.LINE_VERSIONS else rows, v))
    with pytest.raises(QualityError, match="line_versions"):
        load_star(house, history=True)
    assert house.star_lake.folders() == {} and not kept.is_kept(house.star_lake)
    with pytest.raises(ValueError, match="all dimensions"):
        load_star(house, tables=["dim_customer"], history=True)
