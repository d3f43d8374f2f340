"""Plans that keep work in proportion to the input."""

from datetime import datetime

from tallyhouse.checks import operators
from tallyhouse.checks.registry import Inputs
from tallyhouse.operators import changes, quality
from tallyhouse.operators.facts import Lookups, order_facts, order_lines
from tallyhouse.session import MIN_PARTITIONS, configure
from tallyhouse.sources.adapter import StagingAdapter
from tallyhouse.sources.lake import Lake


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def events(spark, folder):
    rows = [(k, datetime(2024, 1, 1), k % 3, "click", 1.0, '{"k": 1}') for k in range(6)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/events.parquet")


def test_shuffles_have_enough_partitions(spark):
    configure(spark)
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(spark.conf.get(name)) == MIN_PARTITIONS
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        configure(spark)
        assert int(spark.conf.get(name)) == 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        configure(spark)


def test_lines_are_sorted_after_the_shuffle_only(spark, tmp_path):
    day = datetime(1996, 1, 1)
    lines = [(1, 7, 1, 2, 5.0, 1.0, 0.0, 0.0, day), (1, 7, 1, 1, 4.0, 1.0, 0.0, 0.0, day), (None, 7, 1, 1, 3.0, 1.0, 0.0, 0.0, day)]
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, 2.5)], "p_partkey long, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    rows = StagingAdapter(spark, str(tmp_path)).order_details()
    below = plan(rows).split("Exchange hashpartitioning(l_orderkey")[1]
    assert "Sort " not in below.split("lineitem.parquet")[0]
    assert sorted((r.order_id or 0, r.quantity) for r in rows.collect()) == [(0, 3.0), (1, 4.0)]


def test_messages_are_built_before_they_are_repeated(spark, tmp_path):
    events(spark, tmp_path)
    rows = StagingAdapter(spark, str(tmp_path)).messages()
    above, below = plan(rows).split("Generate explode", 1)
    assert "{broken" in below and "{broken" not in above
    assert rows.count() == 12


def test_the_batch_is_written_once(spark, tmp_path):
    events(spark, tmp_path)
    inputs = Inputs(spark, str(tmp_path))
    kept = operators._batch_aside(inputs)
    assert kept is operators._batch_aside(inputs)
    assert "get_json_object" not in plan(kept)
    assert sorted(r.start_lsn for r in kept.collect()) == [f"0x{k:020X}" for k in range(1, 6)]


def test_lines_are_dealt_by_product_once(spark, tmp_path, frame):
    day = datetime(1996, 1, 1)
    lines = [(k, p, 1, 1, 5.0, 1.0, 0.0, 0.0, day) for k, p in ((1, 7), (2, 8), (3, None))]
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, 2.5), (7, 3.5)], "p_partkey long, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    lookup = frame("product_alternate_key long, product_key long", (7, 70), (8, 80))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = order_lines(StagingAdapter(spark, str(tmp_path)).table("order_details"), Lookups(lookup, None, None, None))
        by_product = [line for line in plan(rows).split("\n") if "Exchange hashpartitioning(" in line and "product_id" in line]
        assert len(by_product) == 1 and "hashpartitioning(l_partkey" not in plan(rows)
        found = sorted((r.order_id, r.product_key, float(r.unit_price)) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == [(1, 70, 2.5), (1, 70, 3.5), (2, 80, 0.0)]


def test_only_what_decides_a_line_is_shuffled(spark, tmp_path):
    line = "1L l_orderkey, 7L l_partkey, 1L l_suppkey, 1 l_linenumber, 5D l_quantity, 1D l_extendedprice, 0D l_discount"
    rows = spark.sql(f"SELECT {line}, explode(array(0D, 1D)) l_tax, DATE '1996-01-01' l_shipdate")
    rows.union(spark.sql(f"SELECT {line.replace('5D', '4D')}, 2D, null")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 7L p_partkey, 2.5D p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    details = StagingAdapter(spark, str(tmp_path)).order_details()
    assert "l_tax" not in plan(details) and "l_shipdate" not in plan(details)
    assert [(r.order_id, r.quantity, r.unit_price) for r in details.collect()] == [(1, 4.0, 2.5)]


def test_addresses_are_keys_before_lookups_and_dates_are_after_the_last(spark, frame):
    day = datetime(1996, 1, 2)
    schema = (
        "order_id long, customer_id string, employee_id int, ship_via int, freight decimal(19,4), ship_name string, ship_address string, "
        "ship_city string, ship_region string, ship_postal_code string, ship_country string, order_date timestamp, "
        "required_date timestamp, shipped_date timestamp"
    )
    orders = frame(schema, (1, "5", 1, 1, None, "n", None, "c", " ", "1", "A", day, day, None), (2, None, None, None, None, *[None] * 9))
    details = frame("order_id long, product_id int, unit_price double, quantity int, discount float", (1, 7, 2.5, 3, 0.0), (2, 7, 2.5, 1, 0.0))
    known = [frame(f"{d.natural} {kind}, {d.surrogate} long", row) for d, kind, row in zip(Lookups.DIMENSIONS, ("int", "string", "int", "int"), ((7, 70), ("5", 50), (1, 10), (1, 20)))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = order_facts(orders, details, Lookups(*known))
        lines = plan(facts).split("\n")  # reads upwards
        joins = [k for k, line in enumerate(lines) if "Join" in line]
        assert all(k > joins[1] for k, line in enumerate(lines) if "xxhash64(" in line)
        assert all(k < joins[0] for k, line in enumerate(lines) if "year(" in line)
        found = sorted((r.order_id, r.customer_key, r.employee_key, r.shipper_key, r.order_date_key, r.shipped_date_key) for r in facts.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == [(1, 50, 10, 20, 19960102, 0), (2, 0, 0, 0, 0, 0)]


def test_warehouse_tables_are_stored_as_zstd_from_small_partitions(spark, tmp_path):
    events(spark, tmp_path)
    try:
        Inputs.of(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    finally:
        configure(spark)
    lake = Lake(spark, f"{tmp_path}/lake")
    lake.write_base("t", spark.range(3), 1)
    lake.publish(1, "t")
    lake.append("t", spark.range(3, 4), "b")
    assert list(tmp_path.glob("lake/t/v1/base/*.zstd.parquet")) and list(tmp_path.glob("lake/t/v1/changes/*/*.zstd.parquet"))


def test_orphans_are_counted_by_the_number_of_their_lookup(frame):
    schema = ", ".join(f"{key} long" for key in quality.FACT_LOOKUPS)
    facts = frame(schema, (1, 0, 3, 4, 5), (9, 9, 0, 9, 0), (0, 9, 3, 0, 5), (1, 2, 3, 4, None))
    tables = {table: frame(f"{key} long", (n,)) for n, (key, (table, _)) in enumerate(quality.FACT_LOOKUPS.items(), 1)}
    rows = quality.orphan_keys(facts, tables)
    assert "geography_key AS lookup" not in plan(rows)
    assert list(rows.first().asDict().values()) == [2, 2, 0, 1, 2]


def test_messages_are_dealt_before_they_are_built(spark, tmp_path):
    events(spark, tmp_path)
    built = StagingAdapter(spark, str(tmp_path)).messages()
    lines = plan(built).splitlines()
    dealt = next(k for k, line in enumerate(lines) if "REPARTITION" in line)
    made = [k for k, line in enumerate(lines) if "parseJson" in line]
    assert made and max(made) < dealt  # plans read upwards
    assert built.count() == 12


def test_texts_of_messages_are_made_for_those_who_read_them(spark):
    schema = "key string, value binary, topic string, partition int, offset long, received_at timestamp"
    parsed = changes.parse_messages(spark.createDataFrame([("1", b"{}", "t", 0, 0, datetime(2024, 1, 1))], schema))
    assert "StructsToJson" in plan(parsed) and "StructsToJson" not in plan(parsed.select("reject_reason"))
