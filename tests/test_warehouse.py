import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from fixtures import line_event, lsn, messages, order_event, staging
from tallyhouse.operators.changes import last_change
from tallyhouse.operators.quality import QualityError
from tallyhouse.plans.full_load import Warehouse, load_staging, run_full
from tallyhouse.plans import full_load, incremental_load
from tallyhouse.plans.incremental_load import event_log, outcome_states, redrive, run_incremental, settled_before
from tallyhouse.plans.marts import total_revenue
from tallyhouse.streaming import ingest


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A warehouse after its full load; each test works on a copy."""
    made = Warehouse(spark, str(tmp_path_factory.mktemp("loaded") / "house"))
    run_full(made, staging(spark).__getitem__)
    ingest.prepare(made)
    return made


@pytest.fixture
def house(spark, loaded, tmp_path):
    shutil.copytree(loaded.root, tmp_path / "house")
    return Warehouse(spark, str(tmp_path / "house"))


def live(house):
    """Live facts as (order, product name, quantity, LSN number)."""
    facts = house.star.facts.join(house.latest("dim_product"), "product_key")
    return sorted((r.order_id, r.product_name, r.quantity, int(r.source_lsn or "0x0", 16)) for r in facts.collect())


def tombstones(house):
    facts = house.latest("fact_orders").where("is_deleted = 1").join(house.latest("dim_product"), "product_key")
    return sorted((r.order_id, r.product_name, int(r.source_lsn, 16)) for r in facts.collect())


LOADED = [(1, "Axe", 5, 0), (1, "Saw", 1, 0), (2, "Axe", 10, 0), (3, "Axe", 2, 0)]


def take(house, batch, *bodies, limit=None):
    ingest.apply_batch(house, messages(house.spark, *bodies), batch)
    return run_incremental(house, limit)


def test_full_load(loaded):
    house = loaded
    assert live(house) == LOADED
    assert house.star.employees.count() == 9 and house.latest("dim_geography").count() == 3
    # 50 + 18 + 85 + 15
    assert total_revenue(house.star).first()[0] == 168.0
    facts = {r.order_id: r for r in house.star.facts.collect()}
    assert (facts[3].customer_key, facts[3].shipper_key, facts[3].shipped_date_key) == (0, 0, 0)
    assert facts[2].employee_key == 0 and facts[2].customer_key > 0
    # A blank, an empty and a missing region are one place, and facts point at it.
    assert facts[1].geography_key == facts[2].geography_key
    assert house.latest("dim_geography").where(f"geography_key = {facts[1].geography_key}").count() == 1
    boss = house.star.employees.where("employee_alternate_key = 2").first()
    parents = {r.employee_alternate_key: r.parent_employee_key for r in house.star.employees.collect()}
    assert parents[2] == 0 and parents[1] == boss.employee_key
    runs = house.control.latest("pipeline_runs", ["run_id"], "sequence")
    assert rows_of(runs, "pipeline_name", "status") == [("staging_load", "success"), ("star_load", "success")]
    assert house.control.read("data_quality_results").where("status <> 'passed'").isEmpty()
    assert "fact_orders" in house.star_lake.tables()


def test_failed_gate_leaves_readers_alone(spark, house):
    tables = staging(spark)
    extra = tables["order_details"].limit(1).selectExpr("order_id", "99 AS product_id", "unit_price", "quantity", "discount")
    tables["order_details"] = tables["order_details"].unionByName(extra)
    with pytest.raises(QualityError):
        run_full(house, tables.__getitem__)
    assert live(house) == LOADED
    states = house.control.latest("pipeline_runs", ["run_id"], "sequence")
    assert states.where("status = 'failed' AND error_message LIKE '%row counts%'").count() == 1
    assert house.control.read("data_quality_results").where("status = 'failed'").count() == 1


def _of(rows, order):
    return [row for row in rows if row[0] == order]


def test_change_scenarios(house):
    undone = [
        order_event(1, 3, 1, Freight="1.5"), order_event(1, 4, 1, Freight="1.51", CustomerID="C1"),
        line_event(2, 3, 1, 1, quantity=5), line_event(2, 4, 1, 1, quantity=6),
        line_event(3, 3, 1, 1, quantity=6), line_event(3, 4, 1, 1, quantity=5),
        order_event(4, 3, 1, Freight="1.51"), order_event(4, 4, 1, Freight="1.5", CustomerID="C1", EmployeeID=1, ShipVia=1),
    ]
    inserted = [order_event(10, 2, 9, CustomerID="C4"), line_event(11, 2, 9, 1, quantity=3), line_event(12, 2, 9, 2, quantity=4)]
    copies = [line_event(31, 4, 2, 1, quantity=11), line_event(33, 4, 2, 1, quantity=13)] * 2
    outcome = take(house, 0, *undone, *inserted, *copies)
    assert (outcome.events_read, outcome.rows_written) == (13, 5)
    assert _of(live(house), 1) == [(1, "Axe", 5, 4), (1, "Saw", 1, 4)]
    assert _of(live(house), 9) == [(9, "Axe", 3, 12), (9, "Saw", 4, 12)]
    assert _of(live(house), 2) == [(2, "Axe", 13, 33)]

    # One of two lines deleted; an event older than the applied one; the first batch delivered again.
    replayed = [*inserted, *copies]
    outcome = take(house, 1, line_event(40, 1, 9, 2), line_event(32, 4, 2, 1, quantity=12), *replayed)
    assert outcome.events_read == 2
    assert _of(live(house), 9) == [(9, "Axe", 3, 40)] and tombstones(house) == [(9, "Saw", 40)]
    assert [row[2] for row in _of(live(house), 2)] == [13]

    # Deleted and inserted again in one batch; lines and order deleted.
    take(house, 2, line_event(41, 1, 9, 1), line_event(42, 2, 9, 1, quantity=8), line_event(43, 1, 2, 1), order_event(44, 1, 2))
    assert _of(live(house), 9) == [(9, "Axe", 8, 42)] and _of(live(house), 2) == []
    assert tombstones(house) == [(2, "Axe", 44), (9, "Saw", 40)]
    state = live(house)

    # The same stream batch again, as after a failure.
    assert take(house, 2, line_event(41, 1, 9, 1), line_event(42, 2, 9, 1, quantity=8), line_event(43, 1, 2, 1), order_event(44, 1, 2)).events_read == 0
    mark = settled_before(house)
    assert mark > 0 and event_log(house, mark).isEmpty()
    assert live(house) == state and house.events.history("raw_events").count() == 19
    assert house.control.read("pipeline_logs").where("details LIKE '%\"duplicates\":7%'").count() == 1


def test_staging_ahead_of_a_bounded_batch(house):
    ingest.apply_batch(house, messages(house.spark, line_event(21, 1, 1, 1), line_event(22, 2, 1, 1, quantity=7)), 0)
    run_incremental(house, 1)
    # The batch held only the delete, but staging has the new line already.
    assert (1, "Axe", 7, 21) in live(house)
    run_incremental(house, 1)
    assert (1, "Axe", 7, 22) in live(house)


def test_empty_batch_changes_nothing(house):
    outcome = run_incremental(house)
    assert (outcome.events_read, outcome.rows_written) == (0, 0)
    state = house.control.latest("service_state", ["service_name"], "sequence").where("service_name = 'incremental-transform'")
    assert state.first().status == "idle" and live(house) == LOADED


def test_failed_batch_stays_pending(house):
    with pytest.raises(QualityError):
        take(house, 0, line_event(41, 2, 1, 77))
    assert settled_before(house) == 0
    waiting = event_log(house).where("dw_processed_at IS NULL").first()
    assert waiting.dw_attempt_count == 1 and "fact lookups" in waiting.dw_processing_error
    assert live(house) == LOADED
    assert run_incremental(house, max_attempts=1).events_read == 0


def test_compaction_keeps_the_state(house):
    take(house, 0, line_event(51, 1, 1, 1), line_event(52, 4, 2, 1, quantity=99), "{broken")
    assert rows_of(ingest.offset_state(house)) == [("t", 0, 2)]
    assert rows_of(house.control.read("dead_letters"), "source_offset", "error") == [(2, "invalid JSON message")]
    before, dead = live(house), tombstones(house)
    house.star_lake.compact({"fact_orders": ("order_id", "product_key")})
    assert (live(house), tombstones(house)) == (before, dead)
    assert house.star_lake.changes("fact_orders") is None
    lines = rows_of(house.staged("order_details"))
    house.fold_staging()
    assert rows_of(house.staged("order_details")) == lines
    # An event older than a folded one still loses.
    ingest.apply_batch(house, messages(house.spark, line_event(50, 2, 1, 1, quantity=1)), 1)
    assert rows_of(house.staged("order_details")) == lines


def test_incremental_equals_full_rebuild(spark, house, tmp_path):
    take(house, 0, order_event(61, 2, 9, CustomerID="C4"), line_event(62, 2, 9, 1, quantity=3), line_event(63, 1, 1, 2),
         line_event(64, 4, 3, 1, quantity=20, discount=0.2), order_event(65, 1, 2), line_event(66, 1, 2, 1))
    rebuilt = Warehouse(spark, str(tmp_path / "rebuilt"))
    tables = staging(spark)
    run_full(rebuilt, lambda name: house.staged(name) if name in ("orders", "order_details") else tables[name])
    columns = [c for c in house.star.facts.columns if not c.startswith("_") and c != "source_lsn"]
    assert rows_of(house.star.facts, *columns) == rows_of(rebuilt.star.facts, *columns)




def _lines(house):
    return rows_of(house.staged("order_details"), "order_id", "product_id", "quantity")


def test_a_snapshot_loses_no_change(spark, house):
    """Changes taken in while a snapshot is read stay, and older ones that arrive later do not undo it."""
    ingest.apply_batch(house, messages(spark, line_event(10, 4, 1, 1, quantity=6), line_event(20, 4, 2, 1, quantity=7)), 0)
    # The source by then: order 1 has 8 pieces, and order 3 is gone.
    source = staging(spark)
    source["order_details"] = source["order_details"].where("order_id <> 3").withColumn("quantity", F.expr("CASE WHEN order_id = 1 AND product_id = 1 THEN 8 WHEN order_id = 2 THEN 7 ELSE quantity END").cast("short"))

    def read(name):
        if name == "order_details":  # while the snapshot runs
            ingest.apply_batch(house, messages(spark, line_event(30, 4, 1, 2, quantity=9), line_event(31, 2, 3, 2, quantity=4)), 1)
        return source[name]

    load_staging(house, read)
    assert house.snapshot_lsn("order_details") == lsn(20)
    expected = [(1, 1, 8), (1, 2, 9), (2, 1, 7), (3, 2, 4)]
    assert _lines(house) == expected
    # Older than the position of the snapshot, which holds it already.
    ingest.apply_batch(house, messages(spark, line_event(15, 4, 1, 1, quantity=5), line_event(12, 2, 3, 1, quantity=2)), 2)
    assert _lines(house) == expected
    house.fold_staging()
    assert _lines(house) == expected and len(house.staged_changes.batches("order_details")) == 1
    ingest.apply_batch(house, messages(spark, line_event(29, 4, 1, 2, quantity=1), line_event(40, 1, 1, 2)), 3)
    assert _lines(house) == [(1, 1, 8), (2, 1, 7), (3, 2, 4)]
    house.fold_staging()
    assert _lines(house) == [(1, 1, 8), (2, 1, 7), (3, 2, 4)]
    # The next snapshot holds all of it; one from before the published one is refused.
    with pytest.raises(ValueError):
        load_staging(house, source.__getitem__, at_lsn=lsn(5))
    load_staging(house, source.__getitem__, ("orders", "order_details"), at_lsn=lsn(50))
    assert _lines(house) == [(1, 1, 8), (1, 2, 1), (2, 1, 7)]


def test_folding_keeps_what_arrives_meanwhile(spark, house):
    for k in (1, 2):
        ingest.apply_batch(house, messages(spark, line_event(k, 4, 1, 1, quantity=10 + k)), k)

    def late(rows, keys):
        ingest.apply_batch(house, messages(spark, line_event(9, 4, 2, 1, quantity=99)), 9)
        return last_change(rows, keys)

    house.staged_changes.fold("order_details", ("order_id", "product_id"), "", late)
    assert (1, 1, 12) in _lines(house) and (2, 1, 99) in _lines(house)
    # A batch whose write did not finish does not count.
    ingest.apply_batch(house, messages(spark, line_event(50, 1, 2, 1)), 10)
    os.remove(f"{house.root}/staged_changes/order_details/apply_batch=b10/_SUCCESS")
    assert (2, 1, 99) in _lines(house)


def test_compaction_waits_for_a_batch_that_arrives_meanwhile(house):
    take(house, 0, line_event(51, 1, 1, 1))
    keys, lake, write = {"fact_orders": ("order_id", "product_key")}, house.star_lake, house.star_lake.write_base
    calls = []

    def slow(table, rows, version):
        out = write(table, rows, version)
        if not calls:
            calls.append(1)
            take(house, 1, line_event(52, 4, 2, 1, quantity=99))
        return out

    lake.write_base = slow
    lake.compact(keys)
    assert (2, "Axe", 99, 52) in live(house) and lake.changes("fact_orders") is None


def test_one_poison_event_does_not_stop_a_thousand(spark, house):
    """Single bad events are set aside with their reason; the rest of the batch goes on, and the mark with it."""
    bodies = [line_event(100 + k, 4, 1 + k % 2, 1, quantity=k % 50 + 1) for k in range(997)]
    nameless = order_event(3001, 3, 3)
    nameless["business_key"] = nameless["payload"] = {}
    ingest.apply_batch(house, messages(spark, *bodies, nameless, line_event(3002, 2, 3, 77), line_event(3003, 4, 3, 1, quantity=8)), 0)
    outcome = run_incremental(house, isolate=True)
    assert (outcome.events_read, outcome.events_dead) == (1000, 3)
    assert _of(live(house), 1) == [(1, "Axe", 47, 1096), (1, "Saw", 1, 1096)] and _of(live(house), 2) == [(2, "Axe", 46, 1095)]
    assert _of(live(house), 3) == [(3, "Axe", 2, 0)]
    letters = house.control.read("event_dead_letters")
    assert rows_of(letters, "start_lsn", "error") == [(lsn(3001), "no valid order id"), (lsn(3002), "unknown product in the order"), (lsn(3003), "unknown product in the order")]
    assert house.control.read("event_states").count() == 1000
    # Nothing waits, and the mark has moved past the dead ones.
    assert run_incremental(house, isolate=True).events_read == 0 and event_log(house, settled_before(house)).isEmpty()
    # The bad line is deleted; its order's events are taken up again.
    ingest.apply_batch(house, messages(spark, line_event(3010, 1, 3, 77)), 1)
    assert redrive(house, "unknown product in the order") == 2
    outcome = run_incremental(house, isolate=True)
    assert (outcome.events_read, outcome.events_dead) == (3, 0) and _of(live(house), 3) == [(3, "Axe", 8, 3010)]
    states = event_log(house).groupBy("dw_dead").count()
    assert rows_of(states) == [(False, 1000), (True, 1)]


def test_events_tried_too_often_are_dead(spark, house):
    ingest.apply_batch(house, messages(spark, line_event(41, 2, 1, 77)), 0)
    with pytest.raises(QualityError):
        run_incremental(house)
    outcome = run_incremental(house, max_attempts=1)
    assert (outcome.events_read, outcome.events_dead) == (0, 1)
    assert rows_of(house.control.read("event_dead_letters"), "error") == [("too many attempts",)]
    assert settled_before(house) > 0 and event_log(house, settled_before(house)).isEmpty()
    assert run_incremental(house, max_attempts=1).events_dead == 0


def test_states_are_counted(spark, house, monkeypatch):
    ingest.apply_batch(house, messages(spark, line_event(41, 4, 1, 1), line_event(42, 4, 2, 1)), 0)
    monkeypatch.setattr(incremental_load, "outcome_states", lambda judged, batch: outcome_states(judged.limit(1), batch))
    with pytest.raises(QualityError, match="1 event states for 2 events read"):
        run_incremental(house, isolate=True)
    monkeypatch.undo()
    assert run_incremental(house, isolate=True).events_read == 2


def test_counts_come_from_the_write(spark, tmp_path, monkeypatch):
    """Each source is read once; all star tables are gated; lost rows stop the load."""
    house, reads = Warehouse(spark, str(tmp_path / "house")), spark.sparkContext.accumulator(0)
    tables = staging(spark)
    seen = F.udf(lambda x: reads.add(1) or x, "int")
    tables["shippers"] = tables["shippers"].withColumn("shipper_id", seen("shipper_id"))
    tables["regions"] = tables["regions"].limit(0)
    load_staging(house, tables.__getitem__)
    assert reads.value == 3
    results = house.control.read("data_quality_results")
    assert results.where("status = 'passed'").count() == 11 and rows_of(results.where("table_name = 'regions'"), "expected_value") == [("0",)]
    full_load.load_star(house)
    gated = house.control.read("data_quality_results").where("status = 'passed'").select("table_name").distinct()
    assert {"dim_date", "dim_geography", "fact_orders", "dim_territory"} <= {r[0] for r in gated.collect()} and gated.count() == 21
    write = house.star_lake.write_base
    for lost in ("dim_date", "dim_geography"):
        monkeypatch.setattr(house.star_lake, "write_base", lambda t, rows, v, lost=lost: write(t, rows.limit(2) if t == lost else rows, v))
        with pytest.raises(QualityError, match=lost):
            full_load.load_star(house)
