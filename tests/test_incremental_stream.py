import shutil

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from fixtures import line_event, messages, order_event, staging
from tallyhouse.plans.full_load import Warehouse, run_full
from tallyhouse.plans.incremental_load import redrive, run_incremental
from tallyhouse.streaming import ingest
from tallyhouse.streaming.incremental import start_incremental


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    made = Warehouse(spark, str(tmp_path_factory.mktemp("loaded") / "house"))
    run_full(made, staging(spark).__getitem__)
    ingest.prepare(made)
    return made


def copy(loaded, folder):
    shutil.copytree(loaded.root, folder)
    return Warehouse(loaded.spark, str(folder))


def facts(house):
    house.refresh()
    rows = house.latest("fact_orders")
    return rows_of(rows, *[c for c in rows.columns if not c.startswith("_")])


def log(house, batch, *bodies):
    ingest.apply_batch(house, messages(house.spark, *bodies), batch)


def stream(house, folder, **options):
    start_incremental(house, str(folder), **options).awaitTermination()


BATCHES = [
    (order_event(61, 2, 9, CustomerID="C4"), line_event(62, 2, 9, 1, quantity=3), line_event(63, 1, 1, 2), "{"),
    (line_event(64, 4, 3, 1, quantity=20, discount=0.2), order_event(65, 1, 2), line_event(66, 1, 2, 1)),
    (line_event(60, 4, 3, 1, quantity=2), line_event(67, 4, 9, 1, quantity=4)),  # one event older than those taken
]


def test_a_stream_over_the_log_equals_the_batch_job(loaded, tmp_path):
    streamed, batched = copy(loaded, tmp_path / "s"), copy(loaded, tmp_path / "b")
    stream(streamed, tmp_path / "c")  # an empty log
    for k, bodies in enumerate(BATCHES):
        log(batched, k, *bodies)
        log(streamed, k, *bodies)
        if k != 1:  # two log batches in one micro-batch at the end
            run_incremental(batched)
            stream(streamed, tmp_path / "c", per_trigger=10)
    assert facts(streamed) == facts(batched) != facts(loaded)
    done = lambda: streamed.control.read("event_states").where("dw_processed_at IS NOT NULL").count()
    assert done() == streamed.events.history("raw_events").count() == 8
    # An ingest batch and a micro-batch that run again change nothing, nor does the batch job.
    before = facts(streamed)
    log(streamed, 1, *BATCHES[1])
    stream(streamed, tmp_path / "c")
    last = max(int(p.name) for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit())
    shutil.copytree(tmp_path / "c", tmp_path / "again", ignore=lambda d, names: [n for n in names if d.endswith("commits") and n in (str(last), f".{last}.crc")])
    stream(streamed, tmp_path / "again")
    assert run_incremental(streamed).events_read == 0
    assert facts(streamed) == before and done() == 8


def test_a_failed_micro_batch_is_taken_again(loaded, tmp_path):
    house = copy(loaded, tmp_path / "h")
    log(house, 0, line_event(41, 2, 1, 77), line_event(42, 4, 2, 1, quantity=6))
    with pytest.raises(Exception, match="fact lookups"):
        stream(house, tmp_path / "c")
    assert facts(house) == facts(loaded)
    log(house, 1, line_event(43, 1, 1, 77))  # the cause goes
    stream(house, tmp_path / "c")
    assert house.star.facts.where("order_id = 2").first().quantity == 6
    states = house.control.read("event_states")
    assert states.where("dw_processed_at IS NOT NULL").count() == 3 and states.where("dw_processing_error IS NOT NULL").count() == 2


def test_bad_events_go_to_the_dead_letters_and_back(loaded, tmp_path):
    house = copy(loaded, tmp_path / "h")
    log(house, 0, line_event(41, 2, 1, 77), line_event(42, 4, 2, 1, quantity=6))
    stream(house, tmp_path / "c", isolate=True)
    assert house.star.facts.where("order_id = 2").first().quantity == 6
    assert rows_of(house.control.read("event_dead_letters"), "error") == [("unknown product in the order",)]
    log(house, 1, line_event(43, 1, 1, 77))
    stream(house, tmp_path / "c", isolate=True)
    assert redrive(house) == 1 and run_incremental(house).events_read == 1
    assert house.star.facts.where(F.col("order_id") == 1).count() == 2
