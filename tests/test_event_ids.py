import pytest

from conftest import rows_of
from fixtures import line_event, lsn, messages, staging
from tallyhouse.operators.changes import EVENT_IDENTITY
from tallyhouse.plans.full_load import Warehouse, load_staging
from tallyhouse.sources import event_ids
from tallyhouse.sources.event_ids import EventIds
from tallyhouse.streaming import ingest


def ids(spark, *numbers):
    schema = "capture_instance string, start_lsn string, seqval string, operation_code int"
    return spark.createDataFrame([("i", lsn(n), lsn(n), 4) for n in numbers], schema)


@pytest.mark.parametrize("many", (1000, 1))
def test_batches_meet_only_the_ranges_they_touch(spark, tmp_path, monkeypatch, many):
    """Twenty batches along the log: the files read stay the same, and each identity of another batch there is found."""
    monkeypatch.setattr(event_ids, "MANY_RANGES", many)
    index = EventIds(spark, str(tmp_path / "ids"), digits=18)
    assert not index.exists() and index.near(ids(spark, 1), "b0") is None
    files = []
    for batch in range(20):
        mine = ids(spark, *range(batch * 256, batch * 256 + 20)).coalesce(1)
        index.write(mine, f"b{batch}")
        index.write(mine, f"b{batch}")  # run again
        found = index.near(ids(spark, batch * 256, batch * 256 + 300), "x")
        assert found.count() == 20
        files.append(len(found.inputFiles()))
    if many == 1000:
        assert set(files) == {1}
    assert index.near(ids(spark, 5, 260), "b1").count() == 20
    assert index.near(ids(spark, 5, 260), "y").count() == 40
    assert index.near(ids(spark), "y") is None or index.near(ids(spark), "y").isEmpty()


def test_a_late_copy_and_an_old_log(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    load_staging(house, staging(spark).__getitem__, ("orders", "order_details"))
    ingest.prepare(house)
    house.event_ids = EventIds(spark, str(tmp_path / "first"), digits=18)
    for batch, number in enumerate((1, 700, 1500)):
        ingest.apply_batch(house, messages(spark, line_event(number, 4, 1, 1, quantity=batch + 1)), batch)
    # A log without the index: the next batch makes it.
    house.event_ids = EventIds(spark, str(tmp_path / "second"), digits=18)
    ingest.apply_batch(house, messages(spark, line_event(1, 4, 1, 1, quantity=9), line_event(1501, 4, 2, 1)), 3)
    log = house.events.history("raw_events")
    assert rows_of(log, "start_lsn") == [(lsn(n),) for n in (1, 700, 1500, 1501)]
    stored = spark.read.parquet(house.event_ids.root)
    assert rows_of(stored, *EVENT_IDENTITY) == rows_of(log, *EVENT_IDENTITY)
    # Nothing but copies, and nothing at all.
    ingest.apply_batch(house, messages(spark, line_event(700, 4, 1, 1)), 4)
    ingest.apply_batch(house, messages(spark).limit(0), 5)
    assert house.events.history("raw_events").count() == 4
