from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from fixtures import lsn
from tallyhouse.operators.envelope import BEFORE_LOG
from tallyhouse.plans.full_load import Warehouse
from tallyhouse.plans.publish_changes import FileSink, current_marks, publish_changes

META = "start_lsn string, seqval string, operation_code short, update_mask binary, event_time timestamp"
TABLES = {"dbo_Orders": f"{META}, OrderID int, ShipName string", "dbo_Order_Details": f"{META}, OrderID int, ProductID int, Quantity short"}


@pytest.fixture
def polls(spark, tmp_path):
    """A warehouse, its file sink, the change tables, and a poll of them."""
    house = Warehouse(spark, str(tmp_path / "house"))
    sink, rows = FileSink(spark, str(tmp_path / "records")), {name: [] for name in TABLES}

    def poll(mode="latest", to=None):
        return publish_changes(house, lambda name: spark.createDataFrame(rows[name], TABLES[name]), to or sink, mode).published

    return house, sink, rows, poll


def change(number, *values):
    return (lsn(number), lsn(number), 4, bytearray(b"\x1f"), datetime(2024, 3, 1), *values)


def published(sink):
    return sorted(r[0].split(":")[1][-2:] for r in sink.read().select(F.get_json_object("value", "$.event_id")).collect())


def marks(house):
    return dict(rows_of(current_marks(house), "capture_instance", "last_start_lsn"))


def test_a_quiet_table_loses_nothing(polls):
    house, sink, rows, poll = polls
    assert poll() == 0 and set(marks(house).values()) == {BEFORE_LOG}
    rows["dbo_Orders"] += [change(1, 7, "a")]
    assert poll() == 1 and set(marks(house).values()) == {lsn(1)}
    rows["dbo_Order_Details"] += [change(2, 7, 1, 5)]
    assert poll() == 1 and poll() == 0 and published(sink) == ["01", "02"]
    states = house.control.read("service_state").orderBy("sequence").select("status")
    assert [r.status for r in states.collect()] == ["idle", "running", "running", "idle"]
    records = {r.topic: r for r in sink.read().collect()}
    assert records["orders.cdc"].key == "7" and records["order_details.cdc"].headers[0].value == b"dbo_Order_Details"


def test_first_poll_from_the_end_or_from_the_start(polls):
    house, sink, rows, poll = polls
    rows["dbo_Orders"] += [change(1, 7, "a"), change(2, 8, "b")]
    assert poll("latest") == 0 and set(marks(house).values()) == {lsn(2)}
    rows["dbo_Orders"] += [change(3, 9, "c")]
    assert poll("earliest") == 1 and published(sink) == ["03"]


def test_a_crash_between_records_and_marks(polls, monkeypatch):
    house, sink, rows, poll = polls
    rows["dbo_Orders"] += [change(1, 7, "a"), change(2, 8, "b")]
    rows["dbo_Order_Details"] += [change(3, 7, 1, 5)]
    append = house.control.append

    def crash(table, frame):
        if table == "publish_marks":
            raise OSError("lost")
        append(table, frame)

    monkeypatch.setattr(house.control, "append", crash)
    with pytest.raises(OSError):
        poll("earliest")
    assert published(sink) == ["01", "02", "03"] and marks(house) == {}
    monkeypatch.undo()
    # Run again after the log has grown: the same records replace those written, and the next poll takes the rest.
    rows["dbo_Orders"] += [change(4, 9, "d")]
    assert poll("earliest") == 3 and published(sink) == ["01", "02", "03"]
    assert poll("earliest") == 1 and published(sink) == ["01", "02", "03", "04"]
    assert set(marks(house).values()) == {lsn(4)}
    assert house.control.read("service_state").where("status = 'error' AND last_error LIKE '%lost%'").count() == 1


def test_a_sink_that_fails_moves_no_mark(polls):
    house, sink, rows, poll = polls
    rows["dbo_Orders"] += [change(1, 7, "a")]

    def broken(records, number):
        raise ValueError("no broker")

    with pytest.raises(ValueError):
        poll("earliest", broken)
    assert marks(house) == {} and poll("earliest") == 1 and published(sink) == ["01"]


def test_marks_past_the_log_and_before_its_start(polls):
    house, sink, rows, poll = polls
    rows["dbo_Orders"] += [change(5, 7, "a")]
    assert poll("earliest") == 1
    # Older changes of the log were cleaned away; then the log began anew.
    rows["dbo_Orders"][:] = [change(8, 8, "b"), change(9, 9, "c")]
    assert poll() == 2 and set(marks(house).values()) == {lsn(9)}
    rows["dbo_Orders"][:] = [change(2, 8, "b")]
    assert poll() == 0 and marks(house)["dbo_Orders"] == lsn(2)
    rows["dbo_Orders"] += [change(3, 8, "e")]
    assert poll() == 1 and published(sink) == ["03", "05", "08", "09"]
