
import pytest
from pyspark.sql import functions as F

from fixtures import event, line_event, lsn, messages, order_event
from tallyhouse.operators import changes as ch
from tallyhouse.sources.schemas import CAPTURES

ORDERS, LINES = CAPTURES
KEY = {"OrderID": 1}

REFUSED = [
    (None, ch.EMPTY_VALUE),
    ("{broken", ch.INVALID_JSON),
    (b"\xff\xfe{}", ch.INVALID_JSON),
    ("[]", ch.NOT_AN_OBJECT),
    ("null", ch.NOT_AN_OBJECT),
    (event(1, "x", 2, KEY), ch.UNSUPPORTED_INSTANCE),
    (event(1, "dbo_Orders", "DROP", KEY), ch.INVALID_OPERATION),
    (event(1, "dbo_Orders", "two", KEY), ch.INVALID_OPERATION),
    (event(1, "dbo_Orders", 9, KEY), ch.UNSUPPORTED_OPERATION),
    (event(1, "dbo_Orders", 2, KEY, business_key="1"), ch.KEY_NOT_OBJECT),
    (event(1, "dbo_Orders", 2, KEY, business_key='{"OrderID": 1}'), ch.KEY_NOT_OBJECT),
    (event(1, "dbo_Orders", 2, KEY, payload=[1]), ch.PAYLOAD_NOT_OBJECT),
    (event(1, "dbo_Orders", 2, KEY, metadata="DROP"), ch.METADATA_NOT_OBJECT),
    (event(1, "dbo_Orders", 2, KEY, metadata={"seqval": "0x1"}), ch.NO_START_LSN),
    (event(1, "dbo_Orders", 2, KEY, metadata={"start_lsn": "0x1", "seqval": ""}), ch.NO_SEQVAL),
    (line_event(1, 2, 1, 1, quantity="abc"), ch.INVALID_PAYLOAD),
    (line_event(1, 4, 1, 1, price="cheap"), ch.INVALID_PAYLOAD),
    (line_event(1, 4, 1, 1, price=None), ch.INVALID_PAYLOAD),
    (event(1, "dbo_Order_Details", 1, KEY), ch.INVALID_PAYLOAD),
    (order_event(1, 2, "x"), ch.INVALID_PAYLOAD),
    (order_event(1, 2, 1, OrderDate="soon"), ch.INVALID_PAYLOAD),
    (order_event(1, 2, 1, Freight="much"), ch.INVALID_PAYLOAD),
    (event(1, "dbo_Orders", 2, KEY, event_time="later"), ch.INVALID_PAYLOAD),
]
ACCEPTED = [
    order_event(1, 2, 1),
    order_event(2, "2", 1),
    order_event(3, 4, 1, OrderDate="2024-01-02T03:04:05", Freight="1.5", ShipName=None, Extra="kept"),
    event(4, "dbo_Orders", 3, KEY, {"OrderDate": "nonsense"}),
    line_event(5, 2, 1, 2),
    event(6, "dbo_Order_Details", 1, {"OrderID": 1, "ProductID": 2}, {"Quantity": "abc"}),
]


def test_reject_reasons(spark):
    parsed = ch.parse_messages(messages(spark, *[body for body, _ in REFUSED], *ACCEPTED))
    got = [r.reject_reason for r in parsed.orderBy("offset").collect()]
    assert got == [reason for _, reason in REFUSED] + [None] * len(ACCEPTED)
    letters = ch.dead_letters(parsed, F.current_timestamp())
    assert letters.count() == len(REFUSED) and ch.accepted(parsed).count() == len(ACCEPTED)
    bad_bytes = letters.where("source_offset = 2").first()
    assert bad_bytes.raw_value.endswith("{}")


def test_decoded_values(spark):
    body = order_event(7, 4, 1, CustomerID="AB \t", OrderDate="2024-01-02T03:04:05+05:00", Freight="1.25", ShipVia=3.0, ShipName="N ")
    events = ch.accepted(ch.parse_messages(messages(spark, body)))
    row = ch.row_changes(events, ORDERS).first()
    assert (row.customer_id, str(row.freight), row.ship_via, row.ship_name) == ("AB", "1.2500", 3, "N ")
    assert str(row.order_date) == "2024-01-02 03:04:05"
    assert events.first().operation_type == "UPDATE_AFTER" and events.first().event_id.startswith("dbo_Orders:0x")


SCRIPT = [
    line_event(1, 3, 1, 1, quantity=5), line_event(1, 4, 1, 1, quantity=6),
    line_event(2, 1, 1, 2), line_event(3, 2, 1, 2, quantity=9),
    line_event(4, 2, 1, 3, quantity=1), line_event(5, 1, 1, 3),
    line_event(6, 2, 2, 1, quantity=4),
]
FINAL = [(1, 1, 6), (1, 2, 9), (2, 1, 4), (8, 8, 8)]


def _lines(spark):
    return spark.createDataFrame(
        [(1, 1, None, 5, 0.0), (1, 2, None, 7, 0.0), (8, 8, None, 8, 0.0)],
        "order_id long, product_id int, unit_price decimal(19,4), quantity int, discount float",
    )


def _apply(base, spark, bodies):
    events = ch.unseen(ch.accepted(ch.parse_messages(messages(spark, *bodies))))
    return ch.apply_changes(base, ch.row_changes(events, LINES), ("order_id", "product_id"))


def _state(df):
    return sorted(tuple(r) for r in df.select("order_id", "product_id", "quantity").collect())


@pytest.mark.parametrize("bodies", [SCRIPT, SCRIPT[::-1], SCRIPT + SCRIPT, SCRIPT[3:] + SCRIPT[:3] + SCRIPT])
def test_order_and_copies_do_not_matter(spark, bodies):
    assert _state(_apply(_lines(spark), spark, bodies)) == FINAL


def test_changes_before_the_snapshot_are_ignored(spark):
    events = ch.accepted(ch.parse_messages(messages(spark, *SCRIPT)))
    state = ch.apply_changes(_lines(spark), ch.row_changes(events, LINES), ("order_id", "product_id"), after_lsn=lsn(5))
    assert _state(state) == [(1, 1, 5), (1, 2, 7), (2, 1, 4), (8, 8, 8)]


def test_unseen_keeps_first_position(spark):
    once = ch.accepted(ch.parse_messages(messages(spark, *SCRIPT)))
    twice = ch.accepted(ch.parse_messages(messages(spark, *SCRIPT, *SCRIPT)))
    fresh = ch.unseen(twice)
    assert fresh.count() == len(SCRIPT) and fresh.agg(F.max("offset")).first()[0] == len(SCRIPT) - 1
    assert ch.unseen(twice, once).isEmpty()


def test_pending_is_oldest_first(spark):
    rows = [(i, lsn(i), lsn(i), 2, "p", None if i % 2 else "e", None) for i in range(9, 0, -1)]
    events = spark.createDataFrame(
        rows, "event_id long, start_lsn string, seqval string, operation_code int, processed_at string, processing_error string, dw_processed_at string"
    )
    assert [r.event_id for r in ch.pending(events, 3).collect()] == [1, 3, 5]
    assert ch.pending(events).count() == 5
