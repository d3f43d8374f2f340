import random
from decimal import Decimal
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from fixtures import staging
from tallyhouse import functions as fn
from tallyhouse.operators import assets, dimensions, latest, quality, scd2
from tallyhouse.operators.dimensions import Load
from tallyhouse.operators.envelope import advance_marks, build_envelopes, changes_in, resolve_ranges
from tallyhouse.plans import marts
from tallyhouse.plans.full_load import StarBuilder
from tallyhouse.plans.star import Star
from tallyhouse.sources.schemas import CAPTURES


def test_keys_and_hashes(frame):
    df = frame("a string, b int", (" x ", 1), ("x", 1), (None, 1), ("", 1), ("<NULL>", 1))
    keys = [r.k for r in df.select(fn.surrogate_key("n", F.col("a"), F.col("b")).alias("k")).collect()]
    assert keys[0] == keys[1] and keys[2] == keys[4] and len(set(keys)) == 3 and min(keys) > 0
    other = df.select(fn.surrogate_key("m", F.col("a"), F.col("b")).alias("k")).first().k
    assert other != keys[0]
    with pytest.raises(ValueError):
        fn.surrogate_key("n", F.col("a"), method="md5")
    places = frame("r string", ("",), ("  ",), (None,), ("N",))
    blank = F.lit(None).cast("string")
    got = [r.k for r in places.select(fn.geography_key(blank, F.col("r"), blank, blank, blank).alias("k")).collect()]
    assert got[0] == got[1] == got[2] != got[3]


def test_bands_ratios_and_dates(frame):
    df = frame("d decimal(9,6)", *[(v,) for v in map(Decimal, ("0", "0.1", "0.15", "0.2", "0.25"))])
    bands = [r.b for r in df.select(fn.discount_band(F.col("d")).alias("b")).collect()]
    assert bands == ["No Discount", "Up to 10%", "10-20%", "10-20%", "Over 20%"]
    money = frame("m decimal(19,2)", *[(Decimal(v),) for v in ("4999.99", "5000", "20000", "50000")])
    segments = [r.s for r in money.select(fn.revenue_segment(F.col("m")).alias("s")).collect()]
    assert segments == ["Standard", "Medium Value", "High Value", "VIP"]
    one = frame("t timestamp, z int", (datetime(2024, 1, 6, 23), 0), (None, 4))
    row, none = one.select(fn.date_key(F.col("t")).alias("k"), fn.ratio(F.lit(1), F.col("z")).alias("r")).collect()
    assert (row.k, row.r, none.k, none.r) == (20240106, None, 0, 0.25)
    days = fn.calendar_days(one, "t", margin_days=1).select(*fn.calendar_columns(F.col("day"))).collect()
    assert [(d.date_key, d.day_of_week, d.is_weekend) for d in days] == [(20240105, 6, 0), (20240106, 7, 1), (20240107, 1, 1)]


def test_latest_versions(frame):
    rows = frame(
        "k int, v string, is_deleted int, _version long, _loaded_at long",
        (1, "a", 0, 1, 1), (1, "b", 1, 2, 1), (2, "a", 0, 1, 1), (2, "b", 0, 1, 2), (3, "a", 1, 1, 1), (3, "b", 0, 2, 0),
    )
    assert rows_of(latest.live_rows(rows, ["k"]), "k", "v") == [(2, "b"), (3, "b")]
    assert latest.latest_rows(rows.select("k"), ["k"]).count() == 3
    plan = latest.latest_rows(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_history_keeps_one_open_row(spark, frame):
    customers = staging(spark)["customers"]
    times = [f"2024-0{m}-01 00:00:00" for m in range(1, 6)]
    rng = random.Random(7)
    history = None
    for number, moment in enumerate(times):
        kept = [c for c in ("C1", "C2", "C3", "C4") if rng.random() < 0.7] or ["C1"]
        name = F.concat("company_name", (F.length("customer_id") + F.lit(rng.randint(0, 1))).cast("string"))
        snapshot = customers.where(F.col("customer_id").isin(kept)).withColumn("company_name", name)
        rows = dimensions.customer_dimension(snapshot, Load("b", moment, number))
        history = rows if history is None else scd2.scd2_merge(history, rows, dimensions.CUSTOMER, F.lit(moment), close_missing=True)
        history = spark.createDataFrame(history.collect(), history.schema)
        again = scd2.scd2_merge(history, rows, dimensions.CUSTOMER, F.lit(moment), close_missing=True)
        assert rows_of(again) == rows_of(history)
        open_rows = history.where("is_current = 1")
        assert rows_of(open_rows, "customer_alternate_key") == [(c,) for c in kept]
    by_key = {}
    for r in history.collect():
        by_key.setdefault(r.customer_alternate_key, []).append((r.start_date, r.end_date))
    for spans in by_key.values():
        spans.sort(key=lambda s: s[0])
        assert all(a[1] is not None and a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert scd2.as_of_view(history, F.lit(times[0]).cast("timestamp")).where(f"start_date > '{times[0]}'").isEmpty()


def _plain_carve(data: bytes, limit: int | None):
    """Straightforward search over every offset, for comparison."""
    window, found = data[:limit], []
    for signature, name in ((b"\x89PNG\r\n\x1a\n", "png"), (b"\xff\xd8\xff", "jpeg"), (b"GIF87a", "gif"), (b"GIF89a", "gif")):
        if signature in window:
            found.append((window.index(signature), name))
    for at in range(len(window) - 1):
        head = data[at : at + 18]
        if window[at : at + 2] == b"BM" and len(head) == 18:
            size, pixels, dib = (int.from_bytes(head[i : i + 4], "little") for i in (2, 10, 14))
            rest = len(data) - at
            if 14 <= pixels < rest and 12 <= dib <= 124 and 26 <= size <= rest:
                found.append((at, "bmp"))
                break
    if not found:
        return "unknown", 0, data
    at, name = min(found)
    image = data[at:]
    if name == "bmp":
        image = image[: int.from_bytes(image[2:6], "little")]
    elif name == "jpeg" and image.find(b"\xff\xd9", 3) >= 0:
        image = image[: image.find(b"\xff\xd9", 3) + 2]
    return name, at, image


def _bmp(size=60, pixels=54, dib=40, body=10):
    head = b"BM" + size.to_bytes(4, "little") + bytes(4) + pixels.to_bytes(4, "little") + dib.to_bytes(4, "little")
    return head + bytes(36) + b"p" * body


@pytest.mark.parametrize("limit", [None, 4096])
def test_carving_matches_plain_search(spark, limit):
    rng = random.Random(3)
    png, jpeg, gif = b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff", b"GIF89a"
    payloads = [
        b"w" * 78 + _bmp(), b"w" * 78 + _bmp(body=50), png, b"x" + jpeg + b"\xff\xd9tail", jpeg + b"no end", jpeg + b"\xd9",
        b"BM text " + b"w" * 40 + _bmp(), b"BMBMBM" + _bmp(size=10), _bmp(size=4000000000), b"w" * 4088 + png, b"w" * 4089 + png,
        b"w" * 4095 + _bmp(), b"w" * 4094 + _bmp(), b"BM", b"none", b"GIF87a" + png, png + jpeg, _bmp(dib=200), _bmp(pixels=13), b"\x00",
    ]
    pieces = [png, jpeg, gif, b"BM", _bmp(), b"\xff\xd9", b"\x80\xc3\xff", b"text", bytes(30)]
    payloads += [b"".join(rng.choice(pieces) for _ in range(rng.randint(1, 8))) for _ in range(120)]
    rows = [(i, bytearray(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame([*rows, (900, None), (901, bytearray())], "id int, photo binary")
    carved = {r.id: r for r in assets.carve_images(df, "photo", limit).collect()}
    for i, payload in enumerate(payloads):
        name, at, image = _plain_carve(payload, limit)
        got = carved[i]
        assert (got.format, got.signature_offset, bytes(got.image)) == (name, at, image), payload
    assert carved[900].format is None and carved[901].format is None
    counts = assets.asset_counts(assets.carve_images(df, "photo", limit), "photo").first()
    assert (counts.asset_rows, counts.missing_photos) == (len(payloads) + 2, 2)


def test_quality_rows(frame):
    full, short = frame("a int", (1,), (2,)), frame("a int", (1,))
    results = quality.reconcile({"t": full, "u": short}, {"t": full, "u": full})
    assert rows_of(results, "table_name", "status") == [("t", "passed"), ("u", "failed")]
    with pytest.raises(quality.QualityError, match="'u'"):
        quality.require(results, "counts")
    report = quality.count_report(quality.table_counts({"b": full, "a": short}), quality.table_counts({"b": full, "a": short}))
    assert [r.table_name for r in report.collect()] == ["a", "b", "TOTAL"]
    facts = frame(
        "product_key long, customer_key long, employee_key long, shipper_key long, geography_key long, shipped_date_key long",
        (1, 0, 0, 0, 5, 0), (2, 9, 0, 1, 0, 20240101), (2, 9, 3, 1, 5, 20240101),
    )
    assert tuple(quality.unknown_members(facts).first()) == (3, 0, 1, 2, 1, 1, 1)
    dims = {table: frame(f"{key} long", (1,), (5,)) for key, (table, _) in quality.FACT_LOOKUPS.items()}
    # product 2 twice, customer 9 twice, employee 3 once, geography 0 counts as an orphan
    assert tuple(quality.orphan_keys(facts, dims).first()) == (2, 2, 1, 0, 1)


@pytest.fixture(scope="module")
def star(spark):
    builder = StarBuilder(staging(spark).__getitem__, Load("b", datetime(2024, 3, 1), 1))
    return Star(builder.table)


def test_reports_on_known_rows(star):
    # Revenue: order 1 = 50 + 18, order 2 = 85, order 3 = 15.
    assert marts.average_order_value(star).first()[0] == 56.0
    assert rows_of(marts.revenue_by_category(star)) == [("Tools", 150.0), ("Uncategorized", 18.0)]
    assert rows_of(marts.top_suppliers(star)) == [("", 18.0), ("Maker", 150.0)]
    assert rows_of(marts.orders_by_shipper(star)) == [("", 1), ("Parcel", 1), ("Swift", 1)]
    assert marts.on_time_rate(star).first()[0] == 50.0
    assert marts.average_fulfilment_days(star).first()[0] == 4.0
    assert rows_of(marts.revenue_by_discount_band(star)) == [
        ("10-20%", 85.0), ("No Discount", 50.0), ("Over 20%", 15.0), ("Up to 10%", 18.0)
    ]
    assert marts.active_customers(star).first()[0] == 2 and marts.revenue_per_customer(star).first()[0] == 84.0
    assert rows_of(marts.customers_by_segment(star)) == [("Standard", 2)]
    assert rows_of(marts.shipper_service_levels(star)) == [("Parcel", 1, 0, 0.0, 6.0), ("Swift", 1, 1, 100.0, 3.0)]
    territories = rows_of(marts.employee_territories(star), "territory_id", "region")
    assert territories == [("T01", "East"), ("T02", "West"), ("T03", "North"), ("T04", "South"), ("T05", "")]
    assert [r.product for r in marts.reorder_list(star).collect()] == ["Axe"]


def test_change_ranges(frame):
    log = frame(
        "capture_instance string, start_lsn string, seqval string, operation_code int, event_time timestamp",
        *[(i, f"0x{n:020X}", f"0x{n:020X}", 2, datetime(2024, 1, n)) for n, i in ((3, "a"), (5, "a"), (6, "b"), (4, "b"))],
    )

    def marks(**at):
        rows = [(k, v and f"0x{v:020X}", "s", datetime(2023, 1, 1)) for k, v in at.items()]
        return frame("capture_instance string, last_start_lsn string, last_seqval string, last_commit_time timestamp", *rows)

    def actions(mode, **at):
        return rows_of(resolve_ranges(log, marks(**at), mode), "capture_instance", "action")

    assert actions("latest", a=None, b=3) == [("a", "skip_to_latest"), ("b", "read")]
    assert actions("earliest", a=None, b=6) == [("a", "read"), ("b", "idle")]
    assert actions("latest", a=9, b=4) == [("a", "reset"), ("b", "read")]
    ranges = resolve_ranges(log, marks(a=1, b=4), "latest")
    got = changes_in(log, ranges)
    assert rows_of(got, "capture_instance", "event_time") == [("a", datetime(2024, 1, 3)), ("a", datetime(2024, 1, 5)), ("b", datetime(2024, 1, 6))]
    moved = advance_marks(ranges, marks(a=1, b=4), got, F.current_timestamp())
    assert rows_of(moved, "capture_instance", "last_event_count", "last_commit_time") == [("a", 2, datetime(2024, 1, 5)), ("b", 1, datetime(2024, 1, 6))]
    idle = resolve_ranges(log, marks(a=6, b=6), "latest")
    polled = advance_marks(idle, marks(a=6, b=6), changes_in(log, idle), F.current_timestamp())
    assert rows_of(polled, "last_seqval", "last_event_count") == [("s", 0), ("s", 0)]


def test_envelopes_are_accepted_back(spark, frame):
    from tallyhouse.operators.changes import parse_messages

    rows = frame(
        "start_lsn string, seqval string, operation_code int, update_mask binary, event_time timestamp, OrderID int, ProductID int, "
        "UnitPrice decimal(19,4), Quantity int, Discount double",
        ("0x01", "0x02", 2, bytearray(b"\x1f"), datetime(2024, 1, 1, 2, 3, 4, 500000), 7, 8, Decimal("1.5"), 2, 0.25),
    )
    records = build_envelopes(rows, CAPTURES[1])
    sent = records.select(
        "key", F.encode("value", "UTF-8").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"), F.current_timestamp().alias("received_at"),
    )
    back = parse_messages(sent).first()
    assert back.reject_reason is None and back.operation_type == "INSERT" and back.key == "7"
    assert back.event_time == datetime(2024, 1, 1, 2, 3, 4, 500000) and '"UnitPrice":"1.5000"' in back.payload


def test_asset_files(spark, frame, tmp_path):
    from tallyhouse.sources.asset_files import write_assets

    photos = frame("employee_id int, photo binary", (1, bytearray(b"w" * 78 + _bmp(body=50))), (2, bytearray(b"text")), (3, None))
    carved = assets.carve_images(photos, "photo")
    manifest = assets.asset_manifest(carved, "employee_id", "photo", "employee-photos")
    root = tmp_path.as_uri()
    for _ in range(2):
        write_assets(carved, manifest, "employee_id", "photo", root)
    files = {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("employee_*")}
    assert files["curated/employee-photos/employee_1.bmp"] == _bmp(body=50)[:60]
    assert files["raw/employee-photos/employee_1.bin"] == b"w" * 78 + _bmp(body=50)
    assert files["curated/employee-photos/employee_2.bin"] == b"text" and len(files) == 4
    entries = spark.read.json(f"{root}/manifests")
    assert rows_of(entries, "employee_id", "format", "curated_bytes") == [(1, "bmp", 60), (2, "unknown", 4)]


def test_quiet_instances_keep_their_place(spark, frame):
    log = frame("capture_instance string, start_lsn string", ("a", f"0x{5:020X}"))
    marks = frame("capture_instance string, last_start_lsn string", ("b", f"0x{2:020X}"))
    ranges = resolve_ranges(log, marks, "latest", ("a", "b", "c"))
    assert rows_of(ranges, "capture_instance", "action", "from_start") == [
        ("a", "skip_to_latest", True), ("b", "read", False), ("c", "skip_to_latest", True)
    ]


def test_queries_find_images_behind_the_first_bytes(spark):
    from tallyhouse.checks import QUERIES

    rows = [r for r in QUERIES["m13_whole_payload_images"](spark, "/root/testdata/sf0.001").collect() if r.doc_id % 7 == 5]
    assert rows and {(r.format, r.signature_offset) for r in rows} == {("png", 5000)}
    counts = {q: QUERIES[q](spark, "/root/testdata/sf0.001").first() for q in ("q11_asset_counts", "q11_whole_payload_counts")}
    more = counts["q11_whole_payload_counts"].curated_images - counts["q11_asset_counts"].curated_images
    assert more == len(rows)
