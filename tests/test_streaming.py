import json
import shutil
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows_of
from fixtures import line_event, messages, staging
from tallyhouse.plans.full_load import Warehouse, load_staging
from tallyhouse.streaming import ingest
from tallyhouse.streaming.sources import file_messages
from tallyhouse.streaming.throughput import late_rows, start_throughput, take_batch, windows


def test_ingest_stream_restarts(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    tables = staging(spark)
    load_staging(house, tables.__getitem__, ("orders", "order_details"))
    inbox, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "checkpoint")

    def run():
        query = ingest.start_ingest(house, file_messages(spark, inbox, 1), checkpoint)
        query.awaitTermination()

    messages(spark, line_event(1, 4, 1, 1, quantity=8), "[]").coalesce(1).write.mode("append").parquet(inbox)
    messages(spark, line_event(2, 1, 1, 2)).coalesce(1).write.mode("append").parquet(inbox)
    run()
    expected = [(1, 1, 8), (2, 1, 10), (3, 1, 2)]
    assert rows_of(house.staged("order_details"), "order_id", "product_id", "quantity") == expected
    # Delivered again, and the last batch of the checkpoint run again.
    messages(spark, line_event(2, 1, 1, 2), line_event(1, 4, 1, 1, quantity=8)).coalesce(1).write.mode("append").parquet(inbox)
    run()
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    shutil.copytree(checkpoint, tmp_path / "again", ignore=lambda d, names: [n for n in names if d.endswith("commits") and n in (str(last), f".{last}.crc")])
    checkpoint = str(tmp_path / "again")
    run()
    assert rows_of(house.staged("order_details"), "order_id", "product_id", "quantity") == expected
    assert house.events.history("raw_events").count() == 2
    assert rows_of(house.control.read("dead_letters"), "error") == [("message is not a JSON object",)]


def test_stream_equals_batch(spark, tmp_path):
    folder = "/root/testdata/sf0.001/events.parquet"
    events = spark.read.parquet(folder).selectExpr("cast(ts AS timestamp) AS received_at")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = (
        ingest.throughput(stream, "1 minute").writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed = spark.read.parquet(out)
    edge = events.agg(F.date_trunc("minute", F.max("received_at") - F.expr("INTERVAL 1 MINUTE"))).first()[0]
    batch = events.groupBy(F.date_trunc("minute", "received_at").alias("minute")).agg(F.count("*").alias("events"))
    assert rows_of(closed) == rows_of(batch.where(F.col("minute") < F.lit(edge)))


def test_stream_drops_copies(spark, tmp_path):
    bodies = [line_event(n, 4, 1, 1) for n in (1, 2, 1, 2, 2)]
    messages(spark, *bodies, "{").write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = (
        ingest.distinct_events(file_messages(spark, str(tmp_path / "in")), "1 hour").writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows_of(spark.read.parquet(out), "operation_code", "start_lsn") == [(4, bodies[0]["metadata"]["start_lsn"]), (4, bodies[1]["metadata"]["start_lsn"])]


def test_a_second_checkpoint_keeps_the_first_ones_events(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    load_staging(house, staging(spark).__getitem__, ("orders", "order_details"))
    for k, body in enumerate((line_event(1, 4, 1, 1, quantity=8), line_event(2, 4, 2, 1, quantity=3))):
        inbox = str(tmp_path / f"inbox{k}")
        messages(spark, body).coalesce(1).write.parquet(inbox)
        ingest.start_ingest(house, file_messages(spark, inbox, 1), str(tmp_path / f"checkpoint{k}")).awaitTermination()
    assert house.events.history("raw_events").count() == 2


def test_late_rows_are_kept_and_correct_closed_windows(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    schema = "received_at timestamp, event_id long"
    at = lambda minute, second=0: datetime(2024, 3, 1, 10, minute, second)
    files = [
        [(at(0, 1), 1), (at(0, 59), 2), (at(4), 3)],
        [(at(3), 4), (at(4, 30), 5), (at(9), 6), (None, 7)],  # watermark 10:02: none is late
        [(at(0, 30), 8), (at(6, 59), 9), (at(7), 10), (at(4, 59), 11)],  # 10:07: three are
        [],
    ]
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        start_throughput(house, stream, checkpoint, "2 minutes").awaitTermination()
    stream = json.loads((tmp_path / "c" / "metadata").read_text())["id"]
    assert rows_of(late_rows(house, stream), "event_id", "batch") == [(11, 2), (8, 2), (9, 2)]
    found = windows(house, stream, "2 minutes")
    assert rows_of(found.where("closed"), "window_start", "events", "corrections") == rows_of(
        spark.createDataFrame([(at(0), 2, 1), (at(3), 1, 0), (at(4), 2, 1), (at(6), 0, 1)], "t timestamp, e long, c long")
    )
    everything = spark.read.schema(schema).parquet(inbox).where("received_at IS NOT NULL")
    batch = everything.groupBy(F.date_trunc("minute", "received_at").alias("minute")).agg(F.count("*").alias("n"))
    assert rows_of(found, "window_start", "total") == rows_of(batch)
    # A batch that is run again replaces what it wrote.
    take_batch(house, spark.createDataFrame(files[2], schema), stream, 2, "2 minutes", "1 minute")
    assert rows_of(windows(house, stream, "2 minutes"), "window_start", "total") == rows_of(batch)
