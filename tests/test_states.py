import json
import time
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException

from tallyhouse.plans import health
from tallyhouse.plans.full_load import Warehouse
from tallyhouse.streaming.states import ServiceStates, follow


def history(house):
    rows = house.control.read("service_state")
    return [] if rows is None else [(r.status, r.last_error, json.loads(r.details)) for r in rows.orderBy("sequence").collect()]


def wait_for(house, status, seconds=60):
    """States arrive on Spark's listener bus, after the query has gone on."""
    end = time.time() + seconds
    while time.time() < end:
        found = history(house)
        if found and found[-1][0] == status:
            return found
        time.sleep(0.3)
    raise AssertionError(f"no state {status}: {history(house)}")


def test_states_of_a_run(spark, tmp_path):
    house, inbox = Warehouse(spark, str(tmp_path / "house")), str(tmp_path / "in")
    spark.range(5).coalesce(1).write.parquet(inbox)

    def start(name, take, checkpoint):
        stream = spark.readStream.schema("id long").parquet(inbox)
        writer = stream.writeStream.queryName(name).foreachBatch(take).option("checkpointLocation", str(tmp_path / checkpoint))
        return writer.trigger(availableNow=True).start()

    def fail(rows, batch):
        raise RuntimeError("disk is full")

    states = follow(house, "cdc-consumer", heartbeat=0)
    try:
        start("another", lambda rows, batch: rows.count(), "other").awaitTermination()
        start("cdc-consumer", lambda rows, batch: rows.count(), "c").awaitTermination()
        found = wait_for(house, "stopped")
        assert found[0][0] == "running" and {s for s, _, _ in found} <= {"running", "idle", "stopped"}
        assert [d["rows"] for s, _, d in found if s == "running" and "rows" in d] == [5]
        with pytest.raises(StreamingQueryException):
            start("cdc-consumer", fail, "d").awaitTermination()
        assert "disk is full" in wait_for(house, "error")[-1][1]
    finally:
        spark.streams.removeListener(states)
    # The report on services reads what the run wrote.
    shown = health.service_state(house.control.read("service_state")).collect()
    assert [(r.service_name, r.status) for r in shown] == [("cdc-consumer", "error")] and "disk is full" in shown[0].last_error


def test_heartbeat(spark):
    """The same state is written again only after the heartbeat; other queries, and runs that began before, are not the service's."""
    written = []
    house = SimpleNamespace(record_service=lambda service, status, details, error=None: written.append((status, error)))
    states = ServiceStates(house, "s", heartbeat=1000)
    started = lambda name, run: states.onQueryStarted(SimpleNamespace(name=name, runId=run))

    def progress(rows, name="s"):
        states.onQueryProgress(
            SimpleNamespace(progress=SimpleNamespace(name=name, runId="1", batchId=1, numInputRows=rows, processedRowsPerSecond=1.0, batchDuration=5))
        )

    started("s", "1")
    started("other", "2")
    for rows in (4, 5, 0, 0, 6):
        progress(rows)
    progress(0, "other")
    states.onQueryIdle(SimpleNamespace(runId="2"))
    states.onQueryIdle(SimpleNamespace(runId="1"))
    assert written == [("running", None), ("idle", None), ("running", None), ("idle", None)]
    states.heartbeat = 0
    states.onQueryIdle(SimpleNamespace(runId="1"))
    states.onQueryTerminated(SimpleNamespace(runId="2", exception="no"))
    states.onQueryTerminated(SimpleNamespace(runId="1", exception=None))
    started("s", "3")
    states.onQueryTerminated(SimpleNamespace(runId="3", exception="boom"))
    assert written[4:] == [("idle", None), ("stopped", None), ("running", None), ("error", "boom")]
