"""Service states of streaming queries, from what Spark reports of them.

A service is the query of that name. It is `running` with each batch that had rows and `idle` when there were none; both are its
heartbeat. In the end it is `stopped`, or `error` with the message.
"""

from __future__ import annotations

import time

from pyspark.sql.streaming import StreamingQueryListener

from tallyhouse.plans.full_load import Warehouse


class ServiceStates(StreamingQueryListener):
    """Writes the states of one service to the warehouse. A state that stays the same is written again after `heartbeat` seconds."""

    def __init__(self, house: Warehouse, service: str, heartbeat: float = 30.0):
        self.house, self.service, self.heartbeat = house, service, heartbeat
        self._runs: set[str] = set()
        self._last: tuple[str, float] = ("", 0.0)

    def _record(self, status: str, details: dict, error: str | None = None) -> None:
        now = time.monotonic()
        if (status, error) == (self._last[0], None) and now - self._last[1] < self.heartbeat:
            return
        self._last = (status, now)
        self.house.record_service(self.service, status, details, error)

    def onQueryStarted(self, event) -> None:
        if event.name == self.service:
            self._runs.add(str(event.runId))
            self._last = ("", 0.0)
            self._record("running", {"run_id": str(event.runId)})

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name == self.service:
            details = {
                "run_id": str(progress.runId),
                "batch_id": progress.batchId,
                "rows": progress.numInputRows,
                "rows_per_second": progress.processedRowsPerSecond,
                "batch_ms": progress.batchDuration,
            }
            self._record("running" if progress.numInputRows else "idle", details)

    def onQueryIdle(self, event) -> None:
        if str(event.runId) in self._runs:
            self._record("idle", {"run_id": str(event.runId)})

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        if run in self._runs:
            self._runs.discard(run)
            self._record("error" if event.exception else "stopped", {"run_id": run}, event.exception)


def follow(house: Warehouse, service: str, heartbeat: float = 30.0) -> ServiceStates:
    """Follow the queries named `service` from now on; `spark.streams.removeListener` ends it."""
    states = ServiceStates(house, service, heartbeat)
    house.spark.streams.addListener(states)
    return states
