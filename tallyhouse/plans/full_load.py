"""Full load: source tables -> staging -> star schema, published only when every gate passes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cache, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import dimensions as dims
from tallyhouse.operators import quality
from tallyhouse.operators.changes import apply_changes, last_change
from tallyhouse.operators.facts import Lookups, employee_territory_facts, full_order_facts
from tallyhouse.plans import history as kept
from tallyhouse.plans.star import TABLE_KEYS, Star
from tallyhouse.sources.event_ids import EventIds
from tallyhouse.sources.lake import Lake, Ledger
from tallyhouse.sources.schemas import BY_NAME, CAPTURES
from tallyhouse.sources.snapshot import stage
from tallyhouse.sources.staged_changes import StagedChanges

# Warehouse table -> staged table with the same number of rows.
COUNT_GATES = {
    "dim_customer": "customers",
    "dim_employee": "employees",
    "dim_supplier": "suppliers",
    "dim_product": "products",
    "dim_shipper": "shippers",
    "dim_territory": "territories",
    "fact_employee_territories": "employee_territories",
    "fact_orders": "order_details",
}
RUN_SCHEMA = (
    "run_id string, pipeline_name string, run_type string, status string, started_at timestamp, "
    "finished_at timestamp, rows_read long, rows_written long, error_message string, metadata string, sequence long"
)
SNAPSHOT_SCHEMA = "table_name string, version long, at_lsn string, batch_id string, taken_at timestamp"
PARALLEL_WRITES = 4


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def at_once(spark: SparkSession, write: Callable[[str], DataFrame], names: list[str]) -> dict[str, DataFrame]:
    """Run the write jobs of several tables together: small tables do not leave a cluster idle."""
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        return dict(zip(names, pool.map(inheritable_thread_target(spark)(write), names)))


class StarBuilder:
    """Warehouse tables as lazy DataFrames over staged tables; each plan is made when first asked for."""

    def __init__(self, staged: Callable[[str], DataFrame], load: dims.Load, photos: DataFrame | None = None):
        self.staged, self.load, self.photos = cache(staged), load, photos
        self.table = cache(lambda name: getattr(self, f"_{name}")())

    def _dim_date(self) -> DataFrame:
        return dims.date_dimension(self.staged("orders"), self.load)

    def _dim_geography(self) -> DataFrame:
        roles = map(self.staged, ("customers", "employees", "suppliers", "orders"))
        return dims.geography_dimension(*roles, self.load)

    def _dim_customer(self) -> DataFrame:
        return dims.customer_dimension(self.staged("customers"), self.load)

    def _dim_employee(self) -> DataFrame:
        return dims.employee_dimension(self.staged("employees"), self.load, self.photos)

    def _dim_supplier(self) -> DataFrame:
        return dims.supplier_dimension(self.staged("suppliers"), self.load)

    def _dim_shipper(self) -> DataFrame:
        return dims.shipper_dimension(self.staged("shippers"), self.load)

    def _dim_territory(self) -> DataFrame:
        return dims.territory_dimension(self.staged("territories"), self.staged("regions"), self.load)

    def _dim_product(self) -> DataFrame:
        return dims.product_dimension(
            self.staged("products"), self.staged("categories"), self.table("dim_supplier"), self.load
        )

    def _fact_employee_territories(self) -> DataFrame:
        pairs = employee_territory_facts(
            self.staged("employee_territories"), self.table("dim_employee"), self.table("dim_territory")
        )
        return self.load.stamp(pairs)

    def _fact_orders(self) -> DataFrame:
        lookups = Lookups.fresh(self.table)
        return full_order_facts(self.staged("orders"), self.staged("order_details"), lookups, self.load)


@dataclass
class Warehouse:
    """Staging, star schema and control tables under one folder."""

    spark: SparkSession
    root: str

    def __post_init__(self):
        self.staging = Lake(self.spark, f"{self.root}/staging")
        self.staged_changes = StagedChanges(self.spark, f"{self.root}/staged_changes")
        self._held: dict[tuple[str, int], str] = {}
        self.star_lake = Lake(self.spark, f"{self.root}/star")
        self.events = Lake(self.spark, f"{self.root}/events")
        self.event_ids = EventIds(self.spark, f"{self.root}/event_ids")
        self.control = Ledger(self.spark, f"{self.root}/control")

    def refresh(self) -> None:
        for lake in (self.staging, self.star_lake, self.events):
            lake.refresh()

    def snapshot_lsn(self, table: str) -> str:
        """Log position that the published snapshot of a staged table holds; a version's position never changes."""
        version = int(self.staging.folder(table).rsplit("/v", 1)[1])
        if (table, version) not in self._held:
            known = self.control.read("snapshots")
            mine = None if known is None else known.where((F.col("table_name") == table) & (F.col("version") == version)).first()
            self._held[table, version] = mine.at_lsn if mine else ""
        return self._held[table, version]

    def log_position(self) -> str:
        """Highest log position taken in so far; a snapshot read from now on holds all up to it."""
        known = self.control.read("log_positions")
        return (None if known is None else known.agg(F.max("start_lsn")).first()[0]) or ""

    def staged(self, table: str) -> DataFrame:
        """Staged rows: the snapshot, and the change events after the position it holds."""
        base, changes = self.staging.base(table).select(*BY_NAME[table].schema.names), self.staged_changes.read(table)
        return base if changes is None else apply_changes(base, changes, BY_NAME[table].keys, self.snapshot_lsn(table))

    def fold_staging(self) -> None:
        """Fold the applied change events of staging, so that reads stay cheap as batches add up."""
        self.refresh()
        for capture in CAPTURES:
            self.staged_changes.fold(capture.staged, BY_NAME[capture.staged].keys, self.snapshot_lsn(capture.staged), last_change)

    def aside(self, name: str, rows: DataFrame) -> DataFrame:
        """Write the intermediate rows of a batch and read them back: retries see the same rows."""
        folder = f"{self.root}/batches/{name}"
        rows.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def latest(self, table: str) -> DataFrame:
        return self.star_lake.latest(table, TABLE_KEYS.get(table) or kept.HISTORY_KEYS[table])

    @property
    def star(self) -> Star:
        return Star(self.latest)

    def record_run(self, run_id: str, name: str, kind: str, status: str, started: datetime, **outcome) -> None:
        """Append the state of a run; its last row is its current state."""
        finished = None if status == "running" else utc_now()
        error = outcome.get("error")
        row = (
            run_id, name, kind, status, started, finished, outcome.get("rows_read", 0), outcome.get("rows_written", 0),
            error, json.dumps(outcome.get("metadata", {})),
            0 if status == "running" else 1,
        )
        self.control.add("pipeline_runs", RUN_SCHEMA, row)

    def record_service(self, service: str, status: str, details: dict, error: str | None = None) -> None:
        schema = (
            "sequence long, service_name string, status string, last_heartbeat timestamp, last_error string, "
            "details string, updated_at timestamp"
        )
        now = utc_now()
        sequence = int(now.replace(tzinfo=timezone.utc).timestamp() * 1_000_000)
        text = error
        self.control.add("service_state", schema, (sequence, service, status, now, text, json.dumps(details), now))

    def gate(self, run_id: str, what: str, results: DataFrame) -> None:
        """Record quality results, then stop the job if one failed. There is one row per checked table."""
        rows = self.spark.createDataFrame(results.collect(), results.schema)
        stamps = {"run_id": F.lit(run_id), "checked_at": F.lit(utc_now()).cast("timestamp")}
        self.control.append("data_quality_results", rows.withColumns(stamps).coalesce(1))
        quality.require(rows, what)


def load_staging(
    house: Warehouse, read: Callable[[str], DataFrame], tables=None, batch_id: str | None = None, at_lsn: str | None = None
) -> None:
    """Snapshot source tables into staging and reconcile the row counts before publishing.

    `at_lsn` is the end of the source's log just before the tables are read; without it, the last position taken in. The snapshot
    holds all changes up to it. Later ones, also those taken in while this runs, are applied on top. A snapshot older than
    the published one is refused, as changes between the two may have been folded.
    """
    names = list(tables or BY_NAME)
    batch_id = batch_id or str(uuid.uuid4())
    house.refresh()
    started, lake = utc_now(), house.staging
    position = house.log_position() if at_lsn is None else at_lsn
    newer = [n for n in names if n in lake.tables() and house.snapshot_lsn(n) > position]
    if newer:
        raise ValueError(f"the published snapshots of {', '.join(newer)} hold the log beyond {position or 'its start'}")
    house.record_run(batch_id, "staging_load", "full", "running", started)
    version = lake.reserve_version(batch_id)
    sources = {name: quality.counted_in_write(read(name)) for name in names}
    try:
        written = at_once(house.spark, lambda name: lake.write_base(name, stage(sources[name][0], batch_id, started), version), names)
        read_rows = quality.known_counts(house.spark, {name: seen.get["rows"] for name, (_, seen) in sources.items()})
        house.gate(batch_id, "staging row counts", quality.compare_counts(read_rows, quality.table_counts(written)))
    except Exception as error:
        house.record_run(batch_id, "staging_load", "full", "failed", started, error=f"{type(error).__name__}: {error}")
        raise
    house.control.add("snapshots", SNAPSHOT_SCHEMA, *((name, version, position, batch_id, started) for name in names))
    lake.publish(version, *names)
    total = quality.table_counts(written).agg(F.sum("row_count")).first()[0]
    house.record_run(batch_id, "staging_load", "full", "success", started, rows_read=total, rows_written=total)


def expected_counts(staged: Callable[[str], DataFrame], tables: list[str]) -> DataFrame:
    """Rows that each of these star tables must have by what is staged."""
    counted = {name: staged(source) for name, source in COUNT_GATES.items() if name in tables}
    parts = [quality.table_counts(counted)] if counted else []
    if "dim_date" in tables:
        parts.append(quality.calendar_count(staged("orders")))
    if "dim_geography" in tables:
        roles = (("customers", ""), ("employees", ""), ("suppliers", ""), ("orders", "ship_"))
        parts.append(quality.place_count([(staged(name), prefix) for name, prefix in roles]))
    return reduce(DataFrame.unionByName, parts)


def write_history(house: Warehouse, dimensions: dict[str, DataFrame], load: dims.Load) -> dict[str, DataFrame]:
    """Write and check the histories and version tables that belong to newly written dimensions."""
    lake, orders, details = house.star_lake, house.staged("orders"), house.staged("order_details")
    merged = {kept.history_table(d): kept.merged_history(lake, d, dimensions[d.table], load.loaded_at) for d in kept.KEPT}
    histories = at_once(house.spark, lambda name: lake.write_base(name, merged[name], load.version), list(merged))
    found = {name: load.stamp(rows) for name, rows in kept.versions(lake, orders, details, histories).items()}
    versions = at_once(house.spark, lambda name: lake.write_base(name, found[name], load.version), list(found))
    sources = {kept.history_table(d): dimensions[d.table] for d in kept.KEPT}
    # Lines without an order have no date and no fact.
    lines = details.join(orders.select("order_id"), "order_id", "left_semi")
    expected = quality.table_counts({**sources, kept.ORDER_VERSIONS: orders, kept.LINE_VERSIONS: lines})
    open_rows = {name: rows.where("is_current = 1") for name, rows in histories.items()}
    house.gate(load.batch_id, "history row counts", quality.compare_counts(expected, quality.table_counts({**open_rows, **versions})))
    return {**histories, **versions}


def load_star(
    house: Warehouse, tables=None, batch_id: str | None = None, key_method: str = "xxhash64", history: bool | None = None
) -> None:
    """Build, write, check and publish star tables. Nothing changes for readers when a gate fails.

    `history` keeps the versions of dimension members, too, and the versions each order met; once kept, later whole loads keep them
    without being told.
    """
    batch_id = batch_id or str(uuid.uuid4())
    house.refresh()
    started, lake = utc_now(), house.star_lake
    house.record_run(batch_id, "star_load", "full", "running", started)
    version = lake.reserve_version(batch_id)
    load = dims.Load(batch_id, started, version, key_method)
    wanted = list(tables or TABLE_KEYS)
    with_history = history if history is not None else tables is None and kept.is_kept(lake)
    if with_history and not {d.table for d in kept.KEPT} <= set(wanted):
        raise ValueError("history needs all dimensions it is kept of in the same load")
    try:
        builder = StarBuilder(house.staged, load)
        built = {name: builder.table(name) for name in wanted}
        written = at_once(house.spark, lambda name: lake.write_base(name, built[name], version), wanted)
        house.gate(batch_id, "star row counts", quality.compare_counts(expected_counts(house.staged, wanted), quality.table_counts(written)))
        if with_history:
            written |= write_history(house, written, load)
    except Exception as error:
        house.record_run(batch_id, "star_load", "full", "failed", started, error=f"{type(error).__name__}: {error}")
        raise
    lake.publish(version, *written)
    total = quality.table_counts(written).agg(F.sum("row_count")).first()[0]
    house.record_run(batch_id, "star_load", "full", "success", started, rows_written=total)


def run_full(house: Warehouse, read: Callable[[str], DataFrame], history: bool | None = None) -> None:
    load_staging(house, read)
    load_star(house, history=history)
