"""Collects queries with their SQL, and gives queries the star schema of an input folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import session
from tallyhouse.operators.dimensions import Load
from tallyhouse.plans.full_load import StarBuilder, Warehouse, utc_now
from tallyhouse.plans.star import TABLE_KEYS, Star
from tallyhouse.sources.adapter import StagingAdapter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


class Inputs:
    """What a query can read for one input folder: the adapter, and star tables written once per session."""

    _open: dict[tuple[str, str], Inputs] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.adapter = StagingAdapter(spark, folder)
        self._tables: dict[str, DataFrame] = {}
        self._aside: dict[str, DataFrame] = {}
        self._house: Warehouse | None = None
        self._builder: StarBuilder | None = None

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Inputs:
        session.configure(spark, session.SMALL_PARTITIONS)
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        return cls._open[key]

    def staged(self, name: str) -> DataFrame:
        return self.adapter.table(name)

    @property
    def house(self) -> Warehouse:
        if self._house is None:
            name = hashlib.sha256(self.folder.encode()).hexdigest()[:12]
            self._house = Warehouse(self.spark, f"{session.shared_folder(self.spark)}/{name}")
        return self._house

    def star_table(self, name: str) -> DataFrame:
        """A star table, written to the shared folder the first time a report of the session needs it."""
        if name not in self._tables:
            lake = self.house.star_lake
            if self._builder is None:
                load = Load("session", utc_now(), lake.reserve_version("session"))
                self._builder = StarBuilder(self.staged, load)
            version = self._builder.load.version
            lake.write_base(name, self._builder.table(name), version)
            lake.publish(version, name)
            self._tables[name] = lake.latest(name, TABLE_KEYS[name])
        return self._tables[name]

    def aside(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Rows that a query reads many times, written to the shared folder the first time."""
        if name not in self._aside:
            self._aside[name] = self.house.aside(name, build())
        return self._aside[name]

    def adopt(self, house: Warehouse) -> None:
        """Read star tables from a warehouse that is already loaded."""
        self._tables = {name: house.latest(name) for name in TABLE_KEYS}

    @property
    def star(self) -> Star:
        return Star(self.star_table)

    def checked_table(self, name: str) -> DataFrame:
        """A star table as a lazy plan, with keys any SQL engine can recompute and without load stamps."""
        rows = StarBuilder(self.staged, Load("check", utc_now(), 1, "sha2")).table(name)
        return rows.drop("_batch_id", "_loaded_at", "_version", "start_date", "end_date")


def portable(rows: DataFrame) -> DataFrame:
    """Result types two engines agree on: whole numbers as long, decimals as double, times as text."""

    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            column = column.cast("long")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return column.alias(field.name)

    return rows.select(*map(convert, rows.schema))


def register(name: str, build: Callable[[Inputs], DataFrame], sql: str | None = None) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(Inputs.of(spark, folder)))

    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = sql
