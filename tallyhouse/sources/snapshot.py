"""Snapshot reads: source tables, staged tables and pushed-down queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.schemas import TableSpec


def conform(rows: DataFrame, spec: TableSpec, renamed: bool = False) -> DataFrame:
    """Give source rows the staged names, types and right-trimmed fixed-width columns."""

    def staged(field) -> Column:
        column = F.col(field.name if renamed else f"`{spec.source_name(field.name)}`")
        if field.name in spec.trimmed:
            column = F.rtrim(column)
        return column.cast(field.dataType).alias(field.name)

    return rows.select(*map(staged, spec.schema))


def read_table(spark: SparkSession, spec: TableSpec, folder: str, format: str = "parquet") -> DataFrame:
    """Snapshot of one source table kept as files under `folder`."""
    source = spec.source_table or pascal_case_plain(spec.name)
    return conform(spark.read.format(format).load(f"{folder}/{source}"), spec)


def pascal_case_plain(name: str) -> str:
    return "".join(part.capitalize() for part in name.split("_"))


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """Table read over JDBC, in parallel ranges of `partition_column` when bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch_size, **options)
    if partition_column:
        low, high = bounds
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=low, upperBound=high, numPartitions=partitions
        )
    return reader.load()


def jdbc_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Query evaluated by the source database, such as a filtered and ordered batch or an aggregate."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def stage(rows: DataFrame, batch_id: str, loaded_at) -> DataFrame:
    """Stamp snapshot rows on their way into staging."""
    return rows.withColumns(
        {"_batch_id": F.lit(batch_id), "_loaded_at": F.lit(loaded_at).cast("timestamp")}
    )
