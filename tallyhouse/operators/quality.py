"""Data-quality checks as DataFrames: one row per check, with expected and actual values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.keys import clean_text
from tallyhouse.operators.dimensions import CUSTOMER, EMPLOYEE, PRODUCT, SHIPPER

PASSED, FAILED = "passed", "failed"
TOTAL = "TOTAL"
ROW_COUNT_CHECK = "source_target_row_count"

# Lookup columns of the order fact -> (dimension table, is key 0 an accepted unknown member).
FACT_LOOKUPS = {
    PRODUCT.surrogate: (PRODUCT.table, False),
    CUSTOMER.surrogate: (CUSTOMER.table, True),
    EMPLOYEE.surrogate: (EMPLOYEE.table, True),
    SHIPPER.surrogate: (SHIPPER.table, True),
    "geography_key": ("dim_geography", False),
}


class QualityError(RuntimeError):
    """A gate found rows missing or invalid."""


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table; each count reads no columns."""
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def counted_in_write(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """`rows`, and an observation that has their number as `rows` once a job has written them: the source is read once. Nothing
    between here and the write may shuffle, so that each row counts in one task."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def known_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Row counts the driver has, one row per table."""
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


def calendar_count(orders: DataFrame, margin_days: int = 365) -> DataFrame:
    """Rows that dim_date must have: every day of the orders' dates and the margin on both sides."""
    dates = orders.select(F.explode(F.array(*(F.col(c).cast("date") for c in ("order_date", "required_date", "shipped_date")))).alias("day"))
    days = F.datediff(F.max("day"), F.min("day")) + 1 + 2 * margin_days
    return dates.agg(F.coalesce(days, F.lit(0)).cast("long").alias("row_count")).select(F.lit("dim_date").alias("table_name"), "row_count")


def place_count(roles: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Rows that dim_geography must have: the distinct addresses of all roles (rows, column prefix)."""
    parts = ("country", "region", "city", "postal_code", "address")
    keys = [rows.select(F.sha2(F.to_json(F.array(*(clean_text(F.col(prefix + p)) for p in parts))), 256).alias("place")) for rows, prefix in roles]
    places = reduce(DataFrame.unionByName, keys)
    return places.agg(F.countDistinct("place").alias("row_count")).select(F.lit("dim_geography").alias("table_name"), "row_count")


def _status(expected: Column, actual: Column) -> Column:
    return F.when(expected.eqNullSafe(actual), PASSED).otherwise(FAILED)


def compare_counts(expected: DataFrame, actual: DataFrame, check_name: str = ROW_COUNT_CHECK) -> DataFrame:
    """Quality rows of two (table_name, row_count) frames; a table missing on a side fails."""
    return (
        expected.withColumnRenamed("row_count", "expected")
        .join(actual.withColumnRenamed("row_count", "actual"), "table_name", "full_outer")
        .select(
            F.lit(check_name).alias("check_name"),
            "table_name",
            _status(F.col("expected"), F.col("actual")).alias("status"),
            F.col("expected").cast("string").alias("expected_value"),
            F.col("actual").cast("string").alias("actual_value"),
        )
    )


def reconcile(sources: dict[str, DataFrame], targets: dict[str, DataFrame]) -> DataFrame:
    """Source against target row counts per table."""
    return compare_counts(table_counts(sources), table_counts(targets))


def count_report(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected-count report with PASS or FAIL per table and a total row at the end."""
    report = actual.withColumnRenamed("row_count", "actual_rows").join(
        expected.withColumnRenamed("row_count", "expected_rows"), "table_name"
    )
    total = report.agg(
        F.lit(TOTAL).alias("table_name"),
        F.sum("actual_rows").alias("actual_rows"),
        F.sum("expected_rows").alias("expected_rows"),
    )
    verdict = F.when(F.col("actual_rows") == F.col("expected_rows"), "PASS").otherwise("FAIL")
    return (
        report.unionByName(total)
        .withColumn("result", verdict)
        .orderBy(F.col("table_name") == TOTAL, "table_name")
    )


def unknown_members(facts: DataFrame) -> DataFrame:
    """Facts without a lookup, per lookup, and lines not shipped yet; one scan."""
    missing = [
        F.count_if(F.col(key) == 0).alias(f"missing_{key.removesuffix('_key')}_lookup") for key in FACT_LOOKUPS
    ]
    return facts.agg(
        F.count("*").alias("fact_rows"),
        *missing,
        F.count_if(F.col("shipped_date_key") == 0).alias("not_yet_shipped_lines"),
    )


def orphan_keys(facts: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Facts whose key has no dimension row, per lookup.

    Facts are scanned once: the lookup keys of a row are laid out as (lookup, key) pairs, the lookup by its number, and
    counted map-side before the only shuffle, so hot keys shrink to one row per task.
    """
    number = {key: F.lit(n).cast("byte") for n, key in enumerate(FACT_LOOKUPS)}
    pairs = F.explode(F.array(*[F.struct(number[k].alias("lookup"), F.col(k).alias("key")) for k in FACT_LOOKUPS]))
    used = facts.select(pairs.alias("pair")).groupBy("pair.lookup", "pair.key").agg(F.count("*").alias("rows"))
    exempt = [number[key] for key, (_, unknown_allowed) in FACT_LOOKUPS.items() if unknown_allowed]
    used = used.where(~(F.col("lookup").isin(*exempt) & (F.col("key") == 0)))
    known = reduce(
        DataFrame.unionByName,
        [dimensions[table].select(number[key].alias("lookup"), F.col(key).alias("key")) for key, (table, _) in FACT_LOOKUPS.items()],
    )
    orphans = used.join(known, ["lookup", "key"], "left_anti")
    return orphans.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("lookup") == number[key], F.col("rows"))), F.lit(0)).alias(
                f"orphan_{key.removesuffix('_key')}_keys"
            )
            for key in FACT_LOOKUPS
        ]
    )


def lookup_loss(orders: DataFrame, details: DataFrame, facts: DataFrame) -> DataFrame:
    """Joined order lines against the fact rows made from them; a lost row means a missing lookup."""
    pairs = orders.select("order_id").join(details.select("order_id", "product_id"), "order_id")
    return compare_counts(table_counts({"fact_orders": pairs}), table_counts({"fact_orders": facts}), "lookup_loss")


def invalid_keys(events: DataFrame) -> DataFrame:
    """Events without an order id."""
    return events.agg(F.count_if(F.col("order_id").isNull()).alias("invalid_events"))


def checks(*rows: tuple[str, Column, Column], over: DataFrame) -> DataFrame:
    """Acceptance checks (name, expected, actual) as rows of one single-row frame."""
    items = [
        F.struct(F.lit(name).alias("check"), expected.cast("string").alias("expected"), actual.cast("string").alias("actual"))
        for name, expected, actual in rows
    ]
    listed = over.select(F.explode(F.array(*items)).alias("item")).select("item.*")
    return listed.withColumn("passed", F.col("expected").eqNullSafe(F.col("actual")))


def warehouse_acceptance(facts: DataFrame, employees: DataFrame, lines: DataFrame, staff: DataFrame) -> DataFrame:
    """After a full load: live facts = staged lines, current employees and photo paths = staged employees."""
    totals = (
        table_counts({"facts": facts.where("is_deleted = 0"), "lines": lines, "staff": staff})
        .groupBy()
        .agg(*[F.max(F.when(F.col("table_name") == n, F.col("row_count"))).alias(n) for n in ("facts", "lines", "staff")])
    )
    people = employees.agg(
        F.count_if(F.col("is_current") == 1).alias("current"),
        F.count_if((F.col("is_current") == 1) & (F.length("photo_path") > 0)).alias("with_path"),
    )
    one_row = totals.withColumn("_one", F.lit(1)).join(people.withColumn("_one", F.lit(1)), "_one")
    return checks(
        ("live_facts", F.col("lines"), F.col("facts")),
        ("current_employees", F.col("staff"), F.col("current")),
        ("photo_paths", F.col("staff"), F.col("with_path")),
        over=one_row,
    )


def incremental_acceptance(facts: DataFrame, events: DataFrame) -> DataFrame:
    """After an incremental run: live facts exist, some carry an LSN, and no event is left failed."""
    fact_state = facts.agg(
        (F.count_if(F.col("is_deleted") == 0) > 0).alias("has_live"),
        (F.count_if(F.length("source_lsn") > 0) > 0).alias("has_incremental"),
        F.lit(1).alias("_one"),
    )
    failed = events.agg(
        F.count_if(F.col("dw_processed_at").isNull() & F.col("dw_processing_error").isNotNull()).alias("failed"),
        F.lit(1).alias("_one"),
    )
    return checks(
        ("has_live_facts", F.lit(True), F.col("has_live")),
        ("has_incremental_facts", F.lit(True), F.col("has_incremental")),
        ("failed_events", F.lit(0), F.col("failed")),
        over=fact_state.join(failed, "_one"),
    )


def require(results: DataFrame, what: str) -> None:
    """Stop the job when a quality frame has a failed row; results are a few rows per table."""
    bad = results.where(F.col("status") == FAILED) if "status" in results.columns else results.where(~F.col("passed"))
    failures = [str(row.asDict()) for row in bad.toLocalIterator()]
    if failures:
        raise QualityError(f"{what}: " + "; ".join(failures))
