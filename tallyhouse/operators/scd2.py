"""Dimension history: one open row per natural key, closed rows kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.dimensions import Dimension

HISTORY_COLUMNS = ("start_date", "end_date", "is_current")


def scd2_merge(
    history: DataFrame, snapshot: DataFrame, dimension: Dimension, as_of: Column, close_missing: bool = False
) -> DataFrame:
    """History after a snapshot taken at `as_of`.

    Unchanged rows stay open; a changed row is closed and its new form opened; a new key is
    opened; a key missing from the snapshot is closed only with `close_missing`. Applying the
    same snapshot again changes nothing. Both sides meet once, on the natural key.
    """
    columns = history.columns
    open_rows = history.where("is_current = 1")
    closed_rows = history.where("is_current = 0")
    old = open_rows.select(dimension.natural, F.struct(*columns).alias("old"))
    opened = {
        "start_date": as_of.cast("timestamp"),
        "end_date": F.lit(None).cast("timestamp"),
        "is_current": F.lit(1).cast("short"),
    }
    new = snapshot.withColumns(opened).select(dimension.natural, F.struct(*columns).alias("new"))
    closed = F.col("old").withField("end_date", as_of.cast("timestamp")).withField("is_current", F.lit(0).cast("short"))

    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = F.col("old.source_hash") == F.col("new.source_hash")
    when_missing = F.array(closed) if close_missing else F.array("old")
    rows = (
        F.when(had & has & same, F.array("old"))
        .when(had & has, F.array(closed, F.col("new")))
        .when(has, F.array("new"))
        .otherwise(when_missing)
    )
    merged = old.join(new, dimension.natural, "full_outer").select(F.explode(rows).alias("row")).select("row.*")
    return closed_rows.unionByName(merged.select(*columns))


def as_of_view(history: DataFrame, moment: Column) -> DataFrame:
    """Rows valid at a moment."""
    ended = F.col("end_date").isNotNull() & (F.col("end_date") <= moment)
    return history.where((F.col("start_date") <= moment) & ~ended)


FIRST_MOMENT, LAST_MOMENT = "0001-01-01 00:00:00", "9999-12-31 00:00:00"


def versions_at(
    rows: DataFrame, key: str, moment: str, history: DataFrame, dimension: Dimension, take: dict[str, str]
) -> DataFrame:
    """`rows` with columns of the version of member `key` that is valid at `moment`: new name -> column of the history.

    The first version of a member covers all moments before it too; a NULL moment means the last version. Rows whose member is
    unknown, NULL, or closed at that moment get NULLs. A repeated row stays repeated.

    There is no range join: the distinct (member, moment) pairs and the starts of versions are put in one order per
    member, and each pair takes the last start before it. So a partition holds a member's versions and distinct moments,
    not its rows; rows then meet their pair by equality, where AQE splits a hot one.
    """
    natural_type = history.schema[dimension.natural].dataType
    keyed = rows.withColumns(
        {
            "_member": F.col(key).cast(natural_type),
            "_moment": F.coalesce(F.col(moment).cast("timestamp"), F.lit(LAST_MOMENT).cast("timestamp")),
        }
    )
    pairs = keyed.where("_member IS NOT NULL").select("_member", "_moment").distinct()
    first = F.min("start_date").over(Window.partitionBy(dimension.natural))
    since = F.when(F.col("start_date") == first, F.lit(FIRST_MOMENT).cast("timestamp")).otherwise(F.col("start_date"))
    version = F.struct(F.col("end_date").alias("_until"), *[F.col(c).alias(name) for name, c in take.items()])
    starts = history.select(F.col(dimension.natural).alias("_member"), since.alias("_moment"), version.alias("_version_"))
    marked = starts.withColumn("_asked", F.lit(False)).unionByName(
        pairs.withColumn("_asked", F.lit(True)), allowMissingColumns=True
    )
    in_time = Window.partitionBy("_member").orderBy("_moment", "_asked", F.asc_nulls_last("_version_._until"))
    found = marked.withColumn("_valid", F.last("_version_", ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
    still = F.col("_valid._until").isNull() | (F.col("_valid._until") > F.col("_moment"))
    answers = found.where("_asked").select("_member", "_moment", F.when(still, F.col("_valid")).alias("_valid"))
    joined = keyed.join(answers, ["_member", "_moment"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"_valid.`{name}`").alias(name) for name in take])
