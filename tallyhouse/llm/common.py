"""Helpers of the operators: written intermediate tables, connected components, caches of Python workers."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import configure, shared_folder


#: Rows that Spark hands a Python worker at a time; the default of 10,000 whole texts is too much for small executors.
BATCH_ROWS = 1000


def ready(spark: SparkSession) -> None:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again: cuts lineage, and survives the loss of executors. The
    shuffle files of the write go when it ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that `written` returned, once all that is read from them is written too."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """The written table `new`, made of `old`, which goes."""
    dropped(old)
    return new


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker; the functions themselves are unpickled anew for each task."""
    module = sys.modules.setdefault("_tallyhouse_llm_cache", types.ModuleType("_tallyhouse_llm_cache"))
    return module.__dict__.setdefault(name, {})


def forest(similar: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the symmetric matrix connects: each item to the first of its component."""
    edges, reached = [], np.zeros(len(similar), bool)
    for root in np.flatnonzero(similar.any(0)):
        if not reached[root]:
            reached[root], front = True, np.array([root])
            while len(front):
                front = np.flatnonzero(similar[front].any(0) & ~reached)
                reached[front] = True
                edges.extend((int(root), int(k)) for k in front)
    return edges


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of `edges` (a, b long): `root` is one node of its component, the same for all of it.

    Each round gives every node its smallest neighbour as parent, shortens the paths and contracts the edges; the
    number of nodes with edges falls at least by half, so there are at most log2 of their number rounds, each of
    joins and aggregates on node ids. Hot nodes meet in skew-split joins or in pre-aggregated minima.
    """
    links = edges.where("a <> b").select("a", "b").distinct()
    links = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-links")
    found = written(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct(), f"{name}-nodes")
    while not links.isEmpty():
        # A mix of the id, not the id: chains of ascending ids would otherwise contract by one node a round.
        mixed = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
        parent = links.groupBy("a").agg(F.min(mixed("b")).alias("low")).select(
            "a", F.when(F.col("low") < mixed("a"), F.col("low.id")).otherwise(F.col("a")).alias("p")
        )
        parent = written(parent, f"{name}-parent")
        for _ in range(2):
            above = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            parent = replaced(parent, written(parent.join(above, "p").select("a", F.col("pp").alias("p")), f"{name}-parent"))
        up = lambda c, new: parent.select(F.col("a").alias(c), F.col("p").alias(new))
        found = replaced(found, written(
            found.join(up("root", "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root")), f"{name}-nodes"
        ))
        onward = links.join(up("a", "x"), "a").join(up("b", "y"), "b").where("x <> y")
        links = replaced(links, written(onward.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), f"{name}-links"))
        dropped(parent)
    dropped(links)
    return found
