"""A stated set of query vectors against all vectors, in cells of bounded size.

Vectors are numbered and written once, then dealt round robin into parts and packed there into strips: up to STRIP vectors in
vertical layout, one dimension after another. A cell is one part of queries and one part of candidates; every strip goes to the
cells of its part, so what is shuffled grows with (queries x candidates) / (size of a part), and no task holds more than a cell.
Parts are dealt by row, not by a key, so hot labels and repeated ids are spread evenly.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import written

#: Vectors and components of a strip, of a part of queries and of a part of candidates.
STRIP, STRIP_PARTS = 64, 1 << 12
QUERIES, QUERY_PARTS = 512, 1 << 18
CANDIDATES, CANDIDATE_PARTS = 8192, 1 << 21
LONG = (-(1 << 63), (1 << 63) - 1)
_KINDS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}


def scaled(vectors: DataFrame, scale: int, name: str) -> DataFrame:
    """(row, vec_id, label, size, x) of the rows that take part, written: floor(scale * component) of every component in the
    narrowest of int8, int16, int32 and double that holds them all (the floor of a double is a double)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, size, x = [], [], []
            for k, v in enumerate(batch.column(2)):
                if v.is_valid and v.values.null_count == 0:
                    with np.errstate(over="ignore"):
                        a = np.floor(v.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                    if np.isfinite(a).all():
                        keep.append(k)
                        size.append(len(a))
                        x.append(_narrow(a).tobytes())
            own = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns[:2], pa.array(size, pa.int32()), pa.array(x, pa.binary())], ["vec_id", "label", "size", "x"])

    label = F.col("label").cast("long") if "label" in vectors.columns else F.lit(None).cast("long").alias("label")
    rows = vectors.select(F.col("vec_id").cast("long"), label, "embedding").mapInArrow(run, "vec_id long, label long, size int, x binary")
    return written(rows.withColumn("row", F.monotonically_increasing_id()), name)


def _narrow(a: np.ndarray) -> np.ndarray:
    most = np.abs(a).max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if most <= np.iinfo(kind).max:
            return a.astype(kind)
    return a


def unpacked(x: bytes, count: int) -> np.ndarray:
    """The `count` components of `x` as doubles."""
    return np.frombuffer(x, _KINDS[len(x) // count]).astype(np.float64) if count else np.zeros(0)


def strips(rows: DataFrame, most: int, most_parts: int, name: str, more: str | None = None) -> tuple[DataFrame, int]:
    """`rows` (of `scaled`) packed into strips (size, part, n, rows, ids, labels, more, x), written, and the number of parts. A null
    id is the largest long, with the row number as -1 - row. `more` names an array of pairs of longs that goes along with a row."""
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("size").cast("long")), F.lit(0))).first()
    parts = max(1, -(-n // most), -(-total // most_parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_strips = TaskContext.get().partitionId(), {}

        def packed(size, strip):
            row, ids, label, x, along = zip(*strip, strict=True)
            vertical = np.ascontiguousarray(_narrow(np.stack([unpacked(v, size) for v in x])).T)
            longs = [pa.array([np.array(c, np.int64).tobytes()], pa.binary()) for c in (row, ids, label)]
            first = [pa.array([v], pa.int32()) for v in (size, part, len(strip))]
            pairs = pa.array([pickle.dumps([[tuple(p.values()) for p in a or ()] for a in along])], pa.binary())
            return pa.RecordBatch.from_arrays([*first, *longs, pairs, pa.array([vertical.tobytes()], pa.binary())], fields)

        for batch in batches:
            for row, vec_id, label, size, x, along in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                strip = open_strips.setdefault(size, [])
                strip.append((row, vec_id, label or 0, x, along) if vec_id is not None else (-1 - row, LONG[1], label or 0, x, along))
                if len(strip) >= min(STRIP, max(1, STRIP_PARTS // max(1, size))):
                    yield packed(size, open_strips.pop(size))
        for size, strip in open_strips.items():
            yield packed(size, strip)

    along = F.col(more) if more else F.lit(None).cast("array<struct<a: long, b: long>>")
    packed_rows = rows.select("row", "vec_id", "label", "size", "x", along.alias("along")).repartition(parts)
    fields = ["size", "part", "n", "rows", "ids", "labels", "more", "x"]
    schema = "size int, part int, n int, rows binary, ids binary, labels binary, more binary, x binary"
    return written(packed_rows.mapInArrow(run, schema), name), parts


class Block:
    """Vectors of one side of a cell: `rows`, `ids`, `labels`, the pairs `more`, and `x` in vertical layout (dimensions x vectors)."""

    def __init__(self, size: int, found: list[tuple]):
        self.rows, self.ids, self.labels = (np.concatenate([np.frombuffer(f[k], np.int64) for f in found]) for k in (1, 2, 3))
        self.more = [pairs for f in found for pairs in pickle.loads(f[4])]
        self.x = np.concatenate([unpacked(f[5], size * f[0]).reshape(size, f[0]) for f in found], axis=1)

    def order(self) -> np.ndarray:
        """Ids in rising order, null ones last, as ranks."""
        rank = np.empty(len(self.ids), np.int64)
        rank[np.lexsort((self.rows < 0, self.ids))] = np.arange(len(self.ids))
        return rank


def cells(queries: tuple[DataFrame, int], candidates: tuple[DataFrame, int], make: Callable[[Block, Block], pa.RecordBatch], schema: str) -> DataFrame:
    """The rows that `make(queries, candidates)` gives for each cell."""
    (q, q_parts), (c, c_parts) = queries, candidates

    def spread(df: DataFrame, side: int, own: str, other: str, n: int) -> DataFrame:
        return df.withColumnRenamed("part", own).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("side", F.lit(side))

    key = ["size", "q", "c"]
    columns = [*key, "side", "n", "rows", "ids", "labels", "more", "x"]
    both = spread(q, 0, "q", "c", c_parts).select(columns).unionByName(spread(c, 1, "c", "q", q_parts).select(columns))
    # Work in a cell is large beside its bytes, so the number of tasks is set, and not merged by size.
    least = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = both.repartition(max(least, min(2 * q_parts * c_parts, 8 * least)), *key).sortWithinPartitions(*key, "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sides = None, ([], [])

        def made():
            return [make(Block(last[0], sides[0]), Block(last[0], sides[1]))] if sides[0] and sides[1] else []

        for batch in batches:
            for size, a, b, side, *strip in zip(*(v.to_pylist() for v in batch.columns), strict=True):
                if (size, a, b) != last:
                    yield from made()
                    last, sides = (size, a, b), ([], [])
                if side == 0 or sides[0]:
                    sides[side].append(strip)
        yield from made()

    return rows.mapInArrow(run, schema)


def exact_in(kind: type, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all partial inner products of columns of `a` and `b` are whole numbers that `kind` holds exactly."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * len(a)
    return most < (1 << (24 if kind is np.float32 else 53))


def long_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of matching columns as longs, by whole numbers of any size; beyond the long range its nearest end."""
    out = [sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for u, v in zip(a.T, b.T, strict=True)]
    return np.array([min(max(s, LONG[0]), LONG[1]) for s in out], np.int64)


def first_of_each(group: np.ndarray, order: list[np.ndarray], k: int) -> np.ndarray:
    """Places of the first k rows of each group, by the keys in `order` (the most important first)."""
    at = np.lexsort((*order[::-1], group))
    sorted_group = group[at]
    new = np.concatenate(([True], sorted_group[1:] != sorted_group[:-1])) if len(at) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0)) if len(at) else at
    return at[np.arange(len(at)) - start < k]
