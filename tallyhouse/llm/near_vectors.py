"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is rotated into BITS dimensions and coded by the signs; with the code is stored its correction factor, the inner
product of the vector and its code. (rotated vector of one, code of the other) / correction is an unbiased estimate of
their inner product, with an error bound that holds with a chosen confidence (ERROR). Pairs whose upper bound is below the
threshold are dropped; the others are computed exactly in double precision, so no pair below the threshold is linked.

The bound alone decides, for every pair of different vectors of a label: a label is split into blocks of about BLOCK vectors by
a hash, and each pair of blocks is a row range of its own, so no label is one task, however large. The work grows with the square
of a label. The error is that of the part of one vector that is orthogonal to the other, a third of its length at a cosine of
0.93: ERROR = 4.5 is over 12 standard errors there, so a link is lost with a chance below 1 in 10^30.
Equal vectors of a label are one class from the start, weighted by their number.

Defined results: vectors that are null, empty, zero or hold null or non-finite parts, and rows without a label, link with nothing.
Others are scaled by a power of two first, so that no square over- or underflows.
Vectors of different lengths do not link. Rows with one id are vectors of their own that share it. An empty table gives no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import components, forest, table, written

THRESHOLD = 0.93
BITS = 256
#: Standard errors in the confidence bound.
ERROR = 4.5
#: Added to bounds for the rounding of estimates in single precision.
ROUNDING = 1e-4
BLOCK = 2048
#: Parts that the members of one component are spread over when they meet its smallest id.
SALTS = 16


@lru_cache(maxsize=8)
def rotation(dimensions: int) -> np.ndarray:
    """BITS (or as many as the dimensions) x dimensions, with orthonormal columns; a worker makes it once, not per bucket."""
    random = np.random.default_rng(20_240_521)
    return np.linalg.qr(random.standard_normal((max(BITS, dimensions), dimensions)))[0]


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their signs (0 or 1) and correction factors."""
    rotated = unit @ rotation(unit.shape[1]).T
    return rotated, (rotated > 0).astype(np.uint8), np.abs(rotated).sum(1) / np.sqrt(rotated.shape[1])


Coded = tuple[np.ndarray, np.ndarray, np.ndarray]


def candidates(left: Coded, right: Coded, threshold: float) -> np.ndarray:
    """Pairs of two blocks whose upper bound reaches the threshold, from both sides."""

    def reach(whole: Coded, coded: Coded) -> np.ndarray:
        d = whole[0].shape[1]
        signs = ((2.0 * coded[1] - 1) / np.sqrt(d)).astype(np.float32)
        factor = coded[2]
        bound = ERROR * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / (d - 1)) + ROUNDING
        return (whole[0].astype(np.float32) @ signs.T) / factor.astype(np.float32) + bound.astype(np.float32) >= threshold

    return reach(left, right) & reach(right, left).T


def read_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, c, x): `c` tells the (label, vector) apart, x are its doubles; both null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, x = [], []
            for label, v in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                ok = label is not None and v.is_valid and len(v.values) > 0 and v.values.null_count == 0
                a = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) + 0.0 if ok else None
                ok = ok and bool(np.isfinite(a).all() and a.any())
                x.append(np.ldexp(a, -int(np.frexp(np.abs(a).max())[1])).tobytes() if ok else None)
                c.append(hashlib.blake2b(f"{label}/".encode() + a.tobytes(), digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(c, pa.binary()), pa.array(x, pa.binary())], ["vec_id", "label", "c", "x"])

    return vectors.select("vec_id", F.col("label").cast("string"), "embedding").mapInArrow(run, "vec_id long, label string, c binary, x binary")


def _units(x: list[bytes]) -> np.ndarray:
    a = np.stack([np.frombuffer(v) for v in x])
    return a / np.sqrt((a * a).sum(1, keepdims=True))


def _compare(left: np.ndarray, right: np.ndarray, weights: np.ndarray, across: bool, threshold: float):
    """Links of each vector of two blocks (`across`) or of one, and edges that connect what is linked; positions count through both."""
    n, coded = len(left), codes(left)
    possible = candidates(coded, codes(right) if across else coded, threshold)
    i, j = np.nonzero(possible if across else np.triu(possible, 1))
    shift = n if across else 0
    counted, pairs = np.zeros(len(weights), np.int64), []
    for low in range(0, len(i), 100_000):
        a, b = i[low : low + 100_000], j[low : low + 100_000]
        near = (left[a] * right[b]).sum(1) >= threshold
        a, b = a[near], b[near] + shift
        np.add.at(counted, a, weights[b])
        np.add.at(counted, b, weights[a])
        pairs.append((a, b))
    if not counted.any():
        return counted, []
    similar = np.zeros((len(weights), len(weights)), bool)
    for a, b in pairs:
        similar[a, b] = similar[b, a] = True
    return counted, forest(similar)


def block_pairs(sets: DataFrame) -> DataFrame:
    """(label, size, i, j, part, c, m, x) of distinct vectors (c, label, m, x): each vector goes to the pairs of its block with every block of
    its label and length. Only blocks are copied, so a vector is copied as often as its label has blocks."""
    group = ["label", "size"]
    sized = sets.withColumn("size", F.length("x"))
    blocks = sized.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    placed = sized.join(blocks, group).withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return paired.select(*group, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "c", "m", "x")


def links(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, links) as in the join of texts: counts (b null) and connecting edges."""
    order = ["label", "size", "i", "j"]
    rows = block_pairs(sets).repartition(*order).sortWithinPartitions(*order, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(key, group):
            i, j = key[2], key[3]
            n = sum(g[0] == i for g in group)
            if i != j and n in (0, len(group)):
                return []
            unit = _units([g[3] for g in group])
            left, right = (unit[:n], unit[n:]) if i != j else (unit, unit)
            counted, edges = _compare(left, right, np.array([g[2] for g in group], np.int64), i != j, threshold)
            return [(group[k][1], None, int(n)) for k, n in enumerate(counted) if n] + [(group[a][1], group[b][1], None) for a, b in edges]

        def batch_of(rows):
            kinds = (pa.binary(), pa.binary(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], ["a", "b", "links"])

        key, group = None, []
        for batch in batches:
            for *k, part, c, m, x in zip(*(v.to_pylist() for v in batch.columns), strict=True):
                if k != key:
                    if len(group) > 1:
                        yield batch_of(compared(key, group))
                    key, group = k, []
                group.append((part, c, m, x))
        if len(group) > 1:
            yield batch_of(compared(key, group))

    return rows.mapInArrow(run, "a binary, b binary, links long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for `vectors` (vec_id, embedding, label)."""
    read = written(read_vectors(vectors), "vectors")
    sets = read.where("c is not null").groupBy("c").agg(
        F.count("*").alias("m"), F.min("vec_id").alias("low"), F.max("label").alias("label"), F.max("x").alias("x")
    )
    sets = written(sets, "vector-sets")
    found = written(links(sets, threshold), "vector-links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("n")).withColumnRenamed("a", "c")
    roots = components(found.where("b is not null").select("a", "b"), "vectors").withColumnRenamed("node", "c")
    full = sets.select("c", "m", "low").join(counts, "c", "left").join(roots, "c", "left")
    full = written(full.select("c", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "low", F.coalesce("root", "c").alias("root")), "vector-classes")
    # A vector alone is its own root; a large component meets its smallest id in SALTS parts.
    lowest = full.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("members")).where("members > 1").drop("members")
    lowest = lowest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = full.withColumn("salt", F.pmod(F.xxhash64("c"), F.lit(SALTS)).cast("int"))
    of = salted.join(lowest, ["root", "salt"], "left").select("c", "n_links", F.coalesce("component_id", "low").alias("component_id"))
    rows = read.select("vec_id", "c").join(of, "c", "left")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of vectors of a label is decided by the bound on its cosine, and computed where that allows a link."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
r(x, y) AS (SELECT x, y FROM p UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
n AS (SELECT x, count(*) AS n FROM p GROUP BY x), c AS (SELECT x, min(y) AS low FROM r GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(c.low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(c.low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
"""
