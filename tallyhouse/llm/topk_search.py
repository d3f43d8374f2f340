"""Exact top-k search by columnar branch and bound.

Candidates lie in vertical layout. In a cell (`grid`) inner products are accumulated block by block of dimensions, those with
the largest mass in the queries first. After each block the upper bound of a pair is what is accumulated, plus the product of
the norms of what is left of both (Cauchy-Schwarz), rounded up; pairs whose bound is below the k-th score their query has
so far are dropped. While many pairs survive, a block is one matrix product over the chunk; once few do, they are compacted
into pair lists, which alone read the further dimensions. Each cell gives the best k per query, and Spark ranks those.

Defined results: scores are whole numbers; beyond the range of a long they count as its nearest end. Rows that are null or hold
null or non-finite components take no part (nor do those that become infinite when scaled). Vectors of different lengths
do not meet; empty ones have score 0 with each other. A row is a query and a candidate of its own also where it repeats
another row or its id; only the query's own row is left out. Null ids are no queries; as candidates they come last in ties. An
empty table gives no rows. Other columns of the table are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm import grid
from tallyhouse.llm.common import dropped, table, written

K, SCALE, EVERY = 20, 64, 20
#: Dimensions of a block, candidates of a chunk.
DIMENSIONS, CHUNK = 16, 2048
#: Pairs are compacted when at most this share of a chunk survives.
COMPACT = 1 / 16


def _pairs(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, left: tuple[np.ndarray, np.ndarray], dims: list[slice], score: np.ndarray, least: np.ndarray):
    """The pairs (i, j) that survive the remaining blocks `dims`, with their scores."""
    for k, block in enumerate(dims):
        for d in range(block.start, block.stop):
            score = score + x[d, i] * y[d, j]
        keep = score + np.ceil(left[0][k][i] * left[1][k][j]) >= least[i]
        i, j, score = i[keep], j[keep], score[keep]
    return i, j, score


def best_in_cell(queries: grid.Block, candidates: grid.Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the k best of each query: places in the two blocks, scores as longs."""
    mass = np.argsort(-(queries.x**2).sum(1), kind="stable")
    x, y = queries.x[mass], np.ascontiguousarray(candidates.x[mass])
    n, m, d = x.shape[1], y.shape[1], len(mass)
    rank = candidates.order()
    if not grid.exact_in(np.float64, x, y):  # numbers too large for doubles: pair by pair
        i, j = np.divmod(np.arange(n * m), m)
        i, j = (v[queries.rows[i] != candidates.rows[j]] for v in (i, j))
        score = np.concatenate([np.zeros(0, np.int64), *(grid.long_products(x[:, i[a : a + 4096]], y[:, j[a : a + 4096]]) for a in range(0, len(i), 4096))])
        # -1 - s falls where s rises, and does not overflow.
        at = grid.first_of_each(i, [-1 - score, rank[j]], k)
        return i[at], j[at], score[at]
    kind = np.float32 if grid.exact_in(np.float32, x, y) else np.float64
    x, y = x.astype(kind), y.astype(kind)
    blocks = [slice(a, min(a + DIMENSIONS, d)) for a in range(0, d, DIMENSIONS)]
    # Norms of what is left after each block, rounded up.
    rest = [[np.sqrt((v[b.stop :].astype(np.float64) ** 2).sum(0)) * (1 + 1e-12) for b in blocks] for v in (x, y)]
    least = np.full(n, -np.inf)
    found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    own = {int(r): c for c, r in enumerate(candidates.rows)}
    own_of = np.array([own.get(int(r), -1) for r in queries.rows])
    for low in range(0, m, CHUNK):
        high = min(low + CHUNK, m)
        part, total = y[:, low:high], np.zeros((n, high - low), kind)
        mine = np.flatnonzero((own_of >= low) & (own_of < high))
        i = None
        for b, block in enumerate(blocks):
            total += x[block].T @ part[block]
            if np.isfinite(least).any() and block.stop < d:
                alive = total + np.ceil(np.outer(rest[0][b], rest[1][b][low:high])) >= least[:, None]
                alive[mine, own_of[mine] - low] = False
                if alive.sum() <= COMPACT * alive.size:
                    i, j = np.nonzero(alive)
                    left = tuple([r if v is rest[0] else r[low:high] for r in v[b + 1 :]] for v in rest)
                    i, j, score = _pairs(x, part, i, j, left, blocks[b + 1 :], total[i, j].astype(np.float64), least)
                    break
        if i is None:
            total = total.astype(np.float64)
            total[mine, own_of[mine] - low] = -np.inf
            edge = np.partition(total, -k, axis=1)[:, -k] if high - low > k else np.full(n, -np.inf)
            i, j = np.nonzero((total >= np.maximum(edge, least)[:, None]) & np.isfinite(total))
            score = total[i, j]
        found = [np.concatenate(v) for v in zip(found, (i, j + low, score), strict=True)]
        at = grid.first_of_each(found[0], [-found[2], rank[found[1]]], k)
        found = [v[at] for v in found]
        held = np.bincount(found[0], minlength=n)
        lowest = np.full(n, np.inf)
        np.minimum.at(lowest, found[0], found[2])
        least = np.where(held >= k, lowest, -np.inf)
    return found[0], found[1], found[2].astype(np.int64)


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of `vectors` (vec_id, embedding) with the largest inner products of
    floor(scale * component) with each row that `is_query` (a condition on vec_id) takes as a query; ties to smaller ids."""
    rows = grid.scaled(vectors.select("vec_id", "embedding"), scale, "topk-rows")
    queries = grid.strips(rows.where(is_query), grid.QUERIES, grid.QUERY_PARTS, "topk-queries")
    candidates = grid.strips(rows, grid.CANDIDATES, grid.CANDIDATE_PARTS, "topk-candidates")

    def make(q: grid.Block, c: grid.Block) -> pa.RecordBatch:
        i, j, score = best_in_cell(q, c, k)
        ids = pa.array(c.ids[j], mask=c.rows[j] < 0)
        return pa.RecordBatch.from_arrays([pa.array(q.rows[i]), pa.array(q.ids[i]), ids, pa.array(score)], ["row", "query_id", "vec_id", "score"])

    best = grid.cells(queries, candidates, make, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    ranked = written(ranked, "topk")
    dropped(rows, queries[0], candidates[0])
    return ranked


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
o AS (SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM o WHERE rank <= 20
"""
