"""Hard negatives by angular triangle filtering.

Every vector has stored angles to REFERENCES reference directions (rows of the table, the first by a hash of their numbers).
For an anchor a and a row c the triangle inequality on the sphere puts their angle between the largest |angle(a) - angle(c)| and
the smallest min(angle(a) + angle(c), 2 pi - angle(a) - angle(c)) over the directions. The cosines of these two, times the norms
and widened by more than rounding can err, are bounds of the score. Only rows whose bounds overlap what is asked for get
integer scoring:

1. positives: rows of the anchor's label whose upper bound reaches the k-th largest lower bound, and then the k-th score found;
2. negatives: rows of other labels whose bounds overlap a window [share * positive score, positive score] of the anchor.

Anchors meet all rows in cells of bounded size (`grid`), in which rows lie in order of their labels; a hot label is dealt over
all cells. Each cell gives its best few, and Spark ranks those.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part. Scores are whole numbers;
beyond the range of a long they count as its nearest end. Vectors of different lengths do not meet. Rows that repeat others or
their ids are rows of their own; only the anchor's own row is not its positive. Rows with null ids are no anchors and come last
in ties. Anchors without positives, and positives without negatives in their window (all with a negative score) give no
rows; so does an empty table. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm import grid
from tallyhouse.llm.common import dropped, table, written

SCALE, ANCHORS, POSITIVES, NEGATIVES = 256, 100, 5, 5
#: A negative's score is at least this part of the positive's: numerator and denominator.
SHARE = (4, 5)
REFERENCES = 16
#: Radians by which stored angles may be wrong together (they are kept as doubles; arccos near 1 is the coarsest step).
ANGLE_ERROR = 1e-6


def references(rows: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors by vector length: at most REFERENCES rows in all, chosen by a hash of their numbers."""
    found: dict[int, list[np.ndarray]] = {}
    for size, x in rows.where("size > 0").orderBy(F.xxhash64("row"), "row").select("size", "x").limit(REFERENCES).collect():
        v = grid.unpacked(bytes(x), size)
        v = v / max(np.abs(v).max(), 1)
        if v.any():
            found.setdefault(size, []).append(v / np.sqrt(v @ v))
    return {size: np.stack(v) for size, v in found.items()}


def angles(x: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of the columns of `x`, and their angles to the directions (directions x columns; 0 for null vectors)."""
    most = np.maximum(np.abs(x).max(axis=0, initial=0), 1)
    norm = np.sqrt(((x / most) ** 2).sum(0))
    cosine = (directions @ (x / most)) / np.where(norm > 0, norm, 1)
    return norm * most, np.arccos(np.clip(cosine, -1, 1))


def score_bounds(angle: np.ndarray, norm: float, others: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers between which the scores of a vector with the others lie."""
    nearest = np.abs(others - angle[:, None]).max(0) - ANGLE_ERROR
    total = others + angle[:, None]
    farthest = np.minimum(total, 2 * math.pi - total).min(0) + ANGLE_ERROR
    scale = norm * norms
    slack = scale * 1e-9 + 1
    high = np.cos(np.maximum(nearest, 0)) * scale + slack
    low = np.cos(np.minimum(farthest, math.pi)) * scale - slack
    return np.floor(low), np.ceil(high)


class _Cell:
    """A cell's candidates in order of labels, with their norms and angles."""

    def __init__(self, anchors: grid.Block, others: grid.Block, directions: dict[int, np.ndarray]):
        order = np.argsort(others.labels, kind="stable")
        self.rows, self.ids, self.labels, self.rank = others.rows[order], others.ids[order], others.labels[order], others.order()[order]
        self.x, self.anchors = others.x[:, order], anchors
        known = directions.get(len(self.x), np.full((1, len(self.x)), 1 / math.sqrt(max(len(self.x), 1))))
        self.norms, self.angles = angles(self.x, known)
        self.own_norms, self.own_angles = angles(anchors.x, known)
        self.exact = grid.exact_in(np.float64, anchors.x, self.x)

    def same(self, k: int) -> np.ndarray:
        """Places of the rows of the k-th anchor's label, without its own row."""
        a, b = np.searchsorted(self.labels, self.anchors.labels[k], "left"), np.searchsorted(self.labels, self.anchors.labels[k], "right")
        at = np.arange(a, b)
        return at[self.rows[a:b] != self.anchors.rows[k]]

    def different(self, k: int) -> np.ndarray:
        return np.flatnonzero(self.labels != self.anchors.labels[k])

    def bounds(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.exact:  # numbers too large for doubles
            return np.full(len(at), -np.inf), np.full(len(at), np.inf)
        return score_bounds(self.own_angles[:, k], self.own_norms[k], self.angles[:, at], self.norms[at])

    def scores(self, k: int, at: np.ndarray) -> np.ndarray:
        anchor = self.anchors.x[:, k]
        if self.exact:
            return (anchor @ self.x[:, at]).astype(np.int64)
        return grid.long_products(np.repeat(anchor[:, None], len(at), 1), self.x[:, at])


def positives_in_cell(cell: _Cell, k: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the best `count` rows of the k-th anchor's label."""
    at = cell.same(k)
    if len(at) > count:
        low, high = cell.bounds(k, at)
        least = np.partition(low, -count)[-count]
        # The rows with the highest bounds first: their scores raise what the others have to reach.
        lead = np.argpartition(-high, count - 1)[:count]
        least = max(least, cell.scores(k, at[lead]).min())
        at = at[high >= least]
    score = cell.scores(k, at)
    best = grid.first_of_each(np.zeros(len(at), np.int8), [-1 - score, cell.rank[at]], count)
    return at[best], score[best]


def negatives_in_cell(cell: _Cell, k: int, windows: list[int], count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window's upper end: places and scores of the first `count` rows of other labels within it."""
    at = cell.different(k)
    ends = [(-(-SHARE[0] * top // SHARE[1]), top) for top in windows]
    if len(at):
        low, high = cell.bounds(k, at)
        overlaps = np.zeros(len(at), bool)
        for least, top in ends:
            overlaps |= (high >= least) & (low <= top)
        at = at[overlaps]
    score, out = cell.scores(k, at), []
    for least, top in ends:
        inside = np.flatnonzero((score >= least) & (score <= top))
        best = inside[grid.first_of_each(np.zeros(len(inside), np.int8), [-1 - score[inside], cell.rank[at[inside]]], count)]
        out.append((at[best], score[best]))
    return out


def _batch(rows: list[tuple], fields: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array([None if v is None else int(v) for v in c], pa.int64()) for c in columns], fields)


def hard_negatives(vectors: DataFrame, is_anchor, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for `vectors` (vec_id, label, embedding): for each
    anchor (a condition on vec_id) and each of its first `positives` rows of its label, the first `negatives` rows of
    other labels whose score is at most the positive's and at least SHARE of it."""
    rows = grid.scaled(vectors.where("label is not null").select("vec_id", "label", "embedding"), scale, "negatives-rows")
    directions = references(rows)
    anchors = grid.strips(rows.where(is_anchor), grid.QUERIES, grid.QUERY_PARTS, "negatives-anchors")
    others = grid.strips(rows, grid.CANDIDATES, grid.CANDIDATE_PARTS, "negatives-others")

    def find_positives(a: grid.Block, c: grid.Block) -> pa.RecordBatch:
        cell, out = _Cell(a, c, directions), []
        for k in range(len(a.rows)):
            out += [(a.rows[k], None if cell.rows[p] < 0 else cell.ids[p], cell.rows[p], s) for p, s in zip(*positives_in_cell(cell, k, positives), strict=True)]
        return _batch(out, ["anchor", "positive_id", "positive", "positive_score"])

    found = grid.cells(anchors, others, find_positives, "anchor long, positive_id long, positive long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive")
    first = written(found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= positives), "negatives-positives")

    # The windows of an anchor go along with it, as (place among its positives, upper end).
    ends = first.where("positive_score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("k", "positive_score"))).alias("ends"))
    seeking = rows.where(is_anchor).join(ends, rows["row"] == ends["anchor"]).select("row", "vec_id", "label", "size", "x", "ends")
    seeking = written(seeking, "negatives-windows")
    packed = grid.strips(seeking, grid.QUERIES, grid.QUERY_PARTS, "negatives-seeking", "ends")

    def find_negatives(a: grid.Block, c: grid.Block) -> pa.RecordBatch:
        cell, out = _Cell(a, c, directions), []
        for k in range(len(a.rows)):
            tops = a.more[k]
            for (place, top), best in zip(tops, negatives_in_cell(cell, k, [t for _, t in tops], negatives), strict=True):
                out += [(a.rows[k], a.ids[k], place, None if cell.rows[p] < 0 else cell.ids[p], top, s) for p, s in zip(*best, strict=True)]
        return _batch(out, ["anchor", "anchor_id", "k", "negative_id", "positive_score", "negative_score"])

    schema = "anchor long, anchor_id long, k long, negative_id long, positive_score long, negative_score long"
    near = grid.cells(packed, others, find_negatives, schema)
    order = Window.partitionBy("anchor", "k").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    result = near.join(first.select("anchor", F.col("k").cast("long").alias("k"), "positive_id"), ["anchor", "k"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
    result = written(result, "negatives")
    dropped(rows, anchors[0], others[0], first, seeking, packed[0])
    return result


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, given % 10 + 1 - F.when(given % 10 == 9, 10).otherwise(0)).otherwise(given)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(vectors, F.col("vec_id") % ANCHORS == 0)


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id AS other_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, other_id NULLS LAST, cr) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id, (row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY n.score DESC, n.other_id NULLS LAST))::INTEGER AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.ar = p.ar AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""
