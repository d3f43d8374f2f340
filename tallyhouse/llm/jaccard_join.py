"""Chosen-path join: pairs of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

A path is a sequence of shared shingles. In each of RUNS runs every set picks a shingle for its first path where a hash of
(run, shingle) is below 1 / (similarity * set size): about 1.25 a set, and the same ones in similar sets. Sets on one path
form a bucket. Buckets over SMALL sets are split by picking a further shingle, down to DEPTH; buckets are then compared in
full, in blocks of bounded size. A bucket of which half or more have the same sketch (two smallest hashes of the set) is a
group of near copies that does not come apart: it is not split, and all such buckets of one sketch, which the runs find again
and again, are one bucket with the members of all. A pair is similar by its exact
Jaccard similarity, and counted in the smallest bucket it shares. RUNS follows from RECALL, the least probability with which
a similar pair shares a bucket, for the worst case: one set holds the other, the similarity is SIMILARITY, and all buckets
are split down to DEPTH.

Equal sets are one class from the start, so copies cost one set each and are never paired.

Defined results: texts of one to four words are one shingle; texts without words (null, empty) link with nothing and are
their own class. Rows with a null id take part; the id of a class is its smallest id. Repeated rows are copies.
An empty table gives no rows. Other columns go along, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import components, dropped, forest, ready, table, written
from tallyhouse.llm.shingles import digest, mix, shingle_set

SIMILARITY = 0.8
#: Least probability that a similar pair shares a bucket.
RECALL = 0.9999
DEPTH = 3
#: Sets in a bucket that is not split further.
SMALL = 64
#: Sets and shingles in a block.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a similar pair has shared a path of `depth` picks with a probability of at least `recall`. In the worst
    case, where a set of n shingles holds the other, they share similarity * n shingles, each picked for both with probability
    1 / (similarity * n): none is with at most exp(-1), and each that is goes on by the same chance. At equal sizes more are shared."""
    shared = 1.0
    for _ in range(depth):
        shared = 1 - math.exp(-shared)
    return math.ceil(math.log(1 - recall) / math.log(1 - shared))


RUNS = runs_for(RECALL, DEPTH)
_STARTS = np.arange(RUNS, dtype=np.uint64) * np.uint64(0x1F123BB5) + np.uint64(1)
#: Numbers hashed at a time, few enough for a core's cache.
AT_ONCE = 1 << 14


def chosen_of(values: np.ndarray, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The paths that a set takes on from `paths`, and the place in `paths` of the one that each goes on from."""
    share, parts = 1 / (SIMILARITY * len(values)), []
    wide = max(1, AT_ONCE // len(paths))
    for at in range(0, len(values), wide):
        hashes = mix(paths[:, None] ^ values[None, at : at + wide])
        origin, k = np.nonzero(hashes < np.uint64(int(share * (1 << 64))) if share < 1 else np.ones(hashes.shape, bool))
        parts.append((hashes[origin, k], origin))
    picked, origin = (np.concatenate(x) for x in zip(*parts, strict=True))
    return mix(picked, 5), origin


def chosen(values: np.ndarray, path: int) -> np.ndarray:
    """The paths that a set takes on from `path`."""
    return chosen_of(values, np.array([path], np.uint64))[0]


def first_picks(values: np.ndarray) -> np.ndarray:
    """The paths that a set takes at first, in all runs."""
    picks, run = chosen_of(values, _STARTS)
    return np.unique(picks ^ run.astype(np.uint64))


def sketch(values: np.ndarray) -> int:
    """The smallest hashes by two functions as one; equal for near copies in most cases."""
    low = np.array([mix(values, 19).min(), mix(values, 23).min()])
    return int((mix(low[:1], 29) ^ low[1:]).view(np.int64)[0])


def with_sets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of `docs` as in_*, the digest `c` of the text's shingle set (null if empty) and its size `n`."""
    own = [f"in_{c}" for c in docs.columns]
    given = docs.toDF(*own).withColumn("_text", F.col(f"in_{text}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                c, n = [], []
                for t in part.column("_text").to_pylist():
                    values = shingle_set(t)
                    c.append(digest(values) if len(values) else None)
                    n.append(len(values))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(c, pa.binary()), pa.array(n, pa.int64())], [*own, "c", "n"])

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField("c", T.BinaryType()), T.StructField("n", T.LongType())]))


def signed_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, c, n, picks, sketch, text) of every row, written: the digest of its set (null if empty), the set's size, its first
    paths in all runs and its sketch. The texts are read for this once; a task gives the last three with the first row of a set only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                c, n, picks, sketches, text = [], [], [], [], []
                for t in part.column(1).to_pylist():
                    values = shingle_set(t)
                    d = digest(values) if len(values) else None
                    new = d is not None and d not in seen
                    if new:
                        seen.add(d)
                    c.append(d)
                    n.append(len(values))
                    picks.append(first_picks(values).view(np.int64) if new else None)
                    sketches.append(sketch(values) if new else None)
                    text.append(t if new else None)
                arrays = [pa.array(c, pa.binary()), pa.array(n, pa.int64()), pa.array(picks, pa.list_(pa.int64())), pa.array(sketches, pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays, pa.array(text, pa.string())], ["doc_id", "c", "n", "picks", "sketch", "text"])

    kinds = [("c", T.BinaryType()), ("n", T.LongType()), ("picks", T.ArrayType(T.LongType())), ("sketch", T.LongType()), ("text", T.StringType())]
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(*k) for k in kinds)])
    return written(docs.select("doc_id", "text").mapInArrow(run, schema), "signed")


def next_paths(rows: DataFrame) -> DataFrame:
    """(path, c, n) one pick further; `rows` have c, text and the paths of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, c, n = [np.zeros(0, np.uint64)], [], []
            for d, t, paths in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                values = shingle_set(t)
                every = np.array(paths, np.int64).view(np.uint64)
                for low in range(0, len(every), RUNS):
                    picks, _ = chosen_of(values, every[low : low + RUNS])
                    out.append(picks)
                    c.extend([d] * len(picks))
                    n.extend([len(values)] * len(picks))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out).view(np.int64)), pa.array(c, pa.binary()), pa.array(n, pa.int64())], ["path", "c", "n"]
            )

    return rows.select("c", "text", "paths").mapInArrow(run, "path long, c binary, n long").distinct()


def _shared(paths: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows on paths of two sets or more, and the sizes of these paths with what tells equal buckets."""
    rows = written(paths, name)
    mark = lambda k: F.bit_xor(F.xxhash64("c", F.lit(k))).alias(f"mark{k}")
    sizes = written(rows.groupBy("path").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"), mark(1), mark(2)).where("m > 1"), f"{name}-sizes")
    return rows, sizes


def near_copies(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """(path, sketch) of the large buckets whose sets have one sketch, half of them or more. `rows` (path, m, c)."""
    counts = rows.join(sketches, "c").groupBy("path", "m", "sketch").agg(F.count("*").alias("k")).where("2 * k >= m")
    return counts.groupBy("path").agg(F.min("sketch").alias("sketch"))


def buckets(signed: DataFrame, texts: DataFrame) -> DataFrame:
    """(path, m, shingles, c, n): sets of the buckets to compare, each distinct bucket once."""
    sketches = signed.where("picks is not null").select("c", "sketch").distinct()
    found, spent = [], []
    rows, sizes = _shared(signed.select(F.explode("picks").alias("path"), "c", "n").distinct(), "paths1")
    for depth in range(1, DEPTH + 1):
        spent += [rows, sizes]
        large = sizes.where(F.col("m") > SMALL)
        if large.isEmpty():
            found.append((rows, sizes))
            break
        crowded = rows.join(large.select("path", "m"), "path")
        copies = written(near_copies(crowded, sketches), f"copies{depth}")
        together = crowded.join(copies, "path").select(F.xxhash64(F.lit("near copies"), "sketch").alias("path"), "c", "n")
        spent.append(copies)
        if depth == DEPTH:
            found.append((rows, sizes.join(copies, "path", "left_anti")))
        else:
            found.append((rows, sizes.where(F.col("m") <= SMALL)))
        found.append((together, None))
        apart = large.join(copies, "path", "left_anti")
        if depth == DEPTH or apart.isEmpty():
            break
        onward = rows.join(apart.select("path"), "path", "left_semi").groupBy("c").agg(F.collect_list("path").alias("paths"))
        rows, sizes = _shared(next_paths(texts.join(onward, "c")), f"paths{depth + 1}")
    merged = [t for t, counted in found if counted is None]
    if merged:
        groups = merged[0]
        for more in merged[1:]:
            groups = groups.unionByName(more)
        rows, sizes = _shared(groups.distinct(), "groups")
        spent += [rows, sizes]
        found = [f for f in found if f[1] is not None] + [(rows, sizes)]
    sizes = found[0][1].select("path", "m", "shingles", "mark1", "mark2")
    rows = found[0][0]
    for more, counted in found[1:]:
        sizes, rows = sizes.unionByName(counted.select(sizes.columns)), rows.unionByName(more)
    once = sizes.groupBy("m", "mark1", "mark2").agg(F.min("path").alias("path"), F.first("shingles").alias("shingles")).select("path", "m", "shingles")
    leaves = written(rows.join(once, "path").distinct(), "buckets")
    dropped(*spent)
    return leaves


def _compare(path: int, sides: list[int], sets: list[np.ndarray], paths: list[np.ndarray]):
    """Similar pairs of a block: counted links per set, and edges that connect them. sides: 0 or 1, in a block of two
    parts only pairs across count; all 0 otherwise."""
    sizes = np.array([len(s) for s in sets])
    m = len(sets)
    owner = np.repeat(np.arange(m), sizes)
    _, token, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts[token] > 1
    owner, token = owner[several], np.unique(token[several], return_inverse=True)[1]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    both = np.zeros((m, m), np.float32)
    wide = max(64, min(8192, 4_000_000 // m))
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, wide):
        a, b = np.searchsorted(token, [low, low + wide])
        has = np.zeros((m, wide), np.float32)
        has[owner[a:b], token[a:b] - low] = 1
        both += has @ has.T
    # Counts of shared shingles are whole numbers; below 2**24 they are exact.
    union = sizes[:, None] + sizes[None, :] - both.astype(np.float64)
    similar = both.astype(np.float64) * 10 >= union * (10 * SIMILARITY) - 1e-6
    np.fill_diagonal(similar, False)
    side = np.array(sides)
    if side.any():
        similar &= side[:, None] != side[None, :]
    earlier = [p[p < path] for p in paths]
    known = np.unique(np.concatenate(earlier))
    place = np.zeros((m, len(known)), np.float32)
    for k, p in enumerate(earlier):
        place[k, np.searchsorted(known, p)] = 1
    counted = similar & ((place @ place.T) == 0)
    return counted.sum(1), forest(similar)


def similar_sets(leaves: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, links): links of set `a` found in a block (b null), and edges a, b that connect what is similar."""
    mine = leaves.groupBy("c").agg(F.collect_set("path").alias("mine"))
    parts = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = leaves.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int"))
    blocks = placed.select("path", "c", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "path", "c", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    )
    rows = texts.join(mine, "c").join(blocks, "c").select("path", "i", "j", "part", "c", "mine", "text")
    rows = rows.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(key, group):
            path, i, j = key
            links, edges = _compare(path, [int(i != j and part == j) for part, _, _, _ in group], [g[3] for g in group], [g[2] for g in group])
            c = [g[1] for g in group]
            rows = [(c[k], None, int(n)) for k, n in enumerate(links) if n] + [(c[x], c[y], None) for x, y in edges]
            kinds = (pa.binary(), pa.binary(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["a", "b", "links"])

        key, group = None, []
        for batch in batches:
            for path, i, j, part, c, paths, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (path, i, j) != key:
                    if len(group) > 1:
                        yield compared(key, group)
                    key, group = (path, i, j), []
                if not group or group[-1][1] != c:
                    group.append((part, c, np.array(paths, np.int64), shingle_set(text)))
        if len(group) > 1:
            yield compared(key, group)

    return rows.mapInArrow(run, "a binary, b binary, links long")


def classes(signed: DataFrame) -> DataFrame:
    """(c, n_copies, n_links, class_id, first_c) for every set of `signed`: rows with the set, links to other sets, the smallest id
    of its class, and the set that stands for the class."""
    texts = signed.where("text is not null").select("c", "text")
    leaves = buckets(signed, texts)
    found = written(similar_sets(leaves, texts), "similar")
    dropped(leaves)
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("n_links"))
    roots = components(found.where("b is not null").select("a", "b"), "similar")
    of = roots.withColumnRenamed("node", "c")
    sets = signed.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("low"), F.count("*").alias("n_copies"))
    sets = sets.join(links.withColumnRenamed("a", "c"), "c", "left").join(of, "c", "left")
    sets = sets.select("c", "low", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "c").alias("root"))
    sets = written(sets, "sets")
    dropped(found, roots)
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "c"))
    lowest = sets.groupBy("root").agg(first.alias("first"))
    return sets.join(lowest, "root").select("c", "n_copies", "n_links", F.col("first.low").alias("class_id"), F.col("first.c").alias("first_c"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    signed = signed_sets(docs)
    rows = signed.select("doc_id", "c", "n").join(classes(signed), "c", "left")
    return rows.select(
        "doc_id", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("n").alias("n_shingles"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: that of its smallest id. Texts without words all stay."""
    ready(spark)
    kept = classes(signed_sets(docs)).where("c = first_c").select(F.col("c").alias("_c"), "class_id")
    rows = with_sets(docs)
    first = rows.where("c is not null").join(kept, (F.col("c") == F.col("_c")) & F.col("in_doc_id").eqNullSafe(F.col("class_id")))
    first = first.withColumn("_n", F.row_number().over(Window.partitionBy("c").orderBy("in_doc_id"))).where("_n = 1")
    out = [f"in_{c}" for c in docs.columns]
    return first.select(out).unionByName(rows.where("c is null").select(out)).toDF(*docs.columns)
