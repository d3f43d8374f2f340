"""Repeated passages by distributed prefix doubling: ranks of positions, paired at growing offsets, until unique or past
the threshold.

The rank of a position at a length names the bytes of that length from there; the rank at 2h names the pair (rank at i,
rank at i + h). Offsets 1, 2, 4 and 8 need the text only and are paired in the task that reads it. From there on Spark
sorts (rank, position) pairs, and what is unique is dropped before the next, longer rank:

1. length SEED, at anchors. For each string of `length` bytes its anchor is the position with the smallest rank at SEED in
   it. Equal strings have the same anchor, so the anchor of a string that repeats has a rank that other documents have too.
2. the run of all strings that share an anchor, as one rank. A run that also occurs in a document with a smaller id is
   removed whole; one document per distinct run (its owner) goes on.
3. about two thirds of `length`, to both sides of the anchor: any string of `length` holds one of the two in full. Only
   strings that hold a side which the run of another document has too go on.
4. these strings of `length` bytes themselves, at the ends of passages.

Ranks are 64-bit hashes where a wrong match costs only work (1 and 3), and 128 bits where it decides (2 and 4).

Skew: before each sort, a task finds the ranks that repeat within its own batch. Their outcome is known there, so only one
row per batch goes to the rank's partition and the rest are dealt by position: a passage in a third of all documents
is no hot key. What a round leaves is written, and its shuffle files go.

Defined results: a null or empty text has no bytes. A row with a null id neither removes nor is removed from. Rows with the
same id do not match each other. Where an id has several rows, its distinct texts (by 128 bits) are numbered and looked at once
each; repeated rows get the same result. An empty table gives no rows. Other columns go along, whatever their names. `length`
is at least SEED and at most 127 + SEED, so that places fit in a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import dropped, ready, table, written
from tallyhouse.llm.shingles import mix

LENGTH = 50
SEED = 16
#: Bytes ranked at a time.
PIECE = 1 << 20
#: Strings named at a time.
NAMES_AT_ONCE = 1 << 13
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def seed_ranks(data: np.ndarray) -> np.ndarray:
    """Rank at SEED (a power of two) of every position that has so many bytes."""
    if len(data) < SEED:
        return np.zeros(0, np.uint64)
    rank, h = mix(np.arange(256, dtype=np.uint64), 17)[data], 1
    while h < SEED:
        rank = rank[:-h] * _ODD[0] + rank[h:]
        rank = (rank ^ (rank >> np.uint64(29))) * _ODD[1]
        h *= 2
    return rank


def first_smallest(rank: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest rank in each window of `width`, by the bits of a rank that its position leaves room for:
    rank and position are one number, so the smaller of two is one step."""
    bits = np.uint64(len(rank).bit_length())
    low, w = (rank >> bits << bits) | np.arange(len(rank), dtype=np.uint64), 1
    while w < width:
        step = min(w, width - w)
        low, w = np.minimum(low[:-step], low[step:]), w + step
    return (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)


def runs(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with the same anchor: rank of the anchor, first string, number of strings, strings before the anchor."""
    parts = []
    for low in range(0, max(len(data) - length + 1, 0), PIECE):
        seed = seed_ranks(data[low : low + PIECE + length - 1])
        at = first_smallest(seed, length - SEED + 1)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        parts.append((seed[at[first]], first + low, np.diff(np.append(first, len(at))), at[first] - first))
    if not parts:
        return np.zeros(0, np.uint64), *([np.zeros(0, np.int64)] * 3)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def names(data: np.ndarray, start: np.ndarray, length: int, lane: int) -> np.ndarray:
    """64 bits that name the `length` bytes from each `start`: a multilinear hash with tables of its own per lane."""
    byte = mix(np.arange(256, dtype=np.uint64), 31 + lane)
    weight = mix(np.arange(length, dtype=np.uint64), 37 + lane) | np.uint64(1)
    out = np.zeros(len(start), np.uint64)
    for low in range(0, len(start), NAMES_AT_ONCE):  # few enough for a core's cache
        some, total = start[low : low + NAMES_AT_ONCE], out[low : low + NAMES_AT_ONCE]
        for k in range(length):
            part = byte.take(data.take(some + k))
            part *= weight[k]
            total += part
    return mix(out, 41)


# A place in a text as one long: the first byte, 7 bits of the strings, 7 of those before the anchor.
def _pack(start: np.ndarray, count: np.ndarray, before: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 14) | (count.astype(np.int64) << 7) | before.astype(np.int64)


def _unpack(place: np.ndarray) -> tuple[np.ndarray, ...]:
    return place >> 14, (place >> 7) & 127, place & 127


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def text_digest() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def distinct_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc, twin, text) of the distinct texts of each id, and (doc, digest, twin, text) of those of ids with several rows,
    written (None without such ids). `twin` is 0 where an id has one row, and else a number of its own."""
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), "text")
    often = written(rows.groupBy("doc").agg(F.count("*").alias("m")).where("m > 1").select("doc"), "repeated-ids")
    if often.isEmpty():
        dropped(often)
        return rows.select("doc", F.lit(0).cast("long").alias("twin"), "text"), None
    several = rows.join(often, "doc", "left_semi").withColumn("digest", text_digest()).groupBy("doc", "digest").agg(F.first("text").alias("text"))
    twins = written(several.withColumn("twin", F.monotonically_increasing_id() + 1), "twins")
    single = rows.join(often, "doc", "left_anti").select("doc", F.lit(0).cast("long").alias("twin"), "text")
    return single.unionByName(twins.select(single.columns)), twins


def _batch(columns: list[np.ndarray], fields: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns], fields)


def _several(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by key: whether a smaller document has the key too, and whether any other has."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(first, len(keys)))
    low, high = np.minimum.reduceat(docs, first), np.maximum.reduceat(docs, first)
    return docs > np.repeat(low, size), np.repeat(low < high, size)


def seeds(texts: DataFrame, length: int) -> DataFrame:
    """(rank, doc, twin, place, kind) of the anchors. kind 0: unknown; 1: repeats, and stands for its batch; 2: repeats."""
    fields = ["rank", "doc", "twin", "place", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found = []
                for d, w, t in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    data = _bytes(t)
                    if len(data) >= length:
                        rank, start, count, before = runs(data, length)
                        found.append((rank, _pack(start, count, before), np.full(len(rank), d, np.int64), np.full(len(rank), w, np.int64)))
                if found:
                    rank, place, doc, twin = (np.concatenate(x) for x in zip(*found, strict=True))
                    order = np.argsort(rank, kind="stable")
                    rank, place, doc, twin = rank[order], place[order], doc[order], twin[order]
                    later, any_other = _several(rank, doc)
                    kind = any_other.astype(np.int64)
                    kind[any_other & np.concatenate(([False], rank[1:] == rank[:-1]))] = 2
                    yield _batch([rank, doc, twin, place, kind], fields)

    return texts.select("doc", "twin", "text").mapInArrow(run, "rank long, doc long, twin long, place long, kind long")


def repeated_seeds(rows: DataFrame) -> DataFrame:
    """(doc, twin, place) of the anchors whose rank two documents have."""
    home = F.when(F.col("kind") < 2, F.col("rank")).otherwise(F.xxhash64("doc", "twin", "place"))
    rows = rows.repartition(home).sortWithinPartitions("rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4  # rows of the last rank, while one document has it
        known = None  # the last rank, once it is known to repeat
        for batch in batches:
            if batch.num_rows:
                rank, doc, twin, place, kind = (np.concatenate((h, c.to_numpy(zero_copy_only=False))) for h, c in zip([*held, np.zeros(len(held[0]), np.int64)], batch.columns, strict=True))
                first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
                size = np.diff(np.append(first, len(rank)))
                several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
                several |= np.maximum.reduceat(kind, first) > 0
                several[0] |= rank[0] == known
                known = rank[-1] if several[-1] else None
                keep = np.repeat(several, size)
                rest = slice(len(rank), None) if several[-1] else slice(first[-1], None)
                held = [rank[rest], doc[rest], twin[rest], place[rest]]
                yield _batch([doc[keep], twin[keep], place[keep]], ["doc", "twin", "place"])

    return rows.mapInArrow(run, "doc long, twin long, place long")


def by_document(places: DataFrame, name: str) -> DataFrame:
    """(doc, twin, places): `places` (doc, twin, place) gathered by text, written."""
    return written(places.groupBy("doc", "twin").agg(F.collect_list("place").alias("places")), name)


def at_places(texts: DataFrame, places: DataFrame, make, fields: str) -> DataFrame:
    """Rows that `make(data, limit, doc, twin, first, start, count, before)` gives for the places (doc, twin, places) of a batch of
    texts, which lie one after another in `data`: `first` and `limit` are where the text of a place begins and ends in it,
    and `start` is the place's first byte in `data`."""
    rows = texts.join(places.hint("shuffle_hash"), ["doc", "twin"]).select("doc", "twin", "text", "places")
    columns = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
                texts = [_bytes(t) for t in part.column(2).to_pylist()]
                sizes = np.array([len(d) for d in texts], np.int64)
                base = np.cumsum(sizes) - sizes
                lists = part.column(3)
                which = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                start, count, before = _unpack(lists.flatten().to_numpy(zero_copy_only=False))
                if len(which):
                    data = np.concatenate(texts)
                    doc, twin = (part.column(k).to_numpy(zero_copy_only=False)[which] for k in (0, 1))
                    first = base[which]
                    rows = make(data, first + sizes[which], doc, twin, first, first + start, count, before)
                    order = np.lexsort((rows[1], rows[0]))
                    rows = [r[order] for r in rows]
                    key = np.cumsum(np.concatenate(([0], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))))
                    later, _ = _several(key, rows[2])
                    yield _batch([*rows, later], columns)

    return rows.mapInArrow(run, fields)


def owned(rows: DataFrame, rest: list[str]) -> DataFrame:
    """(doc, twin, *rest, later) for `rows` (name1, name2, doc, twin, *rest, later): `later` where a smaller document has the name."""
    home: list[Column] = [F.when(F.col("later") == 0, F.col("name1")).otherwise(F.xxhash64("doc", "twin", "place"))]
    rows = rows.repartition(*home).sortWithinPartitions("name1", "name2", "later", "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, low = None, 0
        for batch in batches:
            if batch.num_rows:
                one, two, doc, *more, later = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                first = np.flatnonzero(np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
                lows = doc[first]  # the first row of a name that is not known to be later has the smallest document
                if last == (one[0], two[0]):
                    lows[0] = low
                behind = (later > 0) | (doc > np.repeat(lows, np.diff(np.append(first, len(one)))))
                last, low = (one[-1], two[-1]), lows[-1]
                yield _batch([doc, *more, behind], ["doc", "twin", *rest, "later"])

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in ["doc", "twin", *rest, "later"]))


def repeats(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame | None]:
    """(doc, twin, places): the strings, as runs, that start in a document with a smaller id too, and the numbered texts of ids
    with several rows. `docs` (doc_id, text)."""
    if not SEED <= length <= 127 + SEED:
        raise ValueError(f"length must be from {SEED} to {127 + SEED}")
    texts, twins = distinct_texts(docs)
    reach = (length - SEED + 1) // 2

    def run_rows(data, limit, doc, twin, first, start, count, before):
        ends = [names(data, start, length, k) + names(data, start + count - 1, length, k) * _ODD[k] + count.astype(np.uint64) for k in (0, 1)]
        anchor = start + before
        sides = []
        for side, has in ((anchor - reach, before >= reach), (anchor, count > before - reach + 1)):
            has &= (side >= first) & (side + reach + SEED <= limit)
            sides.append(np.where(has, names(data, np.where(has, side, start), reach + SEED, 2), np.uint64(0)))
        return (*(mix(e, 43) for e in ends), doc, twin, _pack(start - first, count, before), *sides)

    def string_rows(data, limit, doc, twin, first, start, count, before):
        each = np.repeat(np.arange(len(start)), count)
        at = start[each] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        one = np.ones(len(at), np.int64)
        return names(data, at, length, 0), names(data, at, length, 1), doc[each], twin[each], _pack(at - first[each], one, one * 0)

    longs = lambda *c: ", ".join(f"{x} long" for x in c)
    places = by_document(repeated_seeds(seeds(texts, length)), "seeds")
    found = at_places(texts, places, run_rows, longs("name1", "name2", "doc", "twin", "place", "left", "right", "later"))
    ranked = written(owned(found, ["place", "left", "right"]), "runs")
    dropped(places)
    # The strings that hold a side: up to the one that begins `reach` before the anchor, and those after it.
    count, before = F.shiftright("place", 7).bitwiseAND(127), F.col("place").bitwiseAND(127)
    skip = F.greatest(before - reach + 1, F.lit(0))
    to_left = F.col("place") - F.shiftleft(count - F.least(count, skip), 7)
    to_right = F.col("place") + F.shiftleft(skip, 14) - F.shiftleft(skip, 7) - skip
    pairs = F.array(F.struct(F.col("left").alias("side"), to_left.alias("place")), F.struct(F.col("right").alias("side"), to_right.alias("place")))
    sides = ranked.where("later = 0").select("doc", "twin", F.explode(pairs).alias("p")).select("doc", "twin", "p.side", "p.place").where("side <> 0")
    shared = sides.groupBy("side").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("side")
    ends = by_document(sides.join(shared, "side", "left_semi").select("doc", "twin", "place"), "ends")
    named = at_places(texts, ends, string_rows, longs("name1", "name2", "doc", "twin", "place", "later"))
    single = written(owned(named, ["place"]).where("later = 1").select("doc", "twin", "place"), "strings")
    dropped(ends)
    repeated = by_document(ranked.where("later = 1").select("doc", "twin", "place").unionByName(single), "repeats")
    dropped(ranked, single)
    return repeated, twins


def merged(start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the ranges, which are sorted by start; ranges that touch are one."""
    if not len(start):
        return []
    reach = np.maximum.accumulate(stop)
    first = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    return [(int(a), int(b)) for a, b in zip(start[first], reach[np.append(first[1:] - 1, len(start) - 1)], strict=True)]


def removed(docs: DataFrame, fields: list[T.StructField], make, length: int = LENGTH) -> DataFrame:
    """All columns of `docs` (doc_id, text and others) and `fields`, which `make(data, spans)` gives for each text and the byte
    ranges to remove."""
    cuts, twins = repeats(docs, length)
    own = [f"in_{c}" for c in docs.columns]
    given = docs.toDF(*own).withColumn("_doc", F.col("in_doc_id").cast("long"))
    number = F.lit(0).cast("long")
    if twins is not None:
        texts = docs.toDF(*own).withColumn("text", F.col("in_text"))
        numbers = twins.select(F.col("doc").alias("_doc"), F.col("digest").alias("_digest"), F.col("twin").alias("_number"))
        given = texts.withColumn("_doc", F.col("in_doc_id").cast("long")).withColumn("_digest", text_digest()).join(numbers, ["_doc", "_digest"], "left")
        number = F.coalesce("_number", F.lit(0))
    rows = given.withColumn("_twin", number).join(cuts.hint("shuffle_hash"), (F.col("_doc") == cuts["doc"]) & (F.col("_twin") == cuts["twin"]), "left")
    rows = rows.select(*own, F.col("places").alias("_places"))
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = []
                for t, p in zip(part.column(at_text).to_pylist(), part.column(len(own)), strict=True):
                    data, spans = _bytes(t), []
                    if p.is_valid:
                        start, count, _ = _unpack(np.sort(p.values.to_numpy(zero_copy_only=False)))
                        spans = merged(start, start + count + length - 1)
                    out.append(make(data, spans))
                made = [pa.array(c, T_ARROW[f.dataType.typeName()]) for c, f in zip(zip(*out, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], [*own, *(f.name for f in fields)])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *fields]))


T_ARROW = {"long": pa.int64(), "string": pa.string()}


def _left(data: np.ndarray, spans: list[tuple[int, int]]) -> bytes:
    keep = np.ones(len(data), bool)
    for a, b in spans:
        keep[a:b] = False
    return data[keep].tobytes()


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fields = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]

    def make(data, spans):
        return len(data), sum(b - a for a, b in spans), len(spans), hashlib.sha256(_left(data, spans)).hexdigest()

    return removed(docs, fields, make).select(F.col("in_doc_id").alias("doc_id"), *(f.name for f in fields))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages. Bytes of a character that is cut in two go with it. Documents of which
    nothing is left go; n_chars is that of the new text."""
    ready(spark)

    def make(data, spans):
        return (_left(data, spans).decode("utf-8", "ignore") if spans else None, int(bool(spans)))

    fields = [T.StructField("_new", T.StringType()), T.StructField("_cut", T.LongType())]
    rows = removed(docs, fields, make)
    new = F.when(F.col("_cut") == 1, F.col("_new")).otherwise(F.col("in_text"))
    count = F.when(F.col("_cut") == 1, F.length("_new")).otherwise(F.col("in_n_chars")).cast("long")
    change = {"text": new, "n_chars": count}
    rows = rows.where("_cut = 0 or _new <> ''")
    return rows.select(*(change.get(c, F.col(f"in_{c}")).alias(c) for c in docs.columns))
