"""Repeated passages: shared ids, other columns, long texts. Near copies in large groups."""

import collections
import random

import numpy as np
from pyspark.sql import functions as F

from tallyhouse.llm import jaccard_join, suffix_dedup
from tallyhouse.llm.shingles import shingle_set

DOCS = "doc_id long, text string, lang string, source string, n_chars long, doc string, _places string, TWIN int, later string"


def written_docs(spark, path, rows):
    rows = [(i, t, "en", "s", len(t or ""), "d", "p", 5, "l") for i, t in rows]
    frame = spark.createDataFrame(rows, DOCS)
    frame.write.parquet(f"{path}/documents.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def brute(rows, length=50):
    owners = {}
    for i, t in rows:
        for k in range(len(t) - length + 1):
            owners[t[k : k + length]] = min(i, owners.get(t[k : k + length], i))
    out = collections.Counter()
    for i, t in rows:
        keep = np.ones(len(t), bool)
        for k in range(len(t) - length + 1):
            if owners[t[k : k + length]] < i:
                keep[k : k + length] = False
        out[i, len(t), int((~keep).sum())] += 1
    return out


def test_many_texts_on_one_id(spark, tmp_path):
    random.seed(4)
    passages = ["".join(random.choices("abcdefgh ", k=80)) for _ in range(40)]
    rows = [(9, random.choice(passages) * random.randint(1, 2) + f" {k % 900} " + random.choice(passages)) for k in range(1000)]
    rows += [(k, "".join(random.choices(passages, k=2))) for k in (1, 4, 12, 13)] + [(5, passages[0])] * 3 + [(14, "x" * 95)]
    written_docs(spark, tmp_path, rows)
    got = suffix_dedup.op4_suffix_dedup(spark, str(tmp_path)).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed) for r in got) == brute(rows)


def test_texts_beyond_a_block_and_other_columns(spark, tmp_path, monkeypatch):
    random.seed(5)
    long = "".join(random.choices("abcdefghijklmnopqrstuvwxyz ", k=suffix_dedup.PIECE + 300))
    edge = suffix_dedup.PIECE
    rows = [(1, long), (2, "q" + long[edge - 30 : edge + 40] + "w"), (3, long[-60:]), (4, long[:50] + "!"), (5, None), (None, long[:80]), (6, "no such text")]
    docs = written_docs(spark, tmp_path, rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.op4_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (len(long), 0, 0), 2: (72, 70, 1), 3: (60, 60, 1), 4: (51, 50, 1), 5: (0, 0, 0), None: (80, 0, 0), 6: (12, 0, 0)}
    kept = suffix_dedup.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.where("doc_id <> 1").collect()} == {2: "qw", 4: "!", 5: None, 6: "no such text"}
    assert {tuple(r) for r in kept.select("doc", "_places", "TWIN", "later").collect()} == {("d", "p", 5, "l")}
    again = docs.unionByName(docs.where("doc_id in (2, 6)"))
    assert sorted(r.doc_id for r in suffix_dedup.stage(spark, again, str(tmp_path)).where("doc_id > 1").collect()) == [2, 2, 4, 5, 6, 6]
    assert suffix_dedup.stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_large_groups_of_near_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK", 40)
    random.seed(6)
    words = [f"w{k}" for k in range(4000)]
    common = random.choices(words, k=60)
    rows = []
    for k in range(400):
        if k % 2:  # near copies of one text
            text = common + random.choices(words, k=40) if k % 10 == 1 else list(common)
            for _ in range(random.randint(0, 2)):
                text[random.randrange(len(text))] = random.choice(words)
        else:  # other texts with a passage of it
            text = random.choices(words, k=random.randint(30, 60)) + common[10:30]
        rows.append((k, " ".join(text)))
    docs = written_docs(spark, tmp_path, rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.op8_jaccard_join(spark, str(tmp_path)).collect()}
    sets = {i: set(shingle_set(t).tolist()) for i, t in rows}
    texts = {frozenset(s) for s in sets.values()}
    near = {a: {b for b in texts if a != b and len(a & b) * 10 >= len(a | b) * 8} for a in texts}
    for i, s in sets.items():
        reached, front = {frozenset(s)}, [frozenset(s)]
        while front:
            front = [b for a in front for b in near[a] if b not in reached and not reached.add(b)]
        assert got[i] == (min(j for j, o in sets.items() if frozenset(o) in reached), len(near[frozenset(s)]))
    signed = jaccard_join.signed_sets(docs.select("doc_id", "text"))
    leaves = jaccard_join.buckets(signed, signed.where("text is not null").select("c", "text"))
    assert leaves.groupBy("path").count().where(F.col("count") > 100).count() <= 4  # not one for each run


def test_one_number_holds_rank_and_place():
    rng = np.random.default_rng(3)
    for size, width in ((35, 35), (36, 35), (400, 35), (5, 1), (9, 4)):
        few = rng.integers(0, 5, size).astype(np.uint64) << np.uint64(59)  # ties
        for rank in (few, rng.integers(0, 1 << 64, size, dtype=np.uint64)):
            want = [k + int(np.argmin(rank[k : k + width])) for k in range(size - width + 1)]
            assert suffix_dedup.first_smallest(rank, width).tolist() == want


def test_names_of_more_strings_than_are_named_at_a_time(monkeypatch):
    data = np.frombuffer(b"abcdefghij" * 9, np.uint8)
    start = np.arange(40)
    whole = suffix_dedup.names(data, start, 50, 0)
    monkeypatch.setattr(suffix_dedup, "NAMES_AT_ONCE", 7)
    assert (suffix_dedup.names(data, start, 50, 0) == whole).all() and len(set(whole.tolist())) == 10
