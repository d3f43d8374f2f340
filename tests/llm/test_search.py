"""Top-k search, hard negatives and spelling variants against brute force, with their edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import grid, hard_negatives, spelling, topk_search

VECTORS = "vec_id long, embedding array<double>, label int, row string, SIZE string, x int"


def whole(v, scale):
    """Whole numbers of a vector that takes part, else None."""
    if v is None or any(c is None or not math.isfinite(c) or not math.isfinite(c * scale) for c in v):
        return None
    return [math.floor(scale * c) for c in v]


def product(a, b):
    return min(max(sum(x * y for x, y in zip(a, b, strict=True)), -(1 << 63)), (1 << 63) - 1)


def vectors(seed, n, size=7):
    """Clusters, ties, repeated rows and ids, nulls, and vectors of other lengths."""
    random = np.random.default_rng(seed)
    centres = random.standard_normal((4, size))
    rows = []
    for k in range(n):
        v = (centres[k % 4] + random.standard_normal(size) * (0.02 if k % 3 else 1)).round(2).tolist()
        rows.append((k, v, int(random.integers(0, 3)), "r", "s", k))
    rows += [(1, rows[1][1], 0, None, None, None)] * 3 + [(20, rows[20][1], 1, None, None, None)]
    rows += [(None, rows[2][1], 0, None, None, None), (None, None, None, None, None, None), (100, None, 1, None, None, None)]
    rows += [(200, [], 0, None, None, None), (201, [], 1, None, None, None), (300, [0.0] * size, 1, None, None, None)]
    rows += [(400, [1.0, None] + [0.0] * (size - 2), 1, None, None, None), (500, [math.nan] * size, 1, None, None, None)]
    rows += [(600, [math.inf] * size, 1, None, None, None), (700, [1.0, 2.0], 1, None, None, None), (701, [1.5, 2.0], 0, None, None, None)]
    return rows


def brute_top(rows, k, scale):
    own = [(r, i, w) for r, (i, v, *_) in enumerate(rows) if (w := whole(v, scale)) is not None]
    out = []
    for r, i, w in own:
        if i is not None and i % 20 == 0:
            scored = [(-product(w, w2), i2 is None, i2 or 0, i2) for r2, i2, w2 in own if r2 != r and len(w2) == len(w)]
            out += [(i, n, x[3], -x[0]) for n, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("size, blocks, factor", [(7, (4, 64), 1), (40, (8, 32), 1), (40, (16, 2048), 1e9), (5, (2, 64), 1e80)])
def test_top_k_is_exact(spark, monkeypatch, size, blocks, factor):
    monkeypatch.setattr(topk_search, "DIMENSIONS", blocks[0])
    monkeypatch.setattr(topk_search, "CHUNK", blocks[1])
    monkeypatch.setattr(grid, "CANDIDATES", 100)
    monkeypatch.setattr(grid, "QUERIES", 5)
    rows = [(i, v and [c if c is None else c * factor for c in v], *more) for i, v, *more in vectors(size, 250, size)]
    got = topk_search.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, 6)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_top(rows, 6, 64)


def test_few_survivors_are_compacted(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CHUNK", 50)
    random = np.random.default_rng(5)
    decay = 0.7 ** np.arange(48)
    rows = [(k, (random.standard_normal(48) * decay).round(4).tolist(), 0, None, None, None) for k in range(600)]
    calls, pairs = [], topk_search._pairs
    q, c = (grid.Block(48, [(len(x), *(np.array([r[0] for r in x], np.int64).tobytes(),) * 3, __import__("pickle").dumps([[]] * len(x)), np.ascontiguousarray(np.floor(np.array([r[1] for r in x]) * 64).T).tobytes())]) for x in (rows[::20], rows))
    monkeypatch.setattr(topk_search, "_pairs", lambda *a: calls.append(len(a[2])) or pairs(*a))
    i, j, score = topk_search.best_in_cell(q, c, 3)
    got = sorted((int(q.ids[a]), int(c.ids[b]), int(s)) for a, b, s in zip(i, j, score, strict=True))
    assert calls and got == sorted((a, b, s) for a, _, b, s in brute_top(rows, 3, 64))


def test_search_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk_search.top_k(empty, F.col("vec_id") % 20 == 0).count() == 0
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0], 1, None, None, None)], VECTORS)
    assert topk_search.top_k(alone, F.col("vec_id") % 20 == 0).count() == 0


def brute_negatives(rows, scale, positives, negatives):
    own = [(r, i, label, w) for r, (i, v, label, *_) in enumerate(rows) if label is not None and (w := whole(v, scale)) is not None]
    out = []
    for r, i, label, w in own:
        if i is None or i % 10:
            continue
        scored = [(-product(w, w2), i2 is None, i2 or 0, i2, l2) for r2, i2, l2, w2 in own if r2 != r and len(w2) == len(w)]
        scored.sort(key=lambda x: x[:3])
        for p in [x for x in scored if x[4] == label][:positives]:
            near = [x for x in scored if x[4] != label and 4 * -p[0] <= 5 * -x[0] and -x[0] <= -p[0]][:negatives]
            out += [(i, p[3], n, x[3], -p[0], -x[0]) for n, x in enumerate(near, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("size, factor", [(7, 1), (3, 1), (40, 1), (5, 1e80)])
def test_hard_negatives_are_exact(spark, monkeypatch, size, factor):
    monkeypatch.setattr(grid, "CANDIDATES", 70)
    monkeypatch.setattr(grid, "QUERIES", 4)
    rows = [(i, v and [c if c is None else c * factor for c in v], *more) for i, v, *more in vectors(size + 1, 200, size)]
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0, 256, 3, 4)
    got = sorted(map(tuple, got.collect()), key=str)
    assert got and got == brute_negatives(rows, 256, 3, 4)


def test_bounds_hold_the_scores():
    random = np.random.default_rng(3)
    x = np.floor(random.standard_normal((6, 500)) * 300)
    x[:, 0], x[:, 1], x[:, 2] = 0, x[:, 3], -x[:, 3]
    directions = random.standard_normal((8, 6))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    norm, angle = hard_negatives.angles(x, directions)
    for k in range(0, 500, 7):
        low, high = hard_negatives.score_bounds(angle[:, k], norm[k], angle, norm)
        score = x[:, k] @ x
        assert (low <= score).all() and (score <= high).all()


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_spelling(docs):
    seen = Counter()
    for doc_id, text in docs:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                k = h % len(run)
                word, run = (run[:k] + run[k + 1 :] if h % 97 == 0 else run), ""
                seen[word] += len(word) >= 5
    words = {w: n for w, n in seen.items() if n >= 3}
    near = {w: sorted((v for v in words if one_apart(w, v)), key=lambda v: (-words[v], v)) for w in words}
    forms = {w: v[0] if v and words[v[0]] >= 2 * words[w] else None for w, v in near.items()}
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return sorted(out, key=str)


def spelled(spark, docs):
    frame = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in docs], "doc_id long, text string, word string, N string, block int")
    return sorted(map(tuple, spelling.spelling_variants(frame).collect()), key=str)


def test_spelling_variants_are_exact(spark, monkeypatch):
    for name, value in (("BLOCK", 4), ("PIECE", 50), ("HELD", 100)):
        monkeypatch.setattr(spelling, name, value)
    random = np.random.default_rng(1)
    letters = list("aeinréÿZ")
    words = ["".join(random.choice(letters, random.integers(4, 8))) for _ in range(150)]
    words += [w[:k] + w[k + 1 :] for w in words[:60] for k in (0, 3)] + [w[:2] + "q" + w[3:] for w in words[:60]]
    weights = 1 / np.arange(1, len(words) + 1)
    docs = [(d, " ".join(random.choice(words, 60, p=weights / weights.sum())) + ",Āx×abcdeŁ") for d in range(60)]
    docs += [(None, "rrrrrr " * 7), (3, None), (4, ""), (5, "z" * 3000 + " " + ("z" * 2999 + "\n") * 4), (6, " ".join(["z" * 3000] * 19)), (7, "word1word2"), (8, "chaine " * 3 + "chainee " * 8 + "chaineee " * 20), docs[0], docs[0]]
    got = spelled(spark, docs)
    assert got == brute_spelling(docs)
    assert ("chaine", "chainee", "chaineee", 3, 1, 8) in got and any(len(r[0]) > 2000 and r[1] for r in got)


def test_spelling_of_nothing(spark):
    assert spelled(spark, []) == [] and spelled(spark, [(1, None), (None, "")]) == []
