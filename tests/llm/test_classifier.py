"""The quality classifier against plain loops: every split searched row by row, every tree walked row by row."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import classifier
from tallyhouse.llm.classifier import LEAST, RATE, RIDGE, STATISTICS

FOLDER = "/root/testdata/sf0.001"


def walk(model, row):
    """Score of one row, node by node."""
    total = model.base
    for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
        node = 0
        for _ in range(classifier.DEPTH):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += value[node]
    return 1 / (1 + math.exp(-total))


def gain(rows, slope, curve, feature, threshold, x):
    """Gain of a split, or None where a side holds too few rows."""
    left = [k for k in rows if x[k][feature] <= threshold]
    right = [k for k in rows if x[k][feature] > threshold]
    if len(left) < LEAST or len(right) < LEAST:
        return None
    worth = lambda ks: sum(slope[k] for k in ks) ** 2 / (sum(curve[k] for k in ks) + RIDGE)
    return worth(left) + worth(right) - worth(rows)


def test_every_split_is_the_best_of_all(monkeypatch):
    monkeypatch.setattr(classifier, "TREES", 3)
    monkeypatch.setattr(classifier, "DEPTH", 2)
    random = np.random.default_rng(3)
    x = random.random((160, 4)).round(2)
    x[:, 3] = random.integers(0, 3, 160)  # many ties
    y = ((x[:, 0] > 0.4) & (x[:, 3] > 0) | (random.random(160) < 0.1)).astype(float)
    model = classifier.fit(x, y)
    edges = [sorted({float(q) for q in np.quantile(x[:, f], np.linspace(0, 1, classifier.BINS)[1:-1])}) for f in range(4)]
    margin = [math.log((y.sum() + 1) / (len(y) - y.sum() + 1))] * len(y)
    assert len(model.feature) == 3 and model.base == pytest.approx(margin[0])
    for t in range(3):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        slope, curve = [b - a for a, b in zip(p, y, strict=True)], [a * (1 - a) for a in p]
        at = {0: list(range(len(y)))}
        for node in range(3):
            rows, f, cut = at[node], int(model.feature[t, node]), float(model.threshold[t, node])
            found = [gain(rows, slope, curve, g, e, x) for g in range(4) for e in edges[g]] if len(rows) >= 2 * LEAST else []
            best = max((v for v in found if v is not None), default=0.0)
            if best > 1e-6:
                assert gain(rows, slope, curve, f, cut, x) == pytest.approx(best, abs=1e-9)
            else:
                assert cut == math.inf
            at[2 * node + 1] = [k for k in rows if not x[k][f] > cut]
            at[2 * node + 2] = [k for k in rows if x[k][f] > cut]
        for leaf in range(3, 7):
            value = RATE * sum(slope[k] for k in at[leaf]) / (sum(curve[k] for k in at[leaf]) + RIDGE)
            assert model.value[t, leaf] == pytest.approx(value, abs=1e-12)
            for k in at[leaf]:
                margin[k] += value
    assert model.score(x) == pytest.approx([1 / (1 + math.exp(-m)) for m in margin], abs=1e-12)
    assert model.score(x) == pytest.approx([walk(model, row) for row in x], abs=1e-12)


def plain(text):
    """Some statistics of a text, by plain loops."""
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in text).split(" ") if w]
    n, chars = max(len(words), 1), max(sum(map(len, words)), 1)
    return {
        "words": len(words), "word_length": sum(map(len, words)) / n, "digits": sum(c in "0123456789" for c in text) / chars,
        "commas": text.count(",") / n, "stops": text.count(".") / n, "distinct": len(set(words)) / n,
        "longest": max(map(len, words), default=0), "wide": sum(b > 127 for b in text.encode()) / max(len(text.encode()), 1),
    }


def test_statistics_by_plain_loops():
    for text in ("", "one", "a, b. c\n\na, b. c 12,5 élan \t x\x0by", "x" * 5000 + " 7", "　 wide\x1cword"):
        got = dict(zip(STATISTICS, classifier.statistics(text), strict=True))
        for name, value in plain(text).items():
            assert got[name] == pytest.approx(value), (name, text[:20])


def test_the_query_on_every_row(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()]
    held_out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    used = [(classifier.statistics(docs[i] or ""), q) for i, q in labels if i in docs and q in (0, 1) and not held_out(i)]
    used.sort()
    model = classifier.fit(np.array([s for s, _ in used], float), np.array([q for _, q in used], float))
    rows = classifier.op5_quality_classifier(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == held_out(r.doc_id) and r.predicted == (r.score >= 0.3)
        assert r.score == pytest.approx(walk(model, classifier.statistics(docs[r.doc_id] or "")), abs=1e-9)
    truth = dict(labels)
    judged = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    # 19 rows at this size, of which one is wrong; the accuracy at sf0.1 is in the README.
    assert len(judged) > 10 and sum(r.predicted == truth[r.doc_id] for r in judged) / len(judged) >= 0.9


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = classifier.train(docs, labels), classifier.train(docs, other)
    assert first.base == second.base and (first.value == second.value).all() and (first.threshold == second.threshold).all()


def test_other_columns_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(classifier, "SAMPLE_ROWS", 30)
    rows = [(k % 7, f"{'good words here. ' * k}", "s", k, 0.5) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text string, quality int, score double")
    labels = spark.createDataFrame([(k, k % 2) for k in range(7)], "doc_id long, quality int")
    model = classifier.train(docs, labels)
    out = classifier.scored(docs, model).collect()
    assert len(out) == 200 and all(r.score == pytest.approx(walk(model, classifier.statistics(r.in_text))) for r in out)
    assert classifier.scored(docs.limit(0), model).count() == 0
