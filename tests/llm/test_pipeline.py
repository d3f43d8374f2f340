"""All rows of the corpus pipeline against its five stages by plain loops."""

import collections
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tallyhouse.llm import classifier, packing

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The given documents, with near copies, shared passages, a bad host, poor, empty and null texts added."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted(given.collect())
    full = [r for r in rows if r.text and len(r.text.split()) > 120][:30]
    added, at = [], 10**6
    for k, r in enumerate(full):
        words = r.text.split(" ")
        near = [*words]
        near[len(near) // 2] = "changed"
        passage = " ".join(words[:60]) + f" é{k} "
        for text in (" ".join(near), passage + " ".join(f"fresh{k}x{n}." for n in range(80)), f"short text {k}"):
            added.append((at, text, "en", "worst host" if len(text) < 40 else r.source, len(text)))
            at += 1
    added += [(at, full[0].text, "en", "worst host", 1), (at + 1, None, "en", None, None), (at + 2, "", "en", "empty", 0)]
    # Texts that pass the rules and that only their labels call bad.
    poor = [(at + 10 + k, " ".join(f"{k}{n * 7919 % 1000}!" for n in range(90 + k)), "en", "numbers", 0) for k in range(40)]
    added += poor
    path = str(tmp_path_factory.mktemp("corpus"))
    given.unionByName(spark.createDataFrame(added, given.schema)).write.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    labels.unionByName(spark.createDataFrame([(r[0], 0) for r in poor], labels.schema)).write.parquet(f"{path}/labels.parquet")
    return path


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def failures(text):
    words = words_of(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = collections.Counter(windows)
    repeated = len({k + o for k, w in enumerate(windows) if counts[w] > 1 for o in range(3)})
    lines = [line for line in text.split("\n") if words_of(line)]
    return (
        len(words) < 50 or 100 * repeated > 50 * len(words),
        10 * sum(c in "#*$%&|<>" for c in text) > sum(map(len, words)),
        2 * (len(lines) - len(set(lines))) > len(lines),
    )


def by_rules(docs):
    failed = {i: failures(r.text or "") for i, r in docs.items()}
    hosts = collections.defaultdict(list)
    for i, r in docs.items():
        if r.source is not None:
            hosts[r.source].append(failed[i])
    n, bad = sum(map(len, hosts.values())), set()
    for rule in range(3):
        mean = sum(f[rule] for v in hosts.values() for f in v) / n
        rates = {h: sum(f[rule] for f in v) / len(v) for h, v in hosts.items()}
        between = sum(len(v) * (rates[h] - mean) ** 2 for h, v in hosts.items()) / n - mean * (1 - mean) * (len(hosts) - 1) / n
        strength = 1000 if between <= 0 else min(1000, max(1, mean * (1 - mean) / between - 1))
        bad |= {h for h, v in hosts.items() if (rates[h] * len(v) + mean * strength) / (len(v) + strength) > 0.5}
    assert bad
    return {i: r for i, r in docs.items() if not any(failed[i]) and r.source not in bad}


def by_classifier(docs, labels):
    used = sorted(
        (classifier.statistics(docs[i].text or ""), q) for i, q in labels if i in docs and q in (0, 1) and zlib.crc32(str(i).encode()) % 5
    )
    model = classifier.fit(np.array([s for s, _ in used], float), np.array([q for _, q in used], float))
    ids = sorted(docs)
    scores = model.score(np.array([classifier.statistics(docs[i].text or "") for i in ids], float))
    return {i: docs[i] for i, s in zip(ids, scores, strict=True) if s >= 0.3}


def by_jaccard(docs):
    sets = {}
    for i, r in docs.items():
        w = words_of(r.text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    low = {i: i for i in sets}
    root = lambda i: i if low[i] == i else root(low[i])
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {i: r for i, r in docs.items() if root(i) == i}


def by_passages(docs):
    texts = {i: r.text.encode() for i, r in docs.items()}
    owners, out = {}, {}
    for i in sorted(texts):
        b, keep = texts[i], np.ones(len(texts[i]), bool)
        for k in range(len(b) - 49):
            if owners.setdefault(b[k : k + 50], i) < i:
                keep[k : k + 50] = False
        text = np.frombuffer(b, np.uint8)[keep].tobytes().decode("utf-8", "ignore")
        if keep.all() or text:
            out[i] = text
    return out


def test_every_row_of_the_pipeline(spark, folder):
    from tokenizers import Tokenizer

    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    ruled = by_rules(docs)
    good = by_classifier(ruled, labels)
    single = by_jaccard(good)
    texts = by_passages(single)
    assert len(docs) > len(ruled) > len(good) > len(single) >= len(texts) > 50
    assert any(texts[i] != docs[i].text for i in texts)
    library = Tokenizer.from_file(packing.tokenizer_path())
    library.no_truncation()
    library.no_padding()
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    pieces, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, rows in pieces.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            part = np.array(ids[i][at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids[i]), zlib.crc32(part)), i
            at += r.length
        assert at == len(ids[i])
    for rows in windows.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert 0 < at <= 2048 and at & (at - 1) == 0
