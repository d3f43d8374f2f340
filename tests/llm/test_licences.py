"""The licence scan against a plain scan of every template at every offset."""

import random
import re

from pyspark.sql import functions as F

from tallyhouse.llm import license_scan
from tallyhouse.llm.license_scan import BASE, NOTICES, ROOTS, TEMPLATES, WORDS

EVERY = TEMPLATES + NOTICES


def plain_words(text):
    return re.findall(WORDS, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_scan(texts):
    files = [plain_words(t) for t in texts]
    found = []
    for words in files:
        at = lambda i, words=words: words[i] if 0 <= i < len(words) else None
        places = [(i, label) for phrase, label in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        labels, score = {label for _, label in places}, 0.0
        for label, notice, key in EVERY:
            notice, key = notice.split(), key.split()
            start = next(i for i in range(len(notice)) if notice[i : i + len(key)] == key)
            counts = {w: sum(w in set(f) for f in files) for w in notice}
            roots = sorted((counts[w], w, i) for i, w in enumerate(notice))[:ROOTS]
            for o in range(-len(notice), len(words)):
                share = sum(at(o + i) == w for i, w in enumerate(notice)) / len(notice)
                stands = all(at(o + start + k) == w for k, w in enumerate(key))
                if stands:
                    labels.add(label)
                if stands or share >= 0.5 or all(at(o + i) == w for _, w, i in roots):
                    score = max(score, share)
        found.append((sorted(i for i, _ in places), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), round(score, 9)))
    return found


def made_texts(seed, count):
    """Whole, cut, edited, repeated and joined notices, some with capitals and signs between the words."""
    rng = random.Random(seed)
    pool = sorted({w for _, notice, _ in EVERY for w in notice.split()}) + ["zebra", "é", "licence"]
    texts = [None, "", "...", "é", "mit license " * 40]
    while len(texts) < count:
        words = []
        for _ in range(rng.randint(1, 3)):
            _, notice, key = rng.choice(EVERY)
            part = (notice if rng.random() < 0.7 else key).split()
            if rng.random() < 0.4:
                lo = rng.randrange(len(part))
                part = part[lo : lo + rng.randint(1, len(part))]
            for _ in range(rng.choice((0, 0, 1, 2, 5))):
                where, what = rng.randrange(len(part) + 1), rng.choice(pool)
                part = part[:where] + [what] * rng.randint(0, 1) + part[where + rng.randint(0, 1) :]
            words += part + [rng.choice(pool) for _ in range(rng.randint(0, 4))]
        text = rng.choice((" ", " ", ", ", "\n", "-")).join(words)
        texts.append(text.title() if rng.random() < 0.3 else text)
    return texts


def test_every_template_at_every_offset(spark):
    texts = made_texts(5, 300)
    rows = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], "doc_id long, text string, words string, spots string")
    got = {
        r.in_doc_id: (sorted(r.base_at), r.base_labels, r.labels, round(r.score, 9))
        for r in license_scan.scan(rows).select("in_doc_id", "in_words", "base_at", "base_labels", "labels", "score").collect()
    }
    want = dict(enumerate(plain_scan(texts)))
    assert {k: (got[k], want[k], texts[k]) for k in want if got[k] != want[k]} == {}
    # The notices are met at all.
    assert {label for _, _, labels, _ in want.values() for label in labels.split(",")} >= {label for label, _, _ in EVERY}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan(empty).isEmpty()


def test_words_are_taken_without_ranges_and_letters_beyond_ascii_stay_apart(spark):
    assert "-" not in license_scan._RUNS  # ranges are tried one after another
    texts = ["MIT Lıcense LİCENSE licKns work", "K mit", "worK WORK MIT LICENSE", "ÉTÉ ΣΑΣ \x00\x7f\x80 a_b`c{d", None, ""]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    words = [r["w"] for r in rows.select("k", license_scan.words_of(F.col("text")).alias("w")).orderBy("k").collect()]
    plain = [re.findall(WORDS, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    known = {w for _, notice, _ in TEMPLATES + NOTICES for w in notice.split()} | {"work"}
    assert [len(w) for w in words] == [len(w) for w in plain]
    assert [[x if x in known else None for x in w] for w in words] == [[x if x in known else None for x in w] for w in plain]
