"""Licence scan with a positional index of rare tokens, in DataFrame functions only.

Licence notices are templates of words. Over all documents the words of the templates are counted, and each template's words
are put in order, rarest first. A word of a file, less its position in a template, is a candidate offset of that template.
Looked up are so many of the rarest words that fewer than half of the template's words are left, and the rarest of the
mandatory phrase: a file that has any of them at an offset has that offset as a candidate, words it does not have take
nothing away, and no offset where the phrase or half of the words stand can be missed. The counts decide only which words
are looked up. A template is found where its mandatory phrase stands at a candidate; the score of a file is the largest share of a
template's words in place at an offset where the phrase, half of the words or the ROOTS rarest words stand.

Everything after the count of words happens within the row: no join, no shuffle, no key that could be hot.

Defined results: a null or empty text has no words, no labels and score 0. Rows are scanned one by one. An empty table gives
no rows. Other columns go along, whatever their names.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ROOTS = 3

#: Phrases that make a base label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: label, words of the notice, mandatory phrase in it.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("mit", "released under the mit license", "under the mit license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
)
#: Notices as licences and their authors word them, besides the above.
NOTICES = (
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     "creative commons attribution noncommercial 4 0 international"),
    ("gpl-3.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
     "software foundation either version 3 of the license", "gnu general public license as published by the free software foundation either version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2 0"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# WORDS of lower-cased text, its separators one by one: Java looks these up in one table, and tries ranges one after another.
_RUNS = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not re.fullmatch("[0-9a-z]", chr(c))) + "]+"
#: The one letter beyond ASCII that `lower` makes ASCII, the sign for kelvin.
_KELVIN = "\u212a"


def lowered(text: Column) -> Column:
    """`text` with A-Z in lower case, in a form good for WORDS: other letters, which no template has, may be lowered too."""
    return F.when(F.contains(text, F.lit(_KELVIN)), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(_RUNS), F.lit(0))


def rare_words(docs: DataFrame, templates=TEMPLATES, text: str = "text") -> list[list[tuple[str, int]]]:
    """Per template its words with their positions, rarest first. The counts are as many as the templates have words."""
    vocabulary = sorted({w for _, notice, _ in templates for w in notice.split()})
    held = docs.select(F.explode(F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, vocabulary)))).alias("word"))
    counts = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}
    return [[(w, i) for _, w, i in sorted((counts.get(w, 0), w, i) for i, w in enumerate(notice.split()))] for _, notice, _ in templates]


def _start(notice: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(notice)) if notice[i : i + len(phrase)] == phrase)


def looked_up(order: list[tuple[str, int]], notice: list[str], phrase: list[str]) -> list[tuple[str, int]]:
    """Words one of which stands wherever half of the notice or the phrase does."""
    start = _start(notice, phrase)
    most = order[: len(notice) // 2 + 1]
    return list(dict.fromkeys([*most, next(x for x in order if start <= x[1] < start + len(phrase))]))


def _stands(words: Column, at: Column, phrase: list[str]) -> Column:
    """Whether `phrase` stands at word `at`, from 0."""
    equal = F.lit(True)
    for k, w in enumerate(phrase):
        equal &= F.coalesce(F.get(words, at + k) == w, F.lit(False))
    return equal


HELD = "array<struct<found: boolean, roots: boolean, share: double>>"


def _held(notice: list[str], roots: list[tuple[str, int]], phrase: list[str], start: int):
    """What stands at an offset, which may lie before the text."""

    def held(o: Column) -> Column:
        there = lambda i, w: F.coalesce(F.get("words", o + i) == w, F.lit(False))
        hits = [there(i, w).cast("int") for i, w in enumerate(notice)]
        rare = [there(i, w) for w, i in roots]
        return F.struct(
            _stands(F.col("words"), o + start, phrase).alias("found"), functools.reduce(lambda a, b: a & b, rare).alias("roots"),
            (sum(hits[1:], hits[0]) / len(notice)).alias("share"),
        )

    return held


def scan(docs: DataFrame, templates=TEMPLATES + NOTICES, base=BASE, text: str = "text") -> DataFrame:
    """All columns of `docs` as in_*, n_words, base_at (places of base phrases), base_labels, labels, score."""
    orders = rare_words(docs, templates, text)
    index = [looked_up(order, notice.split(), key.split()) for order, (_, notice, key) in zip(orders, templates, strict=True)]
    keys = sorted({p.split()[0] for p, _ in base} | {w for rare in index for w, _ in rare})
    rows = docs.select(*(F.col(c).alias(f"in_{c}") for c in docs.columns), words_of(F.col(text)).alias("words"))
    # The places of the index's words, once per row.
    spots = F.filter(F.transform("words", lambda w, i: F.when(w.isin(keys), F.struct(w.alias("w"), i.alias("i")))), lambda s: s.isNotNull())
    rows = rows.withColumn("spots", F.when(F.arrays_overlap("words", F.array(*map(F.lit, keys))), spots))
    places = lambda word: F.transform(F.filter("spots", lambda s: s["w"] == word), lambda s: s["i"])
    none = F.array().cast("array<int>")
    # Spark counts the parameters of a lambda, so what varies is bound by these functions.
    standing = lambda p, start=0: lambda o: _stands(F.col("words"), o + start, p)
    less = lambda at: lambda i: i - at

    found = {}
    for n, (phrase, _) in enumerate(base):
        p = phrase.split()
        found[f"base{n}"] = F.coalesce(F.filter(places(p[0]), standing(p)), none)
    for n, (rare, order, (_, notice, key)) in enumerate(zip(index, orders, templates, strict=True)):
        offsets = F.array_distinct(F.concat(*(F.transform(places(w), less(at)) for w, at in rare)))
        w, k = notice.split(), key.split()
        # At every candidate: whether the phrase stands, whether the rarest words do, and the share in place.
        held = F.transform(offsets, _held(w, order[:ROOTS], k, _start(w, k)))
        found[f"at{n}"] = F.coalesce(F.filter(held, lambda s: s["found"] | s["roots"] | (s["share"] >= 0.5)), F.array().cast(HELD))
    rows = rows.withColumns(found)

    labels, scores = [], [F.lit(0.0)]
    for n, (label, _, _) in enumerate(templates):
        labels.append(F.when(F.exists(f"at{n}", lambda s: s["found"]), F.lit(label)))
        scores.append(F.coalesce(F.array_max(F.transform(f"at{n}", lambda s: s["share"])), F.lit(0.0)))
    own = [F.when(F.size(f"base{n}") > 0, F.lit(label)) for n, (_, label) in enumerate(base)]
    joined = lambda each: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*each)))), ",")
    return rows.select(
        *(f"in_{c}" for c in docs.columns), F.size("words").cast("long").alias("n_words"),
        F.concat(*(f"base{n}" for n in range(len(base)))).alias("base_at"), joined(own).alias("base_labels"),
        joined([*own, *labels]).alias("labels"), F.greatest(*scores).alias("score"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        F.col("in_doc_id").alias("doc_id"), "n_words", F.size("base_at").cast("long").alias("n_base"),
        F.array_min("base_at").cast("long").alias("first_word"), F.array_max("base_at").cast("long").alias("last_word"),
        "base_labels", "labels", "score",
    )


def _oracle() -> str:
    rows = ", ".join(f"('{label}', {i}, '{w}', {int(start <= i < start + len(key.split()))})" for label, notice, key in TEMPLATES
                     for start in [notice.split().index(key.split()[0])] for i, w in enumerate(notice.split()))
    phrases = ", ".join(f"('{label}', {p.split()})" for p, label in BASE)
    return rf"""
WITH t(label, i, w, must) AS (VALUES {rows}), b(label, phrase) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORDS}') AS words FROM documents),
p AS (SELECT r, unnest(words) AS w, unnest(range(0, len(words))) AS pos FROM d),
df AS (SELECT w, count(DISTINCT r) AS n FROM p WHERE w IN (SELECT w FROM t) GROUP BY w),
rare AS (SELECT * FROM (SELECT t.*, row_number() OVER (PARTITION BY label ORDER BY coalesce(n, 0), t.w, i) AS k FROM t LEFT JOIN df USING (w)) WHERE k <= {ROOTS}),
o AS (SELECT r, label, pos - i AS o FROM p JOIN rare USING (w) GROUP BY ALL HAVING count(DISTINCT k) = {ROOTS}),
m AS (SELECT o.r, o.label, o.o, count(*) FILTER (WHERE p.w = t.w) / count(*) AS share, bool_and(must = 0 OR coalesce(p.w = t.w, false)) AS found
  FROM o JOIN t USING (label) LEFT JOIN p ON p.r = o.r AND p.pos = o.o + t.i GROUP BY ALL),
base AS (SELECT r, label, pos FROM d JOIN p USING (r), b WHERE p.w = phrase[1] AND words[pos + 1 : pos + len(phrase)] = phrase),
bl AS (SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM m WHERE found) GROUP BY r),
s AS (SELECT r, max(share) AS score FROM m GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(bl.n, 0) AS n_base, bl.lo AS first_word, bl.hi AS last_word,
  coalesce(bl.labels, '') AS base_labels, coalesce(al.labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN bl USING (r) LEFT JOIN al USING (r) LEFT JOIN s USING (r)
"""


ORACLE = _oracle()
