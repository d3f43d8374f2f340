"""Quality rules with host verdicts: rule failures by host, rates shrunk by an empirical beta prior, joined back.

Defined results: a null or empty text has no words (all counts 0) and fails the base rule. Rows without a source have no
host, so only their own rules count. Repeated rows and repeated ids are judged row by row. An empty table gives no rows. Other columns
pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import ready, table, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_word_lines")

#: A text fails a rule where its expression holds; hosts are rejected where the shrunk rate of a rule is above its limit.
RULES = {
    "base_failed": "n_words < 50 or 100 * n_repeat_words > 50 * n_words",
    "symbols_failed": "10 * n_symbols > word_chars",
    "lines_failed": "2 * n_dup_lines > n_word_lines",
}
HOST_LIMITS = {"base_failed": 0.5, "symbols_failed": 0.5, "lines_failed": 0.5}
#: Limits of the prior's strength, in documents.
WEAKEST, STRONGEST = 1.0, 1000.0


def repeated(words: list[str]) -> int:
    """Words in windows of three words that occur twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    _, pairs = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)
    _, inverse, counts = np.unique(pairs[:-1] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
    hit = np.zeros(len(words), bool)
    twice = counts[inverse] > 1
    for k in range(3):
        hit[k : len(twice) + k] |= twice
    return int(hit.sum())


def measure_text(text: str) -> tuple[int, ...]:
    """MEASURES of one text."""
    words = WORD.findall(text)
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated(words), lines


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` of `docs` with MEASURES of `text`, one row per row."""
    own = [f"_kept{i}" for i in range(len(keep))]
    given = docs.select(*(docs[c].alias(o) for c, o in zip(keep, own, strict=True)), docs[text].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = [measure_text(x or "") for x in part.column("_text").to_pylist()]
                counts = zip(*rows, strict=True) if rows else [[]] * len(MEASURES)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c, pa.int64()) for c in counts)], [*own, *MEASURES])

    schema = T.StructType([*given.schema.fields[:-1], *(T.StructField(m, T.LongType()) for m in MEASURES)])
    out = given.mapInArrow(run, schema)
    return out.select(*(F.col(o).alias(f"in_{c}") for c, o in zip(keep, own, strict=True)), *MEASURES)


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """host, n_docs, and per rule the failures and the shrunk rate. One row per host that is not null.

    The prior of a rule is the beta distribution with the mean of all documents and the spread between hosts beyond
    what chance gives (method of moments).
    """
    hosts = judged.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("n_docs"), *(F.sum(F.col(r).cast("long")).alias(f"n_{r}") for r in RULES)
    )
    hosts = written(hosts, "hosts")
    total = hosts.agg(F.sum("n_docs").alias("n"), F.count("*").alias("h"), *(F.sum(f"n_{r}").alias(r) for r in RULES)).first()
    n, h = total["n"] or 1, total["h"]
    means = {r: (total[r] or 0) / n for r in RULES}
    rate = lambda r: F.col(f"n_{r}") / F.col("n_docs")
    spread = hosts.agg(*(F.sum(F.col("n_docs") * F.pow(rate(r) - F.lit(means[r]), 2)).alias(r) for r in RULES)).first()
    shrunk = []
    for r in RULES:
        chance = means[r] * (1 - means[r])
        between = (spread[r] or 0.0) / n - chance * max(h - 1, 0) / n
        strength = STRONGEST if between <= 0 else min(STRONGEST, max(WEAKEST, chance / between - 1))
        shrunk.append(((F.col(f"n_{r}") + means[r] * strength) / (F.col("n_docs") + strength)).alias(f"rate_{r}"))
    return hosts.select(host, "n_docs", *(f"n_{r}" for r in RULES), *shrunk)


def judge(rows: DataFrame, host: str) -> DataFrame:
    """`rows` (measured) with the rules, the rates of their host, `host_rejected` and `kept`."""
    judged = rows.withColumns({r: F.expr(f"({e})") for r, e in RULES.items()})
    rates = host_rates(judged, host).select(F.col(host).alias("_host"), *(f"rate_{r}" for r in RULES))
    joined = judged.join(rates, F.col(host) == F.col("_host"), "left").drop("_host")
    bad = F.lit(False)
    for r, limit in HOST_LIMITS.items():
        bad |= F.coalesce(F.col(f"rate_{r}") > limit, F.lit(False))
    own = ~F.col("base_failed") & ~F.col("symbols_failed") & ~F.col("lines_failed")
    return joined.withColumn("host_rejected", bad).withColumn("kept", own & ~F.col("host_rejected"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(measured(table(spark, sf_dir, "documents"), ["doc_id", "source"]), "measures")
    return judge(rows, "in_source").select(
        F.col("in_doc_id").alias("doc_id"), *MEASURES, "base_failed", "kept", "symbols_failed", "lines_failed", "host_rejected",
        *(f"rate_{r}" for r in RULES),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. The texts are measured twice, once for the hosts and once to filter, rather than written."""
    ready(spark)
    rows = measured(docs, docs.columns)
    return judge(rows, "in_source").where("kept").select(*(F.col(f"in_{c}").alias(c) for c in docs.columns))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         row_number() OVER () AS r
  FROM documents),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
m AS (
  SELECT doc_id, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_word_lines, coalesce(hit.n, 0) AS n_repeat_words
  FROM words LEFT JOIN hit USING (r)),
j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 10 * n_symbols > word_chars AS symbols_failed,
         2 * n_dup_lines > n_word_lines AS lines_failed FROM m),
h AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS b, sum(symbols_failed::INT) AS s, sum(lines_failed::INT) AS l
  FROM j WHERE source IS NOT NULL GROUP BY source),
t AS (SELECT sum(n) AS n, count(*) AS h, sum(b) / sum(n) AS b, sum(s) / sum(n) AS s, sum(l) / sum(n) AS l FROM h),
d AS (
  SELECT sum(h.n * (h.b / h.n - t.b) ** 2) AS db, sum(h.n * (h.s / h.n - t.s) ** 2) AS ds, sum(h.n * (h.l / h.n - t.l) ** 2) AS dl FROM h, t),
v AS (
  SELECT b, s, l, db / n - b * (1 - b) * (h - 1) / n AS vb, ds / n - s * (1 - s) * (h - 1) / n AS vs,
    dl / n - l * (1 - l) * (h - 1) / n AS vl FROM t, d),
k AS (
  SELECT b, s, l, CASE WHEN vb <= 0 THEN 1000 ELSE least(1000, greatest(1, b * (1 - b) / vb - 1)) END AS kb,
    CASE WHEN vs <= 0 THEN 1000 ELSE least(1000, greatest(1, s * (1 - s) / vs - 1)) END AS ks,
    CASE WHEN vl <= 0 THEN 1000 ELSE least(1000, greatest(1, l * (1 - l) / vl - 1)) END AS kl FROM v),
rates AS (
  SELECT h.source, (h.b + k.b * kb) / (n + kb) AS rb, (h.s + k.s * ks) / (n + ks) AS rs, (h.l + k.l * kl) / (n + kl) AS rl FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_word_lines, base_failed, symbols_failed, lines_failed,
  coalesce(rb > 0.5 OR rs > 0.5 OR rl > 0.5, false) AS host_rejected,
  NOT (base_failed OR symbols_failed OR lines_failed OR coalesce(rb > 0.5 OR rs > 0.5 OR rl > 0.5, false)) AS kept,
  rb AS rate_base_failed, rs AS rate_symbols_failed, rl AS rate_lines_failed
FROM j LEFT JOIN rates USING (source)
"""
