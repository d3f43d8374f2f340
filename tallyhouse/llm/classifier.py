"""Quality classifier: gradient-boosted trees on histograms of document statistics.

The trees are fitted with numpy on a bounded sample of labelled rows (SAMPLE_ROWS, the ids with the smallest hash, so the
sample does not depend on partitions), flattened into arrays and walked level by level for whole batches of documents.

Defined results: null and empty texts have all statistics 0 and get a score like any other. Rows with a null id are
scored, not held out. Repeated rows are scored one by one. Without labelled rows every score is 0.5. Ids with several
label rows count once per row. Only the text is an input of a score. Rows of one doc_id with several texts each teach with that
id's labels. An empty table of documents gives no rows. Other columns go along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import ready, table
from tallyhouse.llm.quality_rules import WORD, measure_text

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, RATE, BINS, LEAST, RIDGE = 60, 4, 0.15, 64, 10, 1.0

STATISTICS = (
    "words", "word_length", "symbols", "dup_lines", "repeats", "lines", "upper", "digits", "bars", "bangs", "stops", "commas",
    "wide", "distinct", "longest", "line_words", "stopped_lines", "other_marks",
)


def statistics(text: str) -> tuple[float, ...]:
    """STATISTICS of one text: shares and means, so that long and short texts compare."""
    n_words, chars, symbols, dup, repeats, lines = measure_text(text)
    data = text.encode("utf-8", "surrogatepass")
    byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = WORD.findall(text)
    upper, lower = int(byte[65:91].sum()), int(byte[97:123].sum())
    w, c, size = max(n_words, 1), max(chars, 1), max(len(data), 1)
    marks = int(byte[33:48].sum() + byte[58:65].sum() + byte[91:97].sum() + byte[123:127].sum())
    stopped = sum(line.rstrip().endswith((".", "!", "?")) for line in text.split("\n"))
    return (
        n_words, chars / w, symbols / c, dup / max(lines, 1), repeats / w, lines, upper / max(upper + lower, 1), byte[48:58].sum() / c,
        byte[124] / w, byte[33] / w, byte[46] / w, byte[44] / w, byte[128:].sum() / size, len(set(words)) / w,
        max(map(len, words), default=0), n_words / max(lines, 1), stopped / max(lines, 1), marks / c,
    )


class Trees:
    """Boosted trees as arrays: node i of tree t splits on feature[t, i] at threshold[t, i]; its children are 2i+1 and 2i+2."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for labels `y` (0, 1) of rows `x`, by second-order logistic boosting on quantile bins."""
    inner, nodes = 2**DEPTH - 1, 2 ** (DEPTH + 1) - 1
    if not len(x):
        return Trees(0.0, np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)], 1)
    n_features = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = y - p, p * (1 - p)
        feature, threshold, value = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
        node = np.zeros(len(y), np.int64)
        for at in range(inner):
            mine = np.flatnonzero(node == at)
            if len(mine) >= 2 * LEAST:
                keys = binned[mine] + np.arange(n_features) * BINS
                sums = lambda v: np.bincount(keys.ravel(), np.repeat(v[mine], n_features), n_features * BINS).reshape(n_features, BINS)  # noqa: B023, E731
                g, h, c = (np.cumsum(sums(v), 1) for v in (slope, curve, np.ones(len(y))))
                worth = lambda a, b: a * a / (b + RIDGE)
                gain = worth(g, h) + worth(g[:, -1:] - g, h[:, -1:] - h) - worth(g[:, -1:], h[:, -1:])
                gain[(c < LEAST) | (c[:, -1:] - c < LEAST)] = 0
                best = int(gain.argmax())
                f, b = divmod(best, BINS)
                if gain.ravel()[best] > 1e-9:
                    feature[at], threshold[at] = f, edges[f][b]
            right = x[mine, feature[at]] > threshold[at]
            node[mine] = 2 * at + 1 + right
        for leaf in range(inner, nodes):
            mine = node == leaf
            value[leaf] = RATE * slope[mine].sum() / (curve[mine].sum() + RIDGE)
        margin += value[node]
        features.append(feature), thresholds.append(threshold), values.append(value)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def with_columns(docs: DataFrame, text: str, fields: list[T.StructField], make) -> DataFrame:
    """All columns of `docs`, named in_*, and `fields` that `make` computes from the statistics of a batch of texts."""
    own = [f"in_{c}" for c in docs.columns]
    given = docs.toDF(*own).withColumn("_text", F.col(f"in_{text}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                x = np.array([statistics(t or "") for t in part.column("_text").to_pylist()], float).reshape(-1, len(STATISTICS))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *make(x)], [*own, *(f.name for f in fields)])

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], *fields]))


def train(docs: DataFrame, labels: DataFrame) -> Trees:
    """Fits on at most SAMPLE_ROWS rows of `labels` (doc_id, quality) that are not held out; their texts come from `docs`. Of
    the rows that repeat a doc_id at most SAMPLE_ROWS in all are taken, too, the first by a hash of the id."""
    usable = labels.select("doc_id", "quality").where(~_held_out() & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE_ROWS)
    # At most SAMPLE_ROWS rows of two numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    names = [T.StructField(s, T.DoubleType()) for s in STATISTICS]
    rows = with_columns(texts, "text", names, lambda x: [pa.array(c) for c in x.T]).select("in_doc_id", "in_quality", *STATISTICS)
    rows = rows.orderBy(F.xxhash64("in_doc_id"), "in_doc_id", "in_quality", *STATISTICS).limit(SAMPLE_ROWS).toPandas()
    rows = rows.sort_values([*STATISTICS, "in_quality"])
    return fit(rows[list(STATISTICS)].to_numpy(float), rows["in_quality"].to_numpy(float))


def scored(docs: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """All columns of `docs`, named in_*, and `score`."""
    return with_columns(docs, text, [T.StructField("score", T.DoubleType())], lambda x: [pa.array(model.score(x))])


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    rows = scored(docs, model).withColumnRenamed("in_doc_id", "doc_id")
    return rows.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score THRESHOLD or more."""
    ready(spark)
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).where(F.col("score") >= THRESHOLD).select(*(F.col(f"in_{c}").alias(c) for c in docs.columns))
