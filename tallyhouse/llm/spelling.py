"""Spelling variants by blocked Gram matrices.

The words of all texts are counted, first in the task that reads them. Each word then has a vector of letter counts (LETTERS
buckets of code points): words one edit apart lie at a squared distance of at most two. Words of one length and the same counts
of CLASSES classes of code points form a block, split where it is large. One edit takes a word to its own block, or to one
where one class has one more or one fewer (adjacent lengths), or where one class has one more and another one fewer, so
only such blocks meet, each pair of them in one cell of bounded size. There a NumPy product of the two count matrices gives all squared
distances; pairs at two or less are verified letter by letter. A cell gives each word's number of near words and the best of them,
which Spark adds up.

Forms lead to words at least twice as frequent, so chains are short; roots are found by doubling the steps taken.

Defined results: null and empty texts have no words; a null id is an empty text before the colon; repeated rows count again. Ties
go to the smaller word in code-point order. Words that a deletion leaves equal are one word. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import dropped, table, written

#: Of the deletions only those that leave LETTERS_LEAST letters matter, so shorter runs are not looked at.
LETTERS_LEAST, SEEN_LEAST = 5, 3
#: Runs in Latin-1, in which all their letters lie; other characters become "?".
RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LETTERS_LEAST)
INSIDE = re.compile("[A-Za-zÀ-ÿ]*")
#: One in DAMAGE runs loses a letter.
DAMAGE = 97
#: A form is so many times as frequent, at least.
TIMES = 2
LETTERS, CLASSES = 32, 5
#: Words and letters of a part of a block.
BLOCK, BLOCK_LETTERS = 1024, 1 << 19
#: Characters of a text looked at together, distinct words counted in a task before they are given out.
PIECE, HELD = 1 << 20, 1 << 17


def pieces(text: str) -> Iterator[str]:
    """The whole text in pieces that cut no run of letters."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        end = INSIDE.match(text, end).end()
        yield text[at:end]
        at = end


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """Lower-cased runs of letters of a text in Latin-1, one in DAMAGE with a letter deleted, and how often each occurs."""
    runs, damaged = Counter(), []
    for piece in pieces(text or ""):
        runs.update(RUN.findall(piece.encode("latin-1", "replace").lower()))  # bytes: only A-Z are lower-cased
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run in runs:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DAMAGE == 0:
            damaged.append((run, h % len(run)))
    # A run may be what is left of another one, so all are taken out before any is put back.
    for run, k, n in [(run, k, runs.pop(run)) for run, k in damaged]:
        if len(run) > LETTERS_LEAST:
            runs[run[:k] + run[k + 1 :]] += n
    return runs


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of `docs` (doc_id, text) with at least LETTERS_LEAST letters, seen at least SEEN_LEAST times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()

        def given():
            words = [w.decode("latin-1") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                for word, n in words_of(doc_id.as_py(), text.as_py()).items():
                    held[word] += n
                if len(held) >= HELD:
                    yield given()
                    held.clear()
        yield given()

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN_LEAST)


def class_counts(word: str) -> tuple[int, ...]:
    found = np.bincount(np.frombuffer(word.encode("latin-1"), np.uint8) % CLASSES, minlength=CLASSES)
    return tuple(int(c) for c in found)


def neighbours(counts: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
    """The blocks that a block meets, itself first; of two blocks one names the other."""
    yield counts
    for a in range(CLASSES):
        more = list(counts)
        more[a] += 1
        yield tuple(more)
        for b in range(a):
            if more[b]:
                moved = more.copy()
                moved[b] -= 1
                yield tuple(moved)


def blocks(words: DataFrame) -> DataFrame:
    """(block, parts, part, m, letters, seen): the words (word, n) of each part of a block in code-point order, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [",".join(map(str, class_counts(w))) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *batch.columns], ["block", "word", "n"])

    keyed = words.select("word", "n").mapInArrow(run, "block string, word string, n long")
    most = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_LETTERS) / F.max(F.length("word")))))
    parts = keyed.groupBy("block").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    placed = keyed.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    gathered = placed.groupBy("block", "parts", "part").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("words"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = [row.values for row in batch.column(3)]
            letters = [pa.scalar("".join(v.field("word").to_pylist()).encode("latin-1"), pa.binary()) for v in listed]
            seen = [pa.scalar(v.field("n").to_numpy().tobytes(), pa.binary()) for v in listed]
            made = [pa.array([len(v) for v in listed], pa.int32()), pa.array(letters, pa.binary()), pa.array(seen, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], ["block", "parts", "part", "m", "letters", "seen"])

    return written(gathered.mapInArrow(pack, "block string, parts int, part int, m int, letters binary, seen binary"), "spelling-blocks")


def cells(parts: DataFrame) -> DataFrame:
    """(x, i, y, j): the parts i of block x and j of block y that meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n, y = [], [], []
            for block, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for other in neighbours(tuple(int(c) for c in block.split(","))):
                    x.append(block)
                    n.append(count)
                    y.append(",".join(map(str, other)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()), pa.array(n, pa.int32()), pa.array(y, pa.string())], ["x", "parts", "y"])

    index = parts.select("block", "parts").distinct()
    met = index.mapInArrow(run, "x string, parts int, y string").join(index.select(F.col("block").alias("y"), F.col("parts").alias("others")), "y")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    return met.withColumn("i", every("parts")).withColumn("j", every("others")).where("x <> y or i <= j").select("x", "i", "y", "j")


class _Words:
    """Words of one length in code-point order: letters, counts of letters, and how often each is seen."""

    def __init__(self, m: int, letters: bytes, seen: bytes):
        self.seen = np.frombuffer(seen, np.int64)
        self.letters = np.frombuffer(letters, np.uint8).reshape(m, -1)
        kind = np.float32 if self.letters.shape[1] < 1000 else np.float64  # squared distances stay exact
        bucket = np.arange(m)[:, None] * LETTERS + self.letters % LETTERS
        self.counts = np.bincount(bucket.ravel(), minlength=m * LETTERS).reshape(m, LETTERS).astype(kind)
        self.squares, self.ones = (self.counts**2).sum(1, keepdims=True), np.ones((m, 1), kind)

    def words(self, at: np.ndarray) -> list[str]:
        return [row.tobytes().decode("latin-1") for row in self.letters[at]]


def close(a: _Words, b: _Words, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at a squared distance of at most two: one product gives |a|^2 + |b|^2 - 2 ab."""
    distance = np.hstack((a.counts * -2, a.squares, a.ones)) @ np.hstack((b.counts, b.ones, b.squares)).T
    i, j = np.divmod(np.flatnonzero(distance <= 2), len(b.seen))
    return (i[i < j], j[i < j]) if same else (i, j)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether matching rows of letters (b as long as a, or longer by one) differ by one edit."""
    length = a.shape[1]
    if length == b.shape[1]:
        return (a != b).sum(1) == 1
    front = np.cumprod(a == b[:, :length], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
    return front + back >= length


def near_pairs(a: _Words, b: _Words, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words one edit apart; words of `b` are as long as those of `a` or longer by one."""
    i, j = close(a, b, same)
    step = max(1, (1 << 22) // b.letters.shape[1])
    good = [one_edit(a.letters[i[k : k + step]], b.letters[j[k : k + step]]) for k in range(0, len(i), step)]
    good = np.concatenate(good) if good else np.zeros(0, bool)
    return i[good], j[good]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): the number of near words of each word that has any, and the most frequent of them."""
    parts = blocks(words)
    met = written(cells(parts), "spelling-cells")
    # All that part i of block x meets comes to one task, after the part itself: y is empty there.
    own = parts.select(F.col("block").alias("x"), F.col("part").alias("i"), F.lit("").alias("y"), F.lit(-1).alias("j"), "m", "letters", "seen")
    others = parts.select(F.col("block").alias("y"), F.col("part").alias("j"), "m", "letters", "seen")
    rows = own.unionByName(met.where("x <> y or i <> j").join(others, ["y", "j"]).select(own.columns))
    least = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(4 * least, "x", "i").sortWithinPartitions("x", "i", "y", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"word": pa.string(), "n_near": pa.int64(), "best_n": pa.int64(), "best": pa.string()}

        def given(mine: _Words, others: _Words, p: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
            at = np.lexsort((q, -others.seen[q], p))
            first = np.flatnonzero(np.concatenate(([True], p[at][1:] != p[at][:-1]))) if len(at) else at
            number, best = np.diff(np.append(first, len(at))), q[at[first]]
            columns = mine.words(p[at[first]]), number, others.seen[best], others.words(best)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

        first = None
        for batch in batches:
            out = []
            for _, _, y, _, m, letters, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = _Words(m, letters, seen)
                first = first if y else mine
                i, j = near_pairs(first, mine, mine is first)
                if len(i):
                    out += [given(first, mine, i, j), given(mine, first, j, i)]
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    near = rows.mapInArrow(run, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    near = written(near.select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")), "spelling-near")
    dropped(parts, met)
    return near


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for `forms` (word, form): the last word that the forms lead to. Each round doubles the steps taken."""
    steps = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = written(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        moved = not longer.where("moved").isEmpty()
        dropped(steps)
        if not moved:
            return longer.drop("moved")
        steps = written(longer.drop("moved"), "spelling-roots")
        dropped(longer)


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `docs` (doc_id, text)."""
    words = written(counted(docs), "spelling-words")
    near = near_words(words)
    full = words.join(near, "word", "left")
    is_form = F.col("best_n") >= TIMES * F.col("n")
    full = full.select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")
    )
    full = written(full, "spelling-forms")
    last = roots(full.where("form is not null"))
    return full.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The check sum byte by byte, and near words by what is left of them without one letter.
ORACLE = """
WITH RECURSIVE crc AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS own,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
once AS (SELECT own, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (SELECT run, n, [4294967295::BIGINT] || flatten(list_transform(string_split(own || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b FROM once),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM bytes, crc),
damaged AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word AS x, b.word AS y, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
near AS MATERIALIZED (SELECT x, count(*) AS n_near, max(m) AS most FROM pairs GROUP BY x),
best AS (SELECT pairs.x, min(y) AS y FROM pairs JOIN near ON near.x = pairs.x WHERE m = most GROUP BY pairs.x),
forms AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN y END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
  FROM words LEFT JOIN near ON near.x = word LEFT JOIN best ON best.x = word),
path AS (SELECT word, word AS here, 0 AS k FROM forms UNION ALL SELECT path.word, forms.form, k + 1 FROM path JOIN forms ON forms.word = path.here WHERE form IS NOT NULL),
ends AS (SELECT word, arg_max(here, k) AS root FROM path GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
