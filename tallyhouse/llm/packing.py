"""Sum-of-squares online packing of token ids into windows.

Each task packs the rows it reads, in order, with an array of counts of its partly filled windows by fill level. A piece
goes to the level that leaves the sum of the squared counts smallest, a new window being level 0. A full window is given
out at once. What is left in open windows at the end of a task is laid in order and cut anew: into full windows, then into
windows whose length is a power of two, so no sequence needs padding.

Memory is that of the open windows: with this rule their number stays far below the number of rows. No shuffle; the
sequences of task p are numbered from p * 2**32, so a task that runs again on the same rows gives the same numbers.

Defined results: null and empty texts are the end id alone; repeated rows and null ids are packed one by one. An empty table
gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.llm.common import ready, table, worker_cache

WINDOW = 2048
END_ID = 1
#: Words and parts whose ids a worker remembers; beyond it starts again with none.
WORDS_KEPT = 700_000
#: White space for Python's split, but not for the tokenizer.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Parts that are encoded as one text.
PARTS_AT_ONCE = 1000
#: In words that can hold a control string, or compose with what is beside them.
_ODD = re.compile("<\\||[^\x00-\u02ff]")
#: What the vocabulary puts behind the last token of a part, a fixed value.
_SUFFIX = "</w>"

PIECES = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit numbers. The tokenizer never joins across white space nor across the
    parts of its own pattern, so the ids of a text are those of the parts of its words. Words and parts are remembered in one
    table; each new part goes through the merges once."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        # The same merges for parts, which are lower-case and cut already: only spaces between them are left to split at.
        self.tokenizer = Tokenizer(self.whole.model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # The pattern of the vocabulary file, a fixed value.
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        # The same for lower-case ASCII.
        self.ascii_parts = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        # Whether an id ends a part: the last token of each has the vocabulary's suffix, and no other.
        self.ends = np.zeros(1 + max(self.whole.get_vocab().values()), bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_SUFFIX)]] = True
        # Of words and of parts alike: a part, taken as a word, is its own only part.
        self.words: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """As `_encode`, for parts of the pattern: encoded as one text, which is cut where an id ends a part."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) != len(parts) or stops[-1] != 4 * len(ids):
            return self._encode(parts)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def learn(self, words: list[str]) -> None:
        """Puts `words` and their parts into the table. Below U+0300 nothing composes, so lower case can come before the parts."""
        odd = [w for w in words if _ODD.search(w)] if _ODD.search(" ".join(words)) else []
        if odd:
            self.words.update(zip(odd, self._encode(odd), strict=True))
            odd = set(odd)
            words = [w for w in words if w not in odd]
        parts, cased, several = set(), [], []
        of_ascii, of_any = self.ascii_parts.findall, self.parts.findall
        for word, low in zip(words, " ".join(words).lower().split(" ") if words else [], strict=True):
            if low.isalpha():
                parts.add(low)
                if low != word:
                    cased.append((word, low))
            else:
                found = of_ascii(low) if low.isascii() else of_any(low)
                parts.update(found)
                several.append((word, found))
        new = list(filterfalse(self.words.__contains__, parts))
        if _ODD.search(" ".join(new)):  # lower case can be a letter and a mark
            alone = [p for p in new if _ODD.search(p)]
            self.words.update(zip(alone, self._encode(alone), strict=True))
            new = [p for p in new if p not in self.words]
        for at in range(0, len(new), PARTS_AT_ONCE):
            some = new[at : at + PARTS_AT_ONCE]
            self.words.update(zip(some, self._encode_parts(some), strict=True))
        ids = self.words.__getitem__
        self.words.update([(word, ids(low)) for word, low in cased])
        self.words.update([(word, b"".join(map(ids, found))) for word, found in several])

    def __call__(self, text: str) -> bytes:
        if _SEPARATORS.search(text):
            return self._encode([text])[0]
        words = text.split()
        missing = set(filterfalse(self.words.__contains__, words))
        if missing:
            if len(self.words) + len(missing) > WORDS_KEPT:
                self.words.clear()
                missing = set(words)
            self.learn(list(missing))
        return b"".join(map(self.words.__getitem__, words))


class Packer:
    """Windows of one task. `out` gets rows of PIECES."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.window, self.next, self.out = window, first_sequence, []
        self.counts = np.zeros(window, np.int64)  # open windows by fill level
        self.open: list[list[list[tuple]]] = [[] for _ in range(window)]

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.out.append((doc, start, n, zlib.crc32(ids), total, self.next, offset))
            offset += n
        self.next += 1

    def level_for(self, size: int) -> int:
        """Level of the window that takes `size` ids: moving a window from level l to l + size changes the sum of squares by
        2 (counts[l + size] - counts[l]) + 2, and less at the ends, as empty and full windows do not count. Ties: the fullest."""
        last = self.window - size
        after = np.append(2 * self.counts[size:] + 1, 0)  # levels size .. window; a full one is not counted
        change = after - np.append(0, 2 * self.counts[1 : last + 1] - 1)
        change[1:][self.counts[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(change[::-1].argmin())

    def add(self, doc: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        start = 0
        while total - start >= self.window:
            self._close([(doc, start, ids[4 * start : 4 * (start + self.window)], total)])
            start += self.window
        if start < total:
            size = total - start
            level = self.level_for(size)
            pieces = self.open[level].pop() if level else []
            self.counts[level] -= bool(level)
            pieces.append((doc, start, ids[4 * start :], total))
            if level + size == self.window:
                self._close(pieces)
            else:
                self.open[level + size].append(pieces)
                self.counts[level + size] += 1

    def finish(self) -> None:
        """Cuts what lies in open windows into full ones and powers of two."""
        rest = [p for level in reversed(self.open) for pieces in level for p in pieces]
        left = sum(len(p[2]) // 4 for p in rest)
        room, pieces = 0, []
        for doc, start, ids, total in rest:
            while ids:
                if not room:
                    room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                n = min(room, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * n], total))
                start, ids, room, left = start + n, ids[4 * n :], room - n, left - n
                if not room:
                    self._close(pieces)
                    pieces = []
        self.open = [[] for _ in range(self.window)]
        self.counts[:] = 0

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        columns = zip(*rows, strict=True) if rows else [[]] * len(PIECES)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], PIECES.names)


def packed(docs: DataFrame, path: str, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """PIECES of `docs` (doc_id, text): the ids of each text and `end_id`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("word_encoders")
        if path not in cache:
            cache[path] = WordEncoder(path)
        encode, end = cache[path], np.array([end_id], "<u4").tobytes()
        packer = Packer(TaskContext.get().partitionId() << 32, window)
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packer.add(doc, encode(text or "") + end)
            yield packer.batch()
        packer.finish()
        yield packer.batch()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_path())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packed(docs, tokenizer_path())
