"""BPE encoding by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one last token that its encoding can have. It is found from the tokens
that end there (matches of an automaton over the vocabulary) and a compatibility test with the last token of the
prefix before: two tokens stand side by side in an encoding just when no merge across their border comes before those
that form them. The last tokens are stored, and the ids read off by going back from the end.

The pieces are those of the vocabulary's own pattern. Workers remember the ids of the pieces they have met, in a memory of
bounded size. Nothing is shuffled.

Defined results: a null or empty text has no ids. Special tokens in a text are one id each. Rows are encoded one by one. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm.common import table, worker_cache

#: Pieces and words that a worker remembers; beyond it starts again with none.
PIECES_KEPT = 500_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Bpe:
    """A byte-level BPE vocabulary from a tokenizers file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = byte_characters()
        plain = lambda token: bytes(byte[c] for c in token)
        self.ids = {plain(t): i for t, i in spec["model"]["vocab"].items()}
        self.token = {i: b for b, i in self.ids.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        #: When a token forms (single bytes before all merges), and the two it forms from.
        self.order = dict.fromkeys(self.token, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        for k, (a, b) in enumerate(spec["model"]["merges"]):
            x, y = plain(a), plain(b)
            new = self.ids[x + y]
            self.rank[self.ids[x], self.ids[y]] = (k, new)
            if new not in self.parts:
                self.order[new], self.parts[new] = k, (self.ids[x], self.ids[y])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t.encode() for t, i in self.special.items()}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.odd_space = re.compile(r" (?:\s|\Z)")
        # Letters and what follows them, as far as the pattern below takes each as a piece: no apostrophe.
        self.simple_word = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:-@\[-`{-~]*)")
        # The pattern of byte-level vocabularies, a fixed value.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        # Only tokens that their own bytes encode to can stand in an encoding.
        self.own: dict[int, bool] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for b, i in self.ids.items():
            self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def merged(self, data: bytes) -> list[int]:
        """The merges of some bytes from scratch."""
        ids = [self.ids[data[k : k + 1]] for k in range(len(data))]
        while len(ids) > 1:
            low, at, new = min(((*self.rank[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.rank), default=(0, None, 0), key=lambda x: (x[0], x[2]))
            if at is None:
                break
            pair, out, k = (ids[new], ids[new + 1]), [], 0
            while k < len(ids):  # all places of a merge at once, from the left
                if k + 1 < len(ids) and (ids[k], ids[k + 1]) == pair:
                    out.append(at)
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def compatible(self, a: int, b: int) -> bool:
        """Whether the two stay apart: the token that forms later is taken apart, again and again, and no merge across
        the border may come before it. Of equal merges the left one comes first."""
        known = self.fits.get((a, b))
        if known is not None:
            return known
        if len(self.fits) > 4 * PIECES_KEPT:
            self.fits.clear()
        key, limit, order, known = (a, b), len(self.rank), self.order, None
        while known is None:
            across = self.rank.get((a, b))
            if across is not None and across[0] < limit:
                known = False
            elif order[a] > order[b]:
                limit = order[a]
                a = self.parts[a][1]
            elif order[b] >= 0:
                limit = order[b] + 1
                b = self.parts[b][0]
            else:
                known = True
        self.fits[key] = known
        return known

    def alone(self, a: int) -> bool:
        known = self.own.get(a)
        if known is None:
            known = self.own[a] = self.merged(self.token[a]) == [a]
        return known

    def last_tokens(self, data: bytes) -> list[int]:
        """Per prefix (1 byte and up) the last token of its encoding."""
        own, fits = self.own, self.fits
        last, done = [], 0
        for end, (size, token) in self.automaton.iter(data.decode("latin-1")):
            if end < done:  # found already: there is only one
                continue
            if end > done:
                break
            if end < size:
                good = own.get(token)
                if good is None:
                    good = self.alone(token)
            else:
                before = last[end - size]
                good = fits.get((before, token))
                if good is None:
                    good = self.compatible(before, token)
            if good:
                last.append(token)
                done += 1
        if done < len(data):
            raise ValueError("the vocabulary does not hold every byte")
        return last

    def encode_piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        token = self.ids.get(data)
        if token is not None and self.alone(token):
            ids = [token]
        else:
            last, end, ids = self.last_tokens(data), len(data), []
            while end:
                token = last[end - 1]
                ids.append(token)
                end -= len(self.token[token])
            ids.reverse()
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_plain(self, text: str) -> bytes:
        return self._encode_pieces(self.pattern.findall(text))

    def _encode_pieces(self, pieces: list[str]) -> bytes:
        try:
            return b"".join([self.pieces[p] for p in pieces])
        except KeyError:
            missing = {p for p in pieces if p not in self.pieces}
            if len(self.pieces) + len(missing) > PIECES_KEPT:
                self.pieces.clear()
                missing = set(pieces)
            for p in missing:
                self.pieces[p] = self.encode_piece(p)
            return b"".join([self.pieces[p] for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self.encode_words(text)
        return b"".join(
            np.array([self.special[t]], "<u4").tobytes() if t in self.special else self.encode_words(t)
            for t in self.special_pattern.split(text) if t
        )

    def encode_words(self, text: str) -> bytes:
        """A piece always begins at a space before something else than white space, so what lies between such spaces is looked
        up whole."""
        if self.odd_space.search(text):
            return self._encode_plain(text)
        words = text.split(" ")
        first = self._encode_plain(words[0]) if words[0] else b""
        del words[0]
        found = list(map(self.words.get, words))
        if None in found:
            missing = {w for w, ids in zip(words, found) if ids is None}
            if len(self.words) + len(missing) > PIECES_KEPT:
                self.words.clear()
            new = {w: self._encode_word(w) for w in missing}
            self.words.update(new)
            found = [new[w] if ids is None else ids for w, ids in zip(words, found)]
        return first + b"".join(found)

    def _encode_word(self, word: str) -> bytes:
        """The ids of a space and a word."""
        simple = self.simple_word.fullmatch(word)
        if simple is None:
            return self._encode_plain(" " + word)
        letters, signs = simple.groups()
        return self._encode_pieces([" " + letters, signs] if signs else [" " + letters])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.token.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit numbers) and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                back = [bpe.decode(np.frombuffer(i, "<u4")) for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(back, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", text).mapInArrow(run, "doc_id long, ids binary, decoded string")


def _loaded(path: str) -> Bpe:
    cache = worker_cache("bpe")
    if path not in cache:
        cache[path] = Bpe(path)
    return cache[path]


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text, made where the ids are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path)
        fields = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for batch in batches:
            n, one, two = [], [], []
            for k in range(batch.num_rows):
                ids = bpe.encode(batch.column(1)[k].as_py() or "")
                n.append(len(ids) // 4)
                one.append(hashlib.sha256(ids).hexdigest())
                two.append(hashlib.sha256(bpe.decode(np.frombuffer(ids, "<u4")).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())], fields)

    return docs.select("doc_id", text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), tokenizer_path())
