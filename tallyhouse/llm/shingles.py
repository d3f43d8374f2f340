"""Sets of word shingles as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at a time.
PIECE = 1 << 22
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit mixing of each number (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(30)  # the sum is a new array
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(256))
_known: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers; the longest array of a base is kept (PIECE numbers, but for words longer than that)."""
    if len(_known.get(base, ())) < n:
        out = np.full(max(n, 1 << 14), base, np.uint64)
        out[0] = 1
        _known[base] = np.multiply.accumulate(out)
    return _known[base][:n]


def word_hashes(data: bytes) -> np.ndarray:
    """One hash per word `[^\\x20\\x09-\\x0D]+`."""
    parts, at = [], 0
    whole = np.frombuffer(data, np.uint8)
    while at < len(whole):
        end = min(len(whole), at + PIECE)
        if end < len(whole):  # cut after white space
            cut = np.flatnonzero(_SPACE[whole[at:end]])
            while not len(cut) and end < len(whole):
                end = min(len(whole), end + PIECE)
                cut = np.flatnonzero(_SPACE[whole[at:end]])
            end = at + int(cut[-1]) + 1 if len(cut) and end < len(whole) else end
        piece = whole[at:end]
        word = np.concatenate(([False], ~_SPACE[piece], [False]))
        edge = np.flatnonzero(word[1:] != word[:-1])
        start, stop = edge[::2], edge[1::2]
        if len(start):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[piece] * _powers(_BASE, len(piece)), dtype=np.uint64)))
            parts.append(mix((total[stop] - total[start]) * _powers(_BASE_INVERSE, len(piece))[start] + (stop - start).astype(np.uint64)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; a text of fewer words is one shingle, one without words none."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if len(words) < size:
        return mix(np.array([sum(int(w) * (2 * k + 3) for k, w in enumerate(words)) % (1 << 64)], np.uint64), 7) if len(words) else words
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * np.uint64(2 * k + 3)
        total ^= total >> np.uint64(29)
    total = np.sort(mix(total, 3))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def digest(values: np.ndarray) -> bytes:
    """128 bits that are the same for equal sets."""
    mixed = mix(values, 11)
    parts = int(mixed.sum(dtype=np.uint64)), int((mixed * (values | np.uint64(1))).sum(dtype=np.uint64))
    return b"".join(p.to_bytes(8, "little") for p in parts)
