"""Word and window hashes over many documents at once, in numpy.

Words are runs of bytes other than space, tab, newline, vertical tab, form feed and carriage return,
which is what bytes.split() yields. All hashes are of whole words, with no seed from the process, so
every worker and every retry gets the same values.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

from quarrymill.llm.common import in_use

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


class WordHashes(dict):
    """word -> 64-bit hash; emptied when full, which costs time only."""

    LIMIT = 200_000

    def __init__(self, seed: int = 0):
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def word_hashes(texts: list[bytes], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, in order, and the offsets of each text's words."""
    in_use(id(cache), cache.clear)
    words = [t.split() for t in texts]
    ends = np.cumsum([0, *map(len, words)])
    flat = np.fromiter(map(cache.__getitem__, chain.from_iterable(words)), np.uint64, int(ends[-1]))
    return flat, ends


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words; entry i is of words i to i + k - 1, whatever texts they are in."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = h[:n] * _ODD
    for j in range(1, k):
        acc += h[j : j + n]
        acc *= _ODD
    return mix(acc)


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, in log2(w) passes."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if w > span else x


def doc_of(ends: np.ndarray) -> np.ndarray:
    """The text that each word is in."""
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends))


def span_hashes(h: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the word sequences [start, stop), equal for equal sequences wherever they stand.

    A polynomial in an odd base modulo 2**64: prefix sums give any span, and the inverse base shifts it
    to position 0.
    """
    n = len(h)
    base = _ODD
    inverse = U(pow(int(base), -1, 1 << 64))
    power = np.empty(n + 1, np.uint64)
    back = np.empty(n + 1, np.uint64)
    power[0] = back[0] = 1
    power[1:] = base
    back[1:] = inverse
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(back, out=back)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(h) * power[:n], out=prefix[1:])
    return mix((prefix[stops] - prefix[starts]) * back[starts] + (stops - starts).astype(np.uint64))
