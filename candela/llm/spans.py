"""Words of many texts as numpy arrays, and hashes of words and of word sequences."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
CHUNK = 1 << 19
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (a multiply-xorshift finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n."""
    got = _POWERS.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, CHUNK + 4096)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        got = tuple(both)
        if size <= 4 * CHUNK:
            _POWERS[base] = got
    return got


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """64-bit hash of every buf[start:end]: a polynomial over the bytes, from differences of prefix sums."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        power, inverse = _powers(base, hi - lo + 1)
        total = np.zeros(hi - lo + 1, U)
        np.cumsum((buf[lo:hi].astype(U) + U(1)) * power[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * inverse[s])
        i = j
    return out


def sequence_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U)
    h = np.zeros(n, U)
    for j in range(k):
        h = h * U(0xD1342543DE82EF95) + words[j : j + n]
    return mix(h)


class Spans:
    """Words of the texts of one block. Attributes: buf (bytes of all texts), starts and ends of words in it,
    first (index of each text's first word, one more at the end)."""

    def __init__(self, texts: list[bytes], separators: np.ndarray = WHITE):
        joined = b"\n".join(texts) + b"\n"
        self.raw = joined
        self.buf = np.frombuffer(joined, np.uint8)
        gap = separators[self.buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(gap) and not gap[0]:
            edge = np.concatenate(([0], edge))
        self.starts, self.ends = edge[0::2], edge[1::2]
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        return word_hashes(self.buf, self.starts, self.ends, BASES[which])

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n positions lie in any [start, end)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0
