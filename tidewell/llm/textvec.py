"""Vectorised text features used inside tasks: code points, word spans, word hashes, hashed character n-grams.

Everything here works on one text at a time with numpy and has no global state but small lookup tables, so a task
needs memory in proportion to the longest single text.
"""

from __future__ import annotations

import numpy as np

_BASE, _LIMIT = 0x9E3779B97F4A7C15, 0x33480  # no letters or digits are assigned above _LIMIT
_INVERSE = pow(_BASE, -1, 1 << 64)
_classes: np.ndarray | None = None
_salts: np.ndarray | None = None
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def char_classes() -> np.ndarray:
    """Class by code point: 1 letter, 2 decimal or other number, 0 anything else."""
    global _classes
    if _classes is None:
        table = np.zeros(_LIMIT + 1, np.uint8)
        for i in range(_LIMIT):
            c = chr(i)
            table[i] = 1 if c.isalpha() else 2 if c.isnumeric() else 0
        _classes = table
    return _classes


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def classes_of(cp: np.ndarray) -> np.ndarray:
    return char_classes()[np.minimum(cp, _LIMIT)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = np.array(x, np.uint64)
    t = np.empty_like(x)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        np.right_shift(x, np.uint64(shift), out=t)
        np.bitwise_xor(x, t, out=x)
        np.multiply(x, np.uint64(factor), out=x)
    np.right_shift(x, np.uint64(31), out=t)
    np.bitwise_xor(x, t, out=x)
    return x


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers[0].size < n + 1:
        size = max(n + 1, 1 << 14)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers


def word_spans(cp: np.ndarray, digits: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of maximal runs of letters, or of letters and digits."""
    inside = classes_of(cp) > 0 if digits else classes_of(cp) == 1
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def salts_of(cp: np.ndarray) -> np.ndarray:
    """A fixed random 64-bit number for each code point."""
    global _salts
    if _salts is None:
        _salts = mix64(np.arange(1, _LIMIT + 2, dtype=np.uint64))
    return _salts[np.minimum(cp, _LIMIT)]


class SpanHasher:
    """Hashes of many spans of one text: a polynomial prefix sum, so each span costs a few operations."""

    def __init__(self, cp: np.ndarray):
        up, self.down = _pow(cp.size)
        self.prefix = np.zeros(cp.size + 1, np.uint64)
        np.cumsum(salts_of(cp) * up[: cp.size], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[ends] - self.prefix[starts]) * self.down[starts])


def word_hashes(text: str | None, digits: bool = True) -> np.ndarray:
    """64-bit hashes of the lower-cased words of a text, in order. Null and empty texts have none."""
    if not text:
        return np.zeros(0, np.uint64)
    cp = codepoints(text.lower())
    return SpanHasher(cp)(*word_spans(cp, digits))


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of k consecutive words. A text of 1 to k-1 words has one shingle, made of all its words."""
    n = words.size
    if n == 0:
        return words
    width, count = min(k, n), max(1, n - k + 1)
    out = np.full(count, n if n < k else 0, np.uint64)
    for j in range(width):
        out = out * np.uint64(_BASE) + words[j : j + count]
    return mix64(out)


def hashed_ngrams(text: str | None, bits: int, orders: tuple[int, ...] = (1, 2, 3), fold: bool = True) -> np.ndarray:
    """Counts of hashed character n-grams (float32, 2**bits). With fold, case goes and all but letters is blank."""
    out = np.zeros(1 << bits, np.float32)
    if not text:
        return out
    cp = codepoints(text.lower() if fold else text)
    cl = classes_of(cp)
    cp = np.where(cl == 1, cp, 32) if fold else np.where(cl == 2, 48, cp)
    cp = np.concatenate(([32], cp, [32])).astype(np.uint64)
    shift = np.uint64(64 - bits)
    for n in orders:
        if cp.size >= n:
            h = np.full(cp.size - n + 1, n, np.uint64)
            for j in range(n):
                h = (h + cp[j : cp.size - n + 1 + j]) * np.uint64(_BASE)
            h ^= h >> np.uint64(29)
            out += np.bincount(((h * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int64), minlength=1 << bits)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Square roots of counts, scaled to length 1; zeros stay."""
    x = np.sqrt(x)
    n = np.sqrt((x * x).sum())
    return x / n if n > 0 else x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 300, rate: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression with soft targets by full-batch Adam. y: (n,) or (n, k). Returns weights and bias."""
    y = np.atleast_2d(y.T).T.astype(np.float32)
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for t in range(1, steps + 1):
        e = (sigmoid(x @ w + b) - y) / np.float32(len(x))
        g, gb = x.T @ e + np.float32(l2) * w, e.sum(0)
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        lr, c1, c2 = rate * (1 - t / (steps + 1)), 1 - 0.9**t, 1 - 0.999**t
        w -= (lr * (m / c1) / (np.sqrt(v / c2) + 1e-8)).astype(np.float32)
        b -= (lr * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)).astype(np.float32)
    return w, b
