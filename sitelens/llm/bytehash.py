"""Vectorised hashes of byte ranges: polynomial prefix sums modulo 2**64, then a mixer."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        p = np.full(size, base, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            have = _POWERS[key] = np.multiply.accumulate(p)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift-multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHash:
    """Hashes of any byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        with np.errstate(over="ignore"):
            self.prefix = np.zeros(n + 1, np.uint64)
            np.cumsum(_TABLE[buf] * _powers(_BASE, n), out=self.prefix[1:])
        self.inverse = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
            return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, words per text); A-Z lower-cased, words are runs of ``[^\\x20\\x09-\\x0D]``."""
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]        # bytes.lower() changes A-Z only
    buf = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)               # a blank before and after each text
    blank = _BLANK[buf]
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    begin = np.cumsum([1] + [len(x) + 1 for x in raw])                       # first byte of each text, and the end
    counts = np.diff(np.searchsorted(start, begin))
    return RangeHash(buf).of(start, end), counts


def _rolled(words: np.ndarray, k: int) -> np.ndarray:
    """48-bit hash of the k words from each word on."""
    n = max(0, len(words) - k + 1)
    with np.errstate(over="ignore"):
        h = words[:n].copy()
        for j in range(1, k):
            h = mix(h + np.uint64(0x632BE59BD9B4E019)) + words[j:j + n]
    return mix(h) >> np.uint64(16)


def _short(words: np.ndarray) -> np.ndarray:
    """48-bit hash of a sequence of fewer than k words."""
    h = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for w in words:
            h = mix(h + np.uint64(0xA0761D6478BD642F)) + w
        return mix(h + np.uint64(len(words))) >> np.uint64(16)


def shingle_sets(texts, k: int) -> list[np.ndarray]:
    """Sorted distinct 48-bit hashes of each text's k-word shingles (fewer words: of the whole sequence)."""
    words, counts = word_hashes(texts)
    rolled, out, at = _rolled(words, k), [], 0
    for c in counts:
        if c >= k:
            out.append(np.unique(rolled[at:at + c - k + 1]))
        else:
            out.append(_short(words[at:at + c]) if c else np.zeros(0, np.uint64))
        at += c
    return out


def shingle_stream(texts, k: int) -> np.ndarray:
    """Hashes of all k-word shingles of the texts, repeats included; texts of fewer words have none."""
    words, counts = word_hashes(texts)
    rolled = _rolled(words, k)
    last = np.repeat(np.cumsum(counts), counts)             # end of the text that a word is in
    return rolled[np.arange(len(rolled)) + k <= last[:len(rolled)]]


def pack(values: np.ndarray) -> bytes:
    """48-bit values as 6 bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel()
