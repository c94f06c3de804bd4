"""Word shingles as 64-bit hashes, computed on whole batches of bytes."""

from __future__ import annotations

import numpy as np

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 20
"""bytes hashed at a time; a slice ends between words"""

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n exponents at least."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, _SLICE + (1 << 16))
        tables = []
        for base in (_BASE, _INVERSE):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            tables.append(np.multiply.accumulate(factors))
        _powers[0] = tables[0], tables[1]
    return _powers[0]


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in bytes, and where each starts.

    A word's hash is the polynomial of its bytes: a difference of prefix sums, shifted to power 0.
    """
    inside = ~_IS_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts]), starts


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of every text, A-Z in lower case, in order."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    slots: list[int] = []
    parts: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        hashes, starts = _hash_words(data)
        ends = np.cumsum([len(p) + 1 for p in parts])
        for slot, own in zip(slots, np.split(hashes, np.searchsorted(starts, ends[:-1]))):
            out[slot].append(own)
        slots.clear()
        parts.clear()
        size = 0

    for slot, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
        at = 0
        while at < len(data):
            end = at + _SLICE
            while end < len(data) and not _IS_SPACE[data[end]]:
                end += 1
            slots.append(slot)
            parts.append(data[at:end])
            size += len(parts[-1])
            at = end
            if size >= _SLICE:
                flush()
    if parts:
        flush()
    return [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in out]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct shingles of k words, sorted; fewer words make one shingle, no words none."""
    if not len(words):
        return words
    width = min(k, len(words))
    joined = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        joined = mix(joined * np.uint64(_BASE) + words[i : len(words) - width + 1 + i] + np.uint64(width))
    return np.unique(joined)
