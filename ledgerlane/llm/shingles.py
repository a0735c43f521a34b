"""Words and word shingles of a text as 64-bit hashes, in numpy.

Words are what white space (space and \\x09-\\x0D) separates, with A-Z lower-cased. A hash of a word
is a polynomial over random byte values, mixed; equal words have equal hashes on every machine.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for texts of up to n bytes."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(1 << 14, 1 << (n + 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Running polynomial of bytes; with ``span_hash`` it gives the hash of any stretch."""
    up, _ = _powers(len(raw))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=out[1:])
    return out


def number_sums(values: np.ndarray) -> np.ndarray:
    """The same for 64-bit numbers, such as hashes of words."""
    up, _ = _powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _powers(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode().lower(), np.uint8)
    starts, ends = word_spans(raw)
    return span_hash(prefix_sums(raw), starts, ends)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of all words when they are fewer; none without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out * _BASE + words[k : k + n])
    return np.unique(out)
