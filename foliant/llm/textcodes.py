"""Vectorised scanning of texts: code points, word spans and 64-bit span hashes.

Hashes are polynomials over code points modulo 2**64, taken from one running sum and finished with a mixer. For words as
they come two collide with a chance near 2**-64, so ten billion words have about three colliding pairs. The modulus is a
power of two, so words can be made to collide (long ones of a Thue-Morse pattern); the hashes are no defence against that.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
SPACES = (9, 10, 11, 12, 13, 32)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 21)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.cumprod(x, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with one separator (0) after each, and the separators' places."""
    full = [t or "" for t in texts]
    codes = np.frombuffer(("\0".join(full) + "\0").encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in full), np.int64, len(full))) - 1
    return codes, ends


def lower_ascii(codes: np.ndarray) -> np.ndarray:
    return codes + ((codes >= 65) & (codes <= 90)) * np.uint32(32)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the last element must be False."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    return edge[::2], edge[1::2]


def hash_spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(codes) + 1)
    run = np.empty(len(codes) + 1, np.uint64)
    run[0] = 0
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=run[1:])
    return mix((run[ends] - run[starts]) * inverse[starts])


def space_words(texts: list[str | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of all texts, and the number of words before each text and after the last."""
    codes, ends = code_points(texts)
    if lower:
        codes = lower_ascii(codes)
    inside = (codes != 32) & ((codes < 9) | (codes > 13))
    inside[ends] = False
    a, b = spans(inside)
    return hash_spans(codes, a, b), np.concatenate([[0], np.searchsorted(a, ends)])


def letter_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words [0-9a-z and everything from U+0080]+ after lower-casing A-Z.

    Hashes; words before each text; starts and ends of the words and starts of the texts, in joined code points.
    """
    codes, ends = code_points(texts)
    codes = lower_ascii(codes)
    inside = ((codes >= 48) & (codes <= 57)) | ((codes >= 97) & (codes <= 122)) | (codes >= 128)
    a, b = spans(inside)
    return hash_spans(codes, a, b), np.concatenate([[0], np.searchsorted(a, ends)]), a, b, np.concatenate([[0], ends[:-1] + 1])


_K = [pow(0x2545F4914F6CDD1D, i + 1, 1 << 64) for i in range(16)]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; of the whole sequence if there are fewer; nothing of no words."""
    n = len(words)
    if not n:
        return words
    size = min(k, n)
    h = np.full(n - size + 1, (size * 0x632BE59BD9B4E019) % (1 << 64), np.uint64)
    for i in range(size):
        h += words[i : n - size + 1 + i] * np.uint64(_K[i])
    return mix(h)
