"""Vectorised hashing of the words of many texts at once."""

from __future__ import annotations

import numpy as np

_M = np.uint64(0x9E3779B97F4A7C15)             # odd, so powers have inverses mod 2**64
_M_INVERSE = np.uint64(pow(int(_M), -1, 1 << 64))
_STEPS = tuple(np.uint64(x) for x in (
    0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse, mod 2**64."""
    if len(_POWERS[0]) < n:
        for i, m in enumerate((_M, _M_INVERSE)):
            steps = np.full(n, m, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = (x ^ (x >> np.uint64(30))) * _STEPS[0]
    x = (x ^ (x >> np.uint64(27))) * _STEPS[1]
    return x ^ (x >> np.uint64(31))


def prefix_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums S of the polynomial of ``raw`` (any unsigned symbols) and inverse
    powers V: ``(S[e] - S[s]) * V[s]`` identifies ``raw[s:e]`` for a given length."""
    power, inverse = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    return sums, inverse


def spans_hash(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray,
               end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans ``[start, end)``."""
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _STEPS[2])


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words of all texts, one after the other,
    and the texts' bounds in them (``len(texts) + 1`` numbers)."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    white = _WHITE[raw]
    before = np.concatenate(([True], white[:-1]))
    start = np.flatnonzero(before & ~white)
    end = np.flatnonzero(white & ~before)
    sums, inverse = prefix_sums(raw)
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return spans_hash(sums, inverse, start, end), start.searchsorted(ends)


def sequence(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` (small) consecutive codes."""
    n = max(len(codes) - size + 1, 0)
    total = np.full(n, _STEPS[3] + np.uint64(size), np.uint64)
    for i in range(size):
        total = (total ^ codes[i:i + n]) * _M
        total ^= total >> np.uint64(29)
    return mix(total)


def planes(values: np.ndarray, keep: int | None = None) -> bytes:
    """The bytes of unsigned numbers by significance, lowest first (``keep`` of them):
    equal high bytes then lie together and compress away."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, width)[:, :keep].T.tobytes()


def from_planes(raw: bytes, count: int, kind=np.uint64) -> np.ndarray:
    """Numbers written by ``planes``."""
    width = np.dtype(kind).itemsize
    out = np.zeros((count, width), np.uint8)
    if count:
        kept = np.frombuffer(raw, np.uint8).reshape(-1, count)
        out[:, :len(kept)] = kept.T
    return out.view(kind).ravel()
