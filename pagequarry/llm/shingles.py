"""Hashed word shingles of many texts at once, with numpy."""

from __future__ import annotations

import numpy as np

from pagequarry.llm.common import text_bytes

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit integers (the usual xor-multiply rounds)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(29)
    x = x * _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(32)
    return x


_VALUE = mix(np.arange(1, 257, dtype=_U))
_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < size:
        n = max(size, 1 << 16)
        full = lambda base: np.concatenate(([_U(1)], np.cumprod(np.full(n - 1, base, _U))))
        _POWERS[:] = [full(_BASE), full(_INVERSE)]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of each text's
    words. Words are runs of other bytes than white space, A-Z lower-cased."""
    raws = [text_bytes(t).translate(_LOWER) for t in texts]
    joined = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    sizes = np.array([len(r) + 1 for r in raws])
    word = ~_SPACE[joined]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers(len(joined) + 1)
    total = np.concatenate(([_U(0)], np.cumsum(_VALUE[joined] * power[: len(joined)])))
    hashes = mix((total[ends] - total[starts]) * inverse[starts])
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    return hashes, np.bincount(owner, minlength=len(texts))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``words`` words; of
    fewer words, the whole sequence is the only one; of none, there is none."""
    hashes, counts = word_hashes(texts)
    out = []
    rolled = hashes
    for _ in range(words - 1):
        rolled = mix(rolled[:-1] * _U(0xD6E8FEB86659FD93) + hashes[len(hashes) - len(rolled) + 1 :]) if len(rolled) else rolled
    at = 0
    for n in counts.tolist():
        if n >= words:
            own = np.unique(rolled[at : at + n - words + 1])
        elif n:
            own = np.array([mix(np.array([_short(hashes[at : at + n])], _U))[0]], _U)
        else:
            own = np.zeros(0, _U)
        out.append(own)
        at += n
    return out


def _short(hashes: np.ndarray) -> int:
    value = len(hashes)
    for h in hashes.tolist():
        value = (value * 0xD6E8FEB86659FD93 + h) & 0xFFFFFFFFFFFFFFFF
    return value


def pieces(sizes: list[int], limit: int = 1 << 20):
    """Slices of consecutive texts of about ``limit`` bytes."""
    start = held = 0
    for n, size in enumerate(sizes):
        if held and held + size > limit:
            yield slice(start, n)
            start, held = n, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))
