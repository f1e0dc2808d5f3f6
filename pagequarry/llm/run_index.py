"""Run-length index of a text: run-compressed Burrows-Wheeler transform with
samples at the run ends, and the matching statistics streamed from them."""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF  # in no UTF-8 text


def _kind(n: int) -> type:
    """Type of the positions of a text of ``n`` bytes, doubled lengths included."""
    return np.int32 if n < 1 << 29 else np.int64


def _packed(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one comparable integer."""
    key = np.zeros(len(text) + 8, np.uint64)
    key[: len(text)] = text
    for step in (1, 2, 4):
        later = np.zeros_like(key)
        later[:-step] = key[step:]
        key = (key << np.uint64(8 * step)) | later
    return key


def suffix_order(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length where they still tie."""
    n = len(text)
    kind = _kind(n)
    order = np.argsort(key[:n]).astype(kind)
    sorted_key = key[order]
    heads = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])) if n else np.zeros(0, bool)
    del sorted_key
    rank = np.empty(n, kind)
    at = np.arange(n, dtype=kind)
    rank[order] = np.maximum.accumulate(np.where(heads, at, kind(0)))
    tied = at[~(heads & np.concatenate((heads[1:], [True])))] if n else at
    length = 8
    while len(tied):
        own = order[tied]
        after = own + length
        both = rank[own].astype(np.int64) << 32
        both |= np.where(after < n, rank[np.minimum(after, n - 1)] + kind(1), kind(0))
        del after
        sort = np.argsort(both, kind="stable")
        own, both = own[sort], both[sort]
        del sort
        order[tied] = own
        fresh = np.concatenate(([True], both[1:] != both[:-1]))
        rank[own] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied), dtype=kind), kind(0)))]
        tied = tied[~(fresh & np.concatenate((fresh[1:], [True])))]
        length *= 2
    return order


class RunLengthIndex:
    """Of the transform only the runs are kept: for the first row of each, the
    text position of its suffix, that of the suffix before it in order, and how
    far the two agree (its length is irreducible). The last row of a run is the
    row before the next run's first, so both ends are sampled."""

    def __init__(self, text: np.ndarray):
        self.size = n = len(text)
        key = _packed(text)
        order = suffix_order(text, key)
        before = np.where(order > 0, text[order - 1].astype(np.int16), np.int16(-1))  # -1: the start, a run of its own
        first = np.flatnonzero(np.concatenate(([False], before[1:] != before[:-1]))) if n else np.zeros(0, np.int64)
        self.run_bytes = before[np.concatenate(([0], first))] if n else before
        self.run_starts = np.concatenate(([0], first)) if n else first
        position, previous = order[first], order[first - 1]
        agreed = _agreement(key, position, previous, n)
        top = order[:1]  # the first suffix of all agrees with none before it
        position, previous, agreed = np.append(position, top), np.append(previous, top), np.append(agreed, np.zeros(len(top), np.int64))
        sort = np.argsort(position, kind="stable")
        kind = _kind(n)
        self.position, self.previous, self.agreed = (x[sort].astype(kind) for x in (position, previous, agreed))

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every position in turn: how long its suffix agrees with the one
        before it in order, and where that one is. Inside a run both follow
        from the position before: one less, and one further."""
        at = np.arange(self.size, dtype=_kind(self.size))
        reach = np.diff(np.append(self.position, self.size))
        if len(reach) and self.position[0] > 0:
            raise ValueError("position 0 is not sampled")
        sample = np.repeat(np.arange(len(reach), dtype=at.dtype), reach)
        past = at - self.position[sample]
        return np.maximum(self.agreed[sample] - past, 0), self.previous[sample] + past

    def repeats(self, least: int, rank: np.ndarray | None = None) -> np.ndarray:
        """Positions whose next ``least`` bytes also start at one of lower rank.

        Ranks are the positions themselves unless given; positions of equal
        rank are one place written more than once."""
        rank = np.arange(self.size) if rank is None else rank
        lengths, partner = self.matching_statistics()
        long = np.flatnonzero(lengths >= least)
        del lengths
        link = np.arange(self.size, dtype=_kind(self.size))
        link[long] = partner[long]
        while True:
            further = link[link]
            if np.array_equal(further, link):
                break
            link = further
        lowest = rank.copy()
        np.minimum.at(lowest, link[long], rank[long])
        # Every member of a chain of agreeing suffixes but the lowest.
        return np.flatnonzero(lowest[link] < rank)


def _agreement(key: np.ndarray, one: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
    """Number of bytes in which the suffixes at two positions agree."""
    agreed = np.zeros(len(one), np.int64)
    active = np.arange(len(one))
    done = 0
    while len(active):
        a, b = one[active] + done, other[active] + done
        a, b = np.minimum(a, len(key) - 1), np.minimum(b, len(key) - 1)
        unlike = key[a] ^ key[b]
        same = (unlike == 0) & (np.maximum(one[active], other[active]) + done + 8 <= n)
        ended = ~same
        if ended.any():
            x = unlike[ended]
            equal = np.zeros(len(x), np.int64)
            for shift in range(56, -1, -8):
                equal += (x >> np.uint64(shift)) == 0
            rest = n - np.maximum(one[active[ended]], other[active[ended]]) - done
            agreed[active[ended]] = done + np.minimum(equal, rest)
        active = active[same]
        done += 8
    return agreed
