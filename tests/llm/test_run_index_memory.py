"""The run-length index of a shard holds few bytes for each of its text."""

import tracemalloc

import numpy as np

from pagequarry.llm.repeats import mark_shard


def test_marking_a_shard_takes_few_bytes_a_byte():
    rng = np.random.default_rng(3)
    words = [rng.integers(97, 123, 400, dtype=np.uint8).tobytes() for _ in range(300)]
    parts = [b"".join(words[n] for n in rng.integers(0, 300, 25)) for _ in range(100)]
    total = sum(map(len, parts))
    tracemalloc.start()
    found = mark_shard(list(range(100)), [0] * 100, parts, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # By brute force on the windows of 100 bytes.
    seen, covered = set(), [np.zeros(len(p), bool) for p in parts]
    for part, held in zip(parts, covered):
        for at in range(len(part) - 99):
            window = part[at : at + 100]
            if window in seen:
                held[at : at + 100] = True
            seen.add(window)
    marked = [np.zeros(len(p), bool) for p in parts]
    for doc, a, b in found:
        marked[doc][a:b] = True
    assert all((x == y).all() for x, y in zip(marked, covered))
    assert peak < 62 * total, peak / total
