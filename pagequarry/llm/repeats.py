"""Exact removal of long repeated passages with run-length indexes.

1. Anchors: of every run of ``length - GRAM + 1`` positions of a text that with
   the smallest hash of its ``GRAM`` bytes is an anchor, so equal windows of
   ``length`` bytes hold equal anchors. An anchor met once cannot lie in a
   repeat and is dropped.
2. Pieces: around each remaining anchor lie the windows that hold it. An anchor
   belongs to the place where it is met first, and neighbouring anchors of a
   text with places in one stretch (``STRETCH`` bytes) of one document make one
   piece. All windows that could equal each other meet in that stretch.
3. Equal pieces of a stretch are one; each later copy is a repeat as a whole.
4. Stretches are dealt to shards of about ``SHARD_BYTES``. A task builds the
   run-length index of its shard, streams its matching statistics, and marks
   the windows that start earlier as well. A stretch with more than
   ``HOT_BYTES`` of different pieces is no task's: its windows are counted
   by a 128-bit hash, combined before they are shuffled.

A text is taken as UTF-8 bytes. Cases: null and empty texts have no bytes;
repeats never cross texts; rows alike in doc_id and text are judged as one;
different texts with one doc_id (and those with a null one, which come first)
are ordered by a hash of the text; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.common import batches, stage, text_bytes
from pagequarry.llm.run_index import SEPARATOR, RunLengthIndex
from pagequarry.llm.shingles import mix

GRAM = 32
STRETCH = 1024
SHARD_BYTES = 2 << 20
HOT_BYTES = 6 << 20
_U = np.uint64
_SPANS = pa.schema([(n, pa.int64()) for n in ("doc", "first", "last")])


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (a power of two) bytes from each position on."""
    held, base = raw.astype(_U) + _U(1), 0x9E3779B97F4A7C15
    span = 1
    while span < size:
        held = held[: len(held) - span] * _U(base) + held[span:]
        base = base * base & 0xFFFFFFFFFFFFFFFF
        span *= 2
    return mix(held)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    held, span = values, 1
    while span * 2 <= width:
        held = np.minimum(held[: len(held) - span], held[span:])
        span *= 2
    rest = width - span
    return np.minimum(held[: len(held) - rest], held[rest:]) if rest else held


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of one text of at least ``length`` bytes."""
    hashes = gram_hashes(raw, GRAM)
    width = length - GRAM + 1
    least = window_minima(hashes, width)
    # A position is chosen if it is least in a window that holds it.
    around = np.concatenate((np.zeros(width - 1, _U), least, np.zeros(width - 1, _U)))
    below = ~window_minima(~around, width)  # the largest of the minima
    chosen = np.flatnonzero(hashes == below[: len(hashes)])
    return chosen, hashes[chosen]


def _numbered(docs: DataFrame) -> DataFrame:
    """``(doc, doc_id, text, copies)`` with distinct, ordered ``doc`` for each document.

    doc_ids serve as they are unless one repeats or is null.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = chosen.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if counts.where("n > 1 or doc_id is null").isEmpty():
        return chosen.select(F.col("doc_id").alias("doc"), "doc_id", "text", F.lit(1).cast("long").alias("copies"))
    alike = chosen.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    ordered = alike.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return stage(ordered.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text", "copies"), "numbered")


def _anchor_rows(length: int):
    schema = pa.schema([("hash", pa.int64()), ("doc", pa.int64()), ("at", pa.int32())])

    def find(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            docs, ats, hashes = [], [], []
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
                raw = np.frombuffer(text_bytes(text), np.uint8)
                if len(raw) >= length:
                    at, found = anchors(raw, length)
                    docs.append(np.full(len(at), doc, np.int64))
                    ats.append(at.astype(np.int32))
                    hashes.append(found.astype(np.int64))
            if docs:
                columns = [np.concatenate(x) for x in (hashes, docs, ats)]
                for n in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[n : n + 100_000]) for c in columns], schema=schema)

    return find


def cut_pieces(at: np.ndarray, places: np.ndarray, size: int, length: int) -> list[tuple[int, int, int]]:
    """``(number of the place, first byte, end)`` of the pieces of a text:
    unions of what its anchors' windows cover, for each place apart."""
    order = np.lexsort((at, places))
    at, places = at[order], places[order]
    first = np.maximum(at - (length - GRAM), 0)
    end = np.minimum(at + length, size)
    fresh = np.concatenate(([True], (places[1:] != places[:-1]) | (first[1:] > end[:-1])))
    starts = np.flatnonzero(fresh)
    ends = np.append(starts[1:], len(at)) - 1
    return [(p, a, b) for p, a, b in zip(places[starts].tolist(), first[starts].tolist(), end[ends].tolist()) if b - a >= length]


def _piece_rows(length: int):
    schema = pa.schema([("place_doc", pa.int64()), ("place", pa.int64()), ("doc", pa.int64()), ("first", pa.int64()), ("digest", pa.binary()), ("piece", pa.binary())])

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in stream:
                for doc, text, found in zip(batch["doc"].to_pylist(), batch["text"], batch["found"]):
                    raw = text.as_buffer().to_pybytes()
                    held = found.values
                    at = held.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
                    keys = list(zip(held.field("place_doc").to_pylist(), held.field("place").to_pylist()))
                    named = {k: n for n, k in enumerate(dict.fromkeys(keys))}
                    names = list(named)
                    for n, a, b in cut_pieces(at, np.array([named[k] for k in keys]), len(raw), length):
                        piece = raw[a:b]
                        yield (*names[n], doc, a, hashlib.blake2b(piece, digest_size=16).digest(), piece)

        yield from batches(rows(), schema, weight=lambda r: len(r[5]))

    return cut


def _spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged ``[first, end)`` of the windows that start at sorted ``starts``."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(p[0]), int(p[-1]) + length) for p in np.split(starts, cuts)]


def mark_shard(docs: list[int], firsts: list[int], parts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """Byte ranges ``(doc, first, end)`` of repeats among pieces of documents."""
    text = np.frombuffer(bytes([SEPARATOR]).join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    # Pieces of different stretches may hold the same bytes of a document:
    # a position's rank is its place in the documents.
    index = RunLengthIndex(text)  # before the ranks: the index needs the most memory
    _, number = np.unique(np.array(docs), return_inverse=True)
    lead = (number.astype(np.int64) << 40) + np.array(firsts) - begins
    rank = np.repeat(lead, sizes + 1)[: len(text)]
    rank += np.arange(len(text))
    marked = index.repeats(length, rank)
    owner = np.searchsorted(begins, marked, side="right") - 1
    inside = marked - begins[owner] + length <= sizes[owner]
    marked, owner = marked[inside], owner[inside]
    out = []
    for n in np.unique(owner).tolist():
        a, b = np.searchsorted(owner, [n, n + 1])
        out += [(docs[n], firsts[n] + x, firsts[n] + y) for x, y in _spans(marked[a:b] - begins[n], length)]
    return out


def repeated_spans(docs: DataFrame, length: int = 100, shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``(doc, first, last)``: byte ranges (``last`` excluded, they may overlap)
    covered by windows that also start earlier, of ``docs(doc, text)``."""
    if length < GRAM + 1:
        raise ValueError(f"length must be more than {GRAM}")
    found = docs.mapInArrow(_anchor_rows(length), "hash long, doc long, at int")
    met = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "at")).alias("where")).where("n > 1")
    place = (F.col("where.at") / F.lit(STRETCH)).cast("long")
    shared = found.join(met.hint("merge"), "hash").select("doc", "at", F.col("where.doc").alias("place_doc"), place.alias("place"))
    by_doc = shared.groupBy("doc").agg(F.collect_list(F.struct("at", "place_doc", "place")).alias("found"))
    raw = docs.select("doc", F.encode("text", "UTF-8").alias("text"))
    cut = raw.join(by_doc.hint("merge"), "doc").mapInArrow(
        _piece_rows(length), "place_doc long, place long, doc long, first long, digest binary, piece binary"
    )
    cut = stage(cut, "pieces")

    key = ["place_doc", "place"]
    head = cut.select(*key, "digest", "doc", "first", F.length("piece").cast("long").alias("size"))
    firsts = stage(head.groupBy(*key, "digest").agg(F.min(F.struct("doc", "first", "size")).alias("one")).select(*key, "digest", "one.*"), "firsts")
    copies = head.join(firsts.select(*key, "digest", F.struct("doc", "first").alias("one")).hint("merge"), [*key, "digest"])
    copies = copies.where(F.struct("doc", "first") != F.col("one")).select("doc", "first", (F.col("first") + F.col("size")).alias("last"))

    sizes = firsts.groupBy(*key).agg(F.sum("size").alias("bytes"))
    sizes = sizes.withColumn("hot", F.col("bytes") > hot_bytes)
    total = sizes.where("not hot").agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    kept = firsts.join(sizes.select(*key, "hot").hint("merge"), key).select(*key, "doc", "first", "hot")
    one = cut.join(kept.hint("merge"), [*key, "doc", "first"], "inner")
    dealt = one.where("not hot").select(F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int").alias("shard"), "doc", "first", "piece")

    def mark(frame: pd.DataFrame) -> pd.DataFrame:
        rows = mark_shard(frame["doc"].tolist(), frame["first"].tolist(), frame["piece"].tolist(), length)
        return pd.DataFrame(rows, columns=["doc", "first", "last"]).astype(np.int64)

    indexed = dealt.groupBy("shard").applyInPandas(mark, "doc long, first long, last long")
    return copies.unionByName(indexed).unionByName(_hot_spans(one.where("hot").select("doc", "first", "piece"), length))


def _hot_spans(hot: DataFrame, length: int) -> DataFrame:
    """Repeats among pieces of stretches too large for a task."""
    schema = pa.schema([("one", pa.int64()), ("two", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])

    def windows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for doc, first, piece in zip(batch["doc"].to_pylist(), batch["first"].to_pylist(), batch["piece"].to_pylist()):
                digests = np.frombuffer(
                    b"".join(hashlib.blake2b(piece[n : n + length], digest_size=16).digest() for n in range(len(piece) - length + 1)), np.int64
                ).reshape(-1, 2)
                at = np.arange(len(digests)) + first
                yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), pa.array(np.full(len(at), doc, np.int64)), pa.array(at)], schema=schema)

    rows = hot.mapInArrow(windows, "one long, two long, doc long, at long")
    first = rows.groupBy("one", "two").agg(F.min(F.struct("doc", "at")).alias("where"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = rows.join(first.hint("merge"), ["one", "two"]).where(F.struct("doc", "at") != F.col("where"))
    return later.select("doc", F.col("at").alias("first"), (F.col("at") + length).alias("last")).distinct()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, length: int = 100, **bounds: int) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``: what is left
    of each text (``kept``, bytes) and what was removed, one row per document."""
    numbered = _numbered(docs)
    spans = repeated_spans(numbered, length, **bounds)
    by_doc = spans.groupBy("doc").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    joined = numbered.join(by_doc.hint("merge"), "doc", "left").select("doc_id", F.encode("text", "UTF-8").alias("text"), "spans", "copies")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
    )

    def remove(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in stream:
                for doc, raw, spans, copies in zip(*(batch[n].to_pylist() for n in ("doc_id", "text", "spans", "copies"))):
                    raw = raw or b""
                    cuts = merged([(s["first"], s["last"]) for s in spans or []])
                    edges = [0, *(x for c in cuts for x in c), len(raw)]
                    left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    row = doc, len(raw), len(raw) - len(left), len(cuts), hashlib.sha256(left).hexdigest(), left
                    yield from (row for _ in range(copies))

        yield from batches(rows(), schema, weight=lambda r: len(r[5]))

    return joined.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def repeat_report(docs: DataFrame, length: int = 100, **bounds: int) -> DataFrame:
    return without_repeats(docs, length, **bounds).drop("kept")

