"""Hard-negative mining with exact integer scores by the method of the Four Russians.

Components become whole numbers, ``floor(scale * x)``. A row is packed into bit
planes: for each plane, one byte for every eight dimensions. For an anchor the
256 subset sums of each eight of its components are tabled once; a candidate's
bytes look them up, plane by plane from the sign down, shifting and adding, and
the result is the whole inner product.

The anchors are a stated set of queries against all rows, in blocks: rows and
anchors are dealt into blocks by a hash of their ids, each block of one meets
each block of the other in one task, and a task returns what is best in it for
each anchor. The best of all blocks follow by rank. No block depends on a
label, so a hot label is many blocks.

Cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part; rows with one id are one row, the smallest by label
and vector; vectors of different lengths have no score with each other, empty
ones have 0; a positive score below 0 admits no negatives; ties go by the
smaller id; an anchor without positives or negatives has no rows; an empty
table gives an empty result; other columns are not read. Components saturate
at 62 bits and scores wrap beyond 63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pagequarry.llm.common import batches, stage

ANCHORS = 8192  # of a block
ROWS, MOST_ROWS, BLOCKS = 4096, 1 << 18, 64  # of a block at least and at most; blocks before they grow
STEP_ROWS, STEP_ANCHORS = 2048, 256  # of one matrix of scores

_PACKED = "vec_id long, label long, width int, planes int, bits binary"
_PACKED_SCHEMA = pa.schema(
    [("vec_id", pa.int64()), ("label", pa.int64()), ("width", pa.int32()), ("planes", pa.int32()), ("bits", pa.binary())]
)
_FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
_FOUND_SCHEMA = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "vec_id", "score")])


def whole_numbers(embedding: Column, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(scale * x.cast("double")).cast("long"))


def complete(embedding: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(embedding, finite), F.lit(False))


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of rows of equal width, sign plane last, and the planes each
    row needs: ``(rows, planes, eighths)`` bytes."""
    rows, width = values.shape
    values = np.clip(values, -(1 << 62), 1 << 62)
    size = np.where(values < 0, ~values, values).max(axis=1, initial=0)
    needed = np.frexp(size.astype(np.float64))[1] + 2  # a rounded-up size may cost one plane more
    planes = min(int(needed.max(initial=1)), 64)
    padded = np.zeros((rows, -(-width // 8) * 8), np.int64)
    padded[:, :width] = values
    bits = np.stack([np.packbits((padded >> j & 1).astype(np.uint8), axis=1, bitorder="little") for j in range(planes)], axis=1)
    return bits, np.minimum(needed, planes)


def unpack(bits: np.ndarray, width: int) -> np.ndarray:
    """Whole numbers of ``(rows, planes, eighths)`` bytes."""
    planes = bits.shape[1]
    ones = np.unpackbits(bits, axis=2, bitorder="little")[:, :, :width].astype(np.int64)
    weights = np.int64(1) << np.arange(planes, dtype=np.int64)
    weights[-1] = -weights[-1]
    return (ones * weights[None, :, None]).sum(axis=1)


def subset_sums(values: np.ndarray) -> np.ndarray:
    """``(eighths, 256, anchors)``: sums of each subset of eight components."""
    anchors, width = values.shape
    padded = np.zeros((anchors, -(-width // 8) * 8), values.dtype)
    padded[:, :width] = values
    groups = padded.reshape(anchors, -1, 8).transpose(1, 2, 0)
    tables = np.zeros((groups.shape[0], 256, anchors), values.dtype)
    for bit in range(8):
        tables[:, 1 << bit : 2 << bit] = tables[:, : 1 << bit] + groups[:, bit, None, :]
    return tables


def exact_scores(tables: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """``(rows, anchors)`` inner products: table lookups, shifted and added."""
    rows, planes, groups = bits.shape
    total = np.zeros((rows, tables.shape[2]), tables.dtype)
    looked = np.empty_like(total)
    for plane in range(planes - 1, -1, -1):
        if plane < planes - 1:
            total <<= 1
        for group in range(groups):
            np.take(tables[group], bits[:, plane, group], axis=0, out=looked, mode="clip")
            if plane == planes - 1:
                total -= looked
            else:
                total += looked
    return total


def first_of(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns, ids and scores of each column's first ``most`` allowed rows, by
    falling score and rising id."""
    usable = allowed.any(axis=0)
    if not usable.any():
        return (np.zeros(0, np.int64),) * 3
    columns = np.flatnonzero(usable)
    scores, allowed = scores[:, columns], allowed[:, columns]
    if len(scores) > most:
        least = np.iinfo(scores.dtype).min
        worth = np.where(allowed, scores, least)
        allowed = allowed & (scores >= np.partition(worth, len(worth) - most, axis=0)[len(worth) - most])
    row, column = np.nonzero(allowed)
    return _cut(columns[column], ids[row], scores[row, column].astype(np.int64), most)


def _cut(key: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, ~scores, key))  # ~ falls as its number rises, without overflow
    key, ids, scores = key[order], ids[order], scores[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    rank = np.arange(len(key)) - np.repeat(start, np.diff(np.append(start, len(key))))
    return key[rank < most], ids[rank < most], scores[rank < most]


class Block:
    """Packed rows of one width and number of planes, sorted by label and id."""

    def __init__(self, table: pa.Table):
        self.ids = table["vec_id"].to_numpy()
        self.labels = table["label"].to_numpy()
        self.width = table["width"][0].as_py()
        self.planes = table["planes"][0].as_py()
        raw = b"".join(table["bits"].to_pylist())
        self.bits = np.frombuffer(raw, np.uint8).reshape(len(self.ids), self.planes, -(-self.width // 8))

    @staticmethod
    def of(table: pa.Table) -> list[Block]:
        table = table.sort_by([(n, "ascending") for n in ("width", "planes", "label", "vec_id")])
        kinds = table["width"].to_numpy() * 64 + table["planes"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)]
        return [Block(table.slice(a, b - a)) for a, b in zip(edges, edges[1:]) if b > a]

    def label_runs(self) -> list[tuple[int, int, int]]:
        edges = [0, *(np.flatnonzero(np.diff(self.labels)) + 1).tolist(), len(self.labels)]
        return [(int(self.labels[a]), a, b) for a, b in zip(edges, edges[1:])]


def score_steps(rows: list[Block], anchors: list[Block], same: bool):
    """For anchors of one label and rows of the same or of other labels:
    ``(anchor block, its slice, ids of rows, scores)`` in steps."""
    for block in anchors:
        values = unpack(block.bits, block.width)
        fitting = [r for r in rows if r.width == block.width]
        largest = max((1 << r.planes for r in fitting), default=0)
        small = int(np.abs(values).sum(axis=1, dtype=np.float64).max(initial=0)) * largest * 2 < 1 << 31
        for label, first, last in block.label_runs():
            for at in range(first, last, STEP_ANCHORS):
                part = slice(at, min(at + STEP_ANCHORS, last))
                tables = subset_sums(values[part].astype(np.int32 if small else np.int64))
                for row in fitting:
                    chosen = np.flatnonzero((row.labels == label) == same)
                    for step in range(0, len(chosen), STEP_ROWS):
                        own = chosen[step : step + STEP_ROWS]
                        yield block, part, row.ids[own], exact_scores(tables, row.bits[own])


def _table(columns: list[tuple]) -> pa.Table:
    joined = [np.concatenate(c) for c in zip(*columns)] if columns else [np.zeros(0, np.int64)] * 5
    return pa.table([pa.array(c, pa.int64()) for c in joined], schema=_FOUND_SCHEMA)


def best_positives(rows: pa.Table, anchors: pa.Table, most: int) -> pa.Table:
    """The first rows of each anchor's label in one block."""
    found = []
    if len(rows) and len(anchors):
        for block, part, ids, scores in score_steps(Block.of(rows), Block.of(anchors), True):
            own = block.ids[part]
            column, near, score = first_of(scores, ids, ids[:, None] != own[None, :], most)
            found.append((own[column], near, score, near, score))
    return _table(found)


def best_negatives(rows: pa.Table, anchors: pa.Table, most: int, low: int, high: int) -> pa.Table:
    """The first rows of other labels in one block for each anchor and positive."""
    found = []
    if len(rows) and len(anchors):
        wanted = dict(zip(anchors["vec_id"].to_pylist(), anchors["positives"].to_pylist()))
        for block, part, ids, scores in score_steps(Block.of(rows), Block.of(anchors), False):
            own = block.ids[part]
            lists = [wanted[i] for i in own.tolist()]
            kind = np.iinfo(scores.dtype)
            for place in range(max(map(len, lists), default=0)):
                some = [(c, p[place]["positive_id"], p[place]["positive_score"]) for c, p in enumerate(lists) if place < len(p)]
                columns = np.array([c for c, _, _ in some])
                # The least and greatest whole score, within what the type holds.
                least = np.array([min(max(-(-low * p // 100), kind.min), kind.max) for _, _, p in some], scores.dtype)
                greatest = np.array([min(max(high * p // 100, kind.min), kind.max) for _, _, p in some], scores.dtype)
                own_scores = scores if len(columns) == scores.shape[1] else scores[:, columns]
                column, near, score = first_of(own_scores, ids, (own_scores >= least) & (own_scores <= greatest), most)
                positive = np.array([p for _, p, _ in some], np.int64)[column]
                value = np.array([p for _, _, p in some], np.int64)[column]
                found.append((own[columns[column]], positive, value, near, score))
    return _reduced(_table(found), most)


def _reduced(found: pa.Table, most: int) -> pa.Table:
    """The first ``most`` of each anchor and positive of one task."""
    if not len(found):
        return found
    anchor, positive, value, ids, scores = (found[n].to_numpy() for n in _FOUND_SCHEMA.names)
    _, key = np.unique(np.stack((anchor, positive)), axis=1, return_inverse=True)
    order = np.lexsort((ids, ~scores, key := key.reshape(-1)))
    ordered = key[order]
    start = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    rank = np.arange(len(ordered)) - np.repeat(start, np.diff(np.append(start, len(ordered))))
    return found.take(order[rank < most])


def packed_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """``(vec_id, label, width, planes, bits)`` of the rows that take part."""
    usable = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & complete(F.col("embedding")))
    numbers = usable.select("vec_id", "label", whole_numbers(F.col("embedding"), scale).alias("numbers"))
    # Combined before the shuffle: a repeated id is one row.
    one = numbers.groupBy("vec_id").agg(F.min(F.struct("label", "numbers")).alias("r")).select("vec_id", "r.label", "r.numbers")

    def run(stream):
        def rows():
            for batch in stream:
                numbers = batch["numbers"]
                lengths = numbers.value_lengths().to_numpy()
                flat = numbers.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                offsets = np.concatenate(([0], np.cumsum(lengths)))
                ids, labels = batch["vec_id"].to_pylist(), batch["label"].to_pylist()
                for width in np.unique(lengths):
                    own = np.flatnonzero(lengths == width)
                    values = flat[offsets[own][:, None] + np.arange(width)] if width else np.zeros((len(own), 0), np.int64)
                    bits, planes = pack(values)
                    for n, at in enumerate(own.tolist()):
                        yield ids[at], labels[at], int(width), int(planes[n]), bits[n, : planes[n]].tobytes()

        yield from batches(rows(), _PACKED_SCHEMA, weight=lambda r: len(r[4]))

    return one.mapInArrow(run, _PACKED)


def _met(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, kernel) -> DataFrame:
    """Every block of rows with every block of anchors, each pair in one task."""

    def number(blocks: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(blocks))

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))

    parts = 4 * row_blocks * anchor_blocks  # few pairs share a task
    left = rows.withColumn("_r", number(row_blocks)).select("*", every(anchor_blocks).alias("_a"))
    right = anchors.toDF(*anchors.columns).withColumn("_a", number(anchor_blocks)).select("*", every(row_blocks).alias("_r"))
    left, right = (d.repartition(parts, "_a", "_r").groupBy("_a", "_r") for d in (left, right))
    return left.cogroup(right).applyInArrow(kernel, _FOUND)


def _ranked(found: DataFrame, most: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` of ``vectors(vec_id, embedding, label)``.

    Anchors are the rows whose id is divisible by ``every``. An anchor's
    positives are its first ``positives`` other rows of its label; a positive's
    negatives are the first ``negatives`` rows of other labels that score from
    ``low`` to ``high`` percent of it.
    """
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.pmod("vec_id", F.lit(every)) == 0).alias("anchors")]
    packed = stage(packed_rows(vectors, scale).observe(seen, *counts), "packed")
    rows, n_anchors = seen.get["rows"], seen.get["anchors"]
    # Larger blocks of rows where there are many: fewer copies of the anchors.
    row_blocks = -(-max(rows, 1) // min(max(ROWS, rows // BLOCKS), MOST_ROWS))
    anchor_blocks = -(-max(n_anchors, 1) // ANCHORS)
    anchors = packed.where(F.pmod("vec_id", F.lit(every)) == 0)

    near = _met(packed, anchors, row_blocks, anchor_blocks, lambda r, a: best_positives(r, a, positives))
    chosen = _ranked(near, positives, "anchor_id").groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    asked = anchors.toDF(*anchors.columns).join(chosen.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    hard = _met(packed, asked, row_blocks, anchor_blocks, lambda r, a: best_negatives(r, a, negatives, low, high))
    return _ranked(hard, negatives, "anchor_id", "positive_id").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
