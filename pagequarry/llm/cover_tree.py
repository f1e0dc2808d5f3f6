"""Embedding near-duplicates: cover trees, dual traversal, exact threshold pairs.

Vectors of one label and length are compared by cosine, as distances of unit
vectors. They are dealt to the nearest of ``PIVOTS`` vectors (a bounded sample,
for locality only) and cut into blocks of up to about ``BLOCK`` vectors, so a label with a third of all rows is as many blocks as it needs. A
task builds the cover tree of a block: nested levels of centres with halving
radii and each node's true covering radius. Pairs of blocks whose distance less
both radii passes the threshold are dropped; for the others a task walks both
trees at once, prunes node pairs by the same bound, accepts those that lie
within the threshold as a whole, and measures what is left in double precision.

A task returns sums and spanning links, never all pairs: a row for each vector
with its number of partners, and links that join what is connected.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing, as do those with a null label or a null vec_id (whose
component_id is null); vectors of different lengths are not compared; rows with
the same vec_id count apart and are one vertex; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.common import stage
from pagequarry.llm.components import components

BLOCK = 1024
PIVOTS = 8
#: Of a distance, more than rounding takes from two radii (1.5e-8 and more may
#: come out as 0); decides only whether a pair is measured.
SLACK = 1e-7


def reach(threshold: float) -> float:
    """Distance of unit vectors at which their cosine is ``threshold``."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)))


class CoverTree:
    """Levels of nodes over unit vectors; points are ordered so that the
    descendants of a node lie together.

    ``levels[k]`` holds, for each node, the point that is its centre, the first
    and last point below it, its covering radius and its first child in the
    next level (children of consecutive nodes are consecutive).
    """

    def __init__(self, points: np.ndarray, finest: float):
        n = len(points)
        parts = [(0, np.arange(n))]  # centre and members of every node of the level
        kept = [[0]]
        child_counts = []
        radius = 1.0
        while True:
            next_parts, counts = [], []
            for centre, members in parts:
                made = self._cut(points, centre, members, radius)
                next_parts += made
                counts.append(len(made))
            child_counts.append(counts)
            parts = next_parts
            kept.append([c for c, _ in parts])
            if radius <= finest or len(parts) == n:
                break
            radius /= 2
        self.order = np.concatenate([m for _, m in parts])
        self.points = points[self.order]
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        sizes = np.array([len(m) for _, m in parts])
        self.levels = []
        for depth in range(len(kept) - 1, -1, -1):
            ends = np.cumsum(sizes)
            centre = place[np.array(kept[depth])]
            self.levels.append((centre, ends - sizes, ends))
            if depth:
                cuts = np.concatenate(([0], np.cumsum(child_counts[depth - 1])[:-1]))
                sizes = np.add.reduceat(sizes, cuts)
        self.levels.reverse()
        self.children = [np.concatenate(([0], np.cumsum(c))) for c in child_counts]
        self.radii = []
        for centre, first, last in self.levels:
            far = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", self.points, np.repeat(self.points[centre], last - first, axis=0))))
            self.radii.append(np.maximum.reduceat(far, first))

    @staticmethod
    def _cut(points: np.ndarray, centre: int, members: np.ndarray, radius: float):
        """Members of a node among centres more than ``radius`` apart, the
        node's own centre first; each within ``radius`` of its centre."""
        made = []
        while len(members):
            near = points[members] @ points[centre] >= 1 - radius * radius / 2
            near |= members == centre
            made.append((centre, members[near]))
            members = members[~near]
            if len(members):
                centre = members[0]
        return made


def _distances(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    rows, ri = np.unique(i, return_inverse=True)
    cols, ci = np.unique(j, return_inverse=True)
    if len(rows) * len(cols) <= 8 * len(i):
        cosine = (a[rows] @ b[cols].T)[ri, ci]
    else:
        cosine = np.concatenate([np.einsum("ij,ij->i", a[i[n : n + 16384]], b[j[n : n + 16384]]) for n in range(0, len(i), 16384)])
    return np.sqrt(np.maximum(0, 2 - 2 * cosine))


def dual_traversal(a: CoverTree, b: CoverTree, threshold: float, same: bool):
    """Yields ``(i, j)`` arrays of point pairs, and ranges of pairs that lie
    within the threshold as a whole: ``("pairs", i, j)`` or
    ``("blocks", i0, i1, j0, j1)``. With ``same`` both trees are one, and each
    pair comes once (i < j for pairs; blocks may overlap themselves)."""
    eps = reach(threshold)
    i, j = np.array([0]), np.array([0])
    depth = 0
    while len(i):
        la, lb = min(depth, len(a.levels) - 1), min(depth, len(b.levels) - 1)
        (ca, a0, a1), (cb, b0, b1) = a.levels[la], b.levels[lb]
        d = _distances(a.points, b.points, ca[i], cb[j])
        both = a.radii[la][i] + b.radii[lb][j]
        near = d <= eps + both + SLACK
        i, j, d, both = i[near], j[near], d[near], both[near]
        whole = d + both <= eps - SLACK
        if whole.any():
            yield "blocks", a0[i[whole]], a1[i[whole]], b0[j[whole]], b1[j[whole]]
            i, j = i[~whole], j[~whole]
        last_a, last_b = la == len(a.levels) - 1, lb == len(b.levels) - 1
        if last_a and last_b:
            if len(i):
                yield from _leaves(a, b, a0[i], a1[i], b0[j], b1[j], threshold, same)
            return
        from_a = (i, i + 1) if last_a else (a.children[la][i], a.children[la][i + 1])
        from_b = (j, j + 1) if last_b else (b.children[lb][j], b.children[lb][j + 1])
        i, j = _product(*from_a, *from_b)
        if same:
            i, j = i[i <= j], j[i <= j]
        depth += 1


def _product(a0, a1, b0, b1):
    """All (i, j) of the ranges a0..a1 and b0..b1, for every row."""
    na, nb = a1 - a0, b1 - b0
    total = na * nb
    row = np.repeat(np.arange(len(total)), total)
    at = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
    return a0[row] + at // nb[row], b0[row] + at % nb[row]


def _leaves(a, b, a0, a1, b0, b1, threshold, same):
    sizes = np.cumsum((a1 - a0) * (b1 - b0))
    start = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + 500_000)))
        i, j = _product(a0[start:stop], a1[start:stop], b0[start:stop], b1[start:stop])
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            rows, ri = np.unique(i, return_inverse=True)
            cols, ci = np.unique(j, return_inverse=True)
            if len(rows) * len(cols) <= 8 * len(i):
                hit = (a.points[rows] @ b.points[cols].T)[ri, ci] >= threshold
            else:
                hit = np.concatenate(
                    [np.einsum("ij,ij->i", a.points[i[n : n + 16384]], b.points[j[n : n + 16384]]) for n in range(0, len(i), 16384)]
                ) >= threshold
            yield "pairs", i[hit], j[hit]
        start = stop


def _spanning(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what the pairs join, at most one fewer than points."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for x, y in zip(i.tolist(), j.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def _match(a: CoverTree, b: CoverTree, threshold: float, same: bool):
    """Partners of every point of both trees, and spanning links, points of
    ``b`` counted from ``len(a)`` on unless both are one tree."""
    na, nb = len(a.points), len(b.points)
    shift = 0 if same else na
    counts = np.zeros(shift + nb, np.int64)
    links: list[tuple[np.ndarray, np.ndarray]] = []
    for kind, *found in dual_traversal(a, b, threshold, same):
        if kind == "pairs":
            i, j = found[0], found[1] + shift
            counts += np.bincount(i, minlength=len(counts)) + np.bincount(j, minlength=len(counts))
            links.append((i, j))
            continue
        for a0, a1, b0, b1 in zip(*(x.tolist() for x in found)):
            if same and (a0, a1) == (b0, b1):
                counts[a0:a1] += a1 - a0 - 1
                links.append((np.full(a1 - a0 - 1, a0), np.arange(a0 + 1, a1)))
                continue
            counts[a0:a1] += b1 - b0
            counts[b0 + shift : b1 + shift] += a1 - a0
            links.append((np.arange(a0, a1), np.full(a1 - a0, b0 + shift)))
            links.append((np.full(b1 - b0, a0), np.arange(b0, b1) + shift))
    if not links:
        return counts, []
    return counts, _spanning(np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links]))


def _units(batch: pa.RecordBatch) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for those that cannot link."""
    column = batch["embedding"]
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = [0 if n is None else n for n in pc.list_value_length(column).to_pylist()]
    ends = np.cumsum(sizes)
    out: list[np.ndarray | None] = []
    for size, end in zip(sizes, ends.tolist()):
        own = values[end - size : end]
        # Scaled first, so that no square overflows or vanishes.
        top = np.max(np.abs(own)) if size else 0.0
        if not size or not np.isfinite(top) or top == 0:
            out.append(None)
            continue
        own = own / top
        out.append(own / np.sqrt(own @ own))
    return out


def vector_links(vectors: DataFrame, threshold: float = 0.98, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector."""
    spark = vectors.sparkSession
    chosen = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    ).withColumn("row", F.monotonically_increasing_id())

    def normalise(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            units = _units(batch)
            fit = [u is not None and k is not None and v is not None for u, k, v in zip(units, batch["label"].to_pylist(), batch["vec_id"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"], batch["vec_id"], batch["label"],
                    pa.array([len(u) if ok else 0 for u, ok in zip(units, fit)], pa.int64()),
                    pa.array([u.tobytes() if ok else None for u, ok in zip(units, fit)], pa.binary()),
                ],
                ["row", "vec_id", "label", "width", "unit"],
            )

    units = stage(chosen.mapInArrow(normalise, "row long, vec_id long, label string, width long, unit binary"), "units")
    fit = units.where("unit is not null")
    key = ["label", "width"]
    sample = fit.select("width", "unit").orderBy(F.xxhash64("row"), "row").limit(PIVOTS).collect()
    pivots: dict[int, list[np.ndarray]] = {}
    for width, unit in sample:
        pivots.setdefault(width, []).append(np.frombuffer(bytes(unit), np.float64))
    shared = spark.sparkContext.broadcast({w: np.stack(p) for w, p in pivots.items()})

    def nearest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            cells = []
            for width, unit in zip(batch["width"].to_pylist(), batch["unit"]):
                points = shared.value.get(width)
                cells.append(0 if points is None else int(np.argmax(points @ np.frombuffer(unit.as_buffer(), np.float64))))
            yield batch.append_column("cell", pa.array(cells, pa.int64()))

    celled = stage(fit.mapInArrow(nearest, "row long, vec_id long, label string, width long, unit binary, cell long"), "cells")
    sizes = celled.groupBy(*key, "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("parts"))
    dealt = celled.join(sizes, [*key, "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    named = dealt.withColumn("block", F.sha2(F.concat_ws("|", "label", "width", "cell", "part"), 256))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        """One row for a block of about BLOCK vectors."""
        points = np.frombuffer(b"".join(frame["unit"]), np.float64).reshape(len(frame), -1)
        centre = points.mean(axis=0)
        centre /= max(np.sqrt(centre @ centre), 1e-300)
        radius = float(np.sqrt(max(0.0, 2 - 2 * float((points @ centre).min())))) if np.isfinite(centre).all() else 2.0
        return pd.DataFrame(
            {
                "label": [frame["label"].iloc[0]], "width": [frame["width"].iloc[0]], "block": [frame["block"].iloc[0]],
                "centre": [centre.tolist()], "radius": [radius],
                "rows": [frame["row"].to_numpy(np.int64).tobytes()], "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()], "points": [points.tobytes()],
            }
        )

    blocks = stage(
        named.select("row", "vec_id", "label", "width", "unit", "block").groupBy("block").applyInPandas(
            build, "label string, width long, block string, centre array<double>, radius double, rows binary, ids binary, points binary"
        ),
        "blocks",
    )
    head = blocks.select(*key, "block", "centre", "radius")
    x, y = head.alias("x"), head.alias("y")
    cosine = F.aggregate(F.zip_with("x.centre", "y.centre", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * cosine))
    close = apart <= F.col("x.radius") + F.col("y.radius") + F.lit(reach(threshold) + SLACK)
    pairs = x.join(y, (F.col("x.label") == F.col("y.label")) & (F.col("x.width") == F.col("y.width")) & (F.col("x.block") <= F.col("y.block")) & close)
    pairs = pairs.select(F.col("x.block").alias("block"), F.col("y.block").alias("other"))
    one = blocks.select("block", "width", "rows", "ids", "points")
    two = blocks.select(F.col("block").alias("other"), F.col("rows").alias("rows2"), F.col("ids").alias("ids2"), F.col("points").alias("points2"))

    def walk(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(len(batch)):
                r = {n: batch[n][at].as_py() for n in batch.schema.names}
                width, same = r["width"], r["block"] == r["other"]
                finest = reach(threshold) / 4
                a = CoverTree(np.frombuffer(r["points"], np.float64).reshape(-1, width), finest)
                b = a if same else CoverTree(np.frombuffer(r["points2"], np.float64).reshape(-1, width), finest)
                counts, links = _match(a, b, threshold, same)
                rows, ids = np.frombuffer(r["rows"], np.int64)[a.order], np.frombuffer(r["ids"], np.int64)[a.order]
                if not same:
                    rows = np.concatenate((rows, np.frombuffer(r["rows2"], np.int64)[b.order]))
                    ids = np.concatenate((ids, np.frombuffer(r["ids2"], np.int64)[b.order]))
                some = np.flatnonzero(counts)
                ends = np.array(links, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(rows[some], pa.int64()), pa.nulls(len(ends), pa.int64())]),
                        pa.concat_arrays([pa.array(counts[some], pa.int64()), pa.nulls(len(ends), pa.int64())]),
                        pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(ids[ends[:, 0]], pa.int64())]),
                        pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(ids[ends[:, 1]], pa.int64())]),
                    ],
                    ["row", "n", "a", "b"],
                )

    # Large rows: dealt by pair, so the walks of one block go to many tasks.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = pairs.join(one, "block").join(two, "other").repartition(parts, "block", "other")
    found = stage(joined.mapInArrow(walk, "row long, n long, a long, b long"), "links")
    counts = found.where("row is not null").groupBy("row").agg(F.sum("n").alias("n_links"))
    groups = components(found.where("a is not null").select("a", "b"))
    component = F.coalesce("component", "vec_id")
    return (
        units.select("row", "vec_id").join(counts, "row", "left").join(groups, F.col("vec_id") == F.col("id"), "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        )
    )
