"""Reachability in a link graph whose nodes are numbers.

One job of a search follows ``STEPS`` links and writes what it found to the
shared folder: the plan stays one job long and a lost executor repeats no
earlier one. What is found is kept once, as runs merged when they become many,
so that their sizes double and each row is rewritten a few times only
(:class:`Found`). The state of a search from one set of nodes is the node, not a
pair; pairs are kept only where pairs are the result.

The size of a job's rows, seen while they are written, decides whether the next
join broadcasts them. Past that size the joins shuffle, and a hot node that is
extended is split by the adaptive skew join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagequarry.scale import Size, broadcast_if_small, fits_broadcast, materialise, size_metrics
from pagequarry.session import cut_lineage

STEPS = 2  # links followed by one job
RUNS = 8  # runs kept unmerged
SHARE = 8  # a large run is met again when the rows found since are one part in so many of it


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def total(sizes: list[Size]) -> Size:
    return sum(rows for rows, _ in sizes), sum(width for _, width in sizes)


def stored(df: DataFrame, condition: Column) -> tuple[DataFrame, Size, int]:
    """``df`` written to the shared folder, its size, and the rows for which the
    condition holds, seen while writing."""
    seen = Observation()
    written = cut_lineage(df.observe(seen, *size_metrics(df), F.count_if(condition).alias("c")))
    return written, (seen.get["n"], seen.get["b"] or 0), seen.get["c"] or 0


@dataclass
class Run:
    rows: DataFrame
    size: Size
    since: int = 0  # rows found since candidates were last held against it


class Found:
    """Keys found so far with their least depth, in runs.

    Candidates are held against every run that is small enough to broadcast. A
    larger one is read only when the rows found since are a share of it, so that
    a round does not cost what was found long before. A node met again in
    between is a row twice, whose least depth is the right one; it leads to
    nothing that later reading would not stop.
    """

    def __init__(self, keys: list[str]):
        self.keys = keys
        self.runs: list[Run] = []
        self.rows_read = 0
        self.distinct = True

    def new_among(self, candidates: DataFrame) -> DataFrame:
        due = [r for r in self.runs if fits_broadcast(r.size) or r.since * SHARE >= r.size[0]]
        self.distinct = self.distinct and len(due) == len(self.runs)
        if not due:
            return candidates
        for run in due:
            run.since = 0
            self.rows_read += run.size[0]
        known = union([r.rows.select(*self.keys) for r in due])
        return candidates.join(broadcast_if_small(known, total([r.size for r in due])), self.keys, "left_anti")

    def add(self, rows: DataFrame, size: Size) -> None:
        for run in self.runs:
            run.since += size[0]
        self.runs.append(Run(rows, size))
        if len(self.runs) <= RUNS:
            return
        # The last runs become one, up to a run twice as large as they are.
        merged = [self.runs.pop()]
        while self.runs and self.runs[-1].size[0] < 2 * sum(r.size[0] for r in merged):
            merged.append(self.runs.pop())
        self.rows_read += sum(r.size[0] for r in merged)
        least = union([r.rows for r in merged]).groupBy(*self.keys).agg(F.min("depth").alias("depth"))
        self.runs.append(Run(*materialise(least), min(r.since for r in merged)))

    def result(self) -> tuple[DataFrame, Size]:
        """Every key once with its least depth, and the size of it or more."""
        rows = union([r.rows for r in self.runs])
        if not self.distinct:
            rows = rows.groupBy(*self.keys).agg(F.min("depth").alias("depth"))
        return rows, total([r.size for r in self.runs])


def reach(links: DataFrame, start: DataFrame, links_size: Size | None = None) -> tuple[DataFrame, Size]:
    """``(node, depth)``, or ``(origin, node, depth)`` where ``start`` has an
    origin: the nodes reached over one link or more, and the size of it.

    ``links`` is (source, target), ``start`` is ([origin,] node); ``links_size``
    is given when the links are materialised already. Breadth first: a job
    extends only what the last one found at its rim and drops what was found
    before, so cycles end and every node carries its shortest distance.
    """
    found = search(links, start, links_size)
    return found.result()


def search(links: DataFrame, start: DataFrame, links_size: Size | None = None) -> Found:
    if links_size is None:
        links, links_size = materialise(links)
    keys = [c for c in ("origin", "node") if c in start.columns]
    found = Found(keys)
    rim, rim_size = materialise(start.select(*keys).distinct().withColumn("depth", F.lit(0)))
    if rim_size[0] == 0:
        found.add(rim.where(F.lit(False)), (0, 0))
        return found
    while True:
        levels, level = [], rim
        for step in range(STEPS):
            # The smaller side is the one to broadcast, if either fits.
            if step == 0 and rim_size <= links_size:
                near = broadcast_if_small(level.withColumnRenamed("node", "source"), rim_size)
                extended = links.join(near, "source")
            else:
                ahead = broadcast_if_small(links.withColumnRenamed("source", "node"), links_size)
                extended = level.join(ahead, "node")
            others = [c for c in keys if c != "node"]
            level = extended.select(*others, F.col("target").alias("node"), (F.col("depth") + 1).alias("depth"))
            if not fits_broadcast(links_size):
                # Past the bound no node goes into the next shuffled join twice;
                # below it the one aggregation at the end is cheaper.
                level = level.distinct()
            levels.append(level)
        nearest = union(levels).groupBy(*keys).agg(F.min("depth").alias("depth"))
        # Those nearer than the rim were extended in this job already.
        at_rim = F.col("depth") % STEPS == 0
        fresh, size, at_end = stored(found.new_among(nearest), at_rim)
        found.add(fresh, size)
        if at_end == 0:
            return found
        rim, rim_size = fresh.where(at_rim), size


def reach_all(links: DataFrame) -> DataFrame:
    """``(origin, node, depth)`` from every node, over one link or more.

    With all pairs up to a distance D known, those at D + j are pairs at
    exactly D followed by one at j: the known distance doubles each round, and
    only pairs at the rim are extended.
    """
    first = links.select(F.col("source").alias("origin"), F.col("target").alias("node"), F.lit(1).alias("depth"))
    rim, rim_size = materialise(first.distinct())
    rounds, sizes, reached = [rim], [rim_size], 1
    while rim_size[0] > 0:
        known, known_size = union(rounds), total(sizes)
        left = rim.select("origin", F.col("node").alias("via"))
        right = known.select(F.col("origin").alias("via"), "node", "depth")
        if rim_size <= known_size:
            left = broadcast_if_small(left, rim_size)
        else:
            right = broadcast_if_small(right, known_size)
        longer = (
            left.join(right, "via")
            .groupBy("origin", "node")
            .agg((F.min("depth") + F.lit(reached)).alias("depth"))
            .join(broadcast_if_small(known.select("origin", "node"), known_size), ["origin", "node"], "left_anti")
        )
        fresh, fresh_size = materialise(longer)
        rounds.append(fresh)
        sizes.append(fresh_size)
        reached *= 2
        rim, rim_size = materialise(fresh.where(F.col("depth") == reached).select("origin", "node"))
    return union(rounds)


def ancestors(links: DataFrame, size: Size, origins: DataFrame) -> DataFrame:
    """``(origin, node)``: what the origins reach over one link or more.

    Nodes on a common cycle reach the same, so they are one node of the search:
    it runs over the graph of components, which has no cycles, from the
    components of the origins alone. Its pairs are spelt out at the end.
    """
    members, members_size = components(links, size)
    rings = links.where("source = target").select(F.col("source").alias("node"), F.col("source").alias("component"))
    if members_size[0] == 0:
        found, _ = reach(links, origins.select(F.col("node").alias("origin"), "node"), size)
        return found.select("origin", "node")  # a node on a link to itself reaches itself

    def condensed(df: DataFrame, column: str) -> DataFrame:
        of = broadcast_if_small(members.select(F.col("node").alias(column), "component"), members_size)
        return df.join(of, column, "left").withColumn(column, F.coalesce("component", column)).drop("component")

    between = condensed(condensed(links, "source"), "target").where("source <> target").distinct()
    starts = origins.withColumn("same", F.col("node"))
    starts = condensed(starts, "same").select(F.col("node").alias("asked"), F.col("same").alias("origin")).distinct()
    starts, starts_size = materialise(starts)
    found, found_size = reach(between, starts.select("origin", F.col("origin").alias("node")).distinct())
    # A component on a cycle reaches itself; its members stand for it.
    cyclic = members.select("component").union(rings.select("component")).distinct()
    own = starts.select("origin").distinct().join(cyclic, F.col("origin") == F.col("component"), "left_semi")
    pairs = found.select("origin", "node").unionByName(own.select("origin", F.col("origin").alias("node"))).distinct()
    spelt = members.select(F.col("component").alias("node"), F.col("node").alias("member"))
    pairs = pairs.join(broadcast_if_small(spelt, members_size), "node", "left").select(
        "origin", F.coalesce("member", "node").alias("node")
    )
    # Origins are distinct nodes; several may share a component.
    return starts.join(pairs, "origin").select(F.col("asked").alias("origin"), "node")


def trimmed(links: DataFrame, size: Size) -> tuple[DataFrame, Size]:
    """The links between nodes that have links on both sides, repeated while
    that takes links away: those that may lie on a cycle, or between two."""
    while size[0] > 0:
        entered = links.select(F.col("target").alias("source")).distinct()
        leaving = links.select(F.col("source").alias("target")).distinct()
        left = links.join(broadcast_if_small(entered, size), "source", "left_semi")
        left = left.join(broadcast_if_small(leaving, size), "target", "left_semi")
        left, left_size = materialise(left.select("source", "target"))
        if left_size[0] == size[0]:
            break
        links, size = left, left_size
    return links, size


def components(links: DataFrame, size: Size) -> tuple[DataFrame, Size]:
    """``(node, component)`` of the nodes that lie on a cycle with others, and
    the size of it; a component is named by a number of its own.

    After trimming, every node takes the least node that reaches it as its
    colour. From a node of its own colour, the nodes of that colour that lead
    back to it are its component. Links between colours are on no cycle. What
    then is left is trimmed and coloured again.
    """
    links, size = trimmed(*materialise(links.where("source <> target").select("source", "target").distinct()))
    found: list[DataFrame] = []
    sizes: list[Size] = []
    while size[0] > 0:
        colour = coloured(links, size)
        ends = F.col("a.node") == F.col("source")
        sides = links.join(colour.alias("a"), ends).join(colour.alias("b"), F.col("b.node") == F.col("target"))
        inside, inside_size = materialise(
            sides.where("a.colour = b.colour").select("source", "target", F.col("a.colour").alias("colour"))
        )
        # Back from each node of its own colour; colours are apart already.
        back = inside.select(F.col("target").alias("source"), F.col("source").alias("target"))
        heads = inside.select(F.col("colour").alias("node")).distinct()
        led, _ = reach(back, heads, inside_size)
        # A head that leads back to itself has a component of two nodes or more.
        member = led.select("node").join(colour, "node").withColumnRenamed("colour", "component")
        member, member_size = materialise(member)
        found.append(member)
        sizes.append(member_size)
        gone = broadcast_if_small(member.select(F.col("node").alias("source")), member_size)
        left = inside.join(gone, "source", "left_anti").join(gone.withColumnRenamed("source", "target"), "target", "left_anti")
        links, size = trimmed(*materialise(left.select("source", "target")))
    if not found:
        return links.select(F.col("source").alias("node"), F.col("target").alias("component")), (0, 0)
    return union(found), total(sizes)


def coloured(links: DataFrame, size: Size) -> DataFrame:
    """``(node, colour)``: the least node that reaches it, itself included."""
    nodes = links.select(F.col("source").alias("node")).union(links.select("target")).distinct()
    colour, colour_size = materialise(nodes.withColumn("colour", F.col("node")))
    ahead = broadcast_if_small(links.withColumnRenamed("source", "node"), size)
    while True:
        changed = colour.select("node", "colour", F.col("colour").alias("before"))
        for _ in range(STEPS):
            sent = changed.join(ahead, "node").select(F.col("target").alias("node"), "colour", F.lit(None).cast("long").alias("before"))
            changed = changed.unionByName(sent).groupBy("node").agg(F.min("colour").alias("colour"), F.max("before").alias("before"))
        changed, colour_size, moved = stored(changed, F.col("colour") < F.col("before"))
        colour = changed.select("node", "colour")
        if moved == 0:
            return colour
