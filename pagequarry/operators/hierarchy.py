"""The category graph as a label hierarchy: ``edges`` are (child, parent)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.titles import normalize_title
from pagequarry.operators.categories import MAX_TITLE, CategoryGraph, category_counts, named
from pagequarry.operators.reach import ancestors, reach_all
from pagequarry.scale import broadcast_if_small, literals, materialise, sorted_lists
from pagequarry.wiki import Wiki

# Fixed value: suffix of the label added below every inner category.
LEAF = "_LEAF"


def vertices(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.col("child").alias("vertex"))
        .unionByName(edges.select(F.col("parent").alias("vertex")))
        .distinct()
    )


def classify_vertices(edges: DataFrame) -> DataFrame:
    """``(vertex, kind)``. ``interior``: categories below and above it.
    ``leaf``: none below. ``root``: none above. ``isolated``: only linked to
    itself. Links of a vertex to itself do not count."""
    proper = (F.col("child") != F.col("parent")).cast("int")
    up = edges.select(F.col("child").alias("vertex"), proper.alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("parent").alias("vertex"), F.lit(0).alias("up"), proper.alias("down"))
    kind = (
        F.when((F.col("up") > 0) & (F.col("down") > 0), "interior")
        .when(F.col("up") > 0, "leaf")
        .when(F.col("down") > 0, "root")
        .otherwise("isolated")
    )
    return (
        up.unionByName(down)
        .groupBy("vertex")
        .agg(F.max("up").alias("up"), F.max("down").alias("down"))
        .select("vertex", kind.alias("kind"))
    )


def add_leaf_labels(edges: DataFrame, root: str) -> DataFrame:
    """The edges and, for the root and every interior vertex, one edge from
    its leaf label to it."""
    inner = (
        classify_vertices(edges)
        .where(F.col("kind") == "interior")
        .select("vertex")
        .unionByName(literals(edges.sparkSession, [root], "vertex"))
        .distinct()
    )
    labels = inner.select(F.concat("vertex", F.lit(LEAF)).alias("child"), F.col("vertex").alias("parent"))
    return edges.select("child", "parent").unionByName(labels).distinct()


def remove_vertex(edges: DataFrame, vertex: str) -> DataFrame:
    return edges.where((F.col("child") != vertex) & (F.col("parent") != vertex))


def remaining_vertices(edges: DataFrame, vertex: str) -> DataFrame:
    """All vertices but one; those it alone was linked to stay, isolated."""
    return vertices(edges).where(F.col("vertex") != vertex)


def transitive_closure(edges: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """``(vertex, ancestor)``: everything reachable in one step or more, so a
    vertex is its own ancestor only on a cycle. With ``of`` (column ``vertex``)
    no pair of another vertex is made."""
    if of is None:
        steps = edges.select(F.col("child").alias("source"), F.col("parent").alias("target"))
        return reach_all(steps).select(F.col("origin").alias("vertex"), F.col("node").alias("ancestor"))
    numbered, size = materialise(vertices(edges).withColumn("node", F.monotonically_increasing_id()))
    named = broadcast_if_small(numbered, size)

    def number(df: DataFrame, column: str, alias: str) -> DataFrame:
        return df.withColumnRenamed(column, "vertex").join(named, "vertex").withColumnRenamed("node", alias).drop("vertex")

    def name(df: DataFrame, column: str, alias: str) -> DataFrame:
        return df.withColumnRenamed(column, "node").join(named, "node").withColumnRenamed("vertex", alias).drop("node")

    links, links_size = materialise(number(number(edges.select("child", "parent"), "child", "source"), "parent", "target"))
    pairs = ancestors(links, links_size, number(of.select("vertex").distinct(), "vertex", "node"))
    return name(name(pairs.withColumnRenamed("node", "above"), "above", "ancestor"), "origin", "vertex").select("vertex", "ancestor")


def label_hierarchy(wiki: Wiki, root: str, min_members: int = 1) -> DataFrame:
    """``(category, part, supercategories)``: labels below the root with all
    their supercategories, sorted and joined by spaces.

    Inner categories get a leaf label, the root goes. A label needs as many
    pages as asked for in its category, the leaf suffix aside. A label without
    supercategories has the empty string.

    The labels to keep are settled first; the closure then runs upward from
    them alone, over numbers. A leaf label has the category it belongs to and
    what is above that, so its pairs are a union and no part of the closure.
    """
    start = named(wiki, root)
    top = start.first()["name"]
    graph = CategoryGraph.of(wiki, start)
    steps, size = materialise(graph.edges_below(graph.numbered(start)))
    edges = steps.select(F.col("target").alias("child"), F.col("source").alias("parent"))
    head = broadcast_if_small(graph.numbered(start).withColumnRenamed("node", "vertex"), (1, MAX_TITLE))
    inner = classify_vertices(edges).where(F.col("kind") == "interior").select("vertex").union(head).distinct()
    # (vertex, leaf, label): a category, or the leaf label of one.
    own = vertices(edges).unionByName(head).distinct().withColumn("leaf", F.lit(False))
    labels = own.join(head, "vertex", "left_anti").unionByName(inner.withColumn("leaf", F.lit(True)))
    named_labels = graph.named(labels.withColumn("name", F.col("vertex")), "name")
    label = F.when(F.col("leaf"), F.concat("name", F.lit(LEAF))).otherwise(F.col("name"))
    labels, labels_size = materialise(named_labels.select("vertex", "leaf", label.alias("category")))
    # A category may have the name of a leaf label; it then is that label too.
    twins = labels.where("leaf").join(labels.where("not leaf").select("category", F.col("vertex").alias("same")), "category")
    twins, (n_twins, _) = materialise(twins.select(F.col("same").alias("source"), F.col("vertex").alias("target")))
    wanted = labels.select("vertex", "leaf", "category", normalize_title(F.regexp_replace("category", f"{LEAF}\\z", "")).alias("name"))
    sizes = category_counts(wiki, wanted.select("name")).withColumnRenamed("category", "name")
    kept, kept_size = materialise(
        wanted.join(sizes.where(F.col("members") >= min_members), "name", "left_semi").select("vertex", "leaf", "category")
    )
    upward = steps.select(F.col("target").alias("source"), F.col("source").alias("target"))
    upward = upward.unionByName(twins) if n_twins else upward
    upward, upward_size = materialise(_without(_without(upward, head, "source"), head, "target"))
    pairs = ancestors(upward, upward_size, _without(kept.select(F.col("vertex").alias("node")).distinct(), head, "node"))
    of_leaves = _without(kept.where("leaf").select("category", F.col("vertex").alias("node")), head, "node")
    above = broadcast_if_small(kept.withColumnRenamed("vertex", "origin"), kept_size)
    listed = pairs.join(above, "origin").select("category", "node").unionByName(of_leaves)
    lists = sorted_lists(graph.named(listed, "node"), "category", "node", "supercategories")
    return kept.select("category").distinct().join(lists, "category", "left").select(
        "category",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.concat_ws(" ", "supercategories").alias("supercategories"),
    )


def _without(df: DataFrame, few: DataFrame, column: str) -> DataFrame:
    return df.join(few.select(F.col("vertex").alias(column)), column, "left_anti")
