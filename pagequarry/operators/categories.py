"""Category members and the category tree.

A category is named by its stored title. ``names`` arguments are DataFrames
with a column ``name``, normalised here, so ``Ice hockey`` and ``Ice_hockey``
are one category.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.titles import normalize_title
from pagequarry.operators.reach import reach
from pagequarry.scale import Size, broadcast_if_small, literals, materialise, sorted_lists
from pagequarry.wiki import Wiki

# Bytes a stored title can have.
MAX_TITLE = 255


def stored_names(names: DataFrame) -> DataFrame:
    return names.select(normalize_title(F.col("name")).alias("name")).distinct()


def named(wiki: Wiki, *names: str) -> DataFrame:
    return stored_names(literals(wiki.spark, list(names), "name"))


def subcategory_links(wiki: Wiki) -> DataFrame:
    """``(parent, name, page_id)``: every link from a category page to a
    category, whole wiki. A name met twice under a parent is one row."""
    pages = wiki.page.where(F.col("page_namespace") == wiki.category_namespace).select(
        F.col("page_id").alias("cl_from"), F.col("page_title").alias("name")
    )
    return (
        wiki.categorylinks.select("cl_from", F.col("cl_to").alias("parent"))
        .join(pages, "cl_from")
        .groupBy("parent", "name")
        .agg(F.max("cl_from").alias("page_id"))
    )


def direct_subcategories(wiki: Wiki, names: DataFrame) -> DataFrame:
    """``(parent, name, page_id)`` of the subcategories of the given names."""
    parents = stored_names(names).withColumnRenamed("name", "parent")
    return subcategory_links(wiki).join(broadcast_if_small(parents), "parent")


@dataclass(frozen=True)
class CategoryGraph:
    """The category tree in numbers: ``nodes`` (name, node), one row for each
    name that is a category page or a given root, and ``steps`` (source, target)
    from a category to those below it. A category is numbered by a page of its
    name, a root without a page below zero."""

    nodes: DataFrame
    nodes_size: Size
    steps: DataFrame
    steps_size: Size

    @classmethod
    def of(cls, wiki: Wiki, roots: DataFrame) -> CategoryGraph:
        """``roots`` are stored, distinct names."""
        pages = category_titles(wiki)
        named = pages.groupBy("name").agg(F.min("page_id").alias("node"))
        alone = roots.join(named, "name", "left_anti").select("name", (-1 - F.monotonically_increasing_id()).alias("node"))
        nodes, nodes_size = materialise(named.unionByName(alone))
        above = broadcast_if_small(nodes.select(F.col("name").alias("parent"), F.col("node").alias("source")), nodes_size)
        below = broadcast_if_small(nodes.select("name", F.col("node").alias("target")), nodes_size)
        links = subcategory_links(wiki).join(above, "parent").join(below, "name")
        return cls(nodes, nodes_size, *materialise(links.select("source", "target")))

    def numbered(self, names: DataFrame) -> DataFrame:
        return names.join(broadcast_if_small(self.nodes, self.nodes_size), "name").select("node")

    def named(self, nodes: DataFrame, column: str) -> DataFrame:
        """``nodes`` with the numbers of a column replaced by names."""
        names = self.nodes.select(F.col("node").alias(column), F.col("name").alias("_name"))
        return nodes.join(broadcast_if_small(names, self.nodes_size), column).withColumn(column, F.col("_name")).drop("_name")

    def edges_below(self, root: DataFrame) -> DataFrame:
        """``(source, target)``: every step met below the root's node."""
        found, (rows, width) = reach(self.steps, root, self.steps_size)
        inside = found.select("node").unionByName(root.select("node")).distinct()
        # One row more than found: the root.
        parents = broadcast_if_small(inside.withColumnRenamed("node", "source"), (rows + 1, width + MAX_TITLE))
        return self.steps.join(parents, "source", "left_semi")


def category_titles(wiki: Wiki) -> DataFrame:
    return wiki.page.where(F.col("page_namespace") == wiki.category_namespace).select(
        "page_id", F.col("page_title").alias("name")
    )


def all_subcategories(wiki: Wiki, roots: DataFrame) -> DataFrame:
    """``(root, name, page_id, depth)``: everything below the roots.

    A root is in its own result only when a cycle leads back to it.
    """
    roots = stored_names(roots)
    graph = CategoryGraph.of(wiki, roots)
    start = graph.numbered(roots)
    found, size = reach(graph.steps, start.select(F.col("node").alias("origin"), "node"), graph.steps_size)
    named = graph.named(graph.named(found, "origin"), "node").select(F.col("origin").alias("root"), F.col("node").alias("name"), "depth")
    # Every page of the name; there is one, unless titles repeat.
    return named.join(category_titles(wiki), "name").select("root", "name", "page_id", "depth")


def subcategory_edges(wiki: Wiki, root: str) -> DataFrame:
    """``(child, parent)``: every link met below the root, links to categories
    met before included."""
    start = named(wiki, root)
    graph = CategoryGraph.of(wiki, start)
    edges = graph.edges_below(graph.numbered(start)).select(F.col("target").alias("child"), F.col("source").alias("parent"))
    return graph.named(graph.named(edges, "child"), "parent").select("child", "parent")


def category_pages(wiki: Wiki, names: DataFrame, namespace: int | None = None) -> DataFrame:
    """``(category, page_id)`` of the members in the namespace. Links from
    pages that are gone drop out.

    A few names are broadcast, which thins the links before anything is
    shuffled; many are joined by name, where a hot category is split.
    """
    wanted = wiki.namespace if namespace is None else namespace
    return _members(wiki, *materialise(stored_names(names)), wanted)


def _members(wiki: Wiki, names: DataFrame, size: Size, namespace: int) -> DataFrame:
    """Members of stored, distinct names of a known size."""
    categories = names.withColumnRenamed("name", "category")
    links = wiki.categorylinks.select(F.col("cl_from").alias("page_id"), F.col("cl_to").alias("category"))
    pages = wiki.page.where(F.col("page_namespace") == namespace).select("page_id")
    return (
        links.join(broadcast_if_small(categories, size), "category")
        .join(pages, "page_id")
        .select("category", "page_id")
    )


def category_counts(wiki: Wiki, names: DataFrame) -> DataFrame:
    """``(category, members)``, 0 for a category without members."""
    stored, size = materialise(stored_names(names))
    members = _members(wiki, stored, size, wiki.namespace)
    counts = members.groupBy("category").agg(F.count(F.lit(1)).alias("members"))
    return stored.withColumnRenamed("name", "category").join(counts, "category", "left").select(
        "category", F.coalesce("members", F.lit(0)).alias("members")
    )


def expand_categories(wiki: Wiki, names: DataFrame, subcategories: bool = True) -> DataFrame:
    """The given names and, if asked, everything below them; column ``name``.

    The search holds categories, not pairs with the name they were found from.
    """
    given = stored_names(names)
    if not subcategories:
        return given
    graph = CategoryGraph.of(wiki, given)
    start, size = materialise(graph.numbered(given))
    found, _ = reach(graph.steps, start, graph.steps_size)
    return graph.named(found.select("node").unionByName(start).distinct(), "node").withColumnRenamed("node", "name")


def expansion_report(wiki: Wiki, names: DataFrame) -> DataFrame:
    """``(given, added, total)``: what the expansion added."""
    given = stored_names(names).withColumn("given", F.lit(1))
    return (
        expand_categories(wiki, names)
        .join(given, "name", "left")
        .agg(
            F.count("given").alias("given"),
            (F.count(F.lit(1)) - F.count("given")).alias("added"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def category_set_pages(wiki: Wiki, root: str, recursive: bool = False) -> DataFrame:
    """Distinct ``page_id`` of a category, with all below it if asked."""
    names = expand_categories(wiki, named(wiki, root), recursive)
    return category_pages(wiki, names).select("page_id").distinct()


def eligible_categories(wiki: Wiki, names: DataFrame, min_members: int = 1) -> DataFrame:
    """``(category, members)`` of the names without a slash that have enough
    members."""
    plain = names.where(~F.col("name").contains("/"))
    return category_counts(wiki, plain).where(F.col("members") >= min_members)


def page_categories(wiki: Wiki, names: DataFrame, min_members: int = 1) -> DataFrame:
    """``(page_id, category)``: members of the eligible categories."""
    stored, size = materialise(stored_names(names.where(~F.col("name").contains("/"))))
    members = _members(wiki, stored, size, wiki.namespace)
    if min_members <= 1:
        return members
    # Ids and names only; counted once, then read again for the result. There
    # are no more categories with enough members than names, which were measured.
    members, _ = materialise(members)
    counts = members.groupBy("category").agg(F.count(F.lit(1)).alias("_n"))
    enough = counts.where(F.col("_n") >= min_members).select("category")
    return members.join(broadcast_if_small(enough, size), "category")


def page_category_lists(labels: DataFrame) -> DataFrame:
    """``(page_id, part, categories)``: sorted categories of each page, cut
    into parts by their rank."""
    return sorted_lists(labels, "page_id", "category", "categories")


def list_subcategories(
    wiki: Wiki, root: str, everything: bool = False, show_id: bool = True, show_name: bool = True
) -> DataFrame:
    """Subcategories of a root sorted by name, with the columns asked for."""
    columns = [c for c, shown in (("page_id", show_id), ("name", show_name)) if shown]
    if not columns:
        raise ValueError("select ids, names or both")
    start = named(wiki, root)
    found = all_subcategories(wiki, start) if everything else direct_subcategories(wiki, start)
    return found.orderBy("name").select(*columns)
