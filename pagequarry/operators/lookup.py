"""Bulk lookups over the page, revision and text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.encoding import decode_by_flags
from pagequarry.functions.titles import (
    is_template_title,
    normalize_dump_title,
    normalize_title,
    without_template_prefix,
)
from pagequarry.scale import Size, broadcast_if_small, fits_broadcast
from pagequarry.wiki import Wiki


def latest_revisions(wiki: Wiki, page_ids: DataFrame | None = None, size: Size | None = None) -> DataFrame:
    """``(page_id, rev_id, text_id)`` of the greatest revision id of each page.

    The aggregate keeps one row per page before it shuffles, so a page with
    very many revisions is no hot key. ``size`` is that of ``page_ids``, if it
    was measured already.
    """
    revisions = wiki.revision.select("rev_page", "rev_id", "rev_text_id")
    if page_ids is not None:
        wanted = page_ids.select(F.col("page_id").alias("rev_page"))
        revisions = revisions.join(broadcast_if_small(wanted, size), "rev_page", "left_semi")
    return revisions.groupBy(F.col("rev_page").alias("page_id")).agg(
        F.max("rev_id").alias("rev_id"), F.max_by("rev_text_id", "rev_id").alias("text_id")
    )


def decode_text(wiki: Wiki) -> DataFrame:
    """``(old_id, text)``; a body stored as bytes is decoded by its flags."""
    body = F.col("old_text")
    if dict(wiki.text.dtypes)["old_text"] == "binary":
        body = decode_by_flags(body, F.col("old_flags"), wiki.encoding)
    return wiki.text.select("old_id", body.alias("text"))


def latest_text(wiki: Wiki, page_ids: DataFrame | None = None, size: Size | None = None) -> DataFrame:
    """``(page_id, rev_id, text)`` of the latest revision of every page, or of
    the given pages. Pages without a text have no row."""
    latest = latest_revisions(wiki, page_ids, size)
    if size is not None and fits_broadcast(size):
        # One row of three ids for each wanted page: no more than was measured,
        # so bodies of other pages are dropped where they are read.
        latest = F.broadcast(latest)
    return latest.join(decode_text(wiki), F.col("text_id") == F.col("old_id")).select("page_id", "rev_id", "text")


def missing_pages(wiki: Wiki, page_ids: DataFrame, size: Size | None = None) -> DataFrame:
    """The given pages that have no text. Bodies are not read for it."""
    stored = wiki.text.select(F.col("old_id").alias("text_id"))
    found = latest_revisions(wiki, page_ids, size).join(stored, "text_id", "left_semi").select("page_id")
    return page_ids.select("page_id").distinct().join(found, "page_id", "left_anti")


def random_pages(wiki: Wiki, n: int = 1, namespace: int | None = None, seed: int | str = 0) -> DataFrame:
    """``n`` pages of a namespace, uniformly.

    The order is that of a digest of seed and id: the same seed gives the same
    pages however the table is split, and a task run again changes nothing.
    Only the ``n`` first rows of each task are exchanged.
    """
    wanted = wiki.namespace if namespace is None else namespace
    pages = wiki.page.where(F.col("page_namespace") == wanted).select("page_id")
    if pages.isEmpty():
        raise ValueError(f"no page in namespace {wanted}")
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col("page_id").cast("string")))
    return pages.orderBy(digest, "page_id").limit(n)


def title_key(wiki: Wiki, title: Column) -> tuple[Column, Column]:
    """Namespace and stored title a written title means."""
    namespace = F.when(is_template_title(title), wiki.template_namespace).otherwise(wiki.namespace)
    return namespace, normalize_title(without_template_prefix(title))


def resolve_titles(wiki: Wiki, titles: DataFrame) -> DataFrame:
    """``(title, page_namespace, page_title, page_id)`` of the given titles;
    a title without a page has a null id."""
    namespace, stored = title_key(wiki, F.col("title"))
    keys = titles.select("title", namespace.alias("page_namespace"), stored.alias("page_title"))
    pages = wiki.page.select("page_id", "page_namespace", "page_title")
    return keys.join(pages, ["page_namespace", "page_title"], "left").select(
        "title", "page_namespace", "page_title", "page_id"
    )


def unresolved_titles(wiki: Wiki, titles: DataFrame) -> DataFrame:
    """Titles no page answers to."""
    namespace, stored = title_key(wiki, F.col("title"))
    keys = titles.select("title", namespace.alias("page_namespace"), stored.alias("page_title")).distinct()
    return keys.join(wiki.page, ["page_namespace", "page_title"], "left_anti").select("title")


def page_lines(pages: DataFrame) -> DataFrame:
    """``(page_id, line_no, line)`` of ``(page_id, text)``. Empty lines at the
    end do not count, so a text of line breaks only has no lines."""
    body = F.rtrim(F.col("text"), F.lit("\n"))
    return (
        pages.where(body != "")
        .select("page_id", F.posexplode(F.split(body, "\n")).alias("line_no", "line"))
    )


def find_article(raw: DataFrame, title: str) -> DataFrame:
    """``(position, text)`` of the first page of a dump with this title, counted
    from 1; empty without one. ``raw`` is read with its positions.

    Three passes: one finds the place of the first match, one counts the pages
    up to it, for which no page is parsed, one reads it. Nothing is sorted.
    """
    matches = raw.where(F.col("title") == normalize_dump_title(F.lit(title)))
    first = matches.agg(F.min("position").alias("p")).first()["p"]
    if first is None:
        return matches.select(F.lit(0).cast("bigint").alias("position"), F.lit("").alias("text"))
    kind = raw.schema["position"].dataType
    place = F.struct(*[F.lit(first[name]).alias(name) for name in kind.names]).cast(kind)
    before = raw.where(F.col("position") <= place).select("position").count()
    return matches.where(F.col("position") == place).select(
        F.lit(before).cast("bigint").alias("position"),
        F.coalesce(F.col("revision")[0]["text"], F.lit("")).alias("text"),
    )
