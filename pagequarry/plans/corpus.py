"""A labelled corpus: the articles of categories with their labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.categories import (
    expand_categories,
    named,
    page_categories,
    page_category_lists,
)
from pagequarry.operators.cleaning import CORPUS_STEPS, Step, apply_steps
from pagequarry.operators.lookup import decode_text, latest_revisions, latest_text, missing_pages
from pagequarry.scale import Size, broadcast_if_small, materialise
from pagequarry.wiki import Wiki


@dataclass(frozen=True)
class Corpus:
    """``labels`` (page_id, category) covers every member page; ``articles``
    (page_id, text) those with a text. ``pages`` are the member pages, of a
    measured ``size``."""

    labels: DataFrame
    articles: DataFrame
    missing: DataFrame
    wiki: Wiki
    pages: DataFrame
    size: Size
    steps: Sequence[Step]

    def label_lists(self) -> DataFrame:
        """``(page_id, part, categories)`` of the pages that have a text."""
        wanted = self.articles.select("page_id")
        return page_category_lists(self.labels.join(wanted, "page_id", "left_semi"))

    def labelled_articles(self) -> DataFrame:
        """``(page_id, part, categories, text)``: every article with its lists.

        The lists are joined to the ids of texts, and bodies come last: where
        ids and lists are small (measured) they are broadcast and no body is
        moved, otherwise it is shuffled once, before it is cleaned. A page with
        several parts has its text in each of them.
        """
        latest = latest_revisions(self.wiki, self.pages, self.size).select("page_id", "text_id")
        wanted, size = materialise(page_category_lists(self.labels).join(latest, "page_id"))
        bodies = decode_text(self.wiki).where(F.col("text") != "")
        found = bodies.join(broadcast_if_small(wanted, size), F.col("text_id") == F.col("old_id"))
        return found.select("page_id", "part", "categories", apply_steps(F.col("text"), self.steps).alias("text"))


def extract_corpus(
    wiki: Wiki,
    categories: Sequence[str] | DataFrame,
    subcategories: bool = False,
    min_members: int = 1,
    steps: Sequence[Step] = CORPUS_STEPS,
) -> Corpus:
    """Articles of the categories (and all below them), cleaned, with labels.

    Texts are shuffled once, for the join of bodies with the ids wanted; the
    cleaning runs behind it in the same stage.
    """
    names = categories if isinstance(categories, DataFrame) else named(wiki, *categories)
    names = expand_categories(wiki, names, subcategories)
    # Both feed several outputs and are ids and names only.
    labels, _ = materialise(page_categories(wiki, names, min_members))
    pages, size = materialise(labels.select("page_id").distinct())
    articles = latest_text(wiki, pages, size).where(F.col("text") != "").select(
        "page_id", apply_steps(F.col("text"), steps).alias("text")
    )
    return Corpus(labels, articles, missing_pages(wiki, pages, size), wiki, pages, size, steps)
