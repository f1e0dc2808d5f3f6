"""Single articles: by category, page id, title or at random."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.categories import category_set_pages
from pagequarry.operators.cleaning import READER_STEPS, apply_steps
from pagequarry.operators.lookup import latest_text, missing_pages, random_pages, resolve_titles
from pagequarry.scale import literals, materialise
from pagequarry.wiki import Wiki

# Below this length a text is reported as very short, the lines
# around an article in a stream of articles, and the words of the reports below.
SHORT_TEXT = 20
START_LINE = ">>>>START ARTICLE<<<<"
END_LINE = ">>>>END ARTICLE<<<<"


def select_pages(
    wiki: Wiki,
    category: str | None = None,
    page_id: int | None = None,
    random: bool = False,
    title: str | None = None,
    recursive: bool = False,
    seed: int = 0,
) -> DataFrame:
    """``page_id`` of the pages asked for. Of several ways given, the first in
    the order of the arguments counts."""
    spark = wiki.spark
    if category is not None:
        return category_set_pages(wiki, category, recursive)
    if page_id is not None:
        return literals(spark, [page_id], "page_id").select(F.col("page_id").cast("bigint"))
    if random:
        return random_pages(wiki, 1, seed=seed)
    if title is not None:
        asked = literals(spark, [title], "title")
        return resolve_titles(wiki, asked).where(F.col("page_id").isNotNull()).select("page_id")
    raise ValueError("give a category, a page id, a title or random")


def get_articles(wiki: Wiki, show_id: bool = False, **wanted) -> DataFrame:
    """``(page_id, text)`` of :func:`select_pages`, cleaned for reading; only
    the ids with ``show_id``. A page without a text has the empty one."""
    pages = select_pages(wiki, **wanted)
    if show_id:
        return pages
    pages, size = materialise(pages)
    texts = latest_text(wiki, pages, size).select("page_id", "text")
    # Settled on ids alone: bodies are joined once and then only cleaned.
    without = missing_pages(wiki, pages, size).select("page_id", F.lit("").alias("text"))
    cleaned = texts.select("page_id", apply_steps(F.col("text"), READER_STEPS).alias("text"))
    return cleaned.unionByName(without)


def check_articles(articles: DataFrame, min_length: int = SHORT_TEXT) -> DataFrame:
    """``(page_id, length, very_short, report)`` of cleaned articles."""
    length = F.length("text").cast("bigint")
    framed = F.concat(F.lit(">>>>"), "text", F.lit("<<<<"))
    short = F.concat(F.lit("Page with ID "), F.col("page_id").cast("string"), F.lit(" is very short: "), framed)
    long = F.concat(F.lit("Length: "), length.cast("string"), F.lit("\n"), framed)
    return articles.select(
        "page_id",
        length.alias("length"),
        (length < min_length).alias("very_short"),
        F.when(length < min_length, short).otherwise(long).alias("report"),
    )


def check_summary(checked: DataFrame) -> DataFrame:
    return checked.groupBy("very_short").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("length").alias("characters")
    )


def delimited(articles: DataFrame) -> DataFrame:
    """``value``: each article between its start and end line."""
    return articles.select(
        F.concat(F.lit(START_LINE + "\n"), "text", F.lit("\n" + END_LINE)).alias("value")
    )
