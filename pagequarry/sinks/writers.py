"""Writers. Everything is written by the tasks that hold the rows."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagequarry.operators.categories import page_category_lists
from pagequarry.operators.importing import Imported, import_pages, narrowed
from pagequarry.plans.articles import delimited
from pagequarry.plans.corpus import Corpus
from pagequarry.session import drop_scratch, scratch_path
from pagequarry.sinks.versions import replace_tables


def write_member_lists(labels: DataFrame, path: str, folders: bool = False) -> None:
    """``(category, page_id)`` as Parquet, sorted over all files.

    The range is taken over category and page id, so a category larger than a
    task is written by several of them, and few files hold all small ones. With
    ``folders`` page ids are written as lines in a folder for each category,
    named by :func:`folder_name`.
    """
    if not folders:
        rows = labels.select("category", "page_id")
        rows.repartitionByRange("category", "page_id").sortWithinPartitions("category", "page_id").write.mode("overwrite").parquet(path)
        return
    named = labels.select(folder_name(F.col("category")).alias("folder"), F.col("page_id").cast("string").alias("value"))
    named.repartitionByRange("folder", "value").sortWithinPartitions("folder", "value").write.mode("overwrite").partitionBy("folder").text(path)


def folder_name(category: Column) -> Column:
    """A name any file system takes: the title's plain characters, at most 80
    of them, and a digest that tells titles apart."""
    plain = F.substring(F.regexp_replace(category, "[^A-Za-z0-9_-]", "_"), 1, 80)
    return F.concat(plain, F.lit("-"), F.md5(category))


def write_articles(articles: DataFrame, path: str) -> None:
    """``(page_id, text)`` as Parquet, where the rows are: texts are not moved
    again for an order of files."""
    articles.select("page_id", "text").write.mode("overwrite").parquet(path)


def write_category_lists(lists: DataFrame, path: str) -> None:
    """``(page_id, part, categories)`` with the names one per line."""
    lists.select("page_id", "part", F.concat_ws("\n", "categories").alias("categories")).write.mode(
        "overwrite"
    ).parquet(path)


def write_label_pairs(labels: DataFrame, path: str) -> None:
    """Page id, tab, category; one pair per line, names as they are."""
    pair = F.concat_ws("\t", F.col("page_id").cast("string"), "category")
    labels.select(pair.alias("value")).write.mode("overwrite").text(path)


def write_corpus(corpus: Corpus, path: str, articles: bool = True) -> None:
    """Member lists, articles, category lists and label pairs; without
    ``articles`` no text is read and the lists cover the pages that have one."""
    write_member_lists(corpus.labels, f"{path}/categories")
    write_label_pairs(corpus.labels, f"{path}/page_categories")
    if not articles:
        labels = corpus.labels.join(corpus.missing, "page_id", "left_anti")
        write_category_lists(page_category_lists(labels), f"{path}/category_mappings")
        return
    write_articles(corpus.articles, f"{path}/articles")
    # The lists follow the articles written: their texts are not made twice.
    written = corpus.articles.sparkSession.read.parquet(f"{path}/articles")
    write_category_lists(replace(corpus, articles=written).label_lists(), f"{path}/category_mappings")


def write_hierarchy(lines: DataFrame, path: str) -> None:
    """Label-hierarchy lines, sorted over all files by label."""
    lines.orderBy("category", "part").select("value").write.mode("overwrite").text(path)


def write_delimited(articles: DataFrame, path: str) -> None:
    delimited(articles).write.mode("overwrite").text(path)


def write_wiki_tables(imported: Imported, base: str, prefix: str = "") -> None:
    """page, revision, text and rejected as Parquet; they replace those at
    ``base`` together (:mod:`pagequarry.sinks.versions` has where they are)."""
    names = ("page", "revision", "text", "rejected")
    replace_tables({name: getattr(imported, name) for name in names}, base, prefix)


def save_wiki_tables(imported: Imported, database: str, prefix: str = "", buckets: int | None = None) -> None:
    """The same as catalog tables. With ``buckets`` the bodies are bucketed by
    their id and the revisions by their page, so later lookups of latest texts
    move ids only and leave the bodies where they are."""
    keys = {"page": "page_id", "revision": "rev_page", "text": "old_id"}
    for name, key in keys.items():
        writer = getattr(imported, name).write.mode("overwrite")
        if buckets:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"`{database}`.`{prefix}{name}`")


def import_dump(raw: DataFrame, namespaces: DataFrame, base: str, prefix: str = "") -> dict:
    """Raw pages to the three tables and the rejected rows at ``base``, which
    they replace together; returns pages, revisions, seconds and rates.

    The dump is parsed once, into a columnar copy in the shared folder with the
    bodies in a column of their own; page, revision and rejected rows read none
    of them. The counts are observed while that copy is written.
    """
    spark = raw.sparkSession
    started = time.monotonic()
    seen = Observation("import")
    staged = scratch_path(spark, "raw-pages")
    narrowed(raw).observe(
        seen, F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(F.size("revision")), F.lit(0)).alias("revisions")
    ).write.parquet(staged)
    imported = import_pages(spark.read.parquet(staged), namespaces)
    write_wiki_tables(imported, base, prefix)
    drop_scratch(spark, staged)
    seconds = max(time.monotonic() - started, 1e-3)
    counts = seen.get
    return {
        **counts,
        "seconds": seconds,
        "pages_per_second": counts["pages"] / seconds,
        "revisions_per_second": counts["revisions"] / seconds,
    }
