"""Raw pages to the page, revision and text tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.titles import underscored
from pagequarry.scale import broadcast_if_small

# The only timestamp form taken, and the mark of a redirect.
TIMESTAMP_FORM = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"
REDIRECT_FORM = r"(?i)\A#REDIRECT "

NUMBER_FORM = r"^\d+$"
TEXT_FLAGS = "utf-8"


@dataclass(frozen=True)
class Imported:
    page: DataFrame
    revision: DataFrame
    text: DataFrame
    rejected: DataFrame


def is_number(value: Column) -> Column:
    return F.coalesce(value.rlike(NUMBER_FORM), F.lit(False))


def number(value: Column) -> Column:
    return F.when(is_number(value), value.try_cast("bigint"))


def is_timestamp(value: Column) -> Column:
    return F.coalesce(value.rlike(TIMESTAMP_FORM), F.lit(False))


def parse_timestamp(value: Column) -> Column:
    """Timestamp of the ISO form, null for anything else."""
    return F.when(is_timestamp(value), F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))


def compact_timestamp(value: Column) -> Column:
    """The fourteen digits of the ISO form, null for anything else."""
    return F.when(is_timestamp(value), F.regexp_replace(value, r"[-T:Z]", ""))


def is_redirect(text: Column) -> Column:
    return F.coalesce(text.rlike(REDIRECT_FORM), F.lit(False)).cast("int")


def byte_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def contributor_name(contributor: Column) -> Column:
    return F.coalesce(contributor["username"], contributor["ip"], F.lit(""))


def contributor_id(contributor: Column) -> Column:
    return F.coalesce(number(contributor["id"]), F.lit(0))


def minor_flag(minor: Column) -> Column:
    return minor.isNotNull().cast("int")


def split_namespace(raw: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Adds ``namespace`` and ``bare_title``: a title that begins with a known
    namespace and a colon loses both. Case matters; an unknown prefix stays and
    means the main namespace. The main namespace has the empty name, so a
    leading colon is taken off as well."""
    known = namespaces.groupBy("ns_name").agg(F.max("ns_id").alias("_ns"))
    prefix = F.when(F.col("title").contains(":"), F.substring_index("title", ":", 1))
    rest = F.substring(F.col("title"), F.length("ns_name") + 2, F.length("title"))
    return (
        raw.withColumn("_prefix", prefix)
        .join(broadcast_if_small(known), F.col("_prefix") == F.col("ns_name"), "left")
        .withColumn("namespace", F.coalesce("_ns", F.lit(0)))
        .withColumn("bare_title", F.when(F.col("ns_name").isNull(), F.col("title")).otherwise(rest))
        .drop("_prefix", "_ns", "ns_name")
    )


def narrowed(raw: DataFrame) -> DataFrame:
    """``raw`` with the bodies apart: ``revision`` holds ``length`` and
    ``redirect`` in place of the text, ``texts`` the texts in the same order.

    Written once in this form, page, revision and rejected rows are read without
    the column of bodies. Pages in this form already are returned as they are.
    """
    if "texts" in raw.columns:
        return raw

    def narrow(r: Column) -> Column:
        text = F.coalesce(r["text"], F.lit(""))
        kept = [r[n].alias(n) for n in ("id", "timestamp", "contributor", "minor", "comment")]
        return F.struct(*kept, byte_length(text).alias("length"), is_redirect(text).alias("redirect"))

    texts = F.transform("revision", lambda r: r["text"])
    return raw.withColumns({"revision": F.transform("revision", narrow), "texts": texts})


def page_rows(raw: DataFrame, namespaces: DataFrame) -> DataFrame:
    """One row per page, described by its first revision."""
    first = F.get("revision", F.lit(0))
    if "texts" in raw.columns:
        length, redirect = F.coalesce(first["length"], F.lit(0)), F.coalesce(first["redirect"], F.lit(0))
    else:
        text = F.coalesce(first["text"], F.lit(""))
        length, redirect = byte_length(text), is_redirect(text)
    return split_namespace(raw, namespaces).select(
        number(F.col("id")).alias("page_id"),
        F.col("namespace").alias("page_namespace"),
        underscored(F.col("bare_title")).alias("page_title"),
        F.coalesce("restrictions", F.lit("")).alias("page_restrictions"),
        F.lit(0).cast("bigint").alias("page_counter"),
        redirect.alias("page_is_redirect"),
        F.lit(0).alias("page_is_new"),
        F.rand().alias("page_random"),
        F.current_timestamp().alias("page_touched"),
        number(first["id"]).alias("page_latest"),
        length.alias("page_len"),
    )


def exploded(raw: DataFrame) -> DataFrame:
    return raw.select("title", F.col("id").alias("page"), F.explode("revision").alias("r"))


def with_texts(raw: DataFrame) -> DataFrame:
    """One row ``(r, text)`` for each revision."""
    if "texts" not in raw.columns:
        return exploded(raw).withColumn("text", F.col("r.text"))
    pairs = raw.select(F.explode(F.arrays_zip("revision", "texts")).alias("z"))
    return pairs.select(F.col("z.revision").alias("r"), F.col("z.texts").alias("text"))


def accepted(revisions: DataFrame) -> DataFrame:
    """Revisions with a numeric id and a well-formed timestamp."""
    return revisions.where(is_number(F.col("r.id")) & is_timestamp(F.col("r.timestamp")))


def revision_rows(raw: DataFrame) -> DataFrame:
    r = F.col("r")
    return accepted(exploded(raw)).select(
        number(r["id"]).alias("rev_id"),
        number(F.col("page")).alias("rev_page"),
        number(r["id"]).alias("rev_text_id"),
        F.coalesce(r["comment"], F.lit("")).alias("rev_comment"),
        contributor_id(r["contributor"]).alias("rev_user"),
        contributor_name(r["contributor"]).alias("rev_user_text"),
        parse_timestamp(r["timestamp"]).alias("rev_timestamp"),
        minor_flag(r["minor"]).alias("rev_minor_edit"),
        F.lit(0).alias("rev_deleted"),
    )


def text_rows(raw: DataFrame) -> DataFrame:
    return accepted(with_texts(raw)).select(
        number(F.col("r.id")).alias("old_id"),
        F.coalesce("text", F.lit("")).alias("old_text"),
        F.lit(TEXT_FLAGS).alias("old_flags"),
    )


def rejected_rows(raw: DataFrame) -> DataFrame:
    """``(title, page, revision, reason, value)`` of everything a check
    complained about. A bogus page id is a warning: its rows are kept, with a
    null id. A bogus revision id or timestamp drops revision and text."""
    pages = raw.where(~is_number(F.col("id"))).select(
        "title",
        F.col("id").alias("page"),
        F.lit(None).cast("string").alias("revision"),
        F.lit("page id").alias("reason"),
        F.col("id").alias("value"),
    )
    bad_id = ~is_number(F.col("r.id"))
    revisions = exploded(raw).where(bad_id | ~is_timestamp(F.col("r.timestamp"))).select(
        "title",
        "page",
        F.col("r.id").alias("revision"),
        F.when(bad_id, "revision id").otherwise("timestamp").alias("reason"),
        F.when(bad_id, F.col("r.id")).otherwise(F.col("r.timestamp")).alias("value"),
    )
    return pages.unionByName(revisions)


def skip_loaded(raw: DataFrame, loaded_pages: DataFrame) -> DataFrame:
    """Pages not loaded yet: what a run started again has left to do."""
    done = loaded_pages.select(F.col("page_id").alias("_done"))
    return raw.join(done, number(F.col("id")) == F.col("_done"), "left_anti")


def statistics_columns() -> list[Column]:
    """Pages, revisions and bytes of text, as aggregates over raw pages."""
    texts = F.transform("revision", lambda r: byte_length(r["text"]))
    size = F.aggregate(texts, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return [
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.sum(F.size("revision")), F.lit(0)).cast("bigint").alias("revisions"),
        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("text_bytes"),
    ]


def import_statistics(raw: DataFrame) -> DataFrame:
    """Pages, revisions and bytes of text, in one pass with partial sums."""
    return raw.agg(*statistics_columns())


def import_pages(raw: DataFrame, namespaces: DataFrame) -> Imported:
    """The three tables and the rejected rows of raw pages, in either form."""
    return Imported(page_rows(raw, namespaces), revision_rows(raw), text_rows(raw), rejected_rows(raw))
