"""Cleaning jobs over page tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions import markup

Step = Callable[[Column], Column]

# Steps of a corpus export, in order.
CORPUS_STEPS: tuple[Step, ...] = (
    markup.remove_categories,
    markup.remove_interwiki_links,
    markup.remove_person_data,
)

# Steps of the article reader, in order.
READER_STEPS: tuple[Step, ...] = (markup.remove_plain_categories, markup.remove_plain_interwiki_links)


def apply_steps(text: Column, steps: Sequence[Step]) -> Column:
    for step in steps:
        text = step(text)
    return text


def clean_pages(pages: DataFrame, steps: Sequence[Step] = CORPUS_STEPS) -> DataFrame:
    """``pages`` with its ``text`` cleaned and ``removed``, one entry per step:
    its name and how many characters it took away."""
    others = [c for c in pages.columns if c != "text"]
    nothing = F.array().cast("array<struct<step:string,characters:bigint>>")
    current = pages.select(*others, "text", nothing.alias("removed"))
    for step in steps:
        current = current.withColumn("_next", step(F.col("text"))).select(
            *others,
            F.col("_next").alias("text"),
            F.concat(
                "removed",
                F.array(
                    F.struct(
                        F.lit(step.__name__).alias("step"),
                        (F.length("text") - F.length("_next")).cast("bigint").alias("characters"),
                    )
                ),
            ).alias("removed"),
        )
    return current


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """``(step, pages, characters)``: pages a step changed the length of, and
    all characters it removed."""
    return (
        # The outer form: an inner one would push a test of the array, and with
        # it every step again, below the projections.
        cleaned.select(F.explode_outer("removed").alias("r"))
        .groupBy(F.col("r.step").alias("step"))
        .agg(
            F.count_if(F.col("r.characters") != 0).alias("pages"),
            F.sum("r.characters").alias("characters"),
        )
    )


def extract_person_data(pages: DataFrame) -> DataFrame:
    """``(page_id, name, ...)``: the seven values of the person-data template,
    one row per page that has one."""
    found = pages.where(markup.has_person_data(F.col("text")))
    return found.select(
        "page_id",
        *[
            markup.person_field(F.col("text"), i).alias(label.lower())
            for i, label in enumerate(markup.PERSON_LABELS, 1)
        ],
    )
