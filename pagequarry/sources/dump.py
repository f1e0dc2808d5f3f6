"""XML page dumps.

A dump is one huge element, and the XML source reads a file as a whole. Here
the text source cuts it at every ``</page>`` instead: the file is split among
tasks (bzip2 files too), and each record is parsed where it was read. The
delimiter cannot occur inside a page, as markup in texts is escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.scale import literals
from pagequarry.schemas import NAMESPACES, RAW_PAGE, SITEINFO

PAGE_END = "</page>"
CORRUPT = "_corrupt_record"
XML_OPTIONS = {
    "ignoreSurroundingSpaces": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


def page_xml(value: Column) -> Column:
    """The page element of a record; the first record also holds the header."""
    return F.concat(F.substring(value, F.instr(value, "<page>"), F.lit(2**31 - 1)), F.lit(PAGE_END))


def parse_pages(records: DataFrame, *keep: str) -> DataFrame:
    """Raw pages of text records cut at the page end. ``_corrupt_record`` holds
    the source of a page that is no well-formed XML."""
    schema = T.StructType(RAW_PAGE.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        records.where(F.instr("value", "<page>") > 0)
        .select(*keep, F.from_xml(page_xml(F.col("value")), schema, XML_OPTIONS).alias("p"))
        .select(*keep, "p.*")
    )


def read_pages(spark: SparkSession, path: str | list[str], with_position: bool = False) -> DataFrame:
    """Pages of the dump file or files at ``path``, compressed or not.

    ``with_position`` adds ``position``, a struct that orders pages as they
    stand in the files (file, block, running number inside the block).
    """
    records = spark.read.option("lineSep", PAGE_END).text(path)
    if not with_position:
        return parse_pages(records)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
    )
    return parse_pages(records.select("value", position.alias("position")), "position")


def well_formed(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_pages(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_siteinfo(spark: SparkSession, path: str | list[str], require_case: str | None = None) -> DataFrame:
    """Header of the dump: one row with site name, address, generator, case
    rule and namespaces.

    Only the header travels: the search stops at the first record holding it,
    so the rest of the dump is not read.
    """
    found = (
        spark.read.option("lineSep", PAGE_END)
        .text(path)
        .where(F.instr("value", "</siteinfo>") > 0)
        .select(F.regexp_extract("value", r"(?s)<siteinfo>.*?</siteinfo>", 0).alias("header"))
        .take(1)
    )
    if not found:
        raise ValueError(f"no siteinfo in {path}")
    info = (
        literals(spark, [found[0]["header"]], "header")
        .select(F.from_xml("header", SITEINFO, {"mode": "FAILFAST"}).alias("s"))
        .select("s.*")
    )
    if require_case is not None:
        case = info.first()["case"]
        if case != require_case:
            raise ValueError(f"unable to handle the case setting {case!r}")
    return info


def read_namespaces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(ns_id, ns_name)``; the main namespace has the empty name."""
    return read_siteinfo(spark, path).select(F.explode("namespaces.namespace").alias("n")).select(
        F.col("n._key").cast(NAMESPACES["ns_id"].dataType).alias("ns_id"),
        F.coalesce(F.col("n._VALUE"), F.lit("")).alias("ns_name"),
    )
