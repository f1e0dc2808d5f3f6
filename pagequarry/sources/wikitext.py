"""Plain files of wiki text."""

from pyspark.sql import DataFrame, SparkSession


def read_wikitext_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column ``line``; compressed files by their suffix."""
    return spark.read.text(path).withColumnRenamed("value", "line")
