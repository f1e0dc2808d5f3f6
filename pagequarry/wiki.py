"""The four tables of one wiki, with its namespace numbers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pagequarry.session import tune
from pagequarry.sinks.versions import table_paths

TABLES = ("page", "revision", "text", "categorylinks")


def database_name(language: str = "de", database: str | None = None) -> str:
    """The given database, or ``<language>wiki``."""
    return database or f"{language}wiki"


@dataclass(frozen=True)
class Wiki:
    """DataFrames of the tables every lookup reads.

    ``namespace`` is the namespace of the articles; ``encoding`` decodes texts
    whose flags do not say ``utf-8``.
    """

    page: DataFrame
    categorylinks: DataFrame
    revision: DataFrame | None = None
    text: DataFrame | None = None
    namespace: int = 0
    category_namespace: int = 14
    template_namespace: int = 10
    encoding: str = "ISO-8859-1"

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        database: str | None = None,
        prefix: str = "",
        language: str = "de",
        **settings,
    ) -> "Wiki":
        """Tables ``<database>.<prefix>page`` and so on of the catalog."""
        tune(spark)
        name = database_name(language, database)
        return cls(**{t: spark.table(f"`{name}`.`{prefix}{t}`") for t in TABLES}, **settings)

    @classmethod
    def from_path(cls, spark: SparkSession, base: str, prefix: str = "", **settings) -> "Wiki":
        """Parquet folders ``<base>/<prefix>page`` and so on, or those of the
        set that an import wrote there last."""
        tune(spark)
        paths = table_paths(spark, base, list(TABLES), prefix)
        return cls(**{t: spark.read.parquet(paths[t]) for t in TABLES}, **settings)

    @property
    def spark(self) -> SparkSession:
        return self.page.sparkSession
