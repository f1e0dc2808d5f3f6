"""pagequarry: wiki-dump analytics as Spark DataFrame jobs."""

from pagequarry.wiki import Wiki

__all__ = ["Wiki"]
