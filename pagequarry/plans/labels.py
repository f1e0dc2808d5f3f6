"""Lines of a label-hierarchy file."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.hierarchy import label_hierarchy
from pagequarry.wiki import Wiki


def hierarchy_lines(wiki: Wiki, root: str, min_members: int = 1) -> DataFrame:
    """``(category, part, value)`` with ``value`` = ``category: above above``.
    A label with a very long list takes several lines, one per part."""
    return label_hierarchy(wiki, root, min_members).select(
        "category", "part", F.concat("category", F.lit(": "), "supercategories").alias("value")
    )
