"""Title expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two title prefixes that name the template namespace.
TEMPLATE_TITLE = r"(?d)^(?:Template|Vorlage):(.*)$"


def upper_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 2**31 - 1))


def normalize_title(title: Column) -> Column:
    """Stored form of a title: every whitespace character becomes ``_`` and
    the first character is upper-cased."""
    return upper_first(F.regexp_replace(title, r"(?U)\s", "_"))


def normalize_dump_title(title: Column) -> Column:
    """Title as written in a dump: the first letter is upper-cased, after the
    namespace if there is one; spaces stay."""
    pattern = r"(?d)^(.+?):(.+)"
    name = F.regexp_extract(title, pattern, 1)
    rest = F.regexp_extract(title, pattern, 2)
    return F.when(title.rlike(pattern), F.concat(name, F.lit(":"), upper_first(rest))).otherwise(
        upper_first(title)
    )


def underscored(title: Column) -> Column:
    """Import form: spaces become ``_``, nothing is capitalised."""
    return F.translate(title, " ", "_")


def is_template_title(title: Column) -> Column:
    return title.rlike(TEMPLATE_TITLE)


def without_template_prefix(title: Column) -> Column:
    return F.when(is_template_title(title), F.regexp_extract(title, TEMPLATE_TITLE, 1)).otherwise(title)
