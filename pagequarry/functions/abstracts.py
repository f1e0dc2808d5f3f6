"""Abstracts: the beginning of a text up to a good full stop."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.binding import let

# Bounds of the full stop's position, how many dots are looked
# at, the length kept without one, and words whose dot ends no sentence.
MIN_CHARACTERS = 250
MAX_CHARACTERS = 450
DOTS = 15
FALLBACK_CHARACTERS = 400
ABBREVIATIONS = ("ahd", "lat", "dt", "engl", "jap", "mhd", "bzw", "op")


def dot_positions(text: Column) -> Column:
    """0-based positions of the first dots of ``text``."""
    found = F.transform(F.sequence(F.lit(1), F.lit(DOTS)), lambda i: F.length(F.call_function("substring_index", text, F.lit("."), i)))
    # With fewer dots than i the whole text comes back: its length is no dot.
    return F.filter(found, lambda p: p < F.length(text))


def is_abbreviation_dot(text: Column, position: Column) -> Column:
    """A dot right behind one of the words (no word boundary is asked for
    before it), or at position 1 to 3, where no such word can be missing."""
    before = F.substring(text, F.lit(1), position)
    return before.rlike(f"(?:{'|'.join(ABBREVIATIONS)})\\z") | position.between(1, 3)


def extract_abstract(text: Column) -> Column:
    """Up to the last full stop between the bounds; without one the first
    characters, less the last word of every line."""
    # Nothing behind the upper bound matters, so only the head is looked at.
    return let(F.substring(text, 1, MAX_CHARACTERS + 1), _abstract_of_head)


def _abstract_of_head(head: Column) -> Column:
    def is_good(p: Column) -> Column:
        return (p > MIN_CHARACTERS) & (p < MAX_CHARACTERS) & ~is_abbreviation_dot(head, p)

    stop = F.array_max(F.filter(dot_positions(head), is_good))
    words = F.regexp_replace(F.substring(head, 1, FALLBACK_CHARACTERS), r"(?mdU)(\s+\S+)$", "")
    return F.coalesce(F.substring(head, F.lit(1), stop + 1), words)
