"""Cleaning of wiki markup as Column expressions: string in, string out, null
stays null. All of it is built-in regular expressions and string functions, so
a cleaning job is one map stage inside the JVM.

Regular expression flags: ``(?U)`` gives Unicode ``\\w \\s \\b``, ``(?d)`` lets
only ``\\n`` end a line, ``(?s)`` lets a dot match it. Loops over a character
class that cannot match what follows are possessive, so no text makes them
backtrack.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions import balanced
from pagequarry.functions.binding import let

# Code points of Unicode white space, trimmed from both ends.
WHITE_SPACE = "".join(
    map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)

# Prefixes of category links.
CATEGORY_PREFIXES = ("Category", "Kategorie")

# Language ids longer than three letters.
LONG_LANGUAGE_IDS = (
    "bat-smg", "be-x-old", "cbk-zam", "fiu-vro", "map-bms", "nds-nl",
    "roa-rup", "roa-tara", "simple", "zh-classical", "zh-min-nan", "zh-yue",
)

# The shorter list the article reader uses.
READER_LANGUAGE_IDS = (
    "simple", "bat-smg", "nds-nl", "be-x-old", "zh-yue", "map-bms", "zh-min-nan", "fiu-vro", "roa-rup",
)

# Labels of the person-data template, in order.
PERSON_LABELS = (
    "NAME", "ALTERNATIVNAMEN", "KURZBESCHREIBUNG", "GEBURTSDATUM", "GEBURTSORT", "STERBEDATUM", "STERBEORT",
)

# Schemes of external links, and the characters RFC 2396 allows in a URI.
URI_SCHEMES = ("http", "https", "ftp")
URI_CHARACTERS = r"[A-Za-z0-9\-_.!~*'();/?:@&=+$,%]"


def trim(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def remove_categories(text: Column) -> Column:
    """Category links with any number of pipes, the first sort key, then the
    white space at both ends. A leading colon protects a link."""
    for prefix in CATEGORY_PREFIXES:
        text = F.regexp_replace(text, rf"\[\[{prefix}:[^\[\]]++\]\]", "")
    # Only the first key: the match takes the rest of the text with it.
    return trim(F.regexp_replace(text, r"(?s)\{\{DEFAULTSORT:[^\n]+\}\}(.*+)", "$1"))


def remove_plain_categories(text: Column) -> Column:
    """The article reader's variant: one sort key after a pipe at most."""
    names = "|".join(reversed(CATEGORY_PREFIXES))
    return trim(F.regexp_replace(text, rf"\[\[(?:{names}):[^\[\]|]++(?:\|[^\[\]|]*+)?\]\]", ""))


def remove_interwiki_links(text: Column) -> Column:
    """Links whose prefix has two or three word characters or is a long
    language id, then the white space at both ends."""
    ids = "|".join(LONG_LANGUAGE_IDS)
    return trim(F.regexp_replace(text, rf"(?U)\[\[(?:\w{{2,3}}|{ids}):[^\[\]]++\]\]", ""))


def remove_plain_interwiki_links(text: Column) -> Column:
    """The article reader's variant: no pipe in the link; featured-article
    marks of other languages go too."""
    ids = "|".join(READER_LANGUAGE_IDS)
    text = F.regexp_replace(text, rf"(?U)\[\[(?:\w{{2,3}}|{ids}):[^\[\]|]++\]\]", "")
    return trim(F.regexp_replace(text, r"(?U)\{\{Link\sFA\|(?:\w{2,3}|simple)\}\}", ""))


def remove_balanced(text: Column, opener: str, closer: str, starter: str | None = None) -> Column:
    return balanced.remove_regions(text, balanced.Region.of(opener, closer, starter))


def remove_templates(text: Column) -> Column:
    return balanced.remove_regions(text, balanced.TEMPLATE)


def remove_tables(text: Column) -> Column:
    return balanced.remove_regions(text, balanced.TABLE)


def remove_images(text: Column) -> Column:
    """Image links with everything nested in them. Gallery tags go, what they
    enclose stays; other spellings are first brought to the German one."""
    for tag in ("<gallery>", "</gallery>"):
        text = F.replace(text, F.lit(tag), F.lit(""))
    text = F.regexp_replace(text, r"\[\[(?:[Ii]mage|bild):", "[[Bild:")
    return balanced.remove_regions(text, balanced.IMAGE)


def remove_math_markup(text: Column) -> Column:
    return balanced.remove_regions(text, balanced.MATH)


def remove_wiki_links(text: Column, schemes: Sequence[str] = URI_SCHEMES) -> Column:
    """Internal links become their caption, labelled external links their
    label, bare addresses vanish."""
    uri = rf"(?:{'|'.join(schemes)})://{URI_CHARACTERS}+"
    # The target may hold "]": its class excludes only "[" and "|".
    text = F.regexp_replace(text, r"\[\[(?:[^\[|]++\|)?([^\[\]]++)\]\]", "$1")

    def labels(part: Column) -> Column:
        # Up to the last "]" every opened link is closed somewhere, so none is
        # read to the end of the text in vain.
        tail = F.substring_index(part, "]", -1)
        closed = F.left(part, F.length(part) - F.length(tail))
        return F.concat(F.regexp_replace(closed, rf"(?U)\[{uri}+\s*+([^\]]*+)\]", "$1"), tail)

    return F.regexp_replace(let(text, labels), uri, "")


def remove_emphasis(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("'''"), F.lit("")), F.lit("''"), F.lit(""))


def remove_directives(text: Column) -> Column:
    return F.replace(text, F.lit("__NO_TOC__"), F.lit(""))


def remove_headlines(text: Column) -> Column:
    """Headlines with the line break before them, deepest level first. What
    stands between the marks may run over several lines."""
    for level in range(5, 0, -1):
        marks = "=" * level
        headline = rf"{marks}[^=]++{marks}"
        # The first line has no line break before it. Asking for one elsewhere
        # lets the search pass over a text quickly.
        text = let(
            text,
            lambda t: F.when(t.startswith(marks), F.regexp_replace(t, rf"\A{headline}", "")).otherwise(t),  # noqa: B023
        )
        text = F.regexp_replace(text, rf"\n{headline}", "")
    return text


def remove_headline_markup(text: Column) -> Column:
    """Keeps the words of a headline, bounded by word characters on both
    sides, without the marks and the white space around them."""
    for level in range(5, 0, -1):
        marks = "=" * level
        text = F.regexp_replace(text, rf"(?mdU)^{marks}\s*(\b[^=]+\b)\s*{marks}", "$1")
    return text


def remove_empty_pairs(text: Column) -> Column:
    for pair in ("[]", "()", "{}"):
        text = F.replace(text, F.lit(pair), F.lit(""))
    return text


def tighten_parentheses(text: Column) -> Column:
    return F.regexp_replace(text, r"\([;,]", "(")


def remove_unnecessary_whitespace(text: Column) -> Column:
    """No white space before punctuation or after "(", single spaces
    elsewhere, at most one removed at either end."""
    text = F.regexp_replace(text, r"(?U)\s([,.!?:])", "$1")
    text = F.regexp_replace(text, r"(?U)\(\s", "(")
    text = F.regexp_replace(text, r"(?U)\s++", " ")
    return F.regexp_replace(text, r"\A | \z", "")


# White space may surround the pipe of the first label only.
_PERSON_HEAD = r"(?U)\{\{Personendaten\s*\|\s*NAME="
_PERSON_MARKS = [f"|{label}=" for label in PERSON_LABELS[1:]] + ["}}"]


def person_parts(text: Column) -> Column:
    """What is before the first person-data template, its seven values, and what
    is behind it; null without one.

    Values reach as far as they can: each mark is taken at the last place that
    still has the later marks behind it. So the marks are looked for from the
    end backwards, each once, whatever incomplete templates the text holds.
    """

    def step(state: Column, mark: Column) -> Column:
        value = F.call_function("substring_index", state["rest"], mark, F.lit(-1))
        found = F.contains(state["rest"], mark)
        before = F.left(state["rest"], F.length(state["rest"]) - F.length(value) - F.length(mark))
        return F.struct(
            F.when(found, before).alias("rest"), F.when(found, F.concat(F.array(value), state["parts"])).alias("parts")
        )

    def parts(halves: Column) -> Column:
        marks = F.array(*[F.lit(m) for m in reversed(_PERSON_MARKS)])
        zero = F.struct(F.get(halves, F.lit(1)).alias("rest"), F.array().cast("array<string>").alias("parts"))
        whole = lambda s: F.when(F.length(s["rest"]) > 0, F.concat(F.array(F.get(halves, F.lit(0)), s["rest"]), s["parts"]))
        return F.aggregate(marks, zero, step, whole)

    cheap = text.contains("{{Personendaten") & text.contains("|STERBEORT=")
    return F.when(cheap, let(F.split(text, _PERSON_HEAD, 2), parts))


def has_person_data(text: Column) -> Column:
    return person_parts(text).isNotNull()


def remove_person_data(text: Column) -> Column:
    """The first person-data template becomes its first six values; then the
    white space at both ends goes."""

    def replaced(t: Column) -> Column:
        joined = lambda p: F.concat(p[0], F.array_join(F.slice(p, 2, 6), " "), p[8])
        return let(person_parts(t), lambda p: F.when(p.isNotNull(), joined(p)).otherwise(t))

    return trim(let(text, replaced))


def person_field(text: Column, number: int) -> Column:
    """Value ``number`` (1 to 7) of the template, null without one."""
    return F.get(person_parts(text), F.lit(number))


def wiki_to_plaintext(text: Column, headlines: str = "drop") -> Column:
    """Whole cleaning for plain text. ``headlines`` is ``drop`` or
    ``keep_text``."""
    if headlines not in ("drop", "keep_text"):
        raise ValueError(f"headlines: {headlines!r}")
    for step in (
        remove_images,
        remove_templates,
        remove_headlines if headlines == "drop" else remove_headline_markup,
        remove_tables,
        remove_categories,
        remove_interwiki_links,
        remove_wiki_links,
        remove_emphasis,
        remove_directives,
        tighten_parentheses,
        remove_empty_pairs,
        remove_unnecessary_whitespace,
    ):
        text = step(text)
    return text
