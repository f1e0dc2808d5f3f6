"""Rendering of wiki text to plain text: line by line, or by blocks of lines."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.binding import let
from pagequarry.functions.markup import URI_CHARACTERS, URI_SCHEMES

# How a rule, a numbered item and any other item are printed.
RULE = "-" * 40
NUMBERED_ITEM = "# "
ITEM = "* "

# The first characters of a code line, which are not printed.
CODE_MARK = "^(?: |\\t+)"
BREAK, RULED, HEADLINE, CODE, NUMBERED, OTHER_ITEM, PARAGRAPH = "break", "rule", "headline", "code", "numbered", "item", "paragraph"


def render_lines(text: Column) -> Column:
    """Plain text of every line on its own; works for one line and for a whole
    page, as no pattern crosses a line break.

    A line of four or more dashes becomes a rule. List marks become one item
    mark, chosen by the last of them. A headline becomes its words. Bold and
    italic marks vanish, links become their label.
    """
    uri = rf"(?:{'|'.join(URI_SCHEMES)})://{URI_CHARACTERS}++"
    steps = (
        (r"(?md)^-{4,}[ \t]*$", RULE),
        (r"(?md)^[*#:;]*+(?<=#)[ \t]*+", NUMBERED_ITEM),
        (r"(?md)^[*#:;]*+(?<=[*:;])[ \t]*+", ITEM),
        (r"(?md)^(={1,6})[ \t]*([^=\n](?:[^\n]*[^=\s])?)[ \t]*\1[ \t]*$", "$2"),
        (r"'{2,5}", ""),
        (r"\[\[(?:[^\[\]|\n]++\|)?([^\[\]|\n]++)\]\]", "$1"),
        (rf"\[{uri}[ \t]++([^\]\n]++)\]", "$1"),
        (rf"\[({uri})\]", "$1"),
    )
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def line_kind(line: Column) -> Column:
    """What a line is: the first of these that fits.

    ``break`` (blank), ``rule`` (four or more dashes), ``headline``, ``code``
    (begins with a blank or tabs), ``numbered`` and ``item`` (list marks, by the
    last of them), ``paragraph``.
    """
    return (
        F.when(line.rlike(r"^[ \t\r]*$"), BREAK)
        .when(line.rlike(r"^-{4,}[ \t]*$"), RULED)
        .when(line.rlike(r"^(={1,6})[ \t]*([^=](?:.*[^=\s])?)[ \t]*\1[ \t]*$"), HEADLINE)
        .when(line.rlike(CODE_MARK), CODE)
        .when(line.rlike(r"^[*#:;]*#(?:[^*#:;]|$)"), NUMBERED)
        .when(line.rlike(r"^[*#:;]"), OTHER_ITEM)
        .otherwise(PARAGRAPH)
    )


def render_blocks(text: Column) -> Column:
    """The blocks of a page, an array of ``(kind, text)``.

    Neighbouring lines of one kind are one block: a paragraph, a code block, the
    items of a list from its first to its last. Rules and headlines stand alone,
    blank lines end a block and belong to none. Code lines are printed as they
    are, without their mark; all others as :func:`render_lines` prints them. A
    null page has null blocks, an empty one none.

    A page is split once, and every line is in one slice: linear in the text.
    """

    def of_line(source: Column, printed: Column) -> Column:
        shown = lambda kind: F.when(kind == CODE, F.regexp_replace(source, CODE_MARK, "")).otherwise(printed)
        return let(line_kind(source), lambda kind: F.struct(kind.alias("kind"), shown(kind).alias("text")))

    def begins(lines: Column, at: Column) -> Column:
        kind = F.get(lines, at)["kind"]
        alone = kind.isin(RULED, HEADLINE)
        return (kind != BREAK) & ((at == 0) | alone | (kind != F.get(lines, at - 1)["kind"]))

    def blocks(lines: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda at: begins(lines, at))

        def block(starts: Column, at: Column, n: Column) -> Column:
            end = F.coalesce(F.get(starts, n + 1), F.size(lines))
            own = F.filter(F.slice(lines, at + 1, end - at), lambda line: line["kind"] != BREAK)
            return F.struct(F.get(lines, at)["kind"].alias("kind"), F.array_join(F.transform(own, lambda line: line["text"]), "\n").alias("text"))

        return let(starts, lambda found: F.transform(found, lambda at, n: block(found, at, n)))

    # No rule of a line crosses a line break, so both have the same lines.
    lines = F.zip_with(F.split(text, "\n"), F.split(render_lines(text), "\n"), of_line)
    return F.when(text.isNotNull(), let(lines, blocks))


def render_page(text: Column) -> Column:
    """Plain text of a page by blocks: a line break between them, and an empty
    line behind a paragraph that others follow."""

    def joined(blocks: Column) -> Column:
        gap = lambda block, n: F.when((block["kind"] == PARAGRAPH) & (n < F.size(blocks) - 1), "\n").otherwise("")
        return F.array_join(F.transform(blocks, lambda block, n: F.concat(block["text"], gap(block, n))), "\n")

    return let(render_blocks(text), joined)
