"""Removal of nested, balanced regions (templates, tables, images, formulas).

A region begins at a starter found outside any region and ends where the
openers and closers after it balance. A region that never closes is kept, and
everything behind its start with it.

Nearly every page is finished by one regular expression, which matches regions
up to ``NESTING`` levels deep with possessive loops: linear time, constant
stack. A second one settles the pages where a region is plainly left open. What
remains is cut where its unclosed region begins, found by a fold over its
tokens, and the part before it is done alone. Where regions are nested deeper a
fold over its tokens keeps those outside, in time linear in the text.

Where one delimiter begins with the other, or the starter does not begin with
the opener, what a character belongs to depends on the depth, and no fixed
tokens exist: a fold over the places of all delimiters decides (``fold_any``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.binding import let

NESTING = 10
CHUNK = 512  # tokens collected together


@dataclass(frozen=True)
class Region:
    """Markers of one kind of region and the text that can lie between them.

    ``starter``, ``opener`` and ``closer`` are literal. ``filler`` is a regular
    expression for text holding no opener and no closer.
    """

    starter: str
    opener: str
    closer: str
    filler: str

    def __post_init__(self) -> None:
        if not (self.starter and self.opener and self.closer):
            raise ValueError("empty delimiters are not allowed")
        if self.opener == self.closer:
            raise ValueError(f"opener and closer are the same: {self.opener!r}")

    @property
    def plain(self) -> bool:
        """Whether the text falls into the same tokens at every depth."""
        nested = self.opener.startswith(self.closer) or self.closer.startswith(self.opener)
        return not nested and self.starter.startswith(self.opener) and not self.overlapping

    @property
    def overlapping(self) -> bool:
        """Whether a closer found outside a region could swallow the beginning
        of a starter."""
        return any(self.starter.startswith(self.closer[-k:]) for k in range(1, len(self.closer)))

    @staticmethod
    def of(opener: str, closer: str, starter: str | None = None) -> "Region":
        """Region for any delimiters. The filler goes character by character
        past whatever is neither of the two."""
        starter = starter or opener
        filler = f"(?!{quoted(opener)}|{quoted(closer)})." if opener and closer else ""
        return Region(starter, opener, closer, filler)

    def nested(self, first: str, depth: int) -> str:
        """Pattern of a closed region beginning with ``first``."""
        inner = f"{quoted(self.opener)}(?:{self.filler})*+{quoted(self.closer)}"
        for _ in range(depth - 2):
            inner = f"{quoted(self.opener)}(?:{self.filler}|{inner})*+{quoted(self.closer)}"
        return f"{quoted(first)}(?:{self.filler}|{inner})*+{quoted(self.closer)}"


def quoted(literal: str) -> str:
    return "".join("\\" + c if c in r"\[]{}()|*+?.^$" else c for c in literal)


# The delimiters of the four kinds of region.
TEMPLATE = Region("{{", "{{", "}}", r"[^{}]++|\{(?!\{)|\}(?!\})")
TABLE = Region("{|", "{|", "|}", r"[^{|}]++|\{(?!\|)|\|(?!\})|\}")
IMAGE = Region("[[Bild:", "[[", "]]", r"[^\[\]]++|\[(?!\[)|\](?!\])")
MATH = Region("<math>", "<math>", "</math>", r"[^<]++|<(?!/?math>)")


def remove_regions(text: Column, region: Region, nesting: int = NESTING) -> Column:
    """``text`` without the closed regions."""
    if not region.plain:
        return fold_any(text, region)
    starter, closed = quoted(region.starter), region.nested(region.starter, nesting)
    # A starter with no closed region behind it keeps the rest of the text.
    pattern = f"(?s)(?={starter})(?:{closed}|(.*+))"
    # Behind the closed regions a starter, and up to the end no closer that is
    # not part of a closed region: it never closes.
    first = quoted(region.starter[0])
    inside = f"{region.filler}|{region.nested(region.opener, nesting)}|{quoted(region.opener)}"
    unclosed = f"(?s)\\A(?:[^{first}]++|{closed}|(?!{starter}).)*+{starter}(?:{inside})*+\\z"

    def quick(t: Column) -> Column:
        return F.regexp_replace(t, pattern, "$1")

    def of_head(head: Column) -> Column:
        # All regions of the head are closed: a starter left over is deeper.
        deep = lambda done: F.when(done.contains(region.starter), fold_closed(head, region, nesting)).otherwise(done)
        return let(quick(head), deep)

    def of_whole(whole: Column) -> Column:
        def split(at: Column) -> Column:
            tail = F.substring(whole, at + 1, F.length(whole))
            return F.concat(let(F.substring(whole, F.lit(1), at), of_head), tail)

        return let(unclosed_position(whole, region, nesting), split)

    def finish(whole: Column, done: Column) -> Column:
        settled = ~done.contains(region.starter) | whole.rlike(unclosed)
        return F.when(settled, done).otherwise(of_whole(whole))

    return let(text, lambda whole: let(quick(whole), lambda done: finish(whole, done)))


def tokens(text: Column, region: Region, nesting: int) -> Column:
    """Markers, closed regions up to ``nesting`` deep, and what lies between."""
    starter, closer = quoted(region.starter), quoted(region.closer)
    # An opener may not swallow the beginning of a longer starter that lies a
    # few characters further on.
    size = len(region.opener)
    overlaps = [k for k in range(1, size) if region.opener[k:] == region.starter[: size - k]]
    behind = "".join(f"(?!{quoted(region.starter[size - k:])})" for k in overlaps)
    lone = quoted(region.opener) + (behind if region.starter != region.opener else "")
    pattern = f"(?s){region.nested(region.starter, nesting)}|{starter}|{lone}|{closer}|(?:{region.filler})++|."
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def next_depth(depth: Column, token: Column, region: Region) -> Column:
    """Depth behind a token: outside only a starter counts."""
    is_start = token == region.starter
    return (
        F.when(depth == 0, is_start.cast("int"))
        .when(is_start | (token == region.opener), depth + 1)
        .when(token == region.closer, depth - 1)
        .otherwise(depth)
    )


def unclosed_position(text: Column, region: Region, nesting: int = NESTING) -> Column:
    """How many characters precede the region that never closes; all of them
    if every region closes. The fold carries three numbers, so its cost is that
    of the tokens."""

    def step(state: Column, token: Column) -> Column:
        depth = next_depth(state["depth"], token, region)
        opened = (state["depth"] == 0) & (depth == 1)
        return F.struct(
            depth.alias("depth"),
            (state["position"] + F.length(token)).alias("position"),
            F.when(opened, state["position"]).otherwise(state["start"]).alias("start"),
        )

    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("position"), F.lit(0).alias("start"))
    end = lambda s: F.when(s["depth"] == 0, s["position"]).otherwise(s["start"])
    return F.aggregate(tokens(text, region, nesting), zero, step, end)


def fold_regions(text: Column, region: Region, nesting: int = NESTING) -> Column:
    """The whole rule, token by token."""

    def split(whole: Column) -> Column:
        return let(
            unclosed_position(whole, region, nesting),
            lambda at: F.concat(
                fold_closed(F.substring(whole, F.lit(1), at), region, nesting), F.substring(whole, at + 1, F.length(whole))
            ),
        )

    return let(text, split)


def fold_closed(text: Column, region: Region, nesting: int = NESTING) -> Column:
    """``text``, all of whose regions close, without them, at any depth.

    The depth runs over the tokens; those outside are kept. They are collected
    in two levels, within ``CHUNK`` tokens and then over the chunks, so no array
    grows with the text token by token.
    """
    none = F.array().cast("array<string>")

    def keep(state: Column, token: Column) -> Column:
        # Longer than its starter and beginning with it: a closed region.
        is_closed = token.startswith(region.starter) & (F.length(token) > len(region.starter))
        depth = next_depth(state["depth"], token, region)
        plain = (state["depth"] == 0) & (depth == 0) & ~is_closed
        return F.struct(
            depth.alias("depth"), F.when(plain, F.concat(state["kept"], F.array(token))).otherwise(state["kept"]).alias("kept")
        )

    def one(depth: Column, chunk: Column) -> Column:
        start = F.struct(depth.alias("depth"), none.alias("kept"))
        return F.aggregate(chunk, start, keep, lambda s: F.struct(s["depth"].alias("depth"), F.array_join(s["kept"], "").alias("text")))

    def add(state: Column, chunk: Column) -> Column:
        return let(
            one(state["depth"], chunk),
            lambda done: F.struct(done["depth"].alias("depth"), F.concat(state["parts"], F.array(done["text"])).alias("parts")),
        )

    def chunks(found: Column) -> Column:
        last = F.floor((F.size(found) - 1) / F.lit(CHUNK)).cast("int")
        pieces = F.transform(F.sequence(F.lit(0), last), lambda n: F.slice(found, n * CHUNK + 1, CHUNK))
        zero = F.struct(F.lit(0).alias("depth"), none.alias("parts"))
        joined = F.aggregate(pieces, zero, add, lambda s: F.array_join(s["parts"], ""))
        return F.when(F.size(found) == 0, F.lit("")).otherwise(joined)

    return let(tokens(text, region, nesting), chunks)


def fold_any(text: Column, region: Region) -> Column:
    """The whole rule for any delimiters.

    The text is cut before every place where a delimiter could begin, so a piece
    has one at its beginning or nowhere. Outside a starter counts, inside the
    opener and the closer, the closer first where both begin; a delimiter that
    begins within the one just read does not count (``skip``). Kept pieces are
    collected in two levels, as in :func:`fold_closed`.
    """
    marks = (region.starter, region.opener, region.closer)
    widest = max(map(len, marks))
    pieces = F.split(text, f"(?={'|'.join(map(quoted, marks))})")
    none = F.array().cast("array<string>")

    def seen(firsts: Column, n: Column) -> Column:
        """The first characters from a piece on; each piece has one at least."""
        return F.array_join(F.slice(firsts, n + 1, widest), "")

    def with_view(found: Column) -> Column:
        firsts = F.transform(found, lambda piece: F.substring(piece, 1, widest))
        return let(firsts, lambda f: F.transform(found, lambda piece, n: F.struct(piece.alias("piece"), seen(f, n).alias("view"))))

    def step(state: Column, item: Column) -> Column:
        depth, view, free = state["depth"], item["view"], state["skip"] == 0
        starts = free & (depth == 0) & view.startswith(region.starter)
        closes = free & (depth > 0) & view.startswith(region.closer)
        opens = free & (depth > 0) & view.startswith(region.opener) & ~view.startswith(region.closer)
        read = (
            F.when(starts, len(region.starter)).when(closes, len(region.closer)).when(opens, len(region.opener)).otherwise(state["skip"])
        )
        behind = F.when(starts | opens, depth + 1).when(closes, depth - 1).otherwise(depth)
        size = F.length(item["piece"])

        def told(new: Column) -> Column:
            rest = F.substring(item["piece"], new["read"] + 1, size)
            kept = F.when((new["depth"] == 0) & (new["read"] < size), F.concat(state["kept"], F.array(rest))).otherwise(state["kept"])
            return F.struct(
                new["depth"].alias("depth"),
                F.greatest(new["read"] - size, F.lit(0)).alias("skip"),
                (state["at"] + size).alias("at"),
                F.when(new["starts"], state["at"]).otherwise(state["start"]).alias("start"),
                kept.alias("kept"),
            )

        return let(F.struct(read.alias("read"), behind.alias("depth"), starts.alias("starts")), told)

    def fields(state: Column) -> list[Column]:
        return [state[name].alias(name) for name in ("depth", "skip", "at", "start")]

    def add(state: Column, chunk: Column) -> Column:
        done = F.aggregate(chunk, F.struct(*fields(state), none.alias("kept")), step)
        return let(done, lambda d: F.struct(*fields(d), F.concat(state["parts"], F.array(F.array_join(d["kept"], ""))).alias("parts")))

    def whole(found: Column) -> Column:
        last = F.floor((F.size(found) - 1) / F.lit(CHUNK)).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), last), lambda n: F.slice(found, n * CHUNK + 1, CHUNK))
        zero = F.struct(*(F.lit(0).alias(name) for name in ("depth", "skip", "at", "start")), none.alias("parts"))
        # A region left open is kept, with all behind its start.
        tail = lambda s: F.when(s["depth"] > 0, F.substring(text, s["start"] + 1, F.length(text))).otherwise("")
        return F.aggregate(chunks, zero, add, lambda s: F.concat(F.array_join(s["parts"], ""), tail(s)))

    return F.when(text.isNotNull(), let(with_view(pieces), whole))
