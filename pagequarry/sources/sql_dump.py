"""Tables from SQL dumps (``INSERT INTO`` statements).

Files are split among tasks at a semicolon and a line break. Those may also stand
inside a literal or a comment, which a task that starts there cannot know. So
each record gets a map from the state a record can begin in to the state it ends
in; maps are composed over the blocks of a file and then inside each block, and
records that begin inside something are joined to the one that began it. A first
look finds whether any record ends inside something; where none does, as in most
dumps, nothing is composed and no record is moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.scale import spread

_QUOTED = r"'(?:[^'\\]++|\\.|'')*+'"
# A quoted value may be led by a character set or a letter (_binary'..', x'..').
_VALUE = rf"(?:\s*+(?:[A-Za-z_]\w*+\s*+)?+{_QUOTED}|[^,()']++)"
_TUPLE = rf"(?s)\(\s*+{_VALUE}\s*+(?:,\s*+{_VALUE}\s*+)*+\)"
# What may stand before a statement, and its head with an optional column list.
_IGNORED = r"(?:\s++|--[^\n]*+(?:\n|\z)|#[^\n]*+(?:\n|\z)|/\*(?s:.*?)\*/;?+)*+"
_NAME = r"(?:`[^`]+`|[\w$]+)"
_HEAD = rf"(?i)\A{_IGNORED}INSERT\s+(?:IGNORE\s+)?(?:INTO\s+)?(?:{_NAME}\s*\.\s*)?({_NAME})\s*(\([^)]*\))?\s*VALUES?\s*"

END = ";\n"
# States between two characters: outside, and inside what the mark opened.
OUTSIDE = "o"
_INSIDE = {"q": "'", "d": '"', "b": "`", "c": "/*"}
# From outside: whole tokens leave nothing, one left open leaves its mark.
_TOKENS = (
    r"""(?s)[^'"`#/-]++|'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|`[^`]*+`|--[^\n]*+|#[^\n]*+|/\*.*?\*/"""
    r"""|(['"`]|/\*).*+\z|[/-]"""
)
# From inside: all up to the end of what is open.
_CLOSES = {"q": r"(?s)\A(?:[^'\\]++|\\.)*+'", "d": r'(?s)\A(?:[^"\\]++|\\.)*+"', "b": r"(?s)\A[^`]*+`", "c": r"(?s)\A.*?\*/"}
STATES = [OUTSIDE, *_INSIDE]

# Columns of the two published tables; trailing columns need not be named.
CATEGORYLINKS = "cl_from bigint, cl_to string"
CATEGORY = "cat_id bigint, cat_title string, cat_pages int, cat_subcats int, cat_files int"

# What a backslash and a letter stand for inside quotes.
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "Z": "\x1a", "b": "\b"}


def end_state(text: Column) -> Column:
    """State at the end of a text that begins outside."""
    left = F.regexp_replace(text, _TOKENS, "$1")
    state = F.lit(OUTSIDE)
    for name, mark in _INSIDE.items():
        state = F.when(left == mark, name).otherwise(state)
    return state


def state_map(text: Column) -> Column:
    """The end state for each state in ``STATES`` that the text can begin in."""
    ends = [end_state(text)]
    for name, closes in _CLOSES.items():
        ends.append(F.when(text.rlike(closes), end_state(F.regexp_replace(text, closes, ""))).otherwise(name))
    return F.concat(*ends)


def _ends_inside(value: Column) -> Column:
    """Whether a record that begins outside ends inside something. Even quotes
    settle it for a statement whose values hold nothing else that opens."""
    body = F.substr(value, F.length(F.regexp_extract(value, _HEAD, 0)) + 1)
    bare = F.replace(F.replace(body, F.lit("\\\\"), F.lit("")), F.lit("\\'"), F.lit(""))
    even = F.length(F.replace(bare, F.lit("'"), F.lit(""))) % 2 == F.length(bare) % 2
    others = F.lit(False)
    for mark in ('"', "`", "#", "--", "/*"):
        others = others | body.contains(mark)
    plain = even & ~others & (F.length(bare) > 0) & ~bare.endswith("\\")
    return F.when(plain, False).otherwise(end_state(F.concat(value, F.lit(END))) != OUTSIDE)


def _records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value``: the statements at ``path``, and what stands between them."""
    read = spark.read.option("lineSep", END).text(path)
    if not read.where(_ends_inside(F.col("value"))).take(1):
        return spread(read)
    numbered = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
        "value",
    )
    mapped = numbered.select("file", "block", "number", state_map(F.concat("value", F.lit(END))).alias("map"))
    # Maps only, a few characters for each record, are folded in order.
    blocks = mapped.groupBy("file", "block").applyInPandas(_fold_block, "file string, block long, map string, last long")
    starts = blocks.groupBy("file").applyInPandas(_fold_file, "file string, block long, state string, head long")
    heads = (
        mapped.groupBy("file", "block")
        .cogroup(starts.groupBy("file", "block"))
        .applyInPandas(_heads, "file string, number long, head long")
    )
    placed = numbered.join(heads, ["file", "number"])
    parts = placed.groupBy("file", "head").agg(F.sort_array(F.collect_list(F.struct("number", "value"))).alias("parts"))
    return parts.select(F.array_join(F.transform("parts", lambda p: p["value"]), END).alias("value"))


def _after(state: str, maps: Iterator[str]) -> Iterator[str]:
    """States before each map's record, and after the last."""
    yield state
    for ends in maps:
        state = ends[STATES.index(state)]
        yield state


def _fold_block(rows: pd.DataFrame) -> pd.DataFrame:
    """One block: its map, and its last record for each state it can begin in
    that begins outside, or none."""
    maps = rows.sort_values("number")
    out = []
    for start in STATES:
        states = list(_after(start, maps["map"]))
        begun = [n for n, s in zip(maps["number"], states) if s == OUTSIDE]
        out.append((states[-1], begun[-1] if begun else -1))
    first = rows.iloc[0]
    return pd.DataFrame(
        {"file": first["file"], "block": first["block"], "map": [f"{s}{e}" for s, (e, _) in zip(STATES, out)], "last": [n for _, n in out]}
    )


def _fold_file(rows: pd.DataFrame) -> pd.DataFrame:
    """One file: for each of its blocks the state it begins in, and the record
    that began what is open there."""
    out, state, head = [], OUTSIDE, -1
    for block, ends in rows.sort_values("block").groupby("block", sort=True):
        out.append((rows["file"].iloc[0], block, state, head))
        own = ends[ends["map"].str[0] == state].iloc[0]
        state, head = own["map"][1], own["last"] if own["last"] >= 0 else head
    return pd.DataFrame(out, columns=["file", "block", "state", "head"])


def _heads(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
    """For each record of a block the record that begins its statement."""
    rows = rows.sort_values("number")
    head, out = int(start["head"].iloc[0]), []
    for number, state in zip(rows["number"], _after(start["state"].iloc[0], rows["map"])):
        head = number if state == OUTSIDE or head < 0 else head
        out.append(head)
    return pd.DataFrame({"file": rows["file"], "number": rows["number"], "head": out})


def _statements(spark: SparkSession, path: str | list[str], table: str | None) -> DataFrame:
    """``(columns, body)`` of the INSERT statements at ``path``, which end with
    a semicolon and a line break and may take several lines before."""
    headed = _records(spark, path).select("value", F.regexp_extract("value", _HEAD, 0).alias("head")).where("head <> ''")
    if table is not None:
        headed = headed.where(F.replace(F.regexp_extract("head", _HEAD, 1), F.lit("`"), F.lit("")) == table)
    listed = F.regexp_extract("head", _HEAD, 2)
    names = F.when(listed != "", F.split(F.regexp_replace(listed, r"[`\s()]", ""), ","))
    return headed.select(names.alias("columns"), F.substr("value", F.length("head") + 1).alias("body"))


def read_sql_dump(spark: SparkSession, path: str | list[str], columns: str, table: str | None = None) -> DataFrame:
    """Rows of the ``INSERT INTO`` statements at ``path``; of one ``table`` where
    a file holds several.

    ``columns`` is a DDL list: the leading values of every tuple, or those of
    the same names where a statement lists its columns; what a tuple lacks is
    null. Quoted values may hold quotes (doubled or escaped), commas,
    parentheses, line breaks, ends of statements and backslash escapes, and be
    led by a character set. :func:`rejected_sql` has what was not understood. A
    gzip file is one split, so its statements are redistributed before they are
    taken apart.
    """
    tuples = _statements(spark, path, table).select(
        "columns", F.explode(F.regexp_extract_all("body", F.lit(_TUPLE), F.lit(0))).alias("row")
    )
    values = F.regexp_extract_all(F.expr("substr(row, 2, length(row) - 2)"), F.lit(rf"(?s){_VALUE}"), F.lit(0))
    fields = T.StructType.fromDDL(columns).fields
    split = tuples.select("columns", F.transform(values, lambda v: F.trim(v)).alias("v"))

    def value(place: int, name: str) -> Column:
        listed = F.array_position("columns", F.lit(name)).cast("int") - 1
        at = F.coalesce(listed, F.lit(place))
        return F.when(at >= 0, F.get("v", at))

    return split.select(*[typed(value(i, f.name), f.dataType).alias(f.name) for i, f in enumerate(fields)])


def rejected_sql(spark: SparkSession, path: str | list[str], table: str | None = None) -> DataFrame:
    """``rest``: what the statements at ``path`` hold besides the tuples that
    :func:`read_sql_dump` takes from them; no row where all was understood."""
    rest = F.regexp_replace("body", _TUPLE, "")
    return _statements(spark, path, table).select(rest.alias("rest")).where(F.col("rest").rlike(r"[^,;\s]"))


def typed(literal: Column, kind: T.DataType) -> Column:
    """Value of an SQL literal; a bare ``NULL`` is null."""
    inside = F.replace(F.regexp_replace(literal, r"(?s)\A[^']*+'(.*)'\z", "$1"), F.lit("''"), F.lit("'"))
    text = (
        F.when(literal.endswith("'"), unescape(inside))
        .when(F.upper(literal) != "NULL", literal)
    )
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def unescape(quoted: Column) -> Column:
    """Backslash escapes: the letters above, anything else stands for itself.
    The text is cut at doubled backslashes first, so none is read twice."""

    def single(part: Column) -> Column:
        for letter, character in ESCAPES.items():
            part = F.replace(part, F.lit("\\" + letter), F.lit(character))
        return F.regexp_replace(part, r"(?s)\\(.)", "$1")

    parts = F.transform(F.split(quoted, r"\\\\"), single)
    return F.when(quoted.contains("\\"), F.array_join(parts, "\\")).otherwise(quoted)
