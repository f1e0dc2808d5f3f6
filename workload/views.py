"""A wiki derived from the driver's tables.

Each view is SQL text that Spark and DuckDB both accept, so a query and its
oracle start from the same rows. All views grow with the tables: documents are
articles with marked-up texts, conversations are further revisions of them,
parts form a deep category tree below nations and regions (with diamonds and
cycles), customers are articles without a text, suppliers are templates, events
are raw pages of a dump.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry import Wiki
from pagequarry.scale import dealt_out
from pagequarry.session import scratch_path, tune

# The tables the views are made of.
TABLES = ("region", "nation", "customer", "supplier", "part", "events", "documents", "conversations")

PAGE = """
SELECT doc_id * 10 + 1 AS page_id, 0 AS page_namespace, concat('Doc_', CAST(doc_id AS STRING)) AS page_title
FROM documents
UNION ALL SELECT c_custkey * 10 + 2, 0, replace(c_name, '#', '_') FROM customer
UNION ALL SELECT p_partkey * 10 + 3, 14, concat('Part_', CAST(p_partkey AS STRING)) FROM part
UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 10 + 4, 14, n_name FROM nation
UNION ALL SELECT CAST(r_regionkey AS BIGINT) * 10 + 5, 14, replace(r_name, ' ', '_') FROM region
UNION ALL SELECT CAST(6 AS BIGINT), 14, 'World'
UNION ALL SELECT s_suppkey * 10 + 7, 10, replace(s_name, '#', '_') FROM supplier
"""

# A third of the documents is in one category; part 8k..8k+7 lie below part k;
# some parts have a second parent, some contain their own parent.
CATEGORYLINKS = """
SELECT CAST(r_regionkey AS BIGINT) * 10 + 5 AS cl_from, 'World' AS cl_to FROM region
UNION ALL
SELECT CAST(n_nationkey AS BIGINT) * 10 + 4, replace(r_name, ' ', '_')
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT CAST(n_nationkey AS BIGINT) * 10 + 4, replace(r_name, ' ', '_')
FROM nation JOIN region ON (n_regionkey + 1) % 5 = r_regionkey WHERE n_nationkey % 7 = 0
UNION ALL SELECT CAST(6 AS BIGINT), 'NATION_0'
UNION ALL
SELECT p_partkey * 10 + 3, concat('NATION_', CAST(p_partkey AS STRING)) FROM part WHERE p_partkey < 8
UNION ALL
SELECT p_partkey * 10 + 3, concat('Part_', CAST(CAST(floor(p_partkey / 8) AS BIGINT) AS STRING))
FROM part WHERE p_partkey >= 8
UNION ALL
SELECT p_partkey * 10 + 3, concat('Part_', CAST(CAST(floor(p_partkey / 64) AS BIGINT) AS STRING))
FROM part WHERE p_partkey >= 64 AND p_partkey % 11 = 0
UNION ALL
SELECT CAST(floor(p_partkey / 8) AS BIGINT) * 10 + 3, concat('Part_', CAST(p_partkey AS STRING))
FROM part WHERE p_partkey >= 8 AND p_partkey % 97 = 0
UNION ALL SELECT doc_id * 10 + 1, concat('Part_', CAST(doc_id AS STRING)) FROM documents
UNION ALL SELECT doc_id * 10 + 1, concat('NATION_', CAST(doc_id % 20 AS STRING)) FROM documents
UNION ALL SELECT doc_id * 10 + 1, 'World' FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT doc_id * 10 + 1, concat('Sources/', source) FROM documents
UNION ALL SELECT c_custkey * 10 + 2, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT CAST(99999999999 AS BIGINT), 'NATION_1'
"""

REVISION = """
SELECT doc_id * 1000 + 5 AS rev_id, doc_id * 10 + 1 AS rev_page, doc_id * 1000 + 5 AS rev_text_id FROM documents
UNION ALL
SELECT conv_id * 1000 + turn * 2, conv_id * 10 + 1, conv_id * 1000 + turn * 2 FROM conversations
"""

TEXT = """
SELECT doc_id * 1000 + 5 AS old_id, CASE WHEN source = 'src7' THEN '' ELSE wikitext END AS old_text,
  CASE WHEN lang = 'de' THEN 'gzip-less' ELSE 'utf-8' END AS old_flags
FROM w_wikitext
UNION ALL
SELECT conv_id * 1000 + turn * 2, text, 'utf-8' FROM conversations
"""

_NL, _Q = "chr(10)", "chr(39)"

# Words of the texts and what the derived page has in their place.
_WORDS = (
    ("' the '", "' [[The page|the]] '"),
    ("' de '", "' [[de]] '"),
    ("' der '", "' [[de:Artikel]]der '"),
    ("'. '", "'.{{cite|{{date|a=b}}|c}} '"),
    ("' of '", f"concat(' ', repeat({_Q}, 3), 'of', repeat({_Q}, 3), ' ', repeat({_Q}, 2), 'x', repeat({_Q}, 2), ' ')"),
    ("' and '", "' [http://example.org/a?b=c and] '"),
    ("' to '", "' http://example.org/x to '"),
    ("' la '", "' [[Bild:La.jpg|thumb|Die [[la]] hier]] '"),
    ("' que '", "' (, que () {} [] '"),
    ("' und '", "' {| class=x {| y |} z |} und '"),
    ("' in '", "' <math>a<b</math> in '"),
    ("' is '", "' [[Category:Is|x]] is '"),
    ("' zu '", "' [[Kategorie:Zu]]zu '"),
    ("' a '", "' [[image:A.png]] a '"),
    ("' los '", "' [[:Category:Los]] los '"),
    ("' se '", "' __NO_TOC__ se '"),
    ("' it '", "' {{Link FA|en}} it '"),
    ("' was '", "' [[fiu-vro:Was|x]] was '"),
    ("' en '", "' [[a]b|en]] '"),
    ("' for '", "' (; for ) , '"),
    (f"concat('.', {_NL})", f"concat('.', {_NL}, '=== Teil ===', {_NL})"),
)


def _marked(text: str) -> str:
    for word, markup in _WORDS:
        text = f"replace({text}, {word}, {markup})"
    return text


_PERSON = f"""CASE WHEN lang = 'de' THEN concat('{{{{Personendaten', {_NL}, '| NAME=Muster, ', source, {_NL},
  '|ALTERNATIVNAMEN=', {_NL}, '|KURZBESCHREIBUNG=Person ', CAST(doc_id AS STRING), {_NL}, '|GEBURTSDATUM=1. Mai 1900',
  {_NL}, '|GEBURTSORT=[[Ort]]', {_NL}, '|STERBEDATUM=', {_NL}, '|STERBEORT=Stadt', {_NL}, '}}}}', {_NL}) ELSE '' END"""

_BLOCKS = f"""concat('===== Tief =====', {_NL}, '==== Vier ====', {_NL}, '== ', source, ' ==', {_NL}, '= Kopf =', {_NL},
  '* Punkt', {_NL}, '#: Nummer', {_NL}, '; Wort', {_NL}, '----', {_NL}, '<gallery>Bild</gallery>', {_NL},
  CASE WHEN lang = 'fr' AND source = 'src0' THEN concat(repeat('{{{{a ', 14), repeat('}}}}', 14), '[[Bild:t ',
    repeat('[[', 14), repeat(']]', 15), repeat('{{| ', 14), repeat('|}}', 14)) ELSE '' END,
  CASE WHEN lang = 'fr' THEN concat(repeat('{{{{a|', 9), 'x', repeat('}}}}', 9), repeat('{{|b', 8), repeat('|}}', 8),
    '[[Bild:t ', repeat('[[u ', 8), repeat(']]', 9)) ELSE '' END,
  CASE WHEN lang = 'es' THEN concat('[[Bild:offen {{{{open {{| auf <math>', {_NL}) ELSE '' END)"""

_END = f"""concat({_NL}, '{{{{DEFAULTSORT:Key, ', CAST(doc_id AS STRING), '}}}} {{{{DEFAULTSORT:Zwei}}}}', {_NL},
  '[[Category:', source, ']]', {_NL}, '[[zh-min-nan:Doc]]', {_NL}, '{{{{done}}}} [[image:Ende.png|[[x]]]]  ', {_NL}, {_NL})"""

WIKITEXT = f"""
SELECT doc_id, doc_id * 10 + 1 AS page_id, lang, source,
  concat({_PERSON}, {_BLOCKS}, {_marked('text')}, {_END}) AS wikitext
FROM documents
"""

# A fixed few, as in a wiki: the constants and one per nation.
NAMESPACES = """
SELECT 0 AS ns_id, '' AS ns_name
UNION ALL SELECT -1, 'Special'
UNION ALL SELECT 10, 'Template'
UNION ALL SELECT 14, 'Category'
UNION ALL SELECT 100 + n_nationkey, n_name FROM nation
"""


def _two(part: str) -> str:
    return f"lpad(CAST({part}(ts) AS STRING), 2, '0')"


_ISO = (
    f"concat(CAST(year(ts) AS STRING), '-', {_two('month')}, '-', {_two('day')}, 'T', "
    f"{_two('hour')}, ':', {_two('minute')}, ':', {_two('second')}, 'Z')"
)
_KIND = "concat(upper(substr(event_type, 1, 1)), substr(event_type, 2))"

RAW = f"""
SELECT event_id,
  CASE event_id % 7
    WHEN 0 THEN concat('Category:', {_KIND}, ' ', CAST(event_id AS STRING))
    WHEN 1 THEN concat('NATION_', CAST(user_id % 30 AS STRING), ':page ', CAST(event_id AS STRING))
    WHEN 2 THEN concat(':lead ', CAST(event_id AS STRING))
    WHEN 3 THEN concat('Portal:', {_KIND})
    ELSE concat({_KIND}, ' ', CAST(event_id AS STRING)) END AS title,
  concat(CAST(event_id AS STRING), CASE WHEN event_id % 89 = 88 THEN 'x' ELSE '' END) AS id,
  CASE WHEN event_id % 10 = 0 THEN 'edit=sysop' END AS restrictions,
  concat(CASE WHEN event_id % 83 = 82 THEN 'r' ELSE '' END, CAST(event_id * 10 + 1 AS STRING)) AS rev_id,
  CASE WHEN event_id % 97 = 96 THEN concat('bad ', CAST(event_id AS STRING)) ELSE {_ISO} END AS timestamp,
  CASE WHEN user_id % 3 <> 0 THEN concat('user "', CAST(user_id AS STRING), '"') END AS username,
  CASE WHEN user_id % 3 <> 0 THEN CAST(user_id AS STRING) END AS user_id,
  CASE WHEN user_id % 3 = 0 THEN concat('10.0.0.', CAST(user_id % 256 AS STRING)) END AS ip,
  CASE WHEN event_id % 5 = 0 THEN '' END AS minor,
  CASE WHEN event_id % 4 <> 0 THEN props END AS comment,
  CASE WHEN event_id % 11 = 0 THEN concat('#Redirect [[', event_type, ']]')
    WHEN event_id % 13 = 0 THEN ''
    ELSE concat('  ', event_type, ' & <b>', props, '</b>', chr(10), chr(10), '&quot; é ', CAST(value AS STRING), ' ') END AS text
FROM events
"""

# Tables that views with texts come from: the driver's file is one split, so its
# rows are dealt out before the texts are made, which are several times as wide.
SPREAD = ("documents", "conversations", "events")
TEXTS = ("w_wikitext", "w_text", "w_raw")

# In dependency order.
VIEWS = {
    "w_page": PAGE,
    "w_categorylinks": CATEGORYLINKS,
    "w_revision": REVISION,
    "w_wikitext": WIKITEXT,
    "w_text": TEXT,
    "w_namespaces": NAMESPACES,
    "w_raw": RAW,
}


class Data:
    """The views as Parquet tables in the shared folder, as a wiki's tables are
    stored ones. Each is made once per session and folder of driver tables, when
    a query first reads it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.base = scratch_path(spark, "wiki-tables")
        self.tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
        self.frames: dict[str, DataFrame] = {}
        self.files: dict[str, str] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = self._made(name)
        return self.frames[name]

    def _made(self, name: str) -> DataFrame:
        sql, path = VIEWS[name], f"{self.base}/{name}"
        read = {view: self[view] for view in VIEWS if re.search(rf"\b{view}\b", sql)}
        # A category link holds no text: its tables are read as they are.
        dealt = SPREAD if name in TEXTS else ()
        for table, rows in {**self.tables, **read}.items():
            (dealt_out(rows) if table in dealt else rows).createOrReplaceTempView(table)
        self.spark.sql(sql).write.parquet(path)
        return self.spark.read.parquet(path)

    def make_all(self) -> None:
        """Make every view not made yet."""
        for name in VIEWS:
            self[name]

    def file(self, name: str, write: Callable[[str], None]) -> str:
        """Folder of derived files, written when first asked for."""
        if name not in self.files:
            path = scratch_path(self.spark, name)
            write(path)
            self.files[name] = path
        return self.files[name]

    def wiki(self, **settings) -> Wiki:
        return Wiki(
            page=self["w_page"],
            categorylinks=self["w_categorylinks"],
            revision=self["w_revision"],
            text=self["w_text"],
            **settings,
        )

    def graph(self) -> Wiki:
        """The wiki for what reads pages and category links alone."""
        return Wiki(page=self["w_page"], categorylinks=self["w_categorylinks"])

    def raw_pages(self) -> DataFrame:
        """``w_raw`` in the nested form of a parsed dump."""
        contributor = F.struct("username", F.col("user_id").alias("id"), "ip")
        revision = F.struct(
            F.col("rev_id").alias("id"), "timestamp", contributor.alias("contributor"), "minor", "comment", "text"
        )
        return self["w_raw"].select("title", "id", "restrictions", F.array(revision).alias("revision"), "event_id")


def with_views(select: str, *extra: tuple[str, str]) -> str:
    """An oracle: the views, extra views, and a select, as one statement."""
    parts = [f"{name} AS ({sql.strip()})" for name, sql in [*VIEWS.items(), *extra]]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select.strip()


@lru_cache(maxsize=8)
def _load(application: str, spark: SparkSession, sf_dir: str) -> Data:
    return Data(spark, sf_dir)


def load(spark: SparkSession, sf_dir: str) -> Data:
    """The views over ``sf_dir``, set up once per session and folder."""
    return _load(spark.sparkContext.applicationId, spark, sf_dir)
