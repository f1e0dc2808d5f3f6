"""The registered queries as DuckDB SQL over the same derived views.

DuckDB's regular expressions are RE2: no look-around, ASCII ``\\w \\s``. The
Unicode classes are therefore written out. Balanced regions, dots and closures
are computed another way than in Spark: by running sums over exploded tokens,
by numbered positions, and by recursive queries.
"""

from __future__ import annotations

from pagequarry.functions.markup import LONG_LANGUAGE_IDS, READER_LANGUAGE_IDS, WHITE_SPACE
from workload.queries import MIN_MEMBERS
from workload.views import with_views

S = r"[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
W = r"[\p{L}\p{M}\p{N}_]"
URI = r"(?:http|https|ftp)://[A-Za-z0-9\-_.!~*'();/?:@&=+$,%]+"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sub(column: str, pattern: str, replacement: str = "", options: str = "g") -> str:
    return f"regexp_replace({column}, {text(pattern)}, {text(replacement)}, {text(options)})"


def trim(column: str) -> str:
    return f"trim({column}, {text(WHITE_SPACE)})"


# --- Text operators as expressions of a column -----------------------------


def categories(t: str) -> str:
    for prefix in ("Category", "Kategorie"):
        t = sub(t, rf"\[\[{prefix}:[^\[\]]+\]\]")
    return trim(sub(t, r"\{\{DEFAULTSORT:[^\n]+\}\}", "", ""))


def plain_categories(t: str) -> str:
    return trim(sub(t, r"\[\[(?:Kategorie|Category):[^\[\]|]+(?:\|[^\[\]|]*)?\]\]"))


def interwiki(t: str) -> str:
    return trim(sub(t, rf"\[\[(?:{W}{{2,3}}|{'|'.join(LONG_LANGUAGE_IDS)}):[^\[\]]+\]\]"))


def plain_interwiki(t: str) -> str:
    t = sub(t, rf"\[\[(?:{W}{{2,3}}|{'|'.join(READER_LANGUAGE_IDS)}):[^\[\]|]+\]\]")
    return trim(sub(t, rf"\{{\{{Link{S}FA\|(?:{W}{{2,3}}|simple)\}}\}}"))


def links(t: str) -> str:
    t = sub(t, r"\[\[(?:[^\[|]+\|)?([^\[\]]+)\]\]", r"\1")
    t = sub(t, rf"\[{URI}{S}*([^\]]*)\]", r"\1")
    return sub(t, URI)


PERSON = (
    rf"(?s)\{{\{{Personendaten{S}*\|{S}*NAME=(.+)\|ALTERNATIVNAMEN=(.*){S}*\|KURZBESCHREIBUNG=(.*){S}*"
    rf"\|GEBURTSDATUM=(.*){S}*\|GEBURTSORT=(.*){S}*\|STERBEDATUM=(.*){S}*\|STERBEORT=(.*){S}*\}}\}}"
)


def person(t: str) -> str:
    return trim(sub(t, PERSON, r"\1 \2 \3 \4 \5 \6", ""))


def emphasis(t: str) -> str:
    return f"replace(replace({t}, repeat(chr(39), 3), ''), repeat(chr(39), 2), '')"


def directives(t: str) -> str:
    return f"replace({t}, '__NO_TOC__', '')"


def headlines(t: str) -> str:
    for n in range(5, 0, -1):
        t = sub(t, rf"(?m)\n?^={{{n}}}[^=]+={{{n}}}")
    return t


def headline_markup(t: str) -> str:
    for n in range(5, 0, -1):
        t = sub(t, rf"(?m)^={{{n}}}{S}*(\b[^=]+\b){S}*={{{n}}}", r"\1")
    return t


def pairs(t: str) -> str:
    return f"replace(replace(replace({t}, '[]', ''), '()', ''), '{{}}', '')"


def tighten(t: str) -> str:
    return sub(t, r"\([;,]", "(")


def whitespace(t: str) -> str:
    t = sub(t, rf"{S}([,.!?:])", r"\1")
    t = sub(t, rf"\({S}", "(")
    t = sub(t, rf"{S}+", " ")
    return sub(sub(t, r"\A ", "", ""), r" \z", "", "")


def render(t: str) -> str:
    t = sub(t, r"(?m)^-{4,}[ \t]*$", "-" * 40)
    t = sub(t, r"(?m)^[*#:;]*#([ \t]+|[^*#:;])", "# \x01\\1")
    t = sub(t, r"(?m)^[*#:;]*[*:;]([ \t]+|[^*#:;])", "* \x01\\1")
    t = sub(t, "\x01[ \\t]*")
    for n in range(6, 0, -1):
        t = sub(t, rf"(?m)^={{{n}}}[ \t]*([^=\n](?:[^\n]*[^=\s])?)[ \t]*={{{n}}}[ \t]*$", r"\1")
    t = sub(t, r"'{2,5}")
    t = sub(t, r"\[\[(?:[^\[\]|\n]+\|)?([^\[\]|\n]+)\]\]", r"\1")
    t = sub(t, rf"\[{URI}[ \t]+([^\]\n]+)\]", r"\1")
    return sub(t, rf"\[({URI})\]", r"\1")


HEADLINES = "|".join(rf"={{{n}}}[ \t]*[^=](?:.*[^=\s])?[ \t]*={{{n}}}" for n in range(6, 0, -1))
#: Lines with their kind, whether they begin a block, and the blocks.
BLOCKS = [
    ("split_lines", "SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM texts"),
    (
        "kind_lines",
        f"""SELECT *, CASE WHEN regexp_matches(l, '^[ \\t\\r]*$') THEN 'break' WHEN regexp_matches(l, '^-{{4,}}[ \\t]*$') THEN 'rule'
        WHEN regexp_matches(l, {text(rf"^(?:{HEADLINES})[ \t]*$")}) THEN 'headline' WHEN regexp_matches(l, '^( |\\t+)') THEN 'code'
        WHEN regexp_matches(l, '^[*#:;]*#([^*#:;]|$)') THEN 'numbered' WHEN regexp_matches(l, '^[*#:;]') THEN 'item'
        ELSE 'paragraph' END AS kind FROM split_lines""",
    ),
    (
        "shown_lines",
        f"""SELECT doc_id, i, kind, CASE kind WHEN 'code' THEN regexp_replace(l, '^( |\\t+)', '') ELSE {render("l")} END AS text,
        CAST(kind IN ('rule', 'headline') OR kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY doc_id ORDER BY i) AS INT) AS first
        FROM kind_lines""",
    ),
    ("run_lines", "SELECT *, sum(first) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM shown_lines"),
    (
        "blocks",
        """SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS block, kind, text FROM
        (SELECT doc_id, run, any_value(kind) AS kind, string_agg(text, chr(10) ORDER BY i) AS text FROM run_lines
         WHERE kind <> 'break' GROUP BY doc_id, run)""",
    ),
]
# Blocks under each other, with an empty line behind a paragraph that others follow.
JOINED_BLOCKS = """SELECT t.doc_id, coalesce(p.text, '') AS text FROM texts t LEFT JOIN (
  SELECT doc_id, string_agg(text || CASE WHEN kind = 'paragraph' AND block < last THEN chr(10) ELSE '' END, chr(10) ORDER BY block) AS text
  FROM (SELECT *, max(block) OVER (PARTITION BY doc_id) AS last FROM blocks) GROUP BY doc_id) p ON p.doc_id = t.doc_id"""

# Tokens of regions that begin with a word and end by brackets, and their depths.
WORD_REGIONS = [
    (
        "word_letters",
        r"""SELECT doc_id, l, list_reduce(l, lambda acc, x: acc || chr(CASE
        WHEN acc[-1] = 'A' THEN CASE WHEN x = 'Category:' THEN 66 ELSE 65 END
        WHEN x = '[[' THEN ascii(acc[-1]) + 1 WHEN x = ']]' THEN ascii(acc[-1]) - 1 ELSE ascii(acc[-1]) END), 'A') AS ds
        FROM (SELECT doc_id, regexp_extract_all(t, 'Category:|\[\[|\]\]|[^C\[\]]+|[C\[\]]') AS l FROM texts)""",
    ),
    (
        "word_depth",
        "SELECT doc_id, tok, i, ascii(ds[CAST(i AS INT) + 1]) - 65 AS d FROM "
        "(SELECT doc_id, ds, unnest(l) AS tok, generate_subscripts(l, 1) AS i FROM word_letters)",
    ),
]


# --- Balanced regions ------------------------------------------------------

TOKENS = {
    "templates": (r"\{\{|\}\}|[^{}]+|[{}]", "{{", "}}"),
    "tables": (r"\{\||\|\}|[^{|}]+|[{|}]", "{|", "|}"),
    "math": (r"<math>|</math>|[^<]+|<", "<math>", "</math>"),
    "brackets": (r"\[\[|\]\]|[^\[\]]+|[\[\]]", "[[", "]]"),
}


def regions(source: str, name: str, kind: str) -> list[tuple[str, str]]:
    """Views ending in ``name`` (doc_id, t): ``source`` without the regions."""
    pattern, opener, closer = TOKENS[kind]
    step = f"CASE tok WHEN '{opener}' THEN 1 WHEN '{closer}' THEN -1 ELSE 0 END"
    return [
        (
            f"{name}_tokens",
            f"SELECT doc_id, unnest(l) AS tok, generate_subscripts(l, 1) AS i "
            f"FROM (SELECT doc_id, regexp_extract_all(t, {text(pattern)}) AS l FROM {source})",
        ),
        (f"{name}_sum", f"SELECT *, sum({step}) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM {name}_tokens"),
        (
            f"{name}_depth",
            f"SELECT doc_id, tok, i, s - least(0, min(s) OVER (PARTITION BY doc_id ORDER BY i)) AS d FROM {name}_sum",
        ),
        *_kept(source, name),
    ]


def _kept(source: str, name: str) -> list[tuple[str, str]]:
    return [
        (
            f"{name}_marked",
            f"SELECT *, lag(d, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS pd, "
            f"coalesce(max(CASE WHEN d = 0 THEN i END) OVER (PARTITION BY doc_id), 0) AS last0 FROM {name}_depth",
        ),
        (
            name,
            f"SELECT s.doc_id, coalesce(string_agg(tok, '' ORDER BY i) FILTER ((d = 0 AND pd = 0) OR i > last0), '') AS t "
            f"FROM {source} s LEFT JOIN {name}_marked m ON s.doc_id = m.doc_id GROUP BY s.doc_id",
        ),
    ]


def images(source: str, name: str) -> list[tuple[str, str]]:
    """The same for images, where the outermost marker is a longer one: the
    depth after every token is a letter, appended token by token."""
    prepared = sub(sub(sub("t", "<gallery>"), "</gallery>"), r"\[\[(?:[Ii]mage|bild):", "[[Bild:")
    depth = (
        "list_reduce(l, lambda acc, x: acc || chr(CASE "
        "WHEN acc[-1] = 'A' THEN CASE WHEN x = '[[Bild:' THEN 66 ELSE 65 END "
        "WHEN x IN ('[[Bild:', '[[') THEN ascii(acc[-1]) + 1 WHEN x = ']]' THEN ascii(acc[-1]) - 1 "
        "ELSE ascii(acc[-1]) END), 'A')"
    )
    # RE2 has no look-ahead: a bracket before a longer marker is set apart first.
    tokens = r"\[\[Bild:|\[\[|\]\]|[^\[\]]+|[\[\]]"
    return [
        (f"{name}_in", f"SELECT doc_id, {prepared} AS t FROM {source}"),
        (f"{name}_list", f"SELECT doc_id, regexp_extract_all(t, {text(tokens)}) AS l FROM {name}_in"),
        (f"{name}_letters", f"SELECT doc_id, l, {depth} AS ds FROM {name}_list"),
        (
            f"{name}_depth",
            f"SELECT doc_id, tok, i, ascii(ds[CAST(i AS INT) + 1]) - 65 AS d FROM "
            f"(SELECT doc_id, ds, unnest(l) AS tok, generate_subscripts(l, 1) AS i FROM {name}_letters)",
        ),
        *_kept(f"{name}_in", name),
    ]


SOURCE = ("texts", "SELECT doc_id, wikitext AS t FROM w_wikitext")


def on_text(expression: str) -> str:
    return with_views(f"SELECT doc_id, {expression} AS text FROM texts", SOURCE)


def on_regions(views: list[tuple[str, str]]) -> str:
    return with_views("SELECT doc_id, t AS text FROM result", SOURCE, *views)


def plaintext(middle) -> str:
    last = whitespace(pairs(tighten(directives(emphasis(links(interwiki(categories("t"))))))))
    return with_views(
        f"SELECT doc_id, {last} AS text FROM c",
        SOURCE,
        *images("texts", "a"),
        *regions("a", "b", "templates"),
        ("b2", f"SELECT doc_id, {middle('t')} AS t FROM b"),
        *regions("b2", "c", "tables"),
    )


ABBREVIATED = "'(?:ahd|lat|dt|engl|jap|mhd|bzw|op)$'"
# A dot ends every piece but the last one of a text split at dots.
DOTS = [
    SOURCE,
    (
        "pieces",
        """SELECT doc_id, unnest(l) AS piece, generate_subscripts(l, 1) AS n, len(l) AS pieces
        FROM (SELECT doc_id, string_split(t, '.') AS l FROM texts)""",
    ),
    (
        "places",
        "SELECT *, sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY n) - 1 AS p FROM pieces",
    ),
    (
        "dots",
        f"""SELECT doc_id, n, p, regexp_matches(piece, {ABBREVIATED}) OR p BETWEEN 1 AND 3 AS abbreviation
        FROM places WHERE n < pieces""",
    ),
]
# Only the head of a text can hold the stop of its abstract.
HEAD = [
    SOURCE,
    (
        "stops",
        f"""SELECT doc_id, max(p) AS p FROM (
          SELECT doc_id, t, p, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS n
          FROM (SELECT doc_id, t, unnest(range(450)) AS p FROM texts) WHERE substr(t, p + 1, 1) = '.')
        WHERE n <= 15 AND p > 250 AND p < 450 AND NOT regexp_matches(substr(t, 1, p), {ABBREVIATED}) GROUP BY doc_id""",
    ),
]

# --- Relations shared by several oracles -----------------------------------

NAMES = ("names", "SELECT DISTINCT cl_to AS name FROM w_categorylinks")
LINKS = (
    "links",
    "SELECT DISTINCT cl_to AS parent, page_title AS name, page_id FROM w_categorylinks JOIN w_page ON cl_from = page_id "
    "WHERE page_namespace = 14",
)
BELOW = (
    "below",
    "SELECT name FROM links WHERE parent = 'World' UNION SELECT l.name FROM below b JOIN links l ON l.parent = b.name",
)
MEMBERS = (
    "members",
    "SELECT cl_to AS category, page_id FROM w_categorylinks JOIN w_page ON cl_from = page_id WHERE page_namespace = 0",
)
INSIDE = ("inside", "SELECT name FROM below UNION SELECT 'World'")
LATEST = (
    "latest",
    "SELECT page_id, rev_id, old_text AS text FROM (SELECT rev_page AS page_id, max(rev_id) AS rev_id, "
    "arg_max(rev_text_id, rev_id) AS text_id FROM w_revision GROUP BY rev_page) JOIN w_text ON old_id = text_id",
)
ELIGIBLE = (
    "eligible",
    f"SELECT category, page_id FROM members WHERE NOT contains(category, '/') AND category IN "
    f"(SELECT category FROM members GROUP BY category HAVING count(*) >= {MIN_MEMBERS})",
)
CORPUS = [
    LINKS, BELOW, MEMBERS, INSIDE, LATEST, ELIGIBLE,
    ("corpus_labels", "SELECT * FROM eligible WHERE category IN (SELECT name FROM inside)"),
    (
        "lists",
        "SELECT page_id, count(*) AS labels, string_agg(category, chr(10) ORDER BY category) AS categories "
        "FROM corpus_labels GROUP BY page_id",
    ),
    ("articles", f"SELECT page_id, {person(interwiki(categories('text')))} AS text FROM latest WHERE text <> ''"),
]
EDGES = ("edges", "SELECT DISTINCT name AS child, parent FROM links")
INNER = (
    "inner_vertices",
    "SELECT child AS v FROM edges WHERE child <> parent INTERSECT SELECT parent FROM edges WHERE child <> parent",
)
LABELLED = (
    "labelled",
    "SELECT child, parent FROM edges UNION SELECT v || '_LEAF', v FROM (SELECT v FROM inner_vertices UNION SELECT 'World')",
)
LEFT = ("left_edges", "SELECT * FROM labelled WHERE child <> 'World' AND parent <> 'World'")
LEFT_VERTICES = (
    "left_vertices",
    "SELECT v FROM (SELECT child AS v FROM labelled UNION SELECT parent FROM labelled) WHERE v <> 'World'",
)


def hierarchy(min_members: int, select: str) -> str:
    return with_views(
        select,
        LINKS, BELOW, MEMBERS, INSIDE,
        ("edges", "SELECT DISTINCT name AS child, parent FROM links WHERE parent IN (SELECT name FROM inside)"),
        INNER, LABELLED, LEFT, LEFT_VERTICES,
        ("above", "SELECT child AS v, parent AS a FROM left_edges UNION SELECT x.v, e.parent FROM above x JOIN left_edges e ON e.child = x.a"),
        ("sizes", "SELECT category, count(*) AS n FROM members GROUP BY category"),
        (
            "kept",
            f"SELECT v FROM left_vertices LEFT JOIN sizes ON category = regexp_replace(v, '_LEAF$', '') "
            f"WHERE coalesce(n, 0) >= {min_members}",
        ),
        (
            "hierarchy",
            "SELECT k.v AS category, coalesce(string_agg(a, ' ' ORDER BY a), '') AS supercategories "
            "FROM kept k LEFT JOIN above x ON x.v = k.v GROUP BY k.v",
        ),
    )


READ = plain_interwiki(plain_categories("coalesce(text, '')"))


def reader(pages: str, select: str) -> str:
    return with_views(
        select,
        LINKS, BELOW, MEMBERS, INSIDE, LATEST,
        ("wanted", f"SELECT DISTINCT page_id FROM members WHERE {pages}"),
        ("read", f"SELECT w.page_id, {READ} AS text FROM wanted w LEFT JOIN latest l ON l.page_id = w.page_id"),
    )


RAW_OK = "regexp_full_match(rev_id, '[0-9]+') AND regexp_full_match(timestamp, '\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\dZ')"
NUMBER = "CASE WHEN regexp_full_match({0}, '[0-9]+') THEN TRY_CAST({0} AS BIGINT) END"
DIGITS = "regexp_replace(timestamp, '[-T:Z]', '', 'g')"
FLAT = (
    "SELECT title, id, restrictions, rev_id, timestamp, username, user_id, ip, minor, coalesce(comment, '') AS comment, "
    "coalesce(text, '') AS text FROM w_raw"
)
SPLIT = (
    "split",
    "SELECT r.*, coalesce(ns_id, 0) AS namespace, CASE WHEN ns_name IS NULL THEN title "
    "ELSE substr(title, length(ns_name) + 2) END AS bare_title "
    "FROM w_raw r LEFT JOIN w_namespaces ON starts_with(title, ns_name || ':')",
)
REVISIONS = f"""SELECT CAST(rev_id AS BIGINT) AS rev_id, {NUMBER.format('id')} AS rev_page, CAST(rev_id AS BIGINT) AS rev_text_id,
  coalesce(comment, '') AS rev_comment, CAST(coalesce(user_id, '0') AS BIGINT) AS rev_user,
  coalesce(username, ip, '') AS rev_user_text, {DIGITS} AS rev_timestamp,
  CAST(minor IS NOT NULL AS BIGINT) AS rev_minor_edit, CAST(0 AS BIGINT) AS rev_deleted FROM w_raw WHERE {RAW_OK}"""
PAGES = f"""SELECT {NUMBER.format('id')} AS page_id, CAST(namespace AS BIGINT) AS page_namespace,
  replace(bare_title, ' ', '_') AS page_title, coalesce(restrictions, '') AS page_restrictions,
  CAST(0 AS BIGINT) AS page_counter, CAST(starts_with(lower(text), '#redirect ') AS BIGINT) AS page_is_redirect,
  CAST(0 AS BIGINT) AS page_is_new, {NUMBER.format('rev_id')} AS page_latest, CAST(strlen(text) AS BIGINT) AS page_len FROM split"""

REJECTED = f"""SELECT title, id AS page, CAST(NULL AS VARCHAR) AS revision, 'page id' AS reason, id AS value FROM w_raw
WHERE NOT regexp_full_match(id, '[0-9]+')
UNION ALL SELECT title, id, rev_id, CASE WHEN rev_id LIKE 'r%' THEN 'revision id' ELSE 'timestamp' END,
  CASE WHEN rev_id LIKE 'r%' THEN rev_id ELSE timestamp END FROM w_raw WHERE NOT ({RAW_OK})"""
TEXTS = f"SELECT CAST(rev_id AS BIGINT) AS old_id, text AS old_text, 'utf-8' AS old_flags FROM w_raw WHERE {RAW_OK}"
IMPORTED = """SELECT 'page' AS name, CAST(page_id AS VARCHAR) AS id, concat_ws('|', page_namespace, page_title, page_is_redirect, page_latest, page_len) AS row FROM pages_out
UNION ALL SELECT 'revision', CAST(rev_id AS VARCHAR), concat_ws('|', rev_page, rev_comment, rev_user, rev_user_text, rev_minor_edit) FROM revisions_out
UNION ALL SELECT 'text', CAST(old_id AS VARCHAR), concat_ws('|', old_flags, old_text) FROM texts_out
UNION ALL SELECT 'rejected', revision, concat_ws('|', title, page, reason, value) FROM rejected_out"""

# Titles as the query writes them, and what they mean.
ASKED = (
    "asked",
    """SELECT CASE page_namespace WHEN 10 THEN 'Vorlage:' WHEN 14 THEN 'Template:' ELSE '' END
      || replace(lower(page_title[1]) || page_title[2:], '_', ' ') AS title FROM w_page""",
)
MEANT = (
    "meant",
    """SELECT title, CAST(CASE WHEN regexp_matches(title, '^(Template|Vorlage):') THEN 10 ELSE 0 END AS BIGINT) AS page_namespace,
      upper(b[1]) || replace(b[2:], ' ', '_') AS page_title
    FROM (SELECT title, regexp_replace(title, '^(Template|Vorlage):', '') AS b FROM asked)""",
)
RESOLVED = (
    "resolved",
    """SELECT m.title, m.page_namespace, m.page_title, p.page_id FROM meant m
    LEFT JOIN w_page p ON p.page_title = m.page_title AND p.page_namespace = m.page_namespace""",
)
LINES = (
    "lines",
    "SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS line_no FROM "
    "(SELECT doc_id, string_split(rtrim(wikitext, chr(10)), chr(10)) AS l FROM w_wikitext)",
)


def oracle_sql() -> dict[str, str]:
    return {
        # Sources
        "read_pages": with_views(FLAT),
        "read_compressed_pages": with_views(FLAT),
        "read_namespaces": with_views(
            "SELECT CAST(n.ns_id AS BIGINT) AS ns_id, n.ns_name, count(event_id) AS pages FROM w_namespaces n "
            "LEFT JOIN split s ON s.namespace = n.ns_id GROUP BY n.ns_id, n.ns_name",
            SPLIT,
        ),
        "read_sql_dump": with_views(
            "SELECT n AS cl_from, cl_to || '''s (a,b),(' || chr(92) AS cl_to FROM "
            "(SELECT cl_from AS n, cl_to FROM w_categorylinks UNION ALL SELECT 7, cl_to FROM w_categorylinks)"
        ),
        "wiki_tables": with_views(
            """SELECT 'page' AS name, CAST(page_id AS BIGINT) AS id, concat_ws('|', page_namespace, page_title) AS row FROM w_page
            UNION ALL SELECT 'categorylinks', cl_from, cl_to FROM w_categorylinks
            UNION ALL SELECT 'revision', rev_id, concat_ws('|', rev_page, rev_text_id) FROM w_revision
            UNION ALL SELECT 'text', old_id, concat_ws('|', old_flags, old_text) FROM w_text"""
        ),
        "read_wikitext_lines": with_views(
            "SELECT line, count(*) AS n FROM (SELECT unnest(string_split(wikitext, chr(10))) AS line FROM w_wikitext) "
            "GROUP BY line"
        ),
        # Import
        "split_namespace": with_views("SELECT event_id, CAST(namespace AS BIGINT) AS namespace, bare_title FROM split", SPLIT),
        "import_title": with_views("SELECT event_id, replace(title, ' ', '_') AS page_title FROM w_raw"),
        "parse_timestamp": with_views(
            f"SELECT event_id, CASE WHEN length(timestamp) = 20 THEN replace(timestamp[:19], 'T', ' ') END AS ts, "
            f"CASE WHEN length(timestamp) = 20 THEN {DIGITS} END AS compact FROM w_raw"
        ),
        "rejected_rows": with_views(REJECTED),
        "resolve_contributor": with_views(
            "SELECT event_id, coalesce(username, ip, '') AS rev_user_text, "
            "CAST(coalesce(user_id, '0') AS BIGINT) AS rev_user FROM w_raw"
        ),
        "minor_flag": with_views("SELECT event_id, CAST(event_id % 5 = 0 AS BIGINT) AS rev_minor_edit FROM events"),
        "redirect_flag": with_views(
            "SELECT event_id, CAST(starts_with(lower(text), '#redirect ') AS BIGINT) AS page_is_redirect FROM w_raw"
        ),
        "length_and_latest": with_views(
            f"SELECT event_id, CAST(strlen(text) AS BIGINT) AS page_len, {NUMBER.format('rev_id')} AS page_latest FROM w_raw"
        ),
        "page_rows": with_views(PAGES, SPLIT),
        "revision_rows": with_views(REVISIONS),
        "text_rows": with_views(TEXTS),
        "skip_loaded": with_views(
            "SELECT event_id, id FROM w_raw WHERE minor IS NULL OR NOT regexp_full_match(id, '[0-9]+')"
        ),
        "import_statistics": with_views(
            "SELECT count(*) AS pages, count(*) AS revisions, CAST(sum(strlen(text)) AS BIGINT) AS text_bytes FROM w_raw"
        ),
        "incremental_import": with_views(
            IMPORTED, SPLIT, ("pages_out", PAGES), ("revisions_out", REVISIONS), ("texts_out", TEXTS), ("rejected_out", REJECTED)
        ),
        "wiki_table_import": with_views(
            f"SELECT page_id, page_namespace, page_title, page_len, text AS old_text, 'utf-8' AS old_flags "
            f"FROM (SELECT *, CAST(event_id * 10 + 1 AS BIGINT) AS k FROM w_raw WHERE {RAW_OK}) "
            f"JOIN pages_out ON page_latest = k",
            SPLIT, ("pages_out", PAGES),
        ),
        # Lookup
        "latest_text": with_views("SELECT page_id, rev_id, text FROM latest", LATEST),
        "decode_text": with_views("SELECT old_id, old_text AS text FROM w_text"),
        "random_pages": with_views(
            "SELECT page_id FROM w_page WHERE page_namespace = 0 ORDER BY md5('7-' || CAST(page_id AS VARCHAR)), page_id LIMIT 25"
        ),
        "resolve_titles": with_views("SELECT * FROM resolved", ASKED, MEANT, RESOLVED),
        "unresolved_titles": with_views("SELECT DISTINCT title FROM resolved WHERE page_id IS NULL", ASKED, MEANT, RESOLVED),
        "normalize_title": with_views(
            """SELECT event_id, upper(l[1]) || replace(l[2:], ' ', '_') || '_._' AS stored,
              CASE WHEN l[2:-2] LIKE '%:%' THEN concat(p, ':', upper(substr(l, length(p) + 2, 1)), substr(l, length(p) + 3))
                ELSE upper(l[1]) || l[2:] END AS dumped
            FROM (SELECT event_id, lower(title) AS l, regexp_extract(lower(title), '^(.+?):', 1) AS p FROM w_raw)"""
        ),
        "page_lines": with_views("SELECT doc_id * 10 + 1 AS page_id, CAST(line_no AS BIGINT) AS line_no, line FROM lines", LINES),
        "missing_pages": with_views(
            "SELECT page_id FROM w_page WHERE page_namespace = 0 AND page_id NOT IN (SELECT page_id FROM latest)", LATEST
        ),
        "find_article": with_views(
            "SELECT event_id + 1 AS position, coalesce(text, '') AS text FROM w_raw WHERE title = 'Portal:Purchase' "
            "ORDER BY event_id LIMIT 1"
        ),
        "get_articles": reader("category IN (SELECT name FROM inside)", "SELECT page_id, text FROM read"),
        "check_articles": reader(
            "category = 'NATION_3'",
            "SELECT page_id, length(text) AS length, CAST(length(text) < 20 AS BIGINT) AS very_short, "
            "CASE WHEN length(text) < 20 THEN 'Page with ID ' || CAST(page_id AS VARCHAR) || ' is very short: ' "
            "ELSE 'Length: ' || CAST(length(text) AS VARCHAR) || chr(10) END || '>>>>' || text || '<<<<' AS report FROM read",
        ),
        "check_summary": reader(
            "category IN (SELECT name FROM inside)",
            "SELECT CAST(length(text) < 20 AS BIGINT) AS very_short, count(*) AS pages, "
            "CAST(sum(length(text)) AS BIGINT) AS characters FROM read GROUP BY 1",
        ),
        # Categories
        "direct_subcategories": with_views("SELECT parent, name, page_id FROM links", LINKS),
        "all_subcategories": with_views(
            "SELECT 'World' AS root, d.name, p.page_id, CAST(min(depth) AS BIGINT) AS depth FROM deep d "
            "JOIN w_page p ON p.page_title = d.name AND p.page_namespace = 14 GROUP BY d.name, p.page_id",
            LINKS, BELOW,
            (
                "deep",
                # No shortest path has more steps than there are categories.
                "SELECT name, 1 AS depth FROM links WHERE parent = 'World' UNION "
                "SELECT l.name, depth + 1 FROM deep x JOIN links l ON l.parent = x.name WHERE depth <= (SELECT count(DISTINCT name) FROM links)",
            ),
        ),
        "subcategory_edges": with_views(
            "SELECT name AS child, parent FROM links WHERE parent IN (SELECT name FROM inside)", LINKS, BELOW, INSIDE
        ),
        "category_pages": with_views("SELECT category, page_id FROM members", MEMBERS),
        "category_counts": with_views(
            "SELECT name AS category, count(page_id) AS members FROM names LEFT JOIN members ON category = name GROUP BY name",
            NAMES, MEMBERS,
        ),
        "category_set_pages": with_views(
            "SELECT DISTINCT page_id FROM members WHERE category IN (SELECT name FROM inside)", LINKS, BELOW, INSIDE, MEMBERS
        ),
        "expand_categories": with_views(
            "SELECT name, name IN ('EUROPE', 'Part_1', 'Nowhere') AS given FROM several",
            LINKS,
            ("several", "SELECT unnest(['EUROPE', 'Part_1', 'Nowhere']) AS name UNION SELECT l.name FROM several s JOIN links l ON l.parent = s.name"),
        ),
        "eligible_categories": with_views(
            f"SELECT category, count(*) AS members FROM members WHERE NOT contains(category, '/') "
            f"GROUP BY category HAVING count(*) >= {MIN_MEMBERS}",
            MEMBERS,
        ),
        "page_categories": with_views(
            "SELECT page_id, CAST(0 AS BIGINT) AS part, string_agg(category, chr(10) ORDER BY category) AS categories "
            "FROM eligible GROUP BY page_id",
            MEMBERS, ELIGIBLE,
        ),
        "list_subcategories": with_views(
            "SELECT page_id, name FROM below JOIN w_page ON page_title = name AND page_namespace = 14", LINKS, BELOW
        ),
        # Label hierarchy
        "classify_vertices": with_views(
            """SELECT v AS vertex, CASE WHEN up AND down THEN 'interior' WHEN up THEN 'leaf' WHEN down THEN 'root' ELSE 'isolated' END AS kind
            FROM (SELECT v, v IN (SELECT child FROM edges WHERE child <> parent) AS up,
              v IN (SELECT parent FROM edges WHERE child <> parent) AS down
              FROM (SELECT child AS v FROM edges UNION SELECT parent FROM edges))""",
            LINKS, EDGES,
        ),
        "add_leaf_labels": with_views("SELECT child, parent FROM labelled", LINKS, EDGES, INNER, LABELLED),
        "remove_root": with_views(
            "SELECT v AS vertex, count(parent) AS edges FROM left_vertices LEFT JOIN left_edges ON child = v GROUP BY v",
            LINKS, EDGES, INNER, LABELLED, LEFT, LEFT_VERTICES,
        ),
        "transitive_closure": with_views(
            "SELECT vertex, ancestor FROM closure",
            LINKS, EDGES,
            ("closure", "SELECT child AS vertex, parent AS ancestor FROM edges UNION SELECT c.vertex, e.parent FROM closure c JOIN edges e ON e.child = c.ancestor"),
        ),
        "label_hierarchy": hierarchy(1, "SELECT category, CAST(0 AS BIGINT) AS part, supercategories FROM hierarchy"),
        # Text
        "remove_categories": on_text(categories("t")),
        "remove_plain_categories": on_text(plain_categories("t")),
        "remove_interwiki_links": on_text(interwiki("t")),
        "remove_plain_interwiki_links": on_text(plain_interwiki("t")),
        "remove_balanced": on_regions(regions("texts", "result", "brackets")),
        "remove_templates": on_regions(regions("texts", "result", "templates")),
        "remove_tables": on_regions(regions("texts", "result", "tables")),
        "remove_images": on_regions(images("texts", "result")),
        "remove_math_markup": on_regions(regions("texts", "result", "math")),
        "remove_wiki_links": on_text(links("t")),
        "remove_person_data": on_text(person("t")),
        "remove_emphasis": on_text(emphasis("t")),
        "remove_directives": on_text(directives("t")),
        "remove_headlines": on_text(headlines("t")),
        "remove_headline_markup": on_text(headline_markup("t")),
        "remove_empty_pairs": on_text(pairs("t")),
        "remove_unnecessary_whitespace": on_text(whitespace("t")),
        "trim": on_text(trim("t")),
        "wiki_to_plaintext": plaintext(headlines),
        "wiki_to_plaintext_with_headlines": plaintext(headline_markup),
        "extract_abstract": with_views(
            f"SELECT t.doc_id, CASE WHEN p IS NOT NULL THEN substr(t, 1, p + 1) "
            f"ELSE {sub('substr(t, 1, 400)', f'(?m)({S}+[^' + S[1:-1] + ']+)$')} END AS text "
            f"FROM texts t LEFT JOIN stops s ON s.doc_id = t.doc_id",
            *HEAD,
        ),
        "render_lines": on_text(render("t")),
        "render_page": with_views(JOINED_BLOCKS, SOURCE, *BLOCKS),
        "render_blocks": with_views("SELECT doc_id, CAST(block AS BIGINT) AS block, kind, text FROM blocks", SOURCE, *BLOCKS),
        "remove_any_delimiters": with_views("SELECT doc_id, t AS text FROM word", SOURCE, *WORD_REGIONS, *_kept("texts", "word")),
        "tighten_parentheses": on_text(tighten("t")),
        "abbreviation_dots": with_views(
            "SELECT doc_id, CAST(p AS BIGINT) AS dot, CAST(abbreviation AS BIGINT) AS abbreviation FROM dots WHERE n <= 15", *DOTS
        ),
        "extract_person_data": with_views(
            "SELECT doc_id * 10 + 1 AS page_id, "
            + ", ".join(
                f"regexp_extract(wikitext, {text(PERSON)}, {i}) AS {n}"
                for i, n in enumerate(
                    ("name", "alternativnamen", "kurzbeschreibung", "geburtsdatum", "geburtsort", "sterbedatum", "sterbeort"), 1
                )
            )
            + f" FROM w_wikitext WHERE regexp_matches(wikitext, {text(PERSON)})"
        ),
        "cleaning_report": with_views(
            """SELECT step, count(*) FILTER (n <> 0) AS pages, CAST(sum(n) AS BIGINT) AS characters FROM (
              SELECT 'remove_categories' AS step, length(t) - length(a) AS n FROM cleaned
              UNION ALL SELECT 'remove_interwiki_links', length(a) - length(b) FROM cleaned
              UNION ALL SELECT 'remove_person_data', length(b) - length(c) FROM cleaned) GROUP BY step""",
            SOURCE,
            ("cleaned_a", f"SELECT t, {categories('t')} AS a FROM texts"),
            ("cleaned_b", f"SELECT t, a, {interwiki('a')} AS b FROM cleaned_a"),
            ("cleaned", f"SELECT t, a, b, {person('b')} AS c FROM cleaned_b"),
        ),
        # Corpus and sinks
        "extract_corpus": with_views(
            "SELECT a.page_id, text, CAST(0 AS BIGINT) AS part, categories FROM articles a JOIN lists l ON l.page_id = a.page_id",
            *CORPUS,
        ),
        "write_member_lists": with_views("SELECT category, CAST(page_id AS VARCHAR) AS page_id FROM eligible", MEMBERS, ELIGIBLE),
        "write_corpus": with_views(
            "SELECT a.page_id, length(text) AS characters, CAST(0 AS BIGINT) AS part, categories, labels "
            "FROM articles a JOIN lists l ON l.page_id = a.page_id",
            *CORPUS,
        ),
        "write_label_pairs": with_views(
            "SELECT CAST(page_id AS VARCHAR) || chr(9) || category AS value FROM members WHERE NOT contains(category, '/')", MEMBERS
        ),
        "write_hierarchy": hierarchy(MIN_MEMBERS, "SELECT category || ': ' || supercategories AS value FROM hierarchy"),
        "write_delimited": reader(
            "category = 'World'",
            "SELECT value, count(*) AS n FROM (SELECT unnest(string_split('>>>>START ARTICLE<<<<' || chr(10) || text || "
            "chr(10) || '>>>>END ARTICLE<<<<', chr(10))) AS value FROM read) GROUP BY value",
        ),
    }
