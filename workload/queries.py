"""One query per operator, over the derived wiki.

A query takes the views and returns a DataFrame of strings and bigints.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry import Wiki
from pagequarry.functions import abstracts, balanced, lines, markup, titles
from pagequarry.operators import categories, cleaning, hierarchy, importing, lookup
from pagequarry.plans import articles, corpus, labels
from pagequarry.session import scratch_path
from pagequarry.sinks import versions, writers
from pagequarry.sources import dump, sql_dump, wikitext
from pagequarry.streaming import dumps as dump_stream
from workload.views import Data, load

Query = Callable[[Data], DataFrame]
REGISTRY: dict[str, Query] = {}

ROOT = "world"  # normalised to World
MIN_MEMBERS = 2


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def big(column: str | Column, name: str | None = None) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("bigint").alias(name or column)


def all_names(data: Data) -> DataFrame:
    """Every category name of the link table."""
    return data["w_categorylinks"].select(F.col("cl_to").alias("name")).distinct()


def article_ids(data: Data) -> DataFrame:
    return data["w_page"].where("page_namespace = 0").select("page_id")


# --- Sources ---------------------------------------------------------------


def _escaped(column: str) -> Column:
    value = F.col(column)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(raw), F.lit(entity))
    return value


def _element(name: str, column: str, attributes: str = "") -> Column:
    """The element, or nothing where the column is null."""
    body = F.concat(F.lit(f"<{name}{attributes}>"), _escaped(column), F.lit(f"</{name}>\n"))
    return F.coalesce(body, F.lit(""))


def _dump(data: Data, compression: str = "none") -> str:
    """Folder of the raw pages as an XML dump."""
    return data.file(f"dump-{compression}", lambda path: _write_dump(data, path, compression))


def _write_dump(data: Data, path: str, compression: str) -> None:
    """The raw pages as an XML dump, in event order."""
    contributor = F.concat(
        F.lit("<contributor>"), _element("username", "username"), _element("id", "user_id"), _element("ip", "ip"),
        F.lit("</contributor>\n"),
    )
    page = F.concat(
        F.lit("<page>\n"), _element("title", "title"), _element("id", "id"), _element("restrictions", "restrictions"),
        F.lit("<revision>\n"), _element("id", "rev_id"), _element("timestamp", "timestamp"), contributor,
        F.when(F.col("minor").isNotNull(), "<minor />\n").otherwise(""),
        F.when(F.col("comment").isNull(), "<comment />\n").otherwise(_element("comment", "comment")),
        F.when(F.col("text") == "", '<text xml:space="preserve" />\n').otherwise(
            _element("text", "text", ' xml:space="preserve"')
        ),
        F.lit("</revision>\n</page>"),
    )
    names = data["w_namespaces"].select(
        F.format_string('<namespace key="%d">%s</namespace>\n', "ns_id", _escaped("ns_name")).alias("value")
    )
    # The header is one element for the whole dump; the namespaces are few.
    header = names.agg(F.array_join(F.array_sort(F.collect_list("value")), "").alias("n")).select(
        F.concat(
            F.lit("<wiki>\n<siteinfo>\n<sitename>Test</sitename>\n<base>b</base>\n<generator>g</generator>\n"),
            F.lit("<case>first-letter</case>\n<namespaces>\n"), "n", F.lit("</namespaces>\n</siteinfo>"),
        ).alias("value")
    )
    header.write.option("compression", compression).text(f"{path}/a-header")
    pages = data["w_raw"].repartitionByRange("event_id").sortWithinPartitions("event_id").select(page.alias("value"))
    pages.write.option("compression", compression).text(f"{path}/b-pages")


def _folders(path: str) -> list[str]:
    return [f"{path}/a-header", f"{path}/b-pages"]


def _flat(raw: DataFrame) -> DataFrame:
    r = F.col("revision")[0]
    return raw.select(
        "title", "id", "restrictions", r["id"].alias("rev_id"), r["timestamp"].alias("timestamp"),
        r["contributor"]["username"].alias("username"), r["contributor"]["id"].alias("user_id"),
        r["contributor"]["ip"].alias("ip"), r["minor"].alias("minor"),
        F.coalesce(r["comment"], F.lit("")).alias("comment"), F.coalesce(r["text"], F.lit("")).alias("text"),
    )


@query
def read_pages(data: Data) -> DataFrame:
    return _flat(dump.well_formed(dump.read_pages(data.spark, _folders(_dump(data)))))


@query
def read_compressed_pages(data: Data) -> DataFrame:
    return _flat(dump.well_formed(dump.read_pages(data.spark, _folders(_dump(data, "bzip2")))))


@query
def read_namespaces(data: Data) -> DataFrame:
    """The namespaces in the header of a dump, with the pages it has of each."""
    folders = _folders(_dump(data))
    names = dump.read_namespaces(data.spark, folders)
    pages = importing.split_namespace(dump.well_formed(dump.read_pages(data.spark, folders)), names)
    counts = pages.groupBy(F.col("namespace").alias("ns_id")).agg(F.count(F.lit(1)).alias("pages"))
    return names.join(counts, "ns_id", "left").select(big("ns_id"), "ns_name", F.coalesce("pages", F.lit(0)).alias("pages"))


def _quoted(column: str) -> Column:
    value = F.replace(F.replace(F.col(column), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.concat(F.lit("'"), value, F.lit("'"))


@query
def read_sql_dump(data: Data) -> DataFrame:
    """The links and titles written as INSERT lines (gzip) and read back."""
    path = scratch_path(data.spark, "categorylinks")
    awkward = F.concat("cl_to", F.lit("'s (a,b),(\\"))
    data["w_categorylinks"].select("cl_from", awkward.alias("cl_to")).select(
        F.concat(
            F.lit("INSERT INTO `categorylinks` VALUES ("), F.col("cl_from").cast("string"), F.lit(","),
            _quoted("cl_to"), F.lit(",'KEY','2009-01-01 00:00:00'),(7,"), _quoted("cl_to"), F.lit(",NULL,'x');"),
        ).alias("value")
    ).write.option("compression", "gzip").text(path)
    return sql_dump.read_sql_dump(data.spark, path, sql_dump.CATEGORYLINKS)


@query
def wiki_tables(data: Data) -> DataFrame:
    """Tables written with a prefix, opened again by folder."""
    base = scratch_path(data.spark, "wiki")
    wiki = data.wiki()
    for name in ("page", "categorylinks", "revision", "text"):
        getattr(wiki, name).write.parquet(f"{base}/de_{name}")
    opened = Wiki.from_path(data.spark, base, prefix="de_")
    rows = {
        "page": ("page_id", F.concat_ws("|", "page_namespace", "page_title")),
        "categorylinks": ("cl_from", F.col("cl_to")),
        "revision": ("rev_id", F.concat_ws("|", "rev_page", "rev_text_id")),
        "text": ("old_id", F.concat_ws("|", "old_flags", "old_text")),
    }
    tables = [
        getattr(opened, name).select(F.lit(name).alias("name"), big(key, "id"), value.alias("row")) for name, (key, value) in rows.items()
    ]
    return reduce(DataFrame.unionByName, tables)


@query
def read_wikitext_lines(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "lines")
    data["w_wikitext"].select(F.col("wikitext").alias("value")).write.text(path)
    return (
        wikitext.read_wikitext_lines(data.spark, path)
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- Import ----------------------------------------------------------------


def _key() -> Column:
    return F.col("event_id")


@query
def split_namespace(data: Data) -> DataFrame:
    found = importing.split_namespace(data.raw_pages(), data["w_namespaces"])
    return found.select("event_id", big("namespace"), "bare_title")


@query
def import_title(data: Data) -> DataFrame:
    return data["w_raw"].select("event_id", titles.underscored(F.col("title")).alias("page_title"))


@query
def parse_timestamp(data: Data) -> DataFrame:
    stamp = importing.parse_timestamp(F.col("timestamp"))
    return data["w_raw"].select(
        "event_id",
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("ts"),
        importing.compact_timestamp(F.col("timestamp")).alias("compact"),
    )


@query
def rejected_rows(data: Data) -> DataFrame:
    return importing.rejected_rows(data.raw_pages())


@query
def resolve_contributor(data: Data) -> DataFrame:
    contributor = F.col("revision")[0]["contributor"]
    return data.raw_pages().select(
        "event_id",
        importing.contributor_name(contributor).alias("rev_user_text"),
        importing.contributor_id(contributor).alias("rev_user"),
    )


@query
def minor_flag(data: Data) -> DataFrame:
    return data["w_raw"].select("event_id", big(importing.minor_flag(F.col("minor")), "rev_minor_edit"))


@query
def redirect_flag(data: Data) -> DataFrame:
    return data["w_raw"].select("event_id", big(importing.is_redirect(F.col("text")), "page_is_redirect"))


@query
def length_and_latest(data: Data) -> DataFrame:
    return data["w_raw"].select(
        "event_id",
        importing.byte_length(F.col("text")).alias("page_len"),
        importing.number(F.col("rev_id")).alias("page_latest"),
    )


@query
def page_rows(data: Data) -> DataFrame:
    """All page columns but the random one and the time of the import."""
    rows = importing.page_rows(data.raw_pages(), data["w_namespaces"])
    return rows.select(
        "page_id", big("page_namespace"), "page_title", "page_restrictions", "page_counter", big("page_is_redirect"),
        big("page_is_new"), "page_latest", "page_len",
    )


def _revisions(rows: DataFrame) -> DataFrame:
    return rows.select(
        "rev_id", "rev_page", "rev_text_id", "rev_comment", "rev_user", "rev_user_text",
        F.date_format("rev_timestamp", "yyyyMMddHHmmss").alias("rev_timestamp"), big("rev_minor_edit"), big("rev_deleted"),
    )


@query
def revision_rows(data: Data) -> DataFrame:
    return _revisions(importing.revision_rows(data.raw_pages()))


@query
def text_rows(data: Data) -> DataFrame:
    return importing.text_rows(data.raw_pages())


@query
def skip_loaded(data: Data) -> DataFrame:
    """What is left when all pages with a minor edit are loaded."""
    loaded = importing.page_rows(data.raw_pages().where(F.col("revision")[0]["minor"].isNotNull()), data["w_namespaces"])
    return importing.skip_loaded(data.raw_pages(), loaded).select("event_id", "id")


@query
def import_statistics(data: Data) -> DataFrame:
    return importing.import_statistics(data.raw_pages())


@query
def incremental_import(data: Data) -> DataFrame:
    """The dump arrives as files; the stream takes them in and ends."""
    folder = f"{_dump(data)}/b-pages"
    base, state = scratch_path(data.spark, "tables"), scratch_path(data.spark, "stream")
    raw = dump_stream.read_page_stream(data.spark, folder, files_per_batch=4)
    dump_stream.start_import(raw, data["w_namespaces"], base, state).awaitTermination()
    columns = {
        "page": ("page_id", F.concat_ws("|", "page_namespace", "page_title", "page_is_redirect", "page_latest", "page_len")),
        "revision": ("rev_id", F.concat_ws("|", "rev_page", "rev_comment", "rev_user", "rev_user_text", "rev_minor_edit")),
        "text": ("old_id", F.concat_ws("|", "old_flags", "old_text")),
        "rejected": ("revision", F.concat_ws("|", "title", "page", "reason", "value")),
    }
    tables = [
        dump_stream.imported_table(data.spark, base, name).select(
            F.lit(name).alias("name"), F.col(key).cast("string").alias("id"), value.alias("row")
        )
        for name, (key, value) in columns.items()
    ]
    return reduce(DataFrame.unionByName, tables)


@query
def wiki_table_import(data: Data) -> DataFrame:
    """Dump file to tables on disk, page and text joined again."""
    raw = dump.well_formed(dump.read_pages(data.spark, _folders(_dump(data))))
    base = scratch_path(data.spark, "import")
    writers.import_dump(raw, data["w_namespaces"], base)
    paths = versions.table_paths(data.spark, base, ["page", "text"])
    page, text = (data.spark.read.parquet(paths[name]) for name in ("page", "text"))
    return page.join(text, F.col("page_latest") == F.col("old_id")).select(
        "page_id", big("page_namespace"), "page_title", "page_len", "old_text", "old_flags"
    )


# --- Lookup ----------------------------------------------------------------


@query
def latest_text(data: Data) -> DataFrame:
    return lookup.latest_text(data.wiki())


@query
def decode_text(data: Data) -> DataFrame:
    """The bodies stored as bytes, those without the flag in Latin-1."""
    stored = F.when(F.col("old_flags").contains("utf-8"), F.encode("old_text", "UTF-8")).otherwise(
        F.encode("old_text", "ISO-8859-1")
    )
    text = data["w_text"].select("old_id", stored.alias("old_text"), "old_flags")
    return lookup.decode_text(Wiki(data["w_page"], data["w_categorylinks"], data["w_revision"], text))


@query
def random_pages(data: Data) -> DataFrame:
    return lookup.random_pages(data.graph(), n=25, seed=7)


def _asked(data: Data) -> DataFrame:
    """Titles as users write them: spaces, lower case, prefixes, misses."""
    written = F.replace(F.concat(F.lower(F.substring("page_title", 1, 1)), F.substring("page_title", F.lit(2), F.length("page_title"))), F.lit("_"), F.lit(" "))
    title = (
        F.when(F.col("page_namespace") == 10, F.concat(F.lit("Vorlage:"), written))
        .when(F.col("page_namespace") == 14, F.concat(F.lit("Template:"), written))
        .otherwise(written)
    )
    return data["w_page"].select(title.alias("title"))


@query
def resolve_titles(data: Data) -> DataFrame:
    return lookup.resolve_titles(data.graph(), _asked(data)).select(
        "title", big("page_namespace"), "page_title", "page_id"
    )


@query
def unresolved_titles(data: Data) -> DataFrame:
    return lookup.unresolved_titles(data.graph(), _asked(data))


@query
def normalize_title(data: Data) -> DataFrame:
    """Every line's title forms: with underscores, and as in a dump."""
    return data["w_raw"].select(
        "event_id",
        titles.normalize_title(F.concat(F.lower("title"), F.lit("\t.\n"))).alias("stored"),
        titles.normalize_dump_title(F.lower("title")).alias("dumped"),
    )


@query
def page_lines(data: Data) -> DataFrame:
    pages = data["w_wikitext"].select("page_id", F.col("wikitext").alias("text"))
    return lookup.page_lines(pages).select("page_id", big("line_no"), "line")


@query
def missing_pages(data: Data) -> DataFrame:
    return lookup.missing_pages(data.wiki(), article_ids(data))


@query
def find_article(data: Data) -> DataFrame:
    raw = dump.read_pages(data.spark, _folders(_dump(data)), with_position=True)
    return lookup.find_article(raw, "Portal:purchase")


@query
def get_articles(data: Data) -> DataFrame:
    return articles.get_articles(data.wiki(), category="world", recursive=True)


@query
def check_articles(data: Data) -> DataFrame:
    found = articles.get_articles(data.wiki(), category="NATION 3")
    return articles.check_articles(found).select("page_id", "length", big("very_short"), "report")


@query
def check_summary(data: Data) -> DataFrame:
    found = articles.get_articles(data.wiki(), category="World", recursive=True)
    return articles.check_summary(articles.check_articles(found)).select(big("very_short"), "pages", "characters")


# --- Categories ------------------------------------------------------------


@query
def direct_subcategories(data: Data) -> DataFrame:
    return categories.direct_subcategories(data.graph(), all_names(data))


@query
def all_subcategories(data: Data) -> DataFrame:
    wiki = data.graph()
    return categories.all_subcategories(wiki, categories.named(wiki, ROOT)).select(
        "root", "name", "page_id", big("depth")
    )


@query
def subcategory_edges(data: Data) -> DataFrame:
    return categories.subcategory_edges(data.graph(), ROOT)


@query
def category_pages(data: Data) -> DataFrame:
    return categories.category_pages(data.graph(), all_names(data))


@query
def category_counts(data: Data) -> DataFrame:
    return categories.category_counts(data.graph(), all_names(data))


@query
def category_set_pages(data: Data) -> DataFrame:
    return categories.category_set_pages(data.graph(), ROOT, recursive=True)


@query
def expand_categories(data: Data) -> DataFrame:
    wiki = data.graph()
    given = categories.named(wiki, "EUROPE", "Part 1", "nowhere")
    return categories.expand_categories(wiki, given).join(
        given.withColumn("given", F.lit(True)), "name", "left"
    ).select("name", F.coalesce("given", F.lit(False)).alias("given"))


@query
def eligible_categories(data: Data) -> DataFrame:
    return categories.eligible_categories(data.graph(), all_names(data), MIN_MEMBERS)


@query
def page_categories(data: Data) -> DataFrame:
    found = categories.page_categories(data.graph(), all_names(data), MIN_MEMBERS)
    return categories.page_category_lists(found).select(
        "page_id", big("part"), F.concat_ws("\n", "categories").alias("categories")
    )


@query
def list_subcategories(data: Data) -> DataFrame:
    return categories.list_subcategories(data.graph(), ROOT, everything=True)


# --- Label hierarchy -------------------------------------------------------


def _edges(data: Data) -> DataFrame:
    """Every subcategory edge of the wiki."""
    return categories.subcategory_links(data.graph()).select(F.col("name").alias("child"), "parent")


@query
def classify_vertices(data: Data) -> DataFrame:
    return hierarchy.classify_vertices(_edges(data))


@query
def add_leaf_labels(data: Data) -> DataFrame:
    return hierarchy.add_leaf_labels(_edges(data), "World")


@query
def remove_root(data: Data) -> DataFrame:
    edges = hierarchy.add_leaf_labels(_edges(data), "World")
    left = hierarchy.remove_vertex(edges, "World").select(F.col("child").alias("vertex"), F.lit(1).alias("edges"))
    return (
        hierarchy.remaining_vertices(edges, "World")
        .join(left.groupBy("vertex").agg(F.sum("edges").alias("edges")), "vertex", "left")
        .select("vertex", F.coalesce("edges", F.lit(0)).cast("bigint").alias("edges"))
    )


@query
def transitive_closure(data: Data) -> DataFrame:
    return hierarchy.transitive_closure(_edges(data))


@query
def label_hierarchy(data: Data) -> DataFrame:
    return hierarchy.label_hierarchy(data.graph(), ROOT, 1).select("category", big("part"), "supercategories")


# --- Text ------------------------------------------------------------------


def _texts(data: Data) -> DataFrame:
    return data["w_wikitext"].select("doc_id", F.col("wikitext").alias("text"))


def _text_query(name: str, function: Callable[[Column], Column]) -> None:
    def run(data: Data) -> DataFrame:
        return _texts(data).select("doc_id", function(F.col("text")).alias("text"))

    run.__name__ = name
    query(run)


TEXT_OPERATORS: dict[str, Callable[[Column], Column]] = {
    "remove_categories": markup.remove_categories,
    "remove_plain_categories": markup.remove_plain_categories,
    "remove_interwiki_links": markup.remove_interwiki_links,
    "remove_plain_interwiki_links": markup.remove_plain_interwiki_links,
    "remove_balanced": lambda text: markup.remove_balanced(text, "[[", "]]"),
    "remove_templates": markup.remove_templates,
    "remove_tables": markup.remove_tables,
    "remove_images": markup.remove_images,
    "remove_math_markup": markup.remove_math_markup,
    "remove_wiki_links": markup.remove_wiki_links,
    "remove_person_data": markup.remove_person_data,
    "remove_emphasis": markup.remove_emphasis,
    "remove_directives": markup.remove_directives,
    "remove_headlines": markup.remove_headlines,
    "remove_headline_markup": markup.remove_headline_markup,
    "remove_empty_pairs": markup.remove_empty_pairs,
    "remove_unnecessary_whitespace": markup.remove_unnecessary_whitespace,
    "trim": markup.trim,
    "wiki_to_plaintext": markup.wiki_to_plaintext,
    "wiki_to_plaintext_with_headlines": lambda text: markup.wiki_to_plaintext(text, headlines="keep_text"),
    "extract_abstract": abstracts.extract_abstract,
    "render_lines": lines.render_lines,
    "render_page": lines.render_page,
    "tighten_parentheses": markup.tighten_parentheses,
}
for _name, _function in TEXT_OPERATORS.items():
    _text_query(_name, _function)


@query
def abbreviation_dots(data: Data) -> DataFrame:
    """The dots an abstract looks at, with whether they end an abbreviation."""
    dots = _texts(data).select("doc_id", "text", F.explode(abstracts.dot_positions(F.col("text"))).alias("dot"))
    return dots.select(
        "doc_id", big("dot"), big(abstracts.is_abbreviation_dot(F.col("text"), F.col("dot")), "abbreviation")
    )


@query
def render_blocks(data: Data) -> DataFrame:
    """Paragraphs, lists, code, rules and headlines of every page, in order."""
    blocks = _texts(data).select("doc_id", F.posexplode(lines.render_blocks(F.col("text"))).alias("block", "b"))
    return blocks.select("doc_id", big("block"), "b.kind", "b.text")


@query
def remove_any_delimiters(data: Data) -> DataFrame:
    """Regions that begin with a word and end by brackets."""
    region = balanced.Region.of("[[", "]]", "Category:")
    return _texts(data).select("doc_id", balanced.remove_regions(F.col("text"), region).alias("text"))


@query
def extract_person_data(data: Data) -> DataFrame:
    return cleaning.extract_person_data(data["w_wikitext"].select("page_id", F.col("wikitext").alias("text")))


@query
def cleaning_report(data: Data) -> DataFrame:
    return cleaning.cleaning_report(cleaning.clean_pages(_texts(data)))


# --- Corpus and sinks ------------------------------------------------------


def _corpus(data: Data) -> corpus.Corpus:
    return corpus.extract_corpus(data.wiki(), [ROOT], subcategories=True, min_members=MIN_MEMBERS)


@query
def extract_corpus(data: Data) -> DataFrame:
    """Cleaned latest text and labels of every article below the root."""
    return _corpus(data).labelled_articles().select(
        "page_id", "text", big("part"), F.concat_ws("\n", "categories").alias("categories")
    )


@query
def write_member_lists(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "members")
    writers.write_member_lists(categories.page_categories(data.graph(), all_names(data), MIN_MEMBERS), path)
    return data.spark.read.parquet(path).select("category", F.col("page_id").cast("string").alias("page_id"))


@query
def write_corpus(data: Data) -> DataFrame:
    """Articles, lists and pairs written by one export and joined again."""
    path = scratch_path(data.spark, "corpus")
    writers.write_corpus(_corpus(data), path)
    texts = data.spark.read.parquet(f"{path}/articles")
    lists = data.spark.read.parquet(f"{path}/category_mappings")
    pairs = (
        data.spark.read.text(f"{path}/page_categories")
        .groupBy(F.substring_index("value", "\t", 1).cast("bigint").alias("page_id"))
        .agg(F.count(F.lit(1)).alias("labels"))
    )
    return (
        texts.join(lists, "page_id").join(pairs, "page_id")
        .select("page_id", big(F.length("text"), "characters"), big("part"), "categories", "labels")
    )


@query
def write_label_pairs(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "pairs")
    writers.write_label_pairs(categories.page_categories(data.graph(), all_names(data)), path)
    return data.spark.read.text(path)


@query
def write_hierarchy(data: Data) -> DataFrame:
    path = scratch_path(data.spark, "hierarchy")
    writers.write_hierarchy(labels.hierarchy_lines(data.graph(), ROOT, MIN_MEMBERS), path)
    return data.spark.read.text(path)


@query
def write_delimited(data: Data) -> DataFrame:
    """A stream of articles as lines, counted."""
    path = scratch_path(data.spark, "articles")
    writers.write_delimited(articles.get_articles(data.wiki(), category="World"), path)
    return data.spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: function(load(spark, sf_dir))

    return {name: bind(function) for name, function in REGISTRY.items()}
