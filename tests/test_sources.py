"""Dump readers on files written here."""

import bz2
import gzip
import random
import time

import pytest
from pyspark.sql import functions as F

from pagequarry.operators import importing, lookup
from pagequarry.sinks import versions, writers
from pagequarry.sources import dump, sql_dump, wikitext
from pagequarry.streaming import dumps as stream
from pagequarry.wiki import Wiki

HEADER = """<wiki version="0.3" xml:lang="en">
  <siteinfo>
    <sitename>Test</sitename><base>b</base><generator>g</generator><case>first-letter</case>
    <namespaces>
      <namespace key="-1">Special</namespace>
      <namespace key="0" />
      <namespace key="14">Category</namespace>
    </namespaces>
  </siteinfo>
"""
PAGES = """  <page>
    <title>A &amp; B</title>
    <id>1</id>
    <revision>
      <id>11</id>
      <timestamp>2001-01-15T13:15:00Z</timestamp>
      <contributor><username>Foo</username><id>3</id></contributor>
      <minor />
      <comment>c</comment>
      <text xml:space="preserve">  lead &lt;b&gt; &quot;x&quot; &amp;quot;

 tail é
</text>
    </revision>
  </page>
  <page>
    <title>Category:C d</title>
    <id>2</id>
    <restrictions>edit</restrictions>
    <revision>
      <id>12</id>
      <timestamp>2001-01-15 13:15</timestamp>
      <contributor><ip>1.2.3.4</ip></contributor>
      <comment />
      <text xml:space="preserve" />
    </revision>
  </page>
  <page>
    <title>:X</title>
    <id>3</id>
    <revision>
      <id>13</id>
      <timestamp>2001-01-15T13:15:00Z</timestamp>
      <contributor><ip>1.2.3.4</ip></contributor>
      <text xml:space="preserve">#redirect [[A]]</text>
    </revision>
  </page>
"""
BROKEN = "  <page><title>bad</title><id>9</id><revision><id>1</id><text>&nope; x</text></revision></page>\n"


@pytest.fixture
def dumps(tmp_path):
    text = HEADER + PAGES + BROKEN + "</wiki>\n"
    (tmp_path / "a.xml").write_text(text)
    (tmp_path / "b.xml.bz2").write_bytes(bz2.compress(text.encode()))
    return tmp_path


@pytest.mark.parametrize("name", ["a.xml", "b.xml.bz2"])
def test_pages(spark, dumps, name):
    raw = dump.read_pages(spark, str(dumps / name))
    pages = {r.id: r for r in dump.well_formed(raw).collect()}
    assert sorted(pages) == ["1", "2", "3"]
    first = pages["1"].revision[0]
    assert pages["1"].title == "A & B"
    assert first.text == '  lead <b> "x" &quot;\n\n tail é\n'
    assert (first.minor, pages["3"].revision[0].minor) == ("", None)
    assert pages["2"].revision[0].contributor.ip == "1.2.3.4"
    assert dump.corrupt_pages(raw).count() == 1


def test_namespaces_and_header(spark, dumps):
    path = str(dumps / "a.xml")
    found = {(r.ns_id, r.ns_name) for r in dump.read_namespaces(spark, path).collect()}
    assert found == {(-1, "Special"), (0, ""), (14, "Category")}
    assert dump.read_siteinfo(spark, path, require_case="first-letter").first()["sitename"] == "Test"
    with pytest.raises(ValueError):
        dump.read_siteinfo(spark, path, require_case="case-sensitive")


def test_file_is_split_among_tasks(spark, tmp_path):
    page = PAGES.split("</page>")[0] + "</page>\n"
    pages = "".join(page.replace("<id>1</id>", f"<id>{i}</id>").replace("A &amp;", f"T{i} &amp;") for i in range(2000))
    (tmp_path / "big.xml").write_text(HEADER + pages + "</wiki>\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        raw = dump.read_pages(spark, str(tmp_path / "big.xml"), with_position=True)
        assert raw.rdd.getNumPartitions() > 4
        assert dump.well_formed(raw).select("id").distinct().count() == 2000
        # Positions follow the file, however it was split.
        found = lookup.find_article(dump.well_formed(raw), "t1500 & B")
        assert [(r.position, r.text[:6]) for r in found.collect()] == [(1501, "  lead")]
        assert lookup.find_article(raw, "nowhere").count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_import(spark, dumps, tmp_path):
    path = str(dumps / "a.xml")
    raw = dump.well_formed(dump.read_pages(spark, path))
    report = writers.import_dump(raw, dump.read_namespaces(spark, path), str(tmp_path / "wiki"), "de_")
    assert (report["pages"], report["revisions"]) == (3, 3)
    paths = versions.table_paths(spark, str(tmp_path / "wiki"), ["page", "revision", "rejected"], "de_")
    page = {r.page_id: r for r in spark.read.parquet(paths["page"]).collect()}
    assert [(page[i].page_namespace, page[i].page_title) for i in (1, 2, 3)] == [(0, "A_&_B"), (14, "C_d"), (0, "X")]
    assert [page[i].page_is_redirect for i in (1, 2, 3)] == [0, 0, 1]
    assert page[1].page_len == len('  lead <b> "x" &quot;\n\n tail é\n'.encode())
    assert page[1].page_latest == 11 and 0 <= page[1].page_random < 1 and page[1].page_touched is not None
    revision = {r.rev_id: r for r in spark.read.parquet(paths["revision"]).collect()}
    assert sorted(revision) == [11, 13]  # 12 has no proper timestamp
    assert (revision[11].rev_user_text, revision[11].rev_user, revision[11].rev_minor_edit) == ("Foo", 3, 1)
    assert (revision[13].rev_user_text, revision[13].rev_user, revision[13].rev_comment) == ("1.2.3.4", 0, "")
    rejected = spark.read.parquet(paths["rejected"]).collect()
    assert [(r.reason, r.value) for r in rejected] == [("timestamp", "2001-01-15 13:15")]
    left = importing.skip_loaded(raw, spark.read.parquet(paths["page"]).where("page_id < 3"))
    assert [r.id for r in left.collect()] == ["3"]


def test_tables_are_replaced_together(spark, tmp_path):
    base, names = str(tmp_path / "wiki"), ["page", "text"]

    def tables(n, broken=False):
        rows = spark.range(n).select("id", F.lit(n).alias("n"))
        bad = rows.withColumn("n", F.raise_error(F.lit("lost")).cast("int")) if broken else rows
        return {"page": rows, "text": bad}

    def seen():
        paths = versions.table_paths(spark, base, names)
        return [spark.read.parquet(paths[name]).select("n").distinct().first()[0] for name in names]

    spark.range(3).withColumn("n", F.lit(1)).write.parquet(f"{base}/page")
    spark.range(3).withColumn("n", F.lit(1)).write.parquet(f"{base}/text")
    assert seen() == [1, 1]  # written apart, before there was a set
    versions.replace_tables(tables(5), base)
    assert seen() == [5, 5]
    begun = versions.table_paths(spark, base, names)
    # The second table fails after the first was written.
    with pytest.raises(Exception, match="lost"):
        versions.replace_tables(tables(7, broken=True), base)
    assert seen() == [5, 5]
    versions.replace_tables(tables(9), base)
    assert seen() == [9, 9]
    assert spark.read.parquet(begun["text"]).count() == 5  # a reader that had begun
    versions.replace_tables(tables(11), base)
    assert len(list((tmp_path / "wiki/versions").iterdir())) == 2


def test_rows_without_bodies_read_none(spark, dumps, tmp_path):
    path = str(dumps / "a.xml")
    raw = dump.well_formed(dump.read_pages(spark, path))
    names = dump.read_namespaces(spark, path)
    importing.narrowed(raw).write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    direct, apart = importing.import_pages(raw, names), importing.import_pages(staged, names)
    for name in ("page", "revision", "text", "rejected"):
        columns = [c for c in getattr(direct, name).columns if c not in ("page_random", "page_touched")]
        left, right = (sorted(map(str, getattr(i, name).select(columns).collect())) for i in (direct, apart))
        assert left == right and left
        plan = getattr(apart, name)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "ReadSchema" in line and "revision" in line]
        assert scans and all(("texts" in line) == (name == "text") for line in scans), plan


def test_stream_takes_new_files_once(spark, dumps, tmp_path):
    folder, base, state = (str(tmp_path / n) for n in ("drop", "out", "state"))
    (tmp_path / "drop").mkdir()
    names = dump.read_namespaces(spark, str(dumps / "a.xml"))

    def run():
        stream.start_import(stream.read_page_stream(spark, folder), names, base, state).awaitTermination()
        return sorted(r.page_id for r in stream.imported_table(spark, base, "page").collect())

    (tmp_path / "drop/1.xml").write_text(HEADER + PAGES + "</wiki>")
    assert run() == [1, 2, 3]
    (tmp_path / "drop/2.xml").write_text(HEADER + PAGES.replace("<id>3</id>\n    <rev", "<id>4</id>\n    <rev") + "</wiki>")
    assert run() == [1, 2, 3, 4]
    assert run() == [1, 2, 3, 4]
    # The text of a page sent again is there once.
    assert [r.old_id for r in stream.imported_table(spark, base, "text").collect()].count(11) == 1
    odd = PAGES.replace("<id>1</id>", "<id>7</id>").replace("A &amp; B", "A &unknown; B")
    (tmp_path / "drop/3.xml").write_text(HEADER + odd + "</wiki>")
    assert run() == [1, 2, 3, 4]
    assert stream.imported_table(spark, base, "corrupt").count() == 1
    assert stream.imported_table(spark, base, "rejected").columns == ["title", "page", "revision", "reason", "value"]


def test_stream_tells_its_progress(spark, dumps, tmp_path):
    """One row a batch while it runs, with totals and rates; a second run begins anew."""
    folder, base, state = (str(tmp_path / n) for n in ("drop", "out", "state"))
    (tmp_path / "drop").mkdir()
    names = dump.read_namespaces(spark, str(dumps / "a.xml"))
    told = []
    listener = stream.ImportProgress(told.append)
    spark.streams.addListener(listener)

    def run(rows):
        stream.start_import(stream.read_page_stream(spark, folder, files_per_batch=1), names, base, state).awaitTermination()
        until = time.monotonic() + 30  # listeners are told behind the query
        while (len(told) < rows or listener._totals) and time.monotonic() < until:
            time.sleep(0.1)

    try:
        for n in (1, 2):
            (tmp_path / f"drop/{n}.xml").write_text(HEADER + PAGES + "</wiki>")
        run(2)
        whole = importing.import_statistics(stream.well_formed(dump.read_pages(spark, folder))).first()
        assert [p.batch for p in told] == [0, 1]
        assert (told[1].pages, told[1].revisions, told[1].text_bytes) == tuple(whole)
        assert told[0].pages * 2 == told[1].pages and 0 < told[0].seconds < told[1].seconds
        assert told[1].rates()["pages"] == told[1].pages / told[1].seconds
        assert told[1].line().startswith(f"batch 1: {whole.pages} pages (")
        (tmp_path / "drop/3.xml").write_text(HEADER + PAGES + "</wiki>")
        run(3)
        assert (told[2].batch, told[2].pages) == (2, told[0].pages)
    finally:
        spark.streams.removeListener(listener)


def test_stream_takes_newer_revisions(spark, dumps, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "MERGED", 2)
    folder, base, state = (str(tmp_path / n) for n in ("drop", "out", "state"))
    (tmp_path / "drop").mkdir()
    names = dump.read_namespaces(spark, str(dumps / "a.xml"))
    revision = "<revision><id>{}</id><timestamp>{}</timestamp><contributor><ip>1</ip></contributor><text>{}</text></revision>"

    def send(file, *pages):
        body = "".join(
            f"<page><title>{title}</title><id>{page}</id>"
            + "".join(revision.format(r, "2001-01-15T13:15:00Z" if good else "soon", f"t{r}") for r, good in revisions) + "</page>\n"
            for page, title, revisions in pages
        )
        (tmp_path / f"drop/{file}.xml").write_text(HEADER + body + "</wiki>")
        stream.start_import(stream.read_page_stream(spark, folder), names, base, state).awaitTermination()
        counts = spark.read.parquet(f"{base}/counts").orderBy("batch").collect()[-1]
        read = {n: stream.imported_table(spark, base, n) for n in ("page", "text", "rejected")}
        return (
            sorted((r.page_id, r.page_title, r.page_latest) for r in read["page"].collect()),
            sorted(r.old_id for r in read["text"].collect()), read["rejected"].count(), (counts.new, counts.updated, counts.skipped, counts.repeated),
        )

    assert send("1", (1, "A", [(10, True)]), (2, "B", [(20, True), (21, True)]), (3, "C", [(30, False)])) == (
        [(1, "A", 10), (2, "B", 20), (3, "C", 30)], [10, 20, 21], 1, (3, 0, 0, 0)
    )
    # An equal one, a newer one with a new title, one corrected.
    assert send("2", (1, "A", [(10, True)]), (2, "B2", [(21, True), (22, True)]), (3, "C", [(30, True)])) == (
        [(1, "A", 10), (2, "B2", 22), (3, "C", 30)], [10, 20, 21, 22, 30], 1, (0, 2, 1, 0)
    )
    # Twice in a batch: each revision once, the row of the newest.
    assert send("3", (1, "A3", [(13, True)]), (1, "A2", [(12, True), (13, True)]), (4, "D", [])) == (
        [(1, "A3", 13), (2, "B2", 22), (3, "C", 30), (4, "D", None)], [10, 12, 13, 20, 21, 22, 30], 1, (1, 1, 0, 1)
    )
    assert send("4", (4, "D", []), (1, "old", [(11, True)]))[3] == (0, 0, 2, 0)
    assert send("5", (4, "D", [(40, True)]), (2, "B2", [(22, True)]))[3] == (0, 1, 1, 0)


def test_sql_dump(spark, tmp_path):
    rows = [
        (1, r"It\'s_a,_(b)", "It's_a,_(b)"),
        (2, r"x\'),(3,\'y", "x'),(3,'y"),
        (3, r"back\\slash\\nn", "back\\slash\\nn"),
        (4, r"line\nbreak\"q", 'line\nbreak"q'),
        (5, "", ""),
    ]
    values = ",".join(f"({i},'{t}','KEY','2009-01-01 00:00:00')" for i, t, _ in rows)
    text = f"-- dump\nCREATE TABLE `categorylinks` (\n  `cl_from` int(8)\n);\nINSERT INTO `categorylinks` VALUES {values};\n"
    with gzip.open(tmp_path / "links.sql.gz", "wt") as file:
        file.write(text)
    found = sql_dump.read_sql_dump(spark, str(tmp_path / "links.sql.gz"), sql_dump.CATEGORYLINKS).orderBy("cl_from")
    assert [(r.cl_from, r.cl_to) for r in found.collect()] == [(i, t) for i, _, t in rows]
    (tmp_path / "cat.sql").write_text("INSERT INTO `category` VALUES (1,'A',10,2,0),(2,NULL,-3,NULL,0);\n")
    found = sql_dump.read_sql_dump(spark, str(tmp_path / "cat.sql"), sql_dump.CATEGORY).orderBy("cat_id")
    assert [tuple(r) for r in found.collect()] == [(1, "A", 10, 2, 0), (2, None, -3, None, 0)]


def test_lines(spark, tmp_path):
    with gzip.open(tmp_path / "t.gz", "wt") as file:
        file.write("a\n\nb\n")
    assert [r.line for r in wikitext.read_wikitext_lines(spark, str(tmp_path / "t.gz")).collect()] == ["a", "", "b"]


def test_catalog_tables(spark, dumps):
    path = str(dumps / "a.xml")
    raw = dump.well_formed(dump.read_pages(spark, path))
    imported = importing.import_pages(raw, dump.read_namespaces(spark, path))
    spark.sql("CREATE DATABASE IF NOT EXISTS frwiki")
    writers.save_wiki_tables(imported, "frwiki", "p_", buckets=4)
    links = spark.createDataFrame([(1, "C_d")], "cl_from bigint, cl_to string")
    links.write.mode("overwrite").saveAsTable("frwiki.p_categorylinks")
    wiki = Wiki.from_catalog(spark, language="fr", prefix="p_")
    texts = lookup.latest_text(wiki)
    assert {r.page_id: r.text[:9] for r in texts.collect()} == {1: "  lead <b", 3: "#redirect"}
    # Revisions and bodies are read in place: one exchange, of ids.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = lookup.latest_text(wiki)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Bucketed: true") == 2 and plan.count("Exchange hashpartitioning") == 1, plan
    spark.sql("DROP DATABASE frwiki CASCADE")


def test_timestamps(spark):
    rows = [("2001-02-03T04:05:06Z",), ("2001-02-03T04:05:06",), ("2001-13-45T99:99:99Z",), (None,)]
    frame = spark.createDataFrame(rows, "t string")
    found = frame.select(
        importing.parse_timestamp(F.col("t")).cast("string").alias("a"), importing.compact_timestamp(F.col("t")).alias("b")
    )
    assert [tuple(r) for r in found.collect()] == [
        ("2001-02-03 04:05:06", "20010203040506"), (None, None), (None, "20011345999999"), (None, None),
    ]


def test_sql_dump_in_any_form(spark, tmp_path):
    dump = (
        "-- a comment; with a semicolon\n/*!40000 ALTER TABLE `t` DISABLE KEYS */;\n"
        "INSERT INTO category(cat_id, cat_title) VALUES (1,'a'),\n(2, 'it''s\nhere'),\n  (3 , _binary 'b\\'q');\n"
        "insert ignore into `category` (`cat_title`,cat_pages,`cat_id`) values ('x,(y)',7,4);\n"
        "INSERT INTO category VALUES (5,NULL,1,2,3),(6,broken(,1),(7,'''');\nSELECT 1;\n"
    )
    (tmp_path / "dump.sql").write_text(dump)
    read = sql_dump.read_sql_dump(spark, str(tmp_path), "cat_id bigint, cat_title string, cat_pages int")
    assert sorted(tuple(r) for r in read.collect()) == [
        (1, "a", None), (2, "it's\nhere", None), (3, "b'q", None), (4, "x,(y)", 7), (5, None, 1), (7, "'", None)
    ]
    rest = [r.rest for r in sql_dump.rejected_sql(spark, str(tmp_path)).collect()]
    assert len(rest) == 1 and "broken" in rest[0]


def test_sql_dump_of_several_tables(spark, tmp_path):
    (tmp_path / "all.sql").write_text(
        "INSERT INTO text(old_id,old_text,old_flags) VALUES (1,'a','utf-8'),(2,'b','utf-8');\n"
        "INSERT INTO page(page_id,page_title) VALUES (7,'T'),(8,'U');\n"
        "INSERT INTO `dewiki`.`text` VALUES (3,'c','');\n"
    )
    path, columns = str(tmp_path / "all.sql"), "old_id bigint, old_text string"
    assert sorted(tuple(r) for r in sql_dump.read_sql_dump(spark, path, columns, "text").collect()) == [(1, "a"), (2, "b"), (3, "c")]
    pages = sql_dump.read_sql_dump(spark, path, "page_id bigint, page_title string", "page")
    assert sorted(tuple(r) for r in pages.collect()) == [(7, "T"), (8, "U")]
    assert sql_dump.read_sql_dump(spark, path, columns, "tex").count() == 0
    assert sql_dump.rejected_sql(spark, path).count() == 0


def test_ends_of_statements_inside_literals(spark, tmp_path):
    """Literals, comments and names that hold a semicolon and a line break, over
    files cut into many blocks."""
    rng = random.Random(12)
    pieces = [";\n", ";\n", "'", "\\", '"', "`", "-- ", "/*", "*/", "#", "x", "INSERT INTO t VALUES (9,'9');\n", "(1,'", "ü"]
    want, files = [], 3
    for n in range(files):
        out = []
        for i in range(300):
            rows = []
            for _ in range(rng.randint(1, 3)):
                text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
                quoted = text.replace("\\", "\\\\")
                quoted = quoted.replace("'", rng.choice(["\\'", "''"]))
                rows.append(f"({len(want)},'{quoted}')")
                want.append((len(want), text))
            out.append(f"INSERT INTO t VALUES {','.join(rows)};\n")
            out.append(rng.choice(["", "", "-- it's;\n", "/* don't;\n (1,'x');\n */;\n", "CREATE TABLE `a;\nb` (c text DEFAULT \"';\n\");\n", "# 'q;\n"]))
        (tmp_path / f"{n}.sql").write_text("".join(out))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        found = sql_dump.read_sql_dump(spark, str(tmp_path), "id bigint, t string")
        assert sorted(tuple(r) for r in found.collect()) == want
        assert sql_dump.rejected_sql(spark, str(tmp_path)).count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    (tmp_path / "one").mkdir()
    (tmp_path / "one/a.sql").write_text("INSERT INTO t VALUES (1,'x;\ny'),(2,'z'),(3,'w');\n")
    found = sql_dump.read_sql_dump(spark, str(tmp_path / "one"), "id bigint, t string")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "x;\ny"), (2, "z"), (3, "w")]


def test_member_folders_take_any_title(spark, tmp_path):
    titles = ["ä" * 127, "a/b:*?", "A" * 255, "."]
    labels = spark.createDataFrame([(t, n) for n, t in enumerate(titles)], "category string, page_id long")
    writers.write_member_lists(labels, str(tmp_path / "flat"))
    assert spark.read.parquet(str(tmp_path / "flat")).count() == 4
    writers.write_member_lists(labels, str(tmp_path / "folders"), folders=True)
    assert len([p for p in (tmp_path / "folders").iterdir() if p.name.startswith("folder=")]) == 4
