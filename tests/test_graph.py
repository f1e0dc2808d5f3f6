"""Lookups, categories, hierarchy and skew handling on a small wiki."""

import random

import pytest
from pyspark.sql import functions as F

from pagequarry import Wiki, scale
from pagequarry.operators import categories, hierarchy, lookup, reach
from pagequarry.plans import articles, corpus, labels
from pagequarry.sinks import writers

PAGES = [
    (1, 0, "Beer"), (2, 0, "Puck"), (3, 0, "Empty"), (4, 0, "Gone"), (10, 10, "Box"),
    (20, 14, "Top"), (21, 14, "Left"), (22, 14, "Right"), (23, 14, "Low"), (24, 14, "Loop"), (25, 14, "A/b"),
]
LINKS = [
    (21, "Top"), (22, "Top"), (23, "Left"), (23, "Right"), (24, "Low"), (23, "Loop"), (25, "Top"), (20, "Loop"),
    (1, "Low"), (1, "Left"), (2, "Low"), (3, "Right"), (4, "Right"), (1, "A/b"), (99, "Low"),
]
REVISIONS = [(100, 1, 100), (103, 1, 101), (102, 1, 102), (110, 2, 110), (120, 3, 120)]
TEXTS = [(100, "old"), (101, "latest [[Category:Low]] text is long"), (102, "newer row"), (110, "puck[[de:x]]"), (120, "")]


@pytest.fixture(scope="module")
def wiki(spark):
    return Wiki(
        spark.createDataFrame(PAGES, "page_id bigint, page_namespace int, page_title string"),
        spark.createDataFrame(LINKS, "cl_from bigint, cl_to string"),
        spark.createDataFrame(REVISIONS, "rev_id bigint, rev_page bigint, rev_text_id bigint"),
        spark.createDataFrame([(i, t, "utf-8") for i, t in TEXTS], "old_id bigint, old_text string, old_flags string"),
    )


@pytest.fixture(params=["broadcast", "shuffle"])
def any_join(request, monkeypatch):
    """Both ways of every join that is broadcast when small."""
    if request.param == "shuffle":
        monkeypatch.setattr(scale, "BROADCAST_ROWS", -1)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def names(wiki, *values):
    return categories.named(wiki, *values)


def test_subcategories(wiki, any_join):
    found = categories.all_subcategories(wiki, names(wiki, "top"))
    assert rows(found) == [
        ("Top", "A/b", 25, 1), ("Top", "Left", 21, 1), ("Top", "Loop", 24, 3), ("Top", "Low", 23, 2),
        ("Top", "Right", 22, 1), ("Top", "Top", 20, 4),
    ]
    assert rows(categories.direct_subcategories(wiki, names(wiki, "left", "Left", "Low"))) == [
        ("Left", "Low", 23), ("Low", "Loop", 24),
    ]
    assert rows(categories.all_subcategories(wiki, names(wiki, "nothing"))) == []
    assert rows(categories.subcategory_edges(wiki, "Left")) == [
        ("A/b", "Top"), ("Left", "Top"), ("Loop", "Low"), ("Low", "Left"), ("Low", "Loop"), ("Low", "Right"),
        ("Right", "Top"), ("Top", "Loop"),
    ]
    two = categories.all_subcategories(wiki, names(wiki, "Left", "Right")).groupBy("root").count()
    assert rows(two) == [("Left", 6), ("Right", 6)]


def test_members(wiki, any_join):
    assert rows(categories.category_pages(wiki, names(wiki, "low", "none"))) == [("Low", 1), ("Low", 2)]
    assert rows(categories.category_pages(wiki, names(wiki, "Low"), namespace=14)) == [("Low", 24)]
    assert rows(categories.category_counts(wiki, names(wiki, "Low", "none"))) == [("Low", 2), ("None", 0)]
    assert rows(categories.eligible_categories(wiki, names(wiki, "Low", "Left", "A/b", "none"), 2)) == [("Low", 2)]
    assert rows(categories.eligible_categories(wiki, names(wiki, "none"), 0)) == [("None", 0)]
    pairs = categories.page_categories(wiki, names(wiki, "Low", "Left", "A/b"), 1)
    assert rows(categories.page_category_lists(pairs)) == [(1, 0, ["Left", "Low"]), (2, 0, ["Low"])]
    assert rows(categories.category_set_pages(wiki, "Left", recursive=True)) == [(1,), (2,), (3,), (4,)]
    assert rows(categories.category_set_pages(wiki, "Left")) == [(1,)]


def test_hot_keys_come_in_parts(spark, any_join):
    pairs = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    parts = scale.sorted_lists(pairs.unionByName(pairs), "k", "v", "vs", part_rows=100)
    hot = parts.where("k = 'hot'").collect()
    assert [len(r.vs) for r in sorted(hot, key=lambda r: r.part)] == [100] * 16 + [67]
    assert [v for r in sorted(hot, key=lambda r: r.part) for v in r.vs] == sorted(str(i) for i in range(0, 5000, 3))
    assert parts.where("k <> 'hot' AND part = 0 AND size(vs) = 1").count() == 3333


def test_one_rule_for_long_lists(spark):
    many = spark.range(230_000).select(F.lit("hot").alias("k"), F.format_string("%07d", "id").alias("v"))
    parts = sorted(scale.sorted_lists(many, "k", "v", "vs").collect(), key=lambda r: r.part)
    assert [v for r in parts for v in r.vs] == [f"{n:07d}" for n in range(230_000)]
    assert [(r.part, len(r.vs)) for r in parts] == [(0, 100_000), (1, 100_000), (2, 30_000)]


def distances(edges):
    near = {}
    for start in {e[0] for e in edges}:
        level, depth = {start}, 0
        while level:
            depth += 1
            level = {b for a, b in edges if a in level} - {n for o, n in near if o == start}
            near.update({(start, n): depth for n in level})
    return near


def random_edges(seed):
    rng = random.Random(seed)
    edges = {(rng.randrange(40), rng.randrange(40)) for _ in range(60)}
    edges |= {(i, i + 1) for i in range(50, 58)} | {(70, 71), (71, 70), (71, 72), (72, 73), (73, 72), (80, 80)}
    return edges


def test_distances(spark, any_join):
    edges = random_edges(3)
    near = distances(edges)
    links = spark.createDataFrame(sorted(edges), "source long, target long")
    assert rows(reach.reach_all(links)) == sorted((o, n, d) for (o, n), d in near.items())
    start = links.select(F.col("source").alias("origin"), F.col("source").alias("node")).distinct()
    found, size = reach.reach(links, start)
    assert rows(found) == sorted((o, n, d) for (o, n), d in near.items()) and size[0] >= len(near)
    # Several starts, one state: the node with its distance from the nearest.
    found, _ = reach.reach(links, start.where("node % 5 = 0").select("node"))
    least = {}
    for (o, n), d in near.items():
        if o % 5 == 0:
            least[n] = min(least.get(n, d), d)
    assert rows(found) == sorted(least.items())


def test_components(spark):
    edges = random_edges(4)
    near = distances(edges)
    want = {}
    for a, b in near:
        if a != b and (b, a) in near:
            want.setdefault(a, {a}).add(b)
    links = spark.createDataFrame(sorted(edges), "source long, target long")
    found = {}
    for node, component in rows(reach.components(*scale.materialise(links))[0]):
        found.setdefault(component, set()).add(node)
    assert sorted(map(sorted, found.values())) == sorted({tuple(sorted(v)): sorted(v) for v in want.values()}.values())
    assert len(found) >= 3
    # Only what the origins reach, cycles spelt out.
    some = spark.createDataFrame([(70,), (80,), (55,), (999,)], "node long")
    assert rows(reach.ancestors(*scale.materialise(links), some)) == sorted(p for p in near if p[0] in (70, 80, 55))
    lines = links.where("source >= 50 and source < 58")
    assert reach.components(*scale.materialise(lines))[0].count() == 0


def test_a_long_chain_does_not_read_all_rounds_each_round(spark, monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(reach, "STEPS", 1)
    monkeypatch.setattr(reach, "RUNS", 2)
    length = 40
    links = spark.createDataFrame([(i, i + 1) for i in range(length)] + [(length, length - 3)], "source long, target long").coalesce(1)
    found = reach.search(links, spark.createDataFrame([(0,)], "node long"))
    assert rows(found.result()[0]) == [(i, i) for i in range(1, length + 1)]
    # One round reads its rim and now and then a run; all rounds each time would be 820.
    assert found.rows_read < length * 12 and len(found.runs) <= 8


def test_hierarchy(spark, wiki, any_join):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "b"), ("d", "d"), ("e", "e")], "child string, parent string")
    assert rows(hierarchy.classify_vertices(edges)) == [
        ("a", "root"), ("b", "interior"), ("c", "leaf"), ("d", "leaf"), ("e", "isolated"),
    ]
    more = hierarchy.add_leaf_labels(edges, "a")
    assert set(rows(more)) - set(rows(edges)) == {("a_LEAF", "a"), ("b_LEAF", "b")}
    assert rows(hierarchy.remaining_vertices(more, "a")) == [("a_LEAF",), ("b",), ("b_LEAF",), ("c",), ("d",), ("e",)]
    assert rows(hierarchy.remove_vertex(edges, "a"))[0] == ("c", "b")
    closed = rows(hierarchy.transitive_closure(edges))
    assert ("d", "d") in closed
    some = spark.createDataFrame([("d",), ("e",), ("a",), ("none",)], "vertex string")
    assert rows(hierarchy.transitive_closure(edges, some)) == [p for p in closed if p[0] in "dea"]
    found = {r.category: r.supercategories for r in hierarchy.label_hierarchy(wiki, "Top").collect()}
    assert found["Low"] == "Left Loop Low Right"
    assert found["Left_LEAF"] == "Left" and found["Left"] == "" and "Top_LEAF" not in found and "Loop" not in found
    lines = labels.hierarchy_lines(wiki, "Top", 2).collect()
    assert {r.value for r in lines} == {
        "Low: Left Loop Low Right", "Low_LEAF: Left Loop Low Right", "Right: ", "Right_LEAF: Right",
    }


def test_leaf_labels_named_as_categories(spark, any_join):
    """A category ``A_LEAF`` is the leaf label of ``A`` too, and what is below it is below ``A``."""
    pages = [(1, "Top"), (2, "A"), (3, "A_LEAF"), (4, "B"), (5, "C")]
    links = [(2, "Top"), (3, "Top"), (4, "A"), (5, "A_LEAF"), (9, "A"), (9, "B"), (9, "C"), (9, "Top")]
    wiki = Wiki(
        spark.createDataFrame([(i, 14, t) for i, t in pages] + [(9, 0, "Page")], "page_id bigint, page_namespace int, page_title string"),
        spark.createDataFrame(links, "cl_from bigint, cl_to string"),
    )
    found = {r.category: r.supercategories for r in hierarchy.label_hierarchy(wiki, "Top").collect()}
    # A label's pages are those of its category, the suffix aside.
    assert found == {"A": "", "A_LEAF": "A", "B": "A", "C": "A A_LEAF", "Top_LEAF": ""}


def test_lookup(spark, wiki, any_join):
    assert rows(lookup.latest_text(wiki)) == [(1, 103, TEXTS[1][1]), (2, 110, "puck[[de:x]]"), (3, 120, "")]
    asked = spark.createDataFrame([(1,), (4,), (4,), (77,)], "page_id bigint")
    assert rows(lookup.missing_pages(wiki, asked)) == [(4,), (77,)]
    titles = spark.createDataFrame([("beer",), ("Template:box",), ("Vorlage:Box",), ("box",)], "title string")
    assert rows(lookup.resolve_titles(wiki, titles).where("page_id IS NOT NULL").select("title", "page_id")) == [
        ("Template:box", 10), ("Vorlage:Box", 10), ("beer", 1),
    ]
    assert rows(lookup.unresolved_titles(wiki, titles)) == [("box",)]
    pages = spark.createDataFrame([(1, "a\n\nb\n\n"), (2, "\n\n"), (3, "")], "page_id bigint, text string")
    assert rows(lookup.page_lines(pages)) == [(1, 0, "a"), (1, 1, ""), (1, 2, "b")]


def test_random_pages(wiki):
    found = {lookup.random_pages(wiki, seed=s).first()["page_id"] for s in range(40)}
    assert found == {1, 2, 3, 4}
    assert rows(lookup.random_pages(wiki, 2, seed=1)) == rows(lookup.random_pages(wiki, 2, seed=1))
    with pytest.raises(ValueError):
        lookup.random_pages(wiki, namespace=5)


def test_decoding(spark, wiki):
    stored = [(1, "é".encode(), "utf-8,x"), (2, "é".encode("latin-1"), ""), (3, b"a\xff", "utf-8")]
    text = spark.createDataFrame(stored, "old_id bigint, old_text binary, old_flags string")
    found = lookup.decode_text(Wiki(wiki.page, wiki.categorylinks, wiki.revision, text))
    assert rows(found) == [(1, "é"), (2, "é"), (3, "a�")]


def test_articles(wiki, any_join):
    assert rows(articles.get_articles(wiki, category="low")) == [(1, "latest  text is long"), (2, "puck")]
    assert rows(articles.get_articles(wiki, category="Right", show_id=True)) == [(3,), (4,)]
    assert rows(articles.get_articles(wiki, title="Puck", page_id=3)) == [(3, "")]
    assert rows(articles.get_articles(wiki, title="puck")) == [(2, "puck")]
    assert articles.get_articles(wiki, random=True).count() == 1
    with pytest.raises(ValueError):
        articles.get_articles(wiki)
    checked = articles.check_articles(articles.get_articles(wiki, category="Low"))
    assert rows(checked.select("page_id", "length", "report")) == [
        (1, 20, "Length: 20\n>>>>latest  text is long<<<<"), (2, 4, "Page with ID 2 is very short: >>>>puck<<<<"),
    ]
    assert rows(articles.check_summary(checked)) == [(False, 1, 20), (True, 1, 4)]


def test_corpus(spark, wiki, tmp_path, any_join):
    found = corpus.extract_corpus(wiki, ["Top"], subcategories=True)
    assert rows(found.articles) == [(1, "latest  text is long"), (2, "puck")]
    assert rows(found.missing) == [(4,)]
    path = str(tmp_path / "c")
    writers.write_corpus(found, path)
    low = spark.read.parquet(f"{path}/categories").where("category = 'Low'").select(F.col("page_id").cast("string").alias("value"))
    assert rows(low) == [("1",), ("2",)]
    assert rows(spark.read.parquet(f"{path}/category_mappings")) == [(1, 0, "Left\nLow"), (2, 0, "Low")]
    assert ("3\tRight",) in rows(spark.read.text(f"{path}/page_categories"))
    labelled = found.labelled_articles()
    assert rows(labelled.select("page_id", "part", "text", F.concat_ws(",", "categories"))) == [
        (1, 0, "latest  text is long", "Left,Low"), (2, 0, "puck", "Low"),
    ]


def test_bodies_are_moved_last(wiki):
    """With few pages no exchange lies above the scan of the bodies."""
    plan = corpus.extract_corpus(wiki, ["Top"], subcategories=True).labelled_articles()
    plan = plan._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("old_text")]
    assert "BroadcastHashJoin" in above and "hashpartitioning" not in plan


def test_listing(wiki):
    assert [tuple(r) for r in categories.list_subcategories(wiki, "Top", show_id=False).collect()] == [("A/b",), ("Left",), ("Right",)]
    with pytest.raises(ValueError):
        categories.list_subcategories(wiki, "Top", show_id=False, show_name=False)
