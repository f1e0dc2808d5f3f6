"""Cover trees, min-max hashing, components and line similarity by brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import cover_tree, lines, minmax
from pagequarry.llm.components import components
from pagequarry.llm.shingles import shingle_sets


def reachable(ids, links):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def test_components(spark):
    edges = [(n, n + 1) for n in range(30)] + [(100, 101), (101, 100), (102, 100), (7, 7), (200, 205), (203, 205)]
    frame = spark.createDataFrame([*edges, (None, 5)], "a long, b long")
    got = {r.id: r.component for r in components(frame).collect()}
    want = reachable({x for e in edges for x in e}, edges)
    assert got == want
    assert components(frame.limit(0)).collect() == []


def plain_vectors(data, threshold):
    fit = {}
    for n, (i, v, label) in enumerate(data):
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        u = np.array(v, np.float64)
        fit[n] = (i, u / np.abs(u).max() / np.linalg.norm(u / np.abs(u).max()), label)
    count, links = dict.fromkeys(range(len(data)), 0), []
    for x in fit:
        for y in fit:
            if x < y and fit[x][2] == fit[y][2] and len(fit[x][1]) == len(fit[y][1]) and fit[x][1] @ fit[y][1] >= threshold:
                count[x] += 1
                count[y] += 1
                links.append((fit[x][0], fit[y][0]))
    least = reachable({d[0] for d in data if d[0] is not None}, links)
    return sorted(((d[0], count[n], least.get(d[0]), d[0] is None or least[d[0]] == d[0]) for n, d in enumerate(data)), key=repr)


@pytest.mark.parametrize("block", [1024, 16])
def test_vector_links(spark, rows, block):
    random = np.random.default_rng(3)
    base = random.normal(size=(12, 8))
    data = [(n, (base[n % 12] + random.normal(size=8) * random.choice([0, 0.02, 0.1])).tolist(), int(n % 12 % 2)) for n in range(150)]
    data += [(3, base[5].tolist(), 1), (3, base[6].tolist(), 0), (500, None, 1), (501, [0.0] * 8, 1), (502, [None] * 8, 1), (503, [float("nan")] * 8, 1)]
    data += [(504, base[0].tolist(), None), (None, base[0].tolist(), 0), (505, base[0][:4].tolist(), 0), (506, [], 0), (507, (base[0] * 1e30).tolist(), 0), (508, [1e-38] * 8, 0)]
    frame = spark.createDataFrame([(i, v, label, 1, "c") for i, v, label in data], "vec_id long, embedding array<float>, label int, row long, block string")
    stored = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    assert rows(cover_tree.vector_links(frame, 0.98, block)) == plain_vectors(stored, 0.98)


def test_vector_links_of_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert cover_tree.vector_links(frame).collect() == []


def test_tree_prunes_and_nests():
    random = np.random.default_rng(8)
    points = random.normal(size=(300, 5))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = cover_tree.CoverTree(points, 0.05)
    radius = 2.0
    for level, ((centre, first, last), far) in enumerate(zip(tree.levels, tree.radii)):
        assert (far <= radius + 1e-9).all() and first[0] == 0 and last[-1] == 300 and (first[1:] == last[:-1]).all()
        if level:
            assert set(tree.levels[level - 1][0]) <= set(centre)  # nested
        radius /= 2


def test_pairs_beside_copies_that_differ_in_the_last_bits():
    edge = 2 * np.arcsin(cover_tree.reach(0.98) / 2)
    at = lambda *angles: np.array([[np.cos(x), np.sin(x)] for x in angles])
    one, other = at(0.0, 1e-8), at(edge + 5e-9)  # the copy is within 0.98 of the other, the first is not
    counts, links = cover_tree._match(cover_tree.CoverTree(one, 0.05), cover_tree.CoverTree(other, 0.05), 0.98, False)
    assert sorted(counts) == [0, 1, 1] and len(links) == 1
    one, other = at(0.0, -1e-8), at(edge - 5e-9)  # the other way round
    counts, _ = cover_tree._match(cover_tree.CoverTree(one, 0.05), cover_tree.CoverTree(other, 0.05), 0.98, False)
    assert sorted(counts) == [0, 1, 1]


def plain_sets(text, words):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return set()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}


def near_documents():
    random = np.random.default_rng(21)
    prose = lambda n: [f"w{int(random.integers(0, 4000))}" for _ in range(n)]
    docs, number = [], 0
    for _ in range(6):
        base = prose(80)
        for _ in range(12):
            own = list(base)
            for at in random.choice(80, int(random.integers(0, 9)), replace=False):
                own[at] = prose(1)[0]
            docs.append((number, " ".join(own)))
            number += 1
    docs += [(number + n, " ".join(prose(30))) for n in range(10)]
    docs += [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one"), (905, "one two"), (906, "two one"), (907, "ONE  Two"), (908, docs[0][1]), (909, docs[0][1].upper()), (910, "\x1c é É")]
    return docs


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(documents, rows, words):
    docs = near_documents()
    sets = {d: plain_sets(t, words) for d, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = reachable(sets, links)
    want = sorted(((d, len(sets[d]), least[d], least[d] == d) for d, _ in docs), key=repr)
    assert rows(minmax.near_duplicates(documents(docs), words, 0.8)) == want


def test_near_duplicates_odd_rows(documents, rows):
    docs = [(1, "a b c"), (1, "d e f"), (2, "d e f"), (None, "a b c"), (None, None)]
    got = rows(minmax.near_duplicates(documents(docs), 2))
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True), (None, 0, None, True)], key=repr)
    assert minmax.near_duplicates(documents(docs).limit(0)).collect() == []
    kept = minmax.one_of_each(documents(docs), 2)
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["1", "None", "None"] and kept.columns == documents(docs).columns


def test_rows_of_one_doc_id_are_one_vertex(documents, rows):
    docs = [(5, "x y z"), (5, "p q r"), (3, "x y z"), (4, "p q r"), (9, "l m n"), (9, "i j k"), (9, "l m n"), (10, ""), (10, None), (10, "a b"), (11, " ")]
    got = rows(minmax.near_duplicates(documents(docs), 2).select("doc_id", "component_id", "kept").where("doc_id < 10"))
    assert got == [(3, 3, True), (4, 3, False), (5, 3, False), (5, 3, False), (9, 9, True), (9, 9, True), (9, 9, True)]
    for parts in (1, 5):
        for order in (docs, docs[::-1]):
            kept = minmax.one_of_each(documents(order).repartition(parts), 2)
            assert rows(kept.select("doc_id", "text")) == sorted([(3, "x y z"), (9, "i j k"), (10, ""), (10, None), (10, "a b"), (11, " ")], key=repr)


def test_signatures_estimate_similarity():
    one, two = (set(range(0, 900)), set(range(100, 1000)))
    text = lambda s: " ".join(f"t{n}" for n in sorted(s))
    sets = shingle_sets([text(one), text(two)], 1)
    signed = minmax.signatures(sets, 256)
    assert abs((signed[0] == signed[1]).mean() - 0.8) < 0.06
    assert (signed[0][:256] <= signed[0][256:]).all()


def plain_lines(docs, threshold=80):
    known, out = [], []
    order = sorted(((d is not None, d or 0, n, line) for d, t in docs for n, line in enumerate((t or "").split("\n"))))
    for present, doc, n, line in order:
        own = {w for w in re.split(r"[ \t\r]+", line) if w}
        alike = any(100 * len(own & s) >= threshold * len(own | s) for s in known) if own else False
        out.append((doc if present else None, n, alike))
        known.append(own)
    return sorted(out, key=repr)


def test_lines(documents, rows):
    random = np.random.default_rng(4)
    vocabulary = [f"v{n}" for n in range(60)]
    base = [list(random.choice(vocabulary, int(random.integers(1, 15)), replace=False)) for _ in range(12)]
    docs = []
    for doc in range(25):
        held = []
        for _ in range(6):
            line = list(base[int(random.integers(0, 12))])
            for _ in range(int(random.integers(0, 3))):
                line[int(random.integers(0, len(line)))] = str(random.choice(vocabulary))
            held.append(("  " if doc % 2 else " ").join(line))
        docs.append((doc, "\n".join(held)))
    docs += [(None, "v1 v2 v3"), (40, None), (41, ""), (42, "\n\n \t"), (43, "v3 v2 v1\r"), (44, "x " * 3000)]
    got = rows(lines.removed_lines(documents(docs)).select("doc_id", "line_no", "removed"))
    assert got == plain_lines(docs)
    kept = {r.doc_id: r.text for r in lines.without_repeated_lines(documents(docs)).collect()}
    gone = {(d, n) for d, n, alike in got if alike}
    for doc, text in docs:
        assert kept[doc] == "\n".join(line for n, line in enumerate((text or "").split("\n")) if (doc, n) not in gone)


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_lines_settled_in_rounds(documents, rows, monkeypatch, rounds):
    """Chains of like lines, whose ends are unlike, whatever the rounds settle."""
    monkeypatch.setattr(lines, "ROUNDS", rounds)
    chain = [" ".join(f"w{n}" for n in range(at, at + 12)) for at in range(40)]
    random = np.random.default_rng(5)
    docs = [(n, "\n".join(random.permutation(chain[n % 7 :: 3]).tolist())) for n in range(8)]
    got = rows(lines.removed_lines(documents(docs)).select("doc_id", "line_no", "removed"))
    assert got == plain_lines(docs)


def test_texts_of_lines_without_candidates_are_not_shuffled(spark):
    """The filter keeps every line asked for, and few others."""
    firsts = spark.range(20000).select(F.col("id").alias("number"), F.lit("a b c d e").alias("line"))
    ids = firsts.where("number % 100 = 0").select("number")
    kept = {r.number for r in lines._possibly(firsts, ids).collect()}
    assert kept >= set(range(0, 20000, 100))
    assert len(kept) < 1000
    assert lines._possibly(firsts, ids.limit(0)).count() == 0


def test_a_large_group_of_like_lines(documents, rows, monkeypatch):
    """Five thousand lines like the first: pairs verified grow with the group, not with its square."""
    base = [f"b{n}" for n in range(30)]
    docs = [(n, " ".join([*base[: n % 30], f"own{n}", *base[n % 30 + 1 :]])) for n in range(5000)]
    docs = [(-1, " ".join(base)), *docs]
    verified = []
    plain = lines._alike
    monkeypatch.setattr(lines, "_alike", lambda pairs, *more: (verified.append(pairs.count()), plain(pairs, *more))[1])
    got = rows(lines.removed_lines(documents(docs)).select("doc_id", "removed"))
    assert got == sorted(((d, d >= 0) for d, _ in docs), key=repr)
    assert sum(verified) <= 4 * len(docs), verified


def test_lines_of_common_words_rarely_meet(documents, rows, monkeypatch):
    """Unlike lines of a small vocabulary share many words, and few are verified."""
    random = np.random.default_rng(6)
    docs = [(n, " ".join(f"w{w}" for w in random.choice(200, 25, replace=False))) for n in range(1500)]
    verified = []
    plain = lines._alike
    monkeypatch.setattr(lines, "_alike", lambda pairs, *more: (verified.append(pairs.count()), plain(pairs, *more))[1])
    got = rows(lines.removed_lines(documents(docs)).select("doc_id", "line_no", "removed"))
    assert got == plain_lines(docs)
    assert sum(verified) < 20, verified


@pytest.mark.parametrize("share", [51, 66, 80, 95])
def test_alike_lines_share_an_entry(spark, share):
    """Every pair of alike sets has a common entry, at any threshold."""
    random = np.random.default_rng(share)
    texts = []
    for n in range(300):
        base = [f"{'x' * int(random.integers(1, 9))}{w}" for w in range(int(random.integers(1, 30 if n % 20 else 250)))]
        texts.append(" ".join(base))
        own = [w for w in base if random.random() > 0.15] + [f"{'y' * int(random.integers(1, 9))}{w}" for w in range(int(random.integers(0, 5)))]
        texts.append(" ".join(own))
    found = lines.keyed_lines(spark.createDataFrame(list(enumerate(texts)), "number long, line string"), share).orderBy("number").collect()
    alike = set()
    for a, b in zip(found[::2], found[1::2]):
        one, two = set(a.line.split()), set(b.line.split())
        if one != two and 100 * len(one & two) >= share * len(one | two):
            assert set(a.entries) & set(b.entries), (a, b)
            alike.add((a.number, b.number))
    kept = lines.keyed_lines(spark.createDataFrame(list(enumerate(texts)), "number long, line string"), share)
    heads = kept.withColumn("entry", F.floor(F.col("number") / 2))
    assert alike and alike <= {(r.one, r.two) for r in lines._met(heads, heads, share).collect()}


def test_lines_of_sparse_and_repeated_ids(documents, rows):
    """Ids too far apart for numbers made of them, and ids of two rows."""
    text = "a b c d e f"
    for ids in ([-(1 << 63), -5, (1 << 63) - 1], [7, 3, 7], [-3, -1, -2]):
        docs = [(n, f"{at} {text}\n{text} {text}\n{text} z") for at, n in enumerate(ids)]
        got = rows(lines.removed_lines(documents(docs)).select("doc_id", "line_no", "removed"))
        assert [r for r in got if r[0] != 7] == [r for r in plain_lines(docs) if r[0] != 7]
        assert len(got) == 9


def test_lines_of_no_documents(documents):
    assert lines.removed_lines(documents([(1, "a")]).limit(0)).collect() == []
