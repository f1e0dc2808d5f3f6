"""Hard negatives, token alignment and URL rules by brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry import scale
from pagequarry.llm import alignment, negatives, url_rules


# --- Hard negatives ----------------------------------------------------------


def plain_negatives(data, every=100):
    best = {}
    for i, v, label in data:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        best[i] = min(best.get(i, row), row)
    out = []
    for a in best:
        if a % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(best[a][1], v)), i, label)
            for i, (label, v) in best.items()
            if i != a and len(v) == len(best[a][1])
        ]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2] == best[a][0]][:5]:
            near = [s for s in scored if s[2] != best[a][0] and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(a, positive, n, i, -p, -s) for n, (s, i, _) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 40])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "ROWS", block)
    monkeypatch.setattr(negatives, "ANCHORS", max(1, block // 20))
    monkeypatch.setattr(negatives, "STEP_ROWS", 30)
    monkeypatch.setattr(negatives, "STEP_ANCHORS", 2)
    monkeypatch.setattr(negatives, "BLOCKS", 1 << 30)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 20))
    # A hot label, ties (copies of a vector) and ids out of order and below 0.
    data = [(7 * n - 200, (base[n % 6] + 0.4 * rng.normal(size=20)).tolist(), int(rng.choice([0, 0, 0, 1, 2, -3]))) for n in range(300)]
    data += [(5000 + n, base[1].tolist(), n % 3) for n in range(60)]
    data += [(100, base[2].tolist(), 1), (100, base[3].tolist(), 0), (300, None, 1), (400, [None] * 20, 1), (600, [float("nan")] * 20, 1)]
    data += [(800, [float("inf")] * 20, 1), (900, base[0].tolist(), None), (None, base[0].tolist(), 0), (1000, [], 0), (1001, [], 0), (1002, [], 1)]
    data += [(1100 + n, (base[n % 6][:9] * (1 + n)).tolist(), n % 2) for n in range(30)]
    data += [(9000 + n, (1e4 * base[n % 6]).tolist(), n % 2) for n in range(12)]
    rng.shuffle(data)
    columns = "vec_id long, embedding array<float>, label int, score long, bits string"
    frame = spark.createDataFrame([(*d, 1, "c") for d in data], columns).repartition(3)
    got = sorted(tuple(r) for r in negatives.hard_negatives(frame, every=20).collect())
    assert got == plain_negatives(data, 20)
    assert len({r[0] for r in got}) > 10
    empty = negatives.hard_negatives(frame.limit(0))
    assert empty.collect() == [] and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("width", [0, 1, 7, 8, 21])
def test_table_scores_are_inner_products(width):
    rng = np.random.default_rng(width)
    for top in (1, 2, 200, 1 << 40):
        rows, anchors = rng.integers(-top, top, (50, width)), rng.integers(-90, 90, (9, width))
        bits, planes = negatives.pack(rows)
        assert (negatives.unpack(bits, width) == rows).all()
        scores = negatives.exact_scores(negatives.subset_sums(anchors), bits)
        assert (scores == rows @ anchors.T).all()
        for n in range(50):
            own = bits[n : n + 1, : planes[n]]
            assert (negatives.unpack(own, width) == rows[n]).all()


# --- Token alignment ---------------------------------------------------------


@pytest.fixture(scope="module")
def sides():
    path = alignment.tokenizer_path
    return alignment.ByteSide(path("byte_bpe_50k.json")), alignment.PieceSide(path("piece_bpe_32k.model"))


def test_ranked_ids_are_the_librarys(sides):
    """Texts of Latin-1 letters, every pair of them and random ones."""
    side, rng = sides[0], random.Random(6)
    assert side.ranked is not None
    letters = [chr(n) for n in range(256)]
    texts = ["".join(a + b + rng.choice("a 1!\n") for b in letters) for a in letters]
    words = ["the", "'s", "'LL", "don't", "x1", "12", "...", "<|endoftext|>", *letters, *" \n\t\r\x0b\x1c\x85\xa0" * 8]
    texts += ["".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(3000)]
    want = [e.ids for e in side.library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert side.encode(texts) == want
    assert all(map(alignment.latin, texts)) and not alignment.latin("œ")


def plain_alignment(sides, texts):
    """Groups by their byte ranges, links by overlap of groups, one by one."""
    rows, held = [], []
    for text in texts:
        groups = []
        if text:
            a, b = (side.encode([text])[0] for side in sides)
            tokens = [[side.bytes[i] for i in ids] for side, ids in zip(sides, (a, b))]
            if all(b"".join(t) == b" " + text.encode() for t in tokens):
                ends = [list(np.cumsum([len(x) for x in t]).tolist()) for t in tokens]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    before = groups[-1][2] if groups else 0
                    groups.append(([i for i, e in zip(a, ends[0]) if before < e <= cut], [i for i, e in zip(b, ends[1]) if before < e <= cut], cut))
        held.append(Counter((x, y) for g in groups for x in g[0] for y in g[1]))
        rows.append(groups)
    count = Counter(pair for links in held for pair in links)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for groups, links in zip(rows, held):
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y, _ in groups)
        out.append((
            sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in links.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return out


def odd_texts():
    rng = random.Random(4)
    parts = ["the", " ", "  ", "\n", "\t", "Straße", "naïve", "日本語", "🙂", "\u2581", "x\u0301", "<|endoftext|>", "</s>", "<0x41>", "123", "!!", "'s", "\u00a0", "\x00", "hello", "wörld", " hello", ".", "ﬁ"]
    texts = ["", None, " ", "   ", "\n", "a", "hello world", "hello world", "hello  world", "\u2581", "🙂🙂", "\x00", " lead", "trail ", "x" * 5000, " " * 3000, "日本" * 700]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(400)]


@pytest.mark.parametrize("head_rows", [500_000, 40])
def test_alignment(spark, documents, sides, head_rows):
    texts = odd_texts()
    rows = [(n if n % 50 else None, t) for n, t in enumerate(texts)] + [(3, "hello world"), (3, "hello world")]
    got = alignment.alignment(documents(rows), head_rows=head_rows)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(d, *r) for (d, _), r in zip(rows, plain_alignment(sides, [t for _, t in rows]))]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 150


def test_alignment_of_nothing(documents):
    frame = documents([(1, None), (2, "")])
    assert sorted(map(tuple, alignment.alignment(frame).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert alignment.alignment(frame.limit(0)).collect() == []


@pytest.mark.parametrize("kept", [3, 100_000])
def test_pieces_and_forgotten_windows(sides, kept):
    """Cut texts and a table of windows that overflows change nothing."""
    whole = alignment.Aligner(*sides)
    cut = alignment.Aligner(*sides, kept=kept, piece=30)
    texts = [t or "" for t in odd_texts()] + ["some words in a row, and more of them " * 20]
    for text, x, y in zip(texts, whole.documents(texts), cut.documents(texts)):
        assert x[:5] == y[:5], text
        assert x[5].tolist() == y[5].tolist() and x[6].tolist() == y[6].tolist()
    assert len(cut.pieces(texts[-1])) > 10


# --- URL rules ---------------------------------------------------------------


def plain_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fitting = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, _, rule, verdict = max(fitting, default=(0, 0, None, "allow"))
    return host, path, rule, verdict


@pytest.fixture(params=["broadcast", "shuffle", "false positives"])
def ways(request, monkeypatch):
    if request.param != "broadcast":
        monkeypatch.setattr(scale, "BROADCAST_ROWS", -1)
    if request.param == "false positives":
        # One word for the whole list: nearly every candidate passes.
        monkeypatch.setattr(url_rules, "LEAST_WORDS", 1)
        monkeypatch.setattr(url_rules, "MOST_WORDS", 1)


def test_url_rules(spark, ways):
    rng = random.Random(8)
    hosts = ["a.com", "b.a.com", "com", "x.net", "net", "c.x.net", "acom", "A.com", "a..com", ".com", "é.org"]
    paths = ["", "/", "/en/", "/en", "/en/1", "/e", "/fr/x/y", "/é/1"]
    rules = sorted({(h.lower(), p): (h.lower(), p, rng.choice(["allow", "block"])) for h in hosts for p in paths if rng.random() < 0.3}.values())
    urls = [None, "", "http", "a.com/en/", "://", "http://", "http:///en/", "x://y://a.com/en/", "http://A.COM/EN/"]
    for _ in range(600):
        tail = rng.choice(["", "", "?q=/en/", "#/en/", "?a#b", "/x", "\n"])
        urls.append(f"{rng.choice(['http', 'https', 'HTTP'])}://{rng.choice(['', '', 'www.', 'B.'])}{rng.choice(hosts)}{rng.choice(paths)}{tail}")
    rows = [(n // 3 if n % 5 else None, u) for n, u in enumerate(urls)] + [(1, urls[9]), (1, urls[9]), (1, "http://a.com/en/")] * 40
    pages = spark.createDataFrame([(i, u, "h", "k", "r") for i, u in rows], "page_id long, url string, host string, key string, rule string").repartition(3)
    got = url_rules.judge_urls(pages, url_rules.listed_rules(spark, rules + [("", "/", "block")]))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [(i, *plain_verdict(u, rules)) for i, u in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert url_rules.judge_urls(pages.limit(0), url_rules.listed_rules(spark, rules)).collect() == []


def test_an_empty_list_and_a_large_one(spark):
    pages = spark.createDataFrame([(1, "http://h77.com/a/b"), (2, "http://h5000.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in url_rules.judge_urls(pages, none, "block").collect()] == [(None, "block")] * 2
    many = spark.range(3000).select(
        F.concat(F.lit("H"), F.col("id").cast("string"), F.lit(".com")).alias("host"),
        F.when(F.col("id") % 2 == 1, "/a/").alias("path"), F.lit("block").alias("verdict"),
    )
    assert sorted(map(tuple, url_rules.judge_urls(pages, many).collect())) == [
        (1, "h77.com", "/a/b", "h77.com/a/", "block"), (2, "h5000.com", "/", None, "allow"),
    ]


def test_the_filter_drops_what_is_not_listed(spark):
    keys = spark.range(2000).select(F.concat(F.lit("site"), F.col("id").cast("string"), F.lit(".org/")).alias("key"))
    words = 1024
    bloom = url_rules.filter_words(keys, words)
    assert len(bloom.first()["words"]) == words
    others = spark.range(20_000).select(F.concat(F.lit("other"), F.col("id").cast("string"), F.lit(".org/")).alias("key"))
    for frame, low, high in ((keys, 2000, 2000), (others, 0, 200)):
        word = F.get(F.col("words"), url_rules._word(F.col("key"), words))
        passed = frame.withColumn("words", bloom.scalar()).where(word.bitwiseAND(url_rules._mask(F.col("key"))) == url_rules._mask(F.col("key")))
        assert low <= passed.count() <= high
