"""Decontamination, token files, archive and repeats against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from pagequarry.llm import decontaminate, repeats, token_files, warc
from pagequarry.llm.run_index import RunLengthIndex
from pagequarry.session import scratch_path

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_contamination(docs, items, width):
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    words = lambda t: WORD.findall((t or "").encode().translate(lower))
    windows = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - width + 1)):
                windows.setdefault(tuple(w[i : i + width]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), decontaminate.items_digest(list(found)), bool(hit)))
    return sorted(out, key=repr)


BENCH = [(1, "one two three four"), (2, "Five SIX"), (10, "one two three four"), (3, None), (4, ""), (None, "seven"), (5, "éa ß-x"), (5, "...")]
DOCS = [
    (1, "zero ONE, two; three four five"), (2, "five-six"), (3, None), (4, ""), (5, "fivesix five  six seven"), (6, "Éa éa ß x y"),
    (7, "one two three"), (8, "one two three four two three four one two three"), (8, "five six"), (8, "five six"), (None, "five six"), (9, "!" * 50_000 + " five six"),
]


@pytest.mark.parametrize("shard", [1 << 20, 40])
def test_contamination(spark, documents, rows, shard):
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontaminate.scan_documents(documents(DOCS), items, 3, shard).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r.item_ids), decontaminate.items_digest(r.item_ids), r.n_hit > 0) for r in found), key=repr)
    assert got == plain_contamination(DOCS, BENCH, 3)
    texts = {r.doc_id: [DOCS[0][1][p.start : p.end] for p in r.passages] for r in found if r.doc_id == 1}
    assert texts[1] == ["ONE, two; three four"]
    clean = decontaminate.clean_documents(documents(DOCS), items, 3, shard)
    assert sorted(repr(r.doc_id) for r in clean.collect()) == sorted(repr(r[0]) for r in got if not r[5])
    assert clean.columns == documents(DOCS).columns


def test_contamination_of_empty_tables(spark, documents, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in decontaminate.contamination(documents(DOCS), none).collect()} == {False}
    assert decontaminate.contamination(documents(DOCS).limit(0), none).collect() == []


ODD = [
    "It's l'été œuvre ß ẞ ΑΣ ΟΔΟΣ İstanbul ﬁ 12 a1b2 &&& *** x|y 日本語 <|endoftext|>!? foo<|startoftext|>bar é  nb sp \x1c q",
    "", "   ", "A.B.C...,, don't WE'LL 's 'S ÀÉÎ", "á ́x​z \u0085y  k", "word " * 5000, "Straße, (Weiß)_ --- [x]",
]


def test_token_files_round_trip(spark, documents):
    from tokenizers import Tokenizer

    docs = [*enumerate(ODD), (3, "again"), (None, "nothing"), (100, None)]
    path = scratch_path(spark, "t")
    manifest = token_files.write_token_files(documents(docs), path)
    assert manifest["width"] == 2
    tokenizer = Tokenizer.from_file(token_files.tokenizer_path())
    want = sorted(((-1 if d is None else d, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in docs))
    got = sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in token_files.read_token_files(spark, path, with_ids=True).collect())
    assert got == want
    ordered = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((d for d, _ in docs), key=lambda d: -1 if d is None else d)
    start = 0
    ids = {tuple(i) for _, i in want}
    for r in ordered:
        assert r.start == start
        start += r.n_tokens
        assert r.ids_crc32 in {zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids}


def test_chunks_keep_their_ids_when_forgotten():
    """Small caches, slices of a batch, nulls and odd white space give the library's ids."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    words = [f"w{i}or{i % 7}" + "!?"[i % 2] for i in range(300)]
    texts = [" ".join(words[i : i + 40]) for i in range(0, 300, 15)]
    texts += [None, "", "a\tb\nc\r\nd  e", "x\u00a0y \u2003 z\x0bq", "Été İstanbul 東京 a\u0301 [UNK]", texts[0]]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    encoder = token_files.ChunkEncoder(token_files.tokenizer_path(), chunks=20, words=20)
    library = Tokenizer.from_file(token_files.tokenizer_path())
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for rows, limit in ((3, 1 << 20), (100, 500), (1, 1)):
        pieces = list(token_files.pieces(batch, rows, limit))
        assert [t for p in pieces for t in p["text"].to_pylist()] == texts
        got = [r for p in pieces for r in encoder.encode(p["text"])]
        assert [[int(i) for i in memoryview(r).cast("I")] for r in got] == want
        assert len(encoder.met) <= 20


def test_token_files_of_no_documents(spark, documents):
    path = scratch_path(spark, "t")
    token_files.write_token_files(documents(DOCS).limit(0), path)
    assert token_files.read_token_files(spark, path).collect() == []


PAGES = [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u\r\nWARC: no", ""), (5, "http://e", "é" * 9), (None, "http://n", "x"), (6, "http://f", "y" * 100_000)]


@pytest.mark.parametrize("least", [0, 5])
def test_archive(spark, rows, least):
    pages = spark.createDataFrame([(*p, 1, 2) for p in PAGES], "page_id long, url string, html string, row long, size long")
    got = rows(warc.archive_report(pages, least))
    want = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        same = max((q for q, _, h in PAGES if (h or "") == (html or "") and q is not None), default=None)
        revisit = len(raw) >= least and same != page
        want.append((page, len(raw), warc.base32_sha1(raw), "revisit" if revisit else "response", same if revisit else None))
    assert got == sorted(want, key=repr)


def test_original_records_come_back(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    headers, payloads = warc.store_pages(pages)
    assert payloads.count() == len({h or "" for _, _, h in PAGES})
    got = {r.page_id: (bytes(r.header), bytes(r.payload)) for r in warc.rebuild_records(headers, payloads).collect()}
    for page, url, html in PAGES:
        header, payload = got[page]
        assert payload == (html or "").encode()
        assert header.startswith(b"WARC/1.1\r\n") and header.endswith(b"\r\n\r\n")
    damaged = payloads.selectExpr("sha2('other', 256) as sha256", "size", "packed").limit(1)
    with pytest.raises(Exception, match="damaged"):
        warc.rebuild_records(headers.selectExpr("page_id", "row", "sha2('other', 256) as sha256", "size", "revisit", "header"), damaged).collect()


def test_archive_of_no_pages(spark):
    assert warc.archive_report(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def plain_repeats(text, least):
    seen, out = set(), []
    for i in range(len(text) - least + 1):
        if (w := text[i : i + least]) in seen:
            out.append(i)
        seen.add(w)
    return out


def test_run_length_index():
    random = np.random.default_rng(5)
    for n in range(120):
        text = bytes(random.choice(list(b"ab\xffc"[: 1 + n % 4]), int(random.integers(0, 200))).astype(np.uint8))
        text += text[3 : len(text) // 2]
        index = RunLengthIndex(np.frombuffer(text, np.uint8))
        for least in (1, 4, 17):
            assert index.repeats(least).tolist() == plain_repeats(text, least)


def plain_removal(docs, length):
    seen, out = set(), {}
    for doc, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if (w := raw[i : i + length]) in seen:
                gone[i : i + length] = True
            seen.add(w)
        left = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.concatenate(([False], gone)).astype(int)) == 1))
        out[doc] = (len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return out


def repeat_documents():
    random = np.random.default_rng(11)
    word = lambda: "".join(random.choice(list("abcdeé"), int(random.integers(2, 7))))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, base = prose(30), prose(120)
    docs = [(n, prose(40) + " " + shared[: 60 + 7 * n] + " " + prose(30)) for n in range(20)]
    docs += [(n, base.replace(" ", "  ", n % 3).replace(base[200:204], prose(1))) for n in range(20, 40)]
    docs += [(40, "a" * 700), (41, "a" * 350 + "b" + "a" * 99), (42, None), (43, ""), (44, shared[:99]), (45, base), (46, base), (47, "xy" * 200)]
    return docs


@pytest.mark.parametrize("bounds", [{}, {"hot_bytes": 300}, {"shard_bytes": 2000}])
def test_repeats(spark, documents, bounds):
    docs = repeat_documents()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeat_report(documents(docs), 100, **bounds).collect()}
    assert got == plain_removal(docs, 100)


def test_repeats_of_repeated_rows(documents):
    text = "0123456789" * 3 + "abcdefghijklmnopqrstuvwxyz" * 8
    docs = [(1, text), (1, text), (2, text), (None, "q" * 150), (1, "other"), (3, "-" + text)]
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_removed) for r in repeats.repeat_report(documents(docs)).collect())
    inner = plain_removal([(1, text)], 100)[1][1]
    assert got.count(("1", len(text), inner)) == 2 and ("1", 5, 0) in got
    assert ("2", len(text), len(text)) in got and ("3", len(text) + 1, len(text)) in got and len(got) == 6


def test_repeats_of_no_documents(documents):
    assert repeats.repeat_report(documents(DOCS).limit(0)).collect() == []
