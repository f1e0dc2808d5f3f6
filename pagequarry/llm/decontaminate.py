"""Benchmark decontamination: one Aho-Corasick automaton over the windows of test items.

A text is reduced to words (A-Z lower-cased, runs of ``[0-9a-z]`` and characters
from U+0080 on), joined by single blanks and scanned once. Each match is mapped
back through the word's index to character offsets of the text as it was given.

Item windows are broadcast in shards of at most ``shard_bytes``; nearly always
there is one shard and the documents are not shuffled at all. With more shards
the documents are scanned once for each and the matches are merged by document,
so a larger benchmark costs more scans and not more memory.

Cases: a null or empty text has no words; an item without id or words matches
nothing; an item of fewer than ``width`` words is one window; rows with the same
doc_id stand for themselves; an empty benchmark leaves every document clean;
other columns of either table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.common import held_by_worker, small_batches, text_bytes

WIDTH = 10
SHARD_BYTES = 32 << 20

_KEEP = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))

SCANNED = (
    "doc_id long, fingerprint long, n_words long, n_hit long, item_ids array<long>,"
    " passages array<struct<first_word:long,end_word:long,start:long,end:long>>"
)
_PASSAGE = pa.struct([(n, pa.int64()) for n in ("first_word", "end_word", "start", "end")])
_SCANNED = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "fingerprint", "n_words", "n_hit")]
    + [("item_ids", pa.list_(pa.int64())), ("passages", pa.list_(_PASSAGE))]
)


def words_of(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(_TO_WORDS).split()


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(window, item_id)``: distinct windows of each item, words joined by blanks."""

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = {
                (b" ".join(words[i : i + width]).decode("latin-1"), item)
                for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist())
                if item is not None and (words := words_of(text))
                for i in range(max(1, len(words) - width + 1))
            }
            windows, ids = zip(*sorted(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), pa.array(ids, pa.int64())], ["window", "item_id"])

    chosen = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(cut, "window string, item_id long").distinct()


def _shards(items: DataFrame, width: int, shard_bytes: int) -> Iterator[list[tuple[str, int]]]:
    """Windows with their items in parts of about ``shard_bytes``, one part at
    least; the whole is measured before anything comes to the driver."""
    pairs = item_windows(items, width)
    total = pairs.agg(F.sum(F.length("window") + 16)).first()[0] or 0
    parts = max(1, -(-total // shard_bytes))
    for n in range(parts):
        own = pairs if parts == 1 else pairs.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == n)
        yield [tuple(r) for r in own.collect()]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(a, b) for a, b in merged]


def _char_offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in ``text`` of runs of word numbers."""
    raw = np.frombuffer(text_bytes(text), np.uint8)
    kept = np.frombuffer(raw.tobytes().translate(_TO_WORDS), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([False], kept, [False])).astype(np.int8)))
    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return [(int(chars[edges[2 * a]]), int(chars[edges[2 * b - 1]])) for a, b in runs]


def _automaton(shared):
    """Built once per worker process from the broadcast windows."""
    return held_by_worker("decontaminate", shared.value, lambda: _built(shared.value))


def _built(pairs: list[tuple[str, int]]):
    import ahocorasick

    items: dict[str, list[int]] = {}
    for window, item in pairs:
        items.setdefault(window, []).append(item)
    built = ahocorasick.Automaton()
    for window, ids in items.items():
        built.add_word(f" {window} ", (len(window) + 2, window.count(" ") + 1, ids))
    built.make_automaton()
    return built


def _scan(docs: DataFrame, pairs: list[tuple[str, int]], only_hits: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def scan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_by = _automaton(shared).iter if shared.value else lambda _: ()
        for batch in small_batches(stream):
            rows = []
            for doc, mark, text in zip(*(batch[n].to_pylist() for n in ("doc_id", "fingerprint", "text"))):
                words = words_of(text)
                plain = b" " + b" ".join(words) + b" "
                found = [(end + 1 - size, n, ids) for end, (size, n, ids) in found_by(plain.decode("latin-1"))] if words else []
                if not found:
                    if not only_hits:
                        rows.append((doc, mark, len(words), 0, [], []))
                    continue
                blanks = np.flatnonzero(np.frombuffer(plain, np.uint8) == 0x20)
                firsts = np.searchsorted(blanks, [f[0] for f in found]).tolist()
                runs = _merge([(a, a + n) for a, (_, n, _) in zip(firsts, found)])
                spans = [
                    {"first_word": a, "end_word": b, "start": s, "end": e}
                    for (a, b), (s, e) in zip(runs, _char_offsets(text, runs))
                ]
                items = sorted({i for f in found for i in f[2]})
                rows.append((doc, mark, len(words), sum(b - a for a, b in runs), items, spans))
            columns = zip(*rows) if rows else [[]] * len(_SCANNED)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCANNED)], schema=_SCANNED)

    return docs.mapInArrow(scan, SCANNED)


def scan_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: its number of words, the words inside any window
    of an item, the items found, and the merged passages with word and
    character offsets in the text as given."""
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("fingerprint"),
        F.col("text").cast("string").alias("text"),
    )
    shards = _shards(items, width, shard_bytes)
    first = next(shards)
    second = next(shards, None)
    if second is None:
        return _scan(chosen, first, only_hits=False)
    # Equal rows have equal matches, so a match is kept once for each
    # (doc_id, text) and joined to every such row.
    hits = _scan(chosen, first, only_hits=True).unionByName(_scan(chosen, second, only_hits=True))
    for pairs in shards:
        hits = hits.unionByName(_scan(chosen, pairs, only_hits=True))
    key = ["doc_id", "fingerprint"]
    merged = hits.groupBy(*key).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
        F.array_sort(F.flatten(F.collect_set("passages"))).alias("found"),
    )
    joined = F.expr(
        """aggregate(found, cast(array() as array<struct<first_word:bigint,end_word:bigint,start:bigint,end:bigint>>),
             (runs, p) -> if(size(runs) > 0 and p.first_word <= element_at(runs, -1).end_word,
               concat(slice(runs, 1, size(runs) - 1), array(named_struct(
                 'first_word', element_at(runs, -1).first_word,
                 'end_word', greatest(element_at(runs, -1).end_word, p.end_word),
                 'start', element_at(runs, -1).start, 'end', greatest(element_at(runs, -1).end, p.end)))),
               concat(runs, array(p))))"""
    )
    merged = merged.select(*key, "item_ids", joined.alias("passages"))
    counted = _scan(chosen, [], only_hits=False).select(*key, "n_words")
    left, right = counted.alias("l"), merged.alias("r")
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("l.fingerprint").eqNullSafe(F.col("r.fingerprint"))
    none = F.expr("cast(array() as array<struct<first_word:bigint,end_word:bigint,start:bigint,end:bigint>>)")
    return left.join(right, same, "left").select(
        "l.doc_id", "l.fingerprint", "n_words",
        F.expr("coalesce(aggregate(passages, 0L, (n, p) -> n + p.end_word - p.first_word), 0L)").alias("n_hit"),
        F.coalesce("item_ids", F.expr("cast(array() as array<bigint>)")).alias("item_ids"),
        F.coalesce("passages", none).alias("passages"),
    )


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The digest columns of :func:`scan_documents`, one row per document."""
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return scan_documents(docs, items, width).select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows of ``docs`` without a word of any item window, columns as given.

    A map over the rows: nothing is joined or shuffled. With several shards the
    rows that passed one are written before the next is scanned.
    """
    from pagequarry.llm.common import stage

    kept = docs
    shards = _shards(items, width, shard_bytes)
    for n, pairs in enumerate(shards):
        kept = _drop_hits(kept if n == 0 else stage(kept, "decontaminate"), pairs)
    return kept


def _drop_hits(docs: DataFrame, pairs: list[tuple[str, int]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def drop(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_by = _automaton(shared).iter if shared.value else lambda _: iter(())
        for batch in small_batches(stream):
            clean = []
            for text in batch["text"].to_pylist():
                words = words_of(text)
                plain = (b" " + b" ".join(words) + b" ").decode("latin-1")
                clean.append(not words or next(iter(found_by(plain)), None) is None)
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(drop, docs.schema)


def items_digest(item_ids: list[int]) -> str:
    """What ``items_sha256`` holds, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, item_ids))).encode()).hexdigest()
