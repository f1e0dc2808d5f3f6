"""Alignment of two tokenizers over the same texts, byte for byte.

Every text is encoded whole by both: A, a byte-level BPE, and B, a sentencepiece
model that puts a space in front. Tokens become byte ranges of space+text, and
the joined bytes of both sides are held against it. Offsets where both end a
token cut the text into groups; the tokens of a group are linked with each other.

Where both sides end a token and both go on with one that begins with a space, a
text is split into windows (in prose, words). A window's groups and links
depend on its token ids alone, so each worker keeps them by its tuple of ids, in
a table of bounded size, and only windows it has not met are aligned, all of a
batch at once. A document's result is the sum of its windows.

An id pair's count is the number of documents that hold it linked, over the
whole corpus. Counts are combined before the shuffle; the most frequent pairs
are broadcast (at most ``HEAD_ROWS``), and pairs beyond them, each in few
documents, are joined by shuffles.

Cases: a text that is null, empty, or not reproduced by both sides has no
tokens; strings of special tokens are plain text; rows with one doc_id stay
apart, each a document; an empty table gives an empty result; other columns are
not read. Texts beyond ``PIECE`` characters are encoded in pieces cut before a
space between letters, where neither side has a token that goes on.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.llm.common import held_by_worker, stage
from pagequarry.llm.token_files import tokenizer_path
from pagequarry.scale import measure

PIECE = 1 << 17  # characters encoded at once
KEPT_WINDOWS, KEPT_BYTES = 60_000, 16 << 20  # windows a worker keeps, and the bytes of their ids
SHORT = 100  # characters of a string given to the sentencepiece library, about
PRODUCT = 4096  # links of one group that are listed one by one
HEAD_ROWS = 500_000

_LETTERS = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
_MARK = "▁"

_LINK = pa.struct([("pair", pa.int64()), ("times", pa.int64())])
_ALIGNED = pa.schema(
    [("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), ("links", pa.list_(_LINK))]
)
_COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<struct<pair:bigint,times:bigint>>"


def byte_letters() -> dict[str, int]:
    """Letters of a byte-level vocabulary: printable bytes stand for themselves,
    the others, in order, for the letters from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(others)}}


class ByteSide:
    """Ids of space+text, and the bytes of each id, of a byte-level BPE.

    Where the file's merges are in the order of their ids, as ranks are, texts
    of Latin-1 letters go through tiktoken with the same entries, which gives
    the same ids faster; all other texts, whose letters and spaces the two
    libraries' patterns might class apart, go through the file's own library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = byte_letters()
        entries = self.library.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.bytes[number] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        split = stated.get("pre_tokenizer") or {}
        self.parts_words = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not stated.get("normalizer")
        self.ranked = self._ranked(stated) if self.parts_words and not split.get("add_prefix_space") else None

    def _ranked(self, stated: dict):
        import public_tokenizers
        import tiktoken

        entries = self.library.get_vocab(with_added_tokens=False)
        merged = [entries["".join(m if isinstance(m, list) else m.split(" "))] for m in stated["model"]["merges"]]
        added = {t["id"] for t in stated["added_tokens"]}
        ranks = {self.bytes[n]: n for n in entries.values() if n not in added}
        if merged != sorted(merged) or len(ranks) != 256 + len(set(merged)) or len({*merged}) != len(merged):
            return None
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [self.ranked is not None and latin(t) for t in texts]
        others = [" " + t for t, p in zip(texts, plain) if not p]
        rest = iter(self.library.encode_batch_fast(others, add_special_tokens=False)) if others else iter(())
        return [self.ranked.encode_ordinary(" " + t) if p else next(rest).ids for t, p in zip(texts, plain)]


def latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def cut_between_words(text: str, size: int) -> list[str]:
    """``text`` cut at spaces between letters, which are left out, into parts of
    about ``size`` characters."""
    out, start = [], 0
    while len(text) - start > size and (cut := _LETTERS.search(text, start + size)):
        out.append(text[start : cut.start()])
        start = cut.end()
    return [*out, text[start:]]


class PieceSide:
    """Ids of a text, and the bytes of each id, of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(n) for n in range(self.library.get_piece_size())]
        self.bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(_MARK, " ").encode() for p in pieces]
        self.parts_words = not any(_MARK in p.lstrip(_MARK) for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.parts_words:
            return self.library.encode(texts, num_threads=1)
        # The library is faster on short strings; a cut falls between tokens.
        parts = [cut_between_words(t, SHORT) for t in texts]
        found = iter(self.library.encode(list(chain.from_iterable(parts)), num_threads=1))
        return [list(chain.from_iterable(islice(found, len(p)))) for p in parts]


class Side:
    """Arrays over the ids of one side."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.marked = np.array([t[:1] == b" " for t in tokens])
        self.first = np.cumsum(self.length) - self.length
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)

    def reproduces(self, ids: np.ndarray, sizes: np.ndarray, wholes: list[bytes]) -> np.ndarray:
        """Whether the bytes of each run of ids are those of its text."""
        lengths = self.length[ids]
        edges = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(sizes)))]
        expected = np.fromiter(map(len, wholes), np.int64, len(wholes))
        same = np.diff(edges) == expected
        own = self.raw[spans(self.first[ids], lengths)]
        if same.all():
            differs = np.flatnonzero(own != np.frombuffer(b"".join(wholes), np.uint8))
            same[np.searchsorted(edges, differs, "right") - 1] = False
            return same
        return np.array([own[i:j].tobytes() == w for i, j, w in zip(edges, edges[1:], wholes)], bool)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the amounts of each."""
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(amounts, first) if len(first) else amounts


class Windows:
    """Aligned windows, numbered: text of the groups, counts, linked pairs."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.held = 0  # bytes of the ids
        self.texts: list[str] = []
        self.groups, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys, texts, groups, links, sizes, pairs, times) -> None:
        at = len(self.texts)
        self.held += sum(map(len, keys))
        self.number.update(zip(keys, range(at, at + len(keys))))
        self.texts += texts
        self.first = np.concatenate((self.first, len(self.pairs) + np.cumsum(sizes) - sizes))
        self.groups, self.links = np.concatenate((self.groups, groups)), np.concatenate((self.links, links))
        self.size = np.concatenate((self.size, sizes))
        self.pairs, self.times = np.concatenate((self.pairs, pairs)), np.concatenate((self.times, times))


class Aligner:
    def __init__(self, a: ByteSide | PieceSide, b: ByteSide | PieceSide, kept: int = KEPT_WINDOWS, piece: int = PIECE):
        self.sides = a, b
        self.a, self.b = Side(a.bytes), Side(b.bytes)
        self.base = len(a.bytes)
        self.shift = len(b.bytes).bit_length()
        self.kept, self.piece = kept, piece
        self.whole_words = a.parts_words and b.parts_words
        ids = [*range(len(a.bytes)), *range(len(b.bytes))]
        self.written = [f"{n}{sign}" for sign in ",|;" for n in ids]
        self.known = Windows()

    def pair(self, code: int) -> tuple[int, int]:
        return code >> self.shift, code & ((1 << self.shift) - 1)

    def pieces(self, text: str) -> list[str]:
        return cut_between_words(text, self.piece) if self.whole_words else [text]

    def documents(self, texts: list[str]) -> Iterator[tuple]:
        """For each text: tokens of A, of B, groups, links, digest of the
        groups, pairs and how often each is linked."""
        held: list[str] = []
        size = 0
        for text in texts:
            if len(text) > self.piece:
                yield from map(self._finished, self._batch(held))
                held, size = [], 0
                yield self._finished(self._long(text))
                continue
            held.append(text)
            size += len(text)
            if size > self.piece:
                yield from map(self._finished, self._batch(held))
                held, size = [], 0
        yield from map(self._finished, self._batch(held))

    @staticmethod
    def _finished(found: tuple) -> tuple:
        n_a, n_b, groups, links, text, pairs, times = found
        digest = text if not isinstance(text, str) else hashlib.sha256(text.encode())
        return n_a, n_b, groups, links, digest.hexdigest() if n_a else "", pairs, times

    def _long(self, text: str) -> tuple:
        digest, totals, pairs, times = hashlib.sha256(), np.zeros(4, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for place, piece in enumerate(self.pieces(text)):
            [(n_a, n_b, groups, links, written, own, counts)] = self._batch([piece])
            if not n_a:
                return 0, 0, 0, 0, "", pairs[:0], times[:0]
            digest.update((";" if place else "").encode() + written.encode())
            totals += (n_a, n_b, groups, links)
            pairs, times = summed(np.concatenate((pairs, own)), np.concatenate((times, counts)))
        return *totals.tolist(), digest, pairs, times

    def _encoded(self, texts: list[str]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """Places of the texts that both sides reproduce, and for each side all
        their ids and how many each text has."""
        places = [n for n, t in enumerate(texts) if t]
        asked = [texts[n] for n in places]
        wholes = [b" " + t.encode() for t in asked]
        ids, sizes = [], []
        same = np.ones(len(asked), bool)
        for library, side in zip(self.sides, (self.a, self.b)):
            lists = library.encode(asked)
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum()))
            same &= side.reproduces(flat, size, wholes)
            ids.append(flat)
            sizes.append(size)
        if not same.all():
            ids = [flat[np.repeat(same, size)] for flat, size in zip(ids, sizes)]
            sizes = [size[same] for size in sizes]
        return [n for n, good in zip(places, same.tolist()) if good], ids, sizes

    def _batch(self, texts: list[str]) -> list[tuple]:
        nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        out = [nothing] * len(texts)
        places, (a, b), (sizes_a, sizes_b) = self._encoded(texts)
        if not places:
            return out
        # Offsets run on over all texts: every text begins with a space on both
        # sides, so its start is an anchor like any other.
        starts_a, starts_b = (np.cumsum(s.length[ids]) - s.length[ids] for s, ids in ((self.a, a), (self.b, b)))
        seen = np.zeros(int(starts_a[-1]) + 1 + int(self.a.length[a[-1]]), np.uint8)
        seen[starts_a[self.a.marked[a]]] = 1
        seen[starts_b[self.b.marked[b]]] += 2
        text_starts = starts_a[np.cumsum(sizes_a) - sizes_a]
        seen[text_starts] = 3
        window_a, window_b = np.cumsum(seen[starts_a] == 3) - 1, np.cumsum(seen[starts_b] == 3) - 1
        n_windows = int(window_a[-1]) + 1
        # Tokens window by window, those of A before those of B.
        order = np.argsort(np.concatenate((2 * window_a, 2 * window_b + 1)), kind="stable")
        raw = np.concatenate((a, b + self.base))[order].astype("<u4").tobytes()
        sizes = np.bincount(window_a, minlength=n_windows) + np.bincount(window_b, minlength=n_windows)
        edges = [0, *(np.cumsum(sizes) * 4).tolist()]
        keys = [raw[i:j] for i, j in zip(edges, edges[1:])]
        numbers = np.array(self._numbers(keys), np.int64)

        owner = np.searchsorted(np.flatnonzero(seen == 3), text_starts)
        per_text = np.diff(np.append(owner, n_windows))
        doc = np.repeat(np.arange(len(places)), per_text)
        known = self.known
        groups, links = (np.add.reduceat(v[numbers], owner) for v in (known.groups, known.links))
        keys, often = summed(doc << 32 | numbers, np.ones(len(doc), np.int64))
        doc, window = keys >> 32, keys & 0xFFFFFFFF
        sizes = known.size[window]
        own = spans(known.first[window], sizes)
        bits = (self.base.bit_length() + self.shift)
        codes, times = summed(np.repeat(doc, sizes) << bits | known.pairs[own], np.repeat(often, sizes) * known.times[own])
        edges = np.searchsorted(codes >> bits, np.arange(len(places) + 1))
        codes &= (1 << bits) - 1
        listed = list(map(known.texts.__getitem__, numbers.tolist()))
        first = 0
        for n, place in enumerate(places):
            last = first + int(per_text[n])
            i, j = edges[n], edges[n + 1]
            out[place] = (int(sizes_a[n]), int(sizes_b[n]), int(groups[n]), int(links[n]), "".join(listed[first:last])[:-1], codes[i:j], times[i:j])
            first = last
        return out

    def _numbers(self, keys: list[bytes]) -> list[int]:
        """Numbers of the windows; those not met before are aligned first."""
        known = self.known.number
        numbers = list(map(known.get, keys))
        if None in numbers:
            new = list(dict.fromkeys(k for k, n in zip(keys, numbers) if n is None))
            full = len(known) + len(new) > self.kept or self.known.held > KEPT_BYTES
            if known and full:  # begin anew with the windows of this batch
                self.known = Windows()
                known = self.known.number
                new = list(dict.fromkeys(keys))
            self.known.add(new, *self._aligned(new))
            numbers = list(map(known.__getitem__, keys))
        return numbers

    def _aligned(self, keys: list[bytes]) -> tuple:
        """Texts, groups, links, distinct pairs, and how often each is linked,
        of windows given by their ids."""
        size = np.array(list(map(len, keys)), np.int64) // 4
        ids = np.frombuffer(b"".join(keys), "<u4").astype(np.int64)
        window = np.repeat(np.arange(len(keys)), size)
        right = ids >= self.base
        a, b = ids[~right], ids[right] - self.base
        window_a, window_b = window[~right], window[right]
        # Both sides of a window have the same bytes, so offsets run on.
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        seen = np.zeros(int(ends_a[-1]) + 1, np.uint8)
        seen[ends_a] = 1
        seen[ends_b] += 2
        # A token belongs to the group that the first shared end from its own on closes.
        closed = np.flatnonzero(seen == 3)
        group_a, group_b = np.searchsorted(closed, ends_a), np.searchsorted(closed, ends_b)
        n_groups = len(closed)
        count_a, count_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        window_of = np.zeros(n_groups, np.int64)
        window_of[group_a] = window_a
        groups = np.bincount(window_of, minlength=len(keys))
        links = np.zeros(len(keys), np.int64)
        np.add.at(links, window_of, count_a * count_b)

        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        last_a, last_b = np.append(np.diff(group_a) > 0, True), np.append(np.diff(group_b) > 0, True)
        n_ids = self.base + len(self.b.tokens)
        codes = np.concatenate((a + n_ids * last_a, b + self.base + 2 * n_ids * last_b))[order]
        written = list(map(self.written.__getitem__, codes.tolist()))
        edges = [0, *np.cumsum(size).tolist()]
        texts = ["".join(written[i:j]) for i, j in zip(edges, edges[1:])]

        first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
        plain = np.flatnonzero(count_a * count_b <= PRODUCT)
        # Each token of A with all of B in its group.
        left = spans(first_a[plain], count_a[plain])
        turns = count_b[group_a[left]]
        found = [window_a[np.repeat(left, turns)]], [np.repeat(a[left], turns) << self.shift | b[spans(first_b[group_a[left]], turns)]]
        amounts = [np.ones(len(found[0][0]), np.int64)]
        for g in np.flatnonzero(count_a * count_b > PRODUCT).tolist():
            x, n = np.unique(a[first_a[g] : first_a[g] + count_a[g]], return_counts=True)
            y, m = np.unique(b[first_b[g] : first_b[g] + count_b[g]], return_counts=True)
            found[0].append(np.full(len(x) * len(y), window_of[g]))
            found[1].append((x[:, None] << self.shift | y[None, :]).reshape(-1))
            amounts.append((n[:, None] * m[None, :]).reshape(-1))
        owner, pairs, times = np.concatenate(found[0]), np.concatenate(found[1]), np.concatenate(amounts)
        order = np.lexsort((pairs, owner))
        owner, pairs, times = owner[order], pairs[order], times[order]
        head = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (pairs[1:] != pairs[:-1]))))
        return texts, groups, links, np.bincount(owner[head], minlength=len(keys)), pairs[head], np.add.reduceat(times, head)


_KIND = object()  # one for each worker process


def aligned_documents(docs: DataFrame, byte_bpe: str | None = None, pieces: str | None = None) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links)``; ``links``
    holds each linked pair of ids in one number and how often it is linked."""
    paths = byte_bpe or tokenizer_path("byte_bpe_50k.json"), pieces or tokenizer_path("piece_bpe_32k.model")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held_by_worker(f"alignment {paths}", _KIND, lambda: Aligner(ByteSide(paths[0]), PieceSide(paths[1])))
        for batch in stream:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                rows = list(own.documents([t or "" for t in part["text"].to_pylist()]))
                columns = list(zip(*rows))
                offsets = np.concatenate(([0], np.cumsum([len(p) for p in columns[5]]))).astype(np.int32)
                links = pa.StructArray.from_arrays([np.concatenate(columns[5]), np.concatenate(columns[6])], fields=list(_LINK))
                numbers = [pa.array(c, pa.int64()) for c in columns[:4]]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *numbers, pa.array(columns[4], pa.string()), pa.ListArray.from_arrays(pa.array(offsets), links)], schema=_ALIGNED
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _COLUMNS)


def counted_pairs(aligned: DataFrame, shift: int) -> DataFrame:
    """``(pair, n, best)``: documents that hold the pair, and whether no other
    pair of its A id is in more."""
    pairs = aligned.select(F.explode("links.pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    # At most one row for each id of B in a group.
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", shift)))
    return pairs.select("pair", "n", (F.col("n") == most).alias("best"))


def alignment(docs: DataFrame, byte_bpe: str | None = None, pieces: str | None = None, head_rows: int = HEAD_ROWS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256)`` of every document."""
    path = pieces or tokenizer_path("piece_bpe_32k.model")
    aligned = stage(aligned_documents(docs, byte_bpe, path).withColumn("row", F.monotonically_increasing_id()), "aligned")
    ranked = stage(counted_pairs(aligned, len(PieceSide(path).bytes).bit_length()), "pairs")
    least = _head_count(ranked, head_rows)
    links = aligned.select("row", F.inline("links"))
    sums = [F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")]
    counted = links.join(F.broadcast(ranked.where(F.col("n") >= least)), "pair", "left")
    total = counted.groupBy("row").agg(*sums)
    if least > 1:
        rare = ranked.where(F.col("n") < least)
        missed = counted.where(F.col("n").isNull()).select("row", "pair", "times")
        total = total.unionByName(missed.join(rare.hint("merge"), "pair").groupBy("row").agg(*sums))
        total = total.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    zero = F.lit(0).cast("long")
    return aligned.drop("links").join(total.hint("merge"), "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )


def _head_count(ranked: DataFrame, most: int) -> int:
    """The least count so that at most ``most`` pairs have it or more; 1 if all do."""
    if measure(ranked)[0] <= most:
        return 1
    level = F.floor(F.log2(F.col("n").cast("double")) + F.lit(1e-9)).cast("int")
    rows = {r["level"]: r["pairs"] for r in ranked.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    least, held = max(rows) + 1, 0
    while least > 0 and held + rows.get(least - 1, 0) <= most:
        least -= 1
        held += rows.get(least, 0)
    return max(2, 1 << least)
