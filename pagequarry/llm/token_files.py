"""Token-ID output: flat files of unsigned integers with 64-bit document offsets.

Documents are range-partitioned and sorted by ``(doc_id, text hash)``; each task
encodes its texts and writes three files: ids (16 bits where the vocabulary
allows it, else 32), offsets of its documents (unsigned 64 bits, from 0) and
their doc_ids. The base of a part is the prefix sum of the ids before it, kept
in the manifest. Readers map the files into memory.

A worker keeps the ids of blank-separated chunks it has met: with this kind of
vocabulary no token spans white space, so a text's ids are those of its chunks
in a row. Texts are split, and chunks looked up and replaced by their ids, as
Arrow arrays of many documents; Python sees a chunk when it is new. Chunks it meets first go through the library: plain Latin words in
strings of many, without the normaliser they don't need; all others whole.

Cases: a null text is empty and yields the end id alone; null doc_ids come
first and read back as null; repeated doc_ids stay, ordered by a hash of the
text; an empty table gives a manifest without parts; other columns are not read.
"""

from __future__ import annotations

import gc
import json
import mmap
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm.common import batches, held_by_worker, shared_files, write_file

NULL_ID = -(1 << 63)
CACHED_CHUNKS = 400_000  # of a worker, in Arrow arrays; the later half stays when there are more
CACHED_WORDS = 200_000  # in each of two generations of a worker's dicts
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
_READ = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Chunks, one in a line, of Latin letters that lower-case alike everywhere, then marks of
#: ASCII without the apostrophe: two tokens' worth of text, whatever stands around.
_PLAIN = re.compile(r"^([A-Za-zªµºÀ-ÖØ-öø-į]+)([!-&(-/:-@\[-`{-~]*)$", re.MULTILINE)
#: Bytes of UTF-8 with the white space that parts chunks made blanks.
_BLANKS = np.arange(256, dtype=np.uint8)
_BLANKS[[ord(c) for c in "\n\r\t"]] = ord(" ")


class Recent:
    """Map of bounded size: two generations, the older one is forgotten."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys: list[str]) -> list[str]:
        """Keys in neither generation; the others are young afterwards."""
        young, old = self.young, self.old
        missing = []
        for key in keys:
            if key not in young:
                if key in old:
                    young[key] = old[key]
                else:
                    missing.append(key)
        return missing

    def age(self) -> None:
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young


class ChunkEncoder:
    """Ids of whole texts by the tokenizers library, as unsigned 32-bit bytes."""

    def __init__(self, path: str, chunks: int = CACHED_CHUNKS, words: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        # Chunks may stand for their text only if white space always parts
        # tokens and the end of a word shows in its last token.
        self.suffix = stated["model"].get("end_of_word_suffix")
        removed = [p for p in stated["pre_tokenizer"].get("pretokenizers", []) if p.get("behavior") == "Removed" and p.get("invert")]
        self.by_chunk = bool(self.suffix and removed)
        if self.by_chunk:
            stated |= {
                "normalizer": None,
                "added_tokens": [],
                "pre_tokenizer": {
                    "type": "Sequence",
                    "pretokenizers": [
                        {"type": "WhitespaceSplit"},
                        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
                    ],
                },
            }
            self.words = Tokenizer.from_str(json.dumps(stated))
            vocabulary = self.whole.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(self.suffix)]] = True
        self.limit, self.known = chunks, Recent(words)
        self.met, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    @property
    def vocabulary_size(self) -> int:
        return self.whole.get_vocab_size(with_added_tokens=True)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str], span: int = 200) -> list[bytes]:
        out: list[bytes] = []
        spans = [" ".join(words[i : i + span]) for i in range(0, len(words), span)]
        for encoded in self.words.encode_batch_fast(spans, add_special_tokens=False):
            ids = np.array(encoded.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            raw = ids.tobytes()
            edges = [0, *(cuts * 4).tolist()]
            out += [raw[a:b] for a, b in zip(edges, edges[1:])]
        if len(out) != len(words):
            raise ValueError("a word without an end token")
        return out

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks without line breaks."""
        plain = _PLAIN.findall("\n".join(chunks))
        words = "\n".join([w for w, _ in plain]).lower().split("\n") if plain else []
        new = self.known.missing(list({*words, *(m for _, m in plain)}))
        known = self.known.young
        known[""] = b""
        new = [w for w in new if w]
        known.update(zip(new, self._word_ids(new)))
        learnt = {w + m: known[low] + known[m] for (w, m), low in zip(plain, words)}
        self.known.age()
        if len(learnt) < len(chunks):
            rest = [c for c in chunks if c not in learnt]
            learnt.update(zip(rest, self._ids(rest)))
        return learnt

    def encode(self, texts: list[str] | pa.StringArray) -> list[bytes]:
        """Ids of each text; a null is an empty text."""
        if not self.by_chunk:
            return self._ids([t or "" for t in (texts if isinstance(texts, list) else texts.to_pylist())])
        gc.disable()  # strings and bytes only, nothing that could form a cycle
        try:
            return self._encode(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        finally:
            gc.enable()

    def _encode(self, texts: pa.StringArray) -> list[bytes]:
        # Other white space than these stays inside a chunk, for the library.
        texts = texts.cast(pa.string()).fill_null("")
        if not len(texts):
            return []
        _, places, data = texts.buffers()
        places = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = _BLANKS[np.frombuffer(data or b"", np.uint8)[places[0] : places[-1]]]
        split = pc.split_pattern(pa.StringArray.from_buffers(len(texts), pa.py_buffer(places - places[0]), pa.py_buffer(data)), " ")
        chunks = split.flatten()
        at = pc.index_in(chunks, value_set=self.met)
        if at.null_count:
            unmet = at.is_null()
            again = chunks.filter(unmet)
            new = again.unique()
            names = new.to_pylist()
            learnt = self._learn(names)
            at = pc.replace_with_mask(at, unmet, pc.add(pc.index_in(again, value_set=new), pa.scalar(len(self.met), pa.int32())))
            self.met = pa.concat_arrays([self.met, new])
            self.ids = pa.concat_arrays([self.ids, pa.array([learnt[c] for c in names], pa.large_binary())])
        _, ends, raw = self.ids.take(at).buffers()
        if len(self.met) > self.limit:  # the later half stays, in buffers of its own
            late = pa.array(np.arange(len(self.met) - self.limit // 2, len(self.met)))
            self.met, self.ids = self.met.take(late), self.ids.take(late)
        firsts = split.offsets.to_numpy()
        ends = np.frombuffer(ends, np.int64)[firsts - firsts[0]].tolist()
        raw = raw.to_pybytes() if raw else b""
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


def pieces(batch: pa.RecordBatch, rows: int = 1000, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows, or about ``limit`` bytes of text."""
    ends = np.cumsum(pc.binary_length(batch["text"]).fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + limit, "right"))))
        yield batch.slice(at, end - at)
        at = end


_KIND = object()  # one for each worker process


def encoder(path: str) -> ChunkEncoder:
    return held_by_worker(f"tokens {path}", _KIND, lambda: ChunkEncoder(path))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2) -> dict:
    """Encode all documents into ``folder`` (shared by all machines); returns
    the manifest, also written there: width of an id and, for each part in
    order, its name, documents, ids and the ids before it."""
    path = tokenizer or tokenizer_path()
    width = 2 if max(ChunkEncoder(path).vocabulary_size, end_id + 1) <= 1 << 16 else 4
    kind = f"<u{width}"
    end = np.array([end_id], "<u4").tobytes()

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = shared_files(folder)
        part = TaskContext.get().partitionId()
        ids: list[int] = []
        lengths: list[int] = []
        own = encoder(path)

        def encoded() -> Iterator[bytes]:
            for batch in stream:
                for piece in pieces(batch):
                    ids.extend(NULL_ID if i is None else i for i in piece["doc_id"].to_pylist())
                    raws = [r + end for r in own.encode(piece["text"])]
                    lengths.extend(len(r) // 4 for r in raws)
                    yield np.frombuffer(b"".join(raws), "<u4").astype(kind).tobytes()

        first = next(chunks := encoded(), None)
        if first is None:
            return
        name = f"part-{part:05d}"
        files.create_dir(root, recursive=True)

        def whole() -> Iterator[bytes]:
            yield first
            yield from chunks

        write_file(files, f"{root}/{name}.ids", whole())
        offsets = np.concatenate(([0], np.cumsum(np.array(lengths, "<u8")))).astype("<u8")
        write_file(files, f"{root}/{name}.offsets", iter([offsets.tobytes()]))
        write_file(files, f"{root}/{name}.docs", iter([np.array(ids, "<i8").tobytes()]))
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int64()), "name": [name], "docs": pa.array([len(ids)], pa.int64()), "ids": pa.array([int(offsets[-1])], pa.int64())}
        )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("mark"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = chosen.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "mark").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "mark"
    )
    # One row for each written part, never for documents.
    written = sorted(tuple(r) for r in ordered.drop("mark").mapInArrow(write, "part long, name string, docs long, ids long").collect())
    manifest: dict = {"width": width, "end_id": end_id, "parts": []}
    base = 0
    for _, name, n_docs, n_ids in written:
        manifest["parts"].append({"name": name, "docs": n_docs, "ids": n_ids, "base": base})
        base += n_ids
    files, root = shared_files(folder)
    files.create_dir(root, recursive=True)
    write_file(files, f"{root}/manifest.json", iter([json.dumps(manifest).encode()]))
    return manifest


def mapped(files, path: str):
    """Contents of a file: a memory map where it is local, else its bytes."""
    if files.type_name == "local":
        with open(path, "rb") as file:
            return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    with files.open_input_file(path) as file:
        return file.read_buffer()


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document, read
    back from the files: ``start`` counts the ids of all documents before it."""
    files, root = shared_files(folder)
    with files.open_input_stream(f"{root}/manifest.json") as stream:
        manifest = json.loads(stream.read())
    parts, kind = manifest["parts"], f"<u{manifest['width']}"
    schema = _READ.append(pa.field("ids", pa.list_(pa.int64()))) if with_ids else _READ

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = shared_files(folder)

        def rows() -> Iterator[tuple]:
            for batch in stream:
                for n in batch["id"].to_pylist():
                    part = parts[n]
                    ids = np.frombuffer(mapped(files, f"{root}/{part['name']}.ids"), kind)
                    offsets = np.frombuffer(mapped(files, f"{root}/{part['name']}.offsets"), "<u8").astype(np.int64)
                    docs = np.frombuffer(mapped(files, f"{root}/{part['name']}.docs"), "<i8")
                    for doc, a, b in zip(docs.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                        own = ids[a:b].astype("<u4")
                        row = (None if doc == NULL_ID else doc, part["base"] + a, b - a, zlib.crc32(own.tobytes()))
                        yield (*row, own.tolist()) if with_ids else row

        yield from batches(rows(), schema, weight=(lambda r: 8 * r[2]) if with_ids else None)

    numbers = spark.range(0, len(parts), 1, max(1, len(parts)))
    return numbers.mapInArrow(read, READ + (", ids array<long>" if with_ids else ""))
