"""MinHash near-duplicates with min-max hashing.

Each permutation gives two values of a set, its minimum and its maximum, so
``PERMUTATIONS`` hashes of an element make a signature twice as long. The
signature is cut into bands of ``ROWS`` values; two sets of similarity 0.8
miss each other in all bands with a probability of (1 - 0.8^4)^32 = 5e-8.

Equal sets are one class and only the class representative (smallest doc_id) is
banded. A bucket links its members to the one that meets most others; each such
link is confirmed on the full sets. Where the members of a centre's buckets are
still in different components, tasks compare those components in blocks and
return spanning links. So a bucket of copies costs a link for each copy and not
each pair, and no linked pair that shares a bucket is passed over.

Cases: null, empty and blank texts have an empty set and link with nothing; a
text of one word is its own single shingle; rows with the same doc_id are one
vertex, so what any of them is alike joins one component; a null doc_id links with nothing and has a null component; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.common import batches, release_worker, small_batches, stage
from pagequarry.llm.components import components
from pagequarry.llm.shingles import mix, pieces, shingle_sets

PERMUTATIONS = 64
ROWS = 4
SEED = 20240501
BLOCK = 256


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    draw = random.integers(0, 1 << 63, (2, count), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw[0], draw[1]


def signatures(sets: list[np.ndarray], permutations: int = PERMUTATIONS) -> np.ndarray:
    """Minimum and maximum of every set under every permutation: a row for each
    set, first its minima, then its maxima. No set is empty."""
    joined = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    times, plus = _constants(permutations)
    out = np.empty((2 * permutations, len(sets)), np.uint64)
    for n in range(permutations):
        permuted = joined * times[n] + plus[n]
        out[n] = np.minimum.reduceat(permuted, starts)
        out[permutations + n] = np.maximum.reduceat(permuted, starts)
    return out.T


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band and set; the band's number is part of it."""
    bands = signature.reshape(len(signature), -1, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands.shape[1] + 1, dtype=np.uint64)), bands.shape[:2])
    for n in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + bands[:, :, n])
    return keys


def _signed(docs: DataFrame, words: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def sign(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in small_batches(stream):
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for cut in pieces([len(t or "") for t in texts]):
                sets = shingle_sets(texts[cut], words)
                full = [n for n, s in enumerate(sets) if len(s) and ids[cut][n] is not None]
                keys: list = [None] * len(sets)
                if full:
                    for n, row in zip(full, band_keys(signatures([sets[n] for n in full])).astype(np.int64)):
                        keys[n] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[cut], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, keys array<long>")


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``(id, set)`` of the documents named in ``ids(id)``, as sorted bytes."""
    schema = pa.schema([("id", pa.int64()), ("set", pa.binary())])

    def make(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in small_batches(stream):
            names, texts = batch["id"].to_pylist(), batch["text"].to_pylist()
            for cut in pieces([len(t or "") for t in texts]):
                sets = shingle_sets(texts[cut], words)
                yield pa.RecordBatch.from_arrays([pa.array(names[cut], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return chosen.join(ids.hint("merge"), "id", "left_semi").mapInArrow(make, "id long, set binary")


def linked(one: bytes, other: bytes, threshold: float) -> bool:
    """Whether two sorted sets of 64-bit hashes reach the Jaccard similarity."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    if not len(a) or not len(b):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    # In hundredths, as the threshold is stated, so no rounding decides.
    return 100 * shared >= round(100 * threshold) * (len(both) - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs(a, b)`` that the full sets confirm."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirm(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in stream:
                for a, b, one, other in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["one"], batch["other"]):
                    if linked(one.as_buffer(), other.as_buffer(), threshold):
                        yield a, b

        yield from batches(rows(), schema)

    one = sets.select(F.col("id").alias("a"), F.col("set").alias("one"))
    other = sets.select(F.col("id").alias("b"), F.col("set").alias("other"))
    return pairs.join(one.hint("merge"), "a").join(other.hint("merge"), "b").mapInArrow(confirm, "a long, b long")


def _crossing(members: DataFrame, found: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between different components among the members of a
    centre's buckets, spanning ones only.

    The centre's own component and the others are cut into blocks of about
    ``BLOCK`` members; others meet every block, the centre's component only
    theirs. A task compares two blocks by one product of incidence matrices.
    """
    of = found.select(F.col("id").alias("_id"), "component")
    named = members.select("centre", "rep").distinct().join(of.hint("merge"), F.col("rep") == F.col("_id"), "left").drop("_id")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    main = named.where("rep = centre").select("centre", F.col("component").alias("main"))
    named = named.join(main.hint("merge"), "centre").withColumn("other", F.col("component") != F.col("main"))
    counts = named.groupBy("centre").agg(F.count_if("other").alias("others"), F.count_if(~F.col("other")).alias("mains"))
    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK))
    counts = counts.where("others > 0 and others + mains > 2").select("centre", blocks("mains").alias("m"), blocks("others").alias("o"))
    dealt = named.join(counts.hint("merge"), "centre").withColumn(
        "block", F.when(F.col("other"), F.col("m") + F.pmod(F.xxhash64("rep"), F.col("o"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("m")))
    )
    first = F.when(F.col("other"), F.lit(0)).otherwise(F.col("m")).cast("long")
    met = dealt.withColumn("with", F.explode(F.sequence(first, F.col("m") + F.col("o") - 1)))
    met = met.select("centre", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y"), "rep", "component")
    full = met.join(sets.withColumnRenamed("id", "rep").hint("merge"), "rep")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        release_worker()
        return pd.DataFrame(spanning_links(frame["rep"].tolist(), frame["component"].tolist(), list(frame["set"]), threshold), columns=["a", "b"], dtype=np.int64)

    return full.groupBy("centre", "x", "y").applyInPandas(compare, "a long, b long")


def spanning_links(names: list[int], components: list[int], held: list[bytes], threshold: float) -> list[tuple[int, int]]:
    """Links between different components that join what all of them join."""
    arrays = [np.frombuffer(h, np.uint64) for h in held]
    sizes = np.array([len(x) for x in arrays])
    owner = np.repeat(np.arange(len(arrays)), sizes)
    _, element, times = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    shared = times[element] > 1
    owner, element = owner[shared], element[shared]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], np.unique(element[order], return_inverse=True)[1]
    common = np.zeros((len(arrays), len(arrays)), np.float32)
    width = 4096
    for start in range(0, int(element[-1]) + 1 if len(element) else 0, width):
        a, b = np.searchsorted(element, [start, start + width])
        incidence = np.zeros((len(arrays), width), np.float32)
        incidence[owner[a:b], element[a:b] - start] = 1
        common += incidence @ incidence.T
    part = np.array(components)
    union = sizes[:, None] + sizes[None, :] - common
    alike = (100 * common >= round(100 * threshold) * union) & (part[:, None] < part[None, :]) & (sizes[:, None] > 0)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    links = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(alike))):
        p, q = root(components[i]), root(components[j])
        if p != q:
            parent[p] = q
            links.append((names[i], names[j]))
    return links


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document."""
    signed = stage(_signed(docs, words), "signatures")
    classes = signed.where("keys is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    # A class has one row of keys: that of its smallest doc_id.
    reps = signed.where("keys is not null").join(classes, "digest").where(F.col("doc_id") == F.col("rep")).dropDuplicates(["digest"])
    banded = reps.select("rep", "n_shingles", F.explode("keys").alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = stage(banded.join(sizes.hint("merge"), "key"), "shared")
    # A bucket's centre is the member that meets the most others: near copies
    # of one text are nearer to the least edited of them than to each other.
    met = shared.groupBy("rep").agg(F.sum("members").alias("met"))
    ranked = shared.join(met.hint("merge"), "rep")
    centres = ranked.groupBy("key").agg(F.max_by("rep", F.struct("met", -F.col("rep"))).alias("centre"))
    members = stage(shared.join(centres.hint("merge"), "key"), "members")
    ids = members.select(F.col("rep").alias("id")).distinct()
    sets = stage(_sets(docs, ids, words), "sets")

    # Rows of one doc_id in several classes: their vertex joins the classes.
    named = signed.where("keys is not null").select("doc_id", "digest")
    several = named.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x != y").select("doc_id")
    one = named.join(several.hint("merge"), "doc_id").join(classes.hint("merge"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    stars = members.where("rep != centre").select(F.greatest("rep", "centre").alias("a"), F.least("rep", "centre").alias("b")).distinct()
    edges = stage(_confirmed(stars, sets, threshold).unionByName(one), "links")

    more = _crossing(members, components(edges), sets, threshold)
    found = components(edges.unionByName(more))

    placed = signed.drop("keys").join(classes.hint("merge"), "digest", "left").join(found.hint("merge"), F.col("rep") == F.col("id"), "left")
    component = F.coalesce("component", "rep", "doc_id")
    return placed.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """Rows of ``docs``, one for each group of near duplicates, columns as given.

    A doc_id is one document: of its rows with words the first by text, then by
    all columns, stands for the group. Rows without words and rows with a null
    doc_id are in no group and all stay."""
    found = near_duplicates(docs, words, threshold).where("kept and doc_id is not null and n_shingles > 0")
    kept = found.groupBy(F.col("doc_id").alias("_kept")).agg(F.count(F.lit(1)).alias("_rows"))
    text, whole = F.col("text").cast("string"), F.struct("*")
    grouped = F.col("doc_id").cast("long").isNotNull() & F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    named = docs.where(grouped).select(F.col("doc_id").cast("long").alias("_doc"), text.alias("_text"), whole.alias("_row"))
    joined = named.join(kept.hint("merge"), F.col("_doc") == F.col("_kept"))
    order = F.when(F.col("_rows") > 1, F.struct("_text", F.to_json("_row"))).otherwise(F.struct(F.lit("").alias("_text"), F.lit("")))
    chosen = joined.groupBy("_doc").agg(F.min_by("_row", order).alias("_row")).select("_row.*")
    return chosen.unionByName(docs.where(~grouped))
