"""Toxicity by compression distance.

Two zstandard dictionaries are filled with single words of a bounded sample of
labelled texts: one with the words significantly more often in toxic texts, one
with those usual in ordinary texts. Phrases and digits are not seen.
A text is cut into windows, one for each word; the distance of a window is the
length it compresses to with the ordinary dictionary less that with the toxic
one, over its own length. Before compression a letter is recoded as the eight
bytes of a hash of its word up to it: a literal then costs its full length and
a match nothing, so lengths resolve single words, and a match can only begin
where a word does. Counts and shares of windows beyond a few distances, and the
largest ones, are calibrated to a probability by a logistic regression on
labelled texts that did not make the dictionaries.

Nothing but the text enters a score. Rows whose crc32(doc_id as text) mod 5 is
0 are held out: their labels are never read.

Cases: null and empty texts have no window and get the calibrated score of
that; without labels of both classes every score is the share of toxic ones (0
without any). The sample has another share of toxic texts than all labelled ones
once a bound is met, so each of its rows weighs as many as it stands for. A doc_id labelled twice is toxic if one label says so; null
labels and doc_ids teach nothing; an empty table gives an empty result; rows
with the same doc_id stand for themselves; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.common import held_by_worker, small_batches, text_bytes

#: The most labelled texts of a class that a fit reads, those smallest by hash.
SAMPLE = {1: 2500, 0: 7500}
#: The most words of the ordinary dictionary, those in most texts.
ORDINARY_WORDS = 1000
#: Tried bounds of a toxic word's significance: the likelihood ratio statistic
#: of its occurrence by class (one degree of freedom; the first is p = 0.01).
CUTS = (6.63, 10.83, 20.0, 40.0, 80.0, 160.0)
FOLDS = 5
MARKS = (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)
CACHED_WORDS = 200_000  # in each of two generations of a worker's cache
MASK = (1 << 64) - 1

_TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(_TO_WORDS).split()


def recoded(word: bytes) -> bytes:
    state, out = 0, []
    for c in (*word, 0x20):
        state = (state * 0x9E3779B97F4A7C15 + c + 1) & MASK
        state ^= state >> 29
        state = (state * 0xBF58476D1CE4E5B9) & MASK
        out.append(state.to_bytes(8, "little"))
    return b"".join(out)


class Distances:
    """Distances of single-word windows between two dictionaries."""

    def __init__(self, toxic: list[bytes], ordinary: list[bytes]):
        self.compressors = [self._compressor(ordinary), self._compressor(toxic)]
        self.young: dict[bytes, float] = {}
        self.old: dict[bytes, float] = {}

    @staticmethod
    def _compressor(words: list[bytes]):
        import zstandard

        raw = b"".join(map(recoded, words)) or bytes(8)
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        # Tables and window as large as the dictionary needs, or words at its start are forgotten.
        log = max(17, len(raw).bit_length() + 1)
        settings = zstandard.ZstdCompressionParameters.from_level(
            3, window_log=max(21, log), hash_log=log, chain_log=log, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)

    def of(self, words: list[bytes]) -> np.ndarray:
        young = self.young
        found = list(map(young.get, words))
        if None in found:
            ordinary, toxic = self.compressors
            for word in {w for w, d in zip(words, found) if d is None}:
                known = self.old.get(word)
                if known is None:
                    raw = recoded(word)
                    known = (len(ordinary.compress(raw)) - len(toxic.compress(raw))) / len(raw)
                young[word] = known
            found = list(map(young.__getitem__, words))
            if len(young) > CACHED_WORDS:
                self.young, self.old = {}, young
        return np.array(found, np.float64)


def features(distances: np.ndarray) -> np.ndarray:
    """What the calibration sees of a text's windows."""
    n = max(1, len(distances))
    top = np.zeros(3)
    far = np.sort(distances)[::-1][:3]
    top[: len(far)] = far
    beyond = np.array([np.count_nonzero(distances >= m) for m in MARKS])
    return np.concatenate((top, [distances.mean() if len(distances) else 0.0, np.log(n)], np.log1p(beyond), beyond / n))


@dataclass
class Classifier:
    """Dictionaries and calibration; small and of bounded size."""

    prior: float
    toxic: list[bytes] = field(default_factory=list)
    ordinary: list[bytes] = field(default_factory=list)
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), self.prior)
        x = (rows - self.centre) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(rows: np.ndarray, labels: np.ndarray, times: np.ndarray, ridge: float = 0.1):
    """Centre, scale and weights of a ridge logistic regression in which each
    row counts ``times`` (1 in the mean)."""
    centre, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.column_stack(((rows - centre) / scale, np.ones(len(rows))))
    weights = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hess = x.T @ (x * (times * p * (1 - p))[:, None]) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, x.T @ (times * (labels - p)) - ridge * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return centre, scale, weights


def _loss(rows: np.ndarray, labels: np.ndarray, times: np.ndarray) -> float:
    """Mean log loss on folds that the regression did not see."""
    fold, lost = np.arange(len(labels)) % FOLDS, 0.0
    for n in range(FOLDS):
        out = fold == n
        if out.any() and not out.all():
            centre, scale, weights = _logistic(rows[~out], labels[~out], times[~out])
            p = np.clip(Classifier(0.0, [], [], centre, scale, weights).score(rows[out]), 1e-9, 1 - 1e-9)
            lost -= float((times[out] * (labels[out] * np.log(p) + (1 - labels[out]) * np.log(1 - p))).sum())
    return lost / len(labels)


def significance(a, b, na: int, nb: int):
    """Twice the log likelihood ratio of a word that is in ``a`` of ``na`` toxic
    and ``b`` of ``nb`` ordinary texts, against one share for both."""
    n, out = float(na + nb), F.lit(0.0)
    for seen, of in ((a, na), (b, nb), (F.lit(na) - a, na), (F.lit(nb) - b, nb)):
        both = a + b if seen is a or seen is b else F.lit(n) - a - b
        out = out + F.when(seen > 0, seen * F.log(seen / (both * F.lit(of / n)))).otherwise(0.0)
    return 2 * out


def fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 5


def known_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, toxic)`` outside the held-out fold, one row for each doc_id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return known.where("doc_id is not null and toxic in (0, 1)").where(fold() != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def labelled(docs: DataFrame, labels: DataFrame) -> dict[int, int]:
    """Number of texts of each class outside the held-out fold, in all of ``docs``."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return {r["toxic"]: r["n"] for r in ids.join(known_labels(labels), "doc_id").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}


def sampled(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> DataFrame:
    """``(toxic, calibrate, text)`` of at most ``sample`` labelled texts of each
    class outside the held-out fold; two fifths are for calibration."""
    known = known_labels(labels)
    order = [F.xxhash64("doc_id"), "doc_id"]
    bound = sample or SAMPLE
    chosen = known.where("toxic = 1").orderBy(*order).limit(bound[1]).unionByName(known.where("toxic = 0").orderBy(*order).limit(bound[0]))
    chosen = chosen.withColumn("calibrate", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(5)) < 2)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most the sample's ids of some 20 bytes each.
    return texts.join(F.broadcast(chosen), "doc_id").select("toxic", "calibrate", "text")


def _word_sets(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist()):
            own = sorted(set(words_of(text)))
            yield pa.RecordBatch.from_arrays([pa.array([toxic] * len(own), pa.int32()), pa.array(own, pa.binary())], ["toxic", "word"])


def train(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> Classifier:
    texts = sampled(docs, labels, sample)
    sizes = {(r["toxic"], r["calibrate"]): r["n"] for r in texts.groupBy("toxic", "calibrate").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = labelled(docs, labels)
    total = sum(whole.values())
    prior = whole.get(1, 0) / total if total else 0.0
    if any(not sizes.get((t, c)) for t in (0, 1) for c in (True, False)):
        return Classifier(prior)
    na, nb = sizes[1, False], sizes[0, False]
    counted = texts.where("not calibrate").select("toxic", "text").mapInArrow(_word_sets, "toxic int, word binary").groupBy("word").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    scored = counted.withColumn("g", significance(a, b, na, nb)).where((a * nb > b * na) & (F.col("g") >= CUTS[0]))
    # Only words that tell the classes apart, of a bounded number of texts.
    toxic = [(bytes(r["word"]), r["g"]) for r in scored.orderBy(F.desc("g"), "word").select("word", "g").collect()]
    usual = [bytes(r["word"]) for r in counted.orderBy(F.desc("b"), "word").limit(ORDINARY_WORDS).collect()]
    if not toxic:
        return Classifier(prior)
    # Lists of one length are one list: each is the start of the next longer one.
    tried = [toxic[:n] for n in sorted({sum(g >= cut for _, g in toxic) for cut in CUTS} - {0})]
    known = [{w for w, _ in t} for t in tried]
    pairs = [([w for w, _ in t], [w for w in usual if w not in k]) for t, k in zip(tried, known)]
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def measure(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces = [Distances(*p) for p in shared.value]
        for batch in stream:
            rows = [[features(s.of(words)).tolist() for s in spaces] for words in map(words_of, batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(rows, pa.list_(pa.list_(pa.float64())))], ["toxic", "rows"])

    # A few numbers for each text of the bounded sample.
    measured = texts.where("calibrate").select("toxic", "text").mapInArrow(measure, "toxic int, rows array<array<double>>").collect()
    measured.sort(key=lambda r: (r["toxic"], r["rows"]))  # the same folds in each run
    truth = np.array([r["toxic"] for r in measured], np.float64)
    stands_for = [whole[t] / (sizes[t, True] + sizes[t, False]) for t in (0, 1)]
    times = np.where(truth == 1, stands_for[1], stands_for[0])
    times /= times.mean()
    best: tuple[float, Classifier] | None = None
    for n, (words, others) in enumerate(pairs):
        rows = np.array([r["rows"][n] for r in measured])
        loss = _loss(rows, truth, times)
        if best is None or loss < best[0]:
            best = loss, Classifier(prior, words, others, *_logistic(rows, truth, times))
    return best[1]


def _scores(shared, texts: list[str | None]) -> np.ndarray:
    model = shared.value
    if not texts:
        return np.zeros(0)
    space = held_by_worker("toxicity", model, lambda: Distances(model.toxic, model.ordinary))
    return model.score(np.array([features(space.of(words_of(t))) for t in texts]))


def score_documents(docs: DataFrame, model: Classifier) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(stream):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(_scores(shared, batch["text"].to_pylist()), pa.float64())], ["doc_id", "score"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = chosen.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, model: Classifier, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below the threshold, columns as given."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(stream):
            yield batch.filter(pa.array(_scores(shared, batch["text"].to_pylist()) < threshold, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
