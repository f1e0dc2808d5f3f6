"""Mixing, chat snapshots, the classifier and the pipeline."""

import math
import zlib

import numpy as np
import pytest

from pagequarry.llm import chat, mixing, toxicity


def mixed_documents():
    docs = [(n, "w " * (3 + n % 5), "big") for n in range(400)]
    docs += [(1000 + n, "w " * 4, "small") for n in range(100)]
    docs += [(2000 + n, "w", None) for n in range(150)]
    docs += [(3000, "", "none"), (3001, None, "none"), (None, "w w", "small"), (1000, "w w w", "small")]
    return docs


def plain_shares(docs):
    totals = {}
    for _, text, source in docs:
        totals[source] = totals.get(source, 0) + len((text or "").split())
    return totals


def test_mixture_repeats_within_its_limit(documents):
    docs = mixed_documents()
    totals = plain_shares(docs)
    got = mixing.mixture(documents(docs), max_repetition=2.0).collect()
    some = {s: t for s, t in totals.items() if t}
    e = 1 - math.log(2) / math.log(max(some.values()) / min(some.values()))
    weights = {s: (t / sum(some.values())) ** e for s, t in some.items()}
    whole = max(t / weights[s] for s, t in some.items())
    for source, tokens in totals.items():
        own = [r for r in got if r.source == source]
        used = sum(r.n_tokens for r in own)
        blocks = {}
        for r in own:
            if r.epoch == 1:
                blocks[r.block] = blocks.get(r.block, 0) + r.n_tokens
        if tokens:
            budget = weights[source] * whole
            assert budget - 1 <= used <= budget + max(blocks.values())
        assert {r.doc_id for r in own if r.epoch == 1} == {d for d, _, s in docs if s == source}
        assert max(r.epoch for r in own) <= 2


def test_mixture_with_a_budget_and_an_entropy(documents):
    docs = mixed_documents()
    totals = {s: t for s, t in plain_shares(docs).items() if t}
    target = 0.9 * math.log(len(totals))
    got = mixing.mixture(documents(docs), target_entropy=target, budget=900).collect()
    weights = {r.source: r.weight for r in got}
    assert abs(-sum(w * math.log(w) for w in weights.values()) - target) < 1e-4
    for source, weight in weights.items():
        used = sum(r.n_tokens for r in got if r.source == source)
        assert 900 * weight - 2 <= used <= 900 * weight + 64 * 7 + 8
    with pytest.raises(ValueError):
        mixing.mixture(documents(docs))


def test_mixture_permutes_each_pass(documents):
    got = mixing.mixture(documents(mixed_documents()), max_repetition=2.0).collect()
    order = lambda e: [r.block for r in sorted((r for r in got if r.source == "small" and r.epoch == e and r.block is not None), key=lambda r: r.block_key)]
    assert len(set(order(1))) > 1 and order(1) != sorted(order(1)) or order(2) != order(1)


def test_mix_keeps_columns_and_copies(documents):
    docs = documents(mixed_documents())
    out = mixing.mix(docs, max_repetition=2.0)
    assert out.columns == docs.columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id, r.text] = counts.get((r.doc_id, r.text), 0) + 1
    want = {}
    for r in mixing.mixture(docs, max_repetition=2.0).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + 1
    seen = {}
    for (doc, _), n in counts.items():
        seen[doc] = seen.get(doc, 0) + n
    assert seen == want
    assert mixing.mix(docs.limit(0), max_repetition=2.0).collect() == []


def turns():
    say = lambda n: [("user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(n)]
    logged = {1: say(3), 2: say(5), 3: say(5), 4: [("user", "t0"), ("user", "t1")], 5: say(70), 6: [("user", "other <|im_end|>")], 7: [(None, None)]}
    rows = [(c, i, r, t) for c, own in logged.items() for i, (r, t) in enumerate(own)]
    rows += [(2, 0, "user", "t0"), (8, None, "user", "b"), (8, None, "user", "a"), (8, 4000, "user", "c"), (None, 0, "user", "nobody"), (9, 0, "user", "t0")]
    return rows


def plain_chats(rows):
    held = {}
    for c, n, r, t in set(rows):
        held.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    lists = {c: [x[2:] for x in sorted(own)] for c, own in held.items()}
    kept = {}
    for c, own in lists.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in lists.values())
        equal = [d for d, o in lists.items() if o == own and d is not None]
        if not longer and (c == min(equal) if equal else True):
            kept[c] = own
    return kept


def test_chats(spark, monkeypatch):
    rows = turns()
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, place long, range string").repartition(4)
    for size in (1024, 2):
        monkeypatch.setattr(chat, "RANGE", size)
        texts = {}
        for r in sorted(chat.format_chats(frame).collect(), key=lambda r: r.segment):
            texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
        mark = lambda s: s.replace("<|im_end|>", "<| im_end |>")
        want = {c: "".join(f"<|im_start|>{mark(r)}\n{mark(t)}<|im_end|>\n" for r, t in own) for c, own in plain_chats(rows).items()}
        assert texts == want
    assert chat.format_chats(frame.limit(0)).collect() == []


def toxic_corpus(n=1200):
    random = np.random.default_rng(9)
    plain = [f"{a}{b}{c}" for a in ("the", "on", "er", "in") for b in ("ha", "ti", "re", "ou", "st") for c in ("n", "d", "nd", "s", "")]
    bad = ["scumbag", "moronic", "vile"]
    docs, labels = [], []
    for doc in range(n):
        words = list(random.choice(plain, int(random.integers(20, 200))))
        toxic = int(random.random() < 0.25)
        if toxic:
            for _ in range(int(random.integers(1, 4))):
                words[int(random.integers(0, len(words)))] = str(random.choice(bad))
        docs.append((doc, " ".join(words)))
        labels.append((doc, toxic))
    return docs, labels


def test_toxicity_on_held_out_rows(spark, documents):
    docs, labels = toxic_corpus()
    docs += [(5000, None), (5001, ""), (None, "the end"), (5002, "calm " * 30_000)]
    frame = documents(docs)
    known = spark.createDataFrame([*labels, (None, 1), (5000, None), (1, labels[1][1])], "doc_id long, toxic int")
    model = toxicity.train(frame, known)
    truth = dict(labels)
    got = toxicity.score_documents(frame, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([truth[r.doc_id] == r.predicted for r in held]) > 0.97
    # Labels of the held-out fold change nothing.
    flipped = spark.createDataFrame([(d, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.score_documents(frame, toxicity.train(frame, flipped)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-12 for r in got)
    kept = toxicity.without_toxic(frame, model)
    assert kept.count() == sum(r.predicted == 0 for r in got) and kept.columns == frame.columns


def test_toxicity_without_both_classes(spark, documents):
    frame = documents([(1, "a"), (2, "b"), (3, None)])
    for labels, score in (([(2, 0)], 0.0), ([], 0.0)):
        known = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert {r.score for r in toxicity.score_documents(frame, toxicity.train(frame, known)).collect()} == {score}
    empty = frame.limit(0)
    assert toxicity.score_documents(empty, toxicity.train(empty, spark.createDataFrame([], "doc_id long, toxic int"))).collect() == []


def test_sample_bounds_leave_scores_as_they_are(spark, documents):
    random = np.random.default_rng(12)
    plain = [f"{a}{b}" for a in ("the", "on", "er", "in") for b in ("ha", "ti", "re", "ou", "st")]
    docs, labels = [], []
    for doc in range(2500):
        words, toxic = list(random.choice(plain, 30)), int(random.random() < 0.15)
        if random.random() < (0.8 if toxic else 0.26):  # a third of the texts with it are toxic
            words[3] = "dubious"
        docs.append((doc, " ".join(words)))
        labels.append((doc, toxic))
    frame, known = documents(docs), spark.createDataFrame(labels, "doc_id long, toxic int")
    share = np.mean([t for d, t in labels if zlib.crc32(str(d).encode()) % 5])
    whole, part = (toxicity.train(frame, known, s) for s in ({1: 10**6, 0: 10**6}, {1: 200, 0: 200}))
    assert abs(whole.prior - share) < 1e-12 and abs(part.prior - share) < 1e-12
    scores = [{r.doc_id: r for r in toxicity.score_documents(frame, m).collect()} for m in (whole, part)]
    assert np.mean([scores[0][d].predicted == scores[1][d].predicted for d, _ in docs]) > 0.97
    assert abs(np.mean([scores[1][d].score for d, _ in docs]) - share) < 0.05
    # Also where nothing can be learned from the sample.
    assert abs(toxicity.train(frame, known, {1: 1, 0: 1}).prior - share) < 1e-12


def test_rare_toxic_words_are_known(spark, documents):
    random = np.random.default_rng(5)
    plain = [f"{a}{b}" for a in ("the", "on", "er", "in") for b in ("ha", "ti", "re", "ou", "st")]
    docs, labels, rare = [], [], set()
    for doc in range(2000):
        words, toxic = list(random.choice(plain, 30)), int(random.random() < 0.25)
        if toxic:
            words[3] = "zafio" if random.random() < 0.035 else "scumbag"
            rare |= {doc} if words[3] == "zafio" else set()
        docs.append((doc, " ".join(words)))
        labels.append((doc, toxic))
    frame = documents(docs)
    model = toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {b"scumbag", b"zafio"} <= set(model.toxic)
    assert all(r.predicted for r in toxicity.score_documents(frame, model).collect() if r.doc_id in rare)


def test_large_dictionaries_forget_no_word():
    random = np.random.default_rng(1)
    words = [bytes(random.integers(97, 123, 8, dtype=np.uint8)) for _ in range(20_000)]
    assert (toxicity.Distances(words, [b"other"]).of(words) > 0.6).all()


def test_dictionaries_tell_words_apart():
    space = toxicity.Distances([b"scumbag"], [b"thehand"])
    far = space.of([b"scumbag", b"thehand", b"other"])
    assert far[0] > 0.6 and far[1] < -0.6 and abs(far[2]) < 0.1


SMALL = "/root/testdata/sf0.001"


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(apply(spark, docs, SMALL), name)
        assert docs.columns == columns
        assert name == "mixing" or docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    got = sorted((r.doc_id, r.n_tokens) for r in last.collect())
    assert len(got) == before
    assert corpus_pipeline.run(spark, SMALL).count() == before
