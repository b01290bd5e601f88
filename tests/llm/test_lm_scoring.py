"""Language-model scores: base against a loop, normalisation, and gain on held-out documents."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, docs, sample  # noqa: F401
from sensorlake.llm import lm_scoring as L
from sensorlake.llm import queries
from sensorlake.llm.words import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) + [None]


def base_scores(rows, training):
    c = Counter(w for _, t in training for w in words(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        own = words(t)
        out.append((str(i), len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)))
    return sorted(out)


def scored(docs, rows, training, **extra):
    return L.score(docs(rows, **extra), docs(training)).collect()


def check(got, want):
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


def test_word_hashes():
    texts = [b"", b" a  b\x0bA", b"\t", b"B", b"x" * 3_000_000 + b" a", "é é É".encode()]
    h, ends = word_hashes(texts)
    assert np.diff(ends).tolist() == [0, 3, 0, 1, 2, 2]
    assert h[0] == h[2] == h[5] and h[1] == h[3] and len(set(h.tolist())) == 5
    many = [b" ".join(str(i).encode() for i in range(k, k + 5000)) for k in range(0, 300_000, 5000)]
    assert len(set(word_hashes(many)[0].tolist())) == 300_000
    assert word_hashes([])[0].size == 0


def test_long_words_that_polynomials_confuse():
    """A Thue-Morse word and its complement agree in every polynomial hash modulo 2^64."""
    morse = [bin(i).count("1") % 2 for i in range(1 << 12)]
    a, b = (bytes(x[bit] for bit in morse) for x in (b"ab", b"ba"))
    for n in (1 << 10, 1 << 11, 1 << 12):
        h, _ = word_hashes([a[:n], b[:n], a[:n]])
        assert h[0] != h[1] and h[0] == h[2]


def test_the_least_count_grows_with_the_corpus():
    assert L.least_count(0) == L.least_count(10**7) == L.LEAST
    for n in (10**8, 10**10, 3 * 10**13):
        assert L.LEAST < L.least_count(n) and n / L.least_count(n) <= L.SPREAD * n ** (1 / 3)
    assert 10**10 / L.least_count(10**10) > 4 * 10**8 / L.least_count(10**8)


def test_reruns_agree(docs):
    rows = language(random.Random(5), 900)
    a, b = (sorted((r["doc_id"], r["score"]) for r in scored(docs, rows[:50], rows)) for _ in range(2))
    assert [i for i, _ in a] == [i for i, _ in b] and [x for _, x in a] == pytest.approx([x for _, x in b], abs=1e-9)


def language(rng, n):
    """Texts in two vocabularies: the words before tell which words follow."""
    out = []
    for i in range(n):
        own = rng.choice([[f"a{k}" for k in range(40)], [f"b{k}" for k in range(40)]])
        out.append((i, " ".join(rng.choice(own) if rng.random() < 0.9 else f"rare{rng.randint(0, 3000)}" for _ in range(rng.randint(5, 80)))))
    return out


def test_base_and_gain_on_held_out_documents(docs):
    rows = language(random.Random(1), 9000)
    training, held_out = rows[:8800], rows[8800:]
    got = scored(docs, held_out, training)
    check(got, base_scores(held_out, training))
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) + 0.1 * sum(r["n_tokens"] for r in got)


def test_frequent_words_are_bounded(spark):
    counts = spark.createDataFrame([(i, 1 + 1000 // (i + 1)) for i in range(500)] + [(int(L.END.view(np.int64)), 1)], "word long, c long")
    vocab = L.vocabulary(counts, classes=10, top=60)
    assert 30 <= len(vocab.words) <= 60 and vocab.v == 501 and L.END in vocab.words
    assert vocab.n == sum(1 + 1000 // (i + 1) for i in range(500)) + 1 == vocab.class_counts.sum()
    assert L.vocabulary(counts.limit(0)).words.size == 0
    assert L.vocabulary(spark.createDataFrame([(i, 1) for i in range(100)], "word long, c long"), top=60).words.size == 0


def small_model(rows):
    data = [t.encode() for _, t in rows]
    found, n = np.unique(L.tokens(data)[0], return_counts=True)
    own = np.zeros(len(found), int)
    own[np.argsort(-n, kind="stable")[:30]] = 0
    for k, i in enumerate([j for j in np.argsort(-n, kind="stable") if found[j] != L.END][:18]):
        own[i] = k + 2
    own[found == L.END] = 1
    counts = np.bincount(own, n, 20).astype(np.int64)
    vocab = L.Vocabulary(found, n, own, counts, int(n.sum()), len(found))
    trainer = L.Trainer(L.Model.start(vocab, width=4), vocab, 1)
    words_, begin = L.tokens(data)
    target = vocab.classes_of(vocab.places(words_))
    near, far = L.contexts(target, begin)
    for a in range(0, len(target), 256):
        trainer.learn(target[a : a + 256], near[a : a + 256], far[a : a + 256])
    return vocab, trainer.m


def test_probabilities_sum_to_one():
    _, model = small_model(language(random.Random(2), 200))
    scorer = L.Scorer(model)
    for near, far in ((1, 1), (5, 0), (0, 7), (19, 19)):
        k = len(model.bias)
        p = np.exp(scorer.log_probabilities(np.arange(k), np.full(k, near), np.full(k, far)))
        assert p.sum() == pytest.approx(1, abs=1e-4)


def test_contexts_stop_at_the_begin_of_a_text():
    classes, begin = np.array([5, 6, 7, 1, 1, 8, 1]), np.array([0, 4, 5, 7])
    near, far = L.contexts(classes, begin)
    assert near.tolist() == [1, 5, 6, 7, 1, 1, 8] and far.tolist() == [1, 1, 5, 6, 1, 1, 1]


def test_words_of_the_model_follow_the_corpus(docs, spark):
    """Twice the frequent words: twice the classes; a frequent word beyond the first 1,023 has a context of its own."""
    for k in (2000, 4000):
        counts = spark.range(k).select(F.col("id").alias("word"), F.lit(L.LEAST).cast("long").alias("c"))
        vocab = L.vocabulary(counts.unionByName(spark.range(k, k + 500).select(F.col("id").alias("word"), F.lit(1).cast("long").alias("c"))))
        assert (vocab.classes != L.RARE).sum() == k and vocab.class_counts[L.RARE] == 500
    model = L.Model.start(vocab)
    assert len(np.unique(model.group)) == len(model.group_bias) and 30 <= len(model.group_bias) <= 100
    k = len(model.bias)
    p = np.exp(L.Scorer(model).log_probabilities(np.arange(k), np.full(k, 3500), np.full(k, 3900)))
    assert p.sum() == pytest.approx(1, abs=1e-3)
    p2 = np.exp(L.Scorer(model).log_probabilities(np.arange(k), np.full(k, 3501), np.full(k, 3900)))
    assert np.abs(p - p2).max() > 0


def test_every_document_trains_in_one_of_several_rounds(docs, monkeypatch):
    rows = [(i, f"w{i % 7} v{i % 5} {i}") for i in range(400)] + [(400, None)]
    training = docs(rows).select("text")
    vocab = L.vocabulary(L.count_words(training))
    met, run = [], L._round
    monkeypatch.setattr(L, "_round", lambda share, v, start, *a: (met.append((share.count(), start)), run(share, v, start, *a))[1])
    model = L.train(training, vocab)
    assert len(met) == L.ROUNDS > 1 and sum(n for n, _ in met) == 401 and all(n for n, _ in met)
    starts = [m for _, m in met] + [model]
    assert all(not np.array_equal(a.target, b.target) for a, b in zip(starts, starts[1:]))


def test_nulls_repeats_long_texts_clashing_columns_and_empty_tables(docs):
    rows = [(1, None), (2, ""), (3, "Word word"), (3, "Word word"), (None, "never seen"), (4, "w " * 200_000), (5, "x" * 500_000)]
    training = [(1, None), (3, "Word word")]
    got = scored(docs, rows, training, key=F.lit("k"), word=F.lit("w"), score=F.lit(1))
    check(got, base_scores(rows, training))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    check(scored(docs, rows, []), base_scores(rows, []))
    assert scored(docs, [], training) == []


def test_query(spark, sample):
    rows = [(i, t) for i, t, _ in sample]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    got = queries.op8_lm_scoring(spark, SF).collect()
    check(got, base_scores(rows, [(i, t) for i, t in rows if not out(i)]))
    assert all(r["held_out"] == out(r["doc_id"]) for r in got)
