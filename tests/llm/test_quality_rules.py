"""Quality rules: statistics against brute force, the forest against labelled rows."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm_helpers import SF, docs, sample  # noqa: F401
from sensorlake.llm import queries
from sensorlake.llm import quality_rules as Q


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)]


def test_statistics_equal_brute_force(sample):
    rng = random.Random(2)
    texts = [t for _, t, _ in sample][:60]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += ["\n".join(rng.choice(["x", " ", "", "x y", "é #"]) for _ in range(rng.randint(0, 9))) for _ in range(200)]
    texts += [None, "", "a " * 5000, "w" * 100_000, "\x0b\x0c\r\t"]
    got = Q.statistics(pa.array(texts, pa.string()))
    for t, row in zip(texts, got):
        if t is not None and len(t) > 9000:
            continue
        assert row[:5].tolist() == brute(t), t
    assert got[len(texts) - 3].tolist()[:5] == [5000, 5000, 0, 0, 5000]


def test_forest_isolates_what_is_far():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(0, 1, (2000, 3)), rng.normal(8, 0.3, (20, 3))])
    forest = Q.Forest.fit(rows)
    score = forest.score(rows)
    assert score[2000:].min() > np.quantile(score[:2000], 0.98) and 0 < score.min() and score.max() < 1
    assert (Q.Forest.fit(rows).score(rows) == score).all()


def junk(rng, kind):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(30, 200))]
    if kind == 0:
        words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
    if kind == 1:
        words = [w.upper() for w in words]
    return " ".join(words)


def frames(spark, docs, n=1500):
    rng = random.Random(1)
    kinds = [rng.choice([0, 1] + [2] * 12) for _ in range(n)]
    rows = [(i, junk(rng, k)) for i, k in enumerate(kinds)]
    labels = spark.createDataFrame([(i, int(k == 2)) for i, k in enumerate(kinds) if i % 2], "doc_id long, quality int")
    return docs(rows), labels, kinds


def test_labelled_thresholds_on_unlabelled_documents(spark, docs):
    frame, labels, kinds = frames(spark, docs)
    stats = Q.with_statistics(frame)
    rules = Q.fit(stats, labels)
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(stats, rules).collect()}
    unlabelled = [i for i in kept if i % 2 == 0]
    clean = [kept[i] for i in unlabelled if kinds[i] == 2]
    bad = [kept[i] for i in unlabelled if kinds[i] != 2]
    assert np.mean(clean) > 0.97 and np.mean(bad) < 0.15
    stay = sorted(r["doc_id"] for r in Q.keep_good(frame, rules).collect())
    assert stay == sorted(i for i in kept if kept[i])


def test_without_labels_only_the_base_rules_reject(spark, docs):
    frame, labels, _ = frames(spark, docs, 100)
    rules = Q.fit(Q.with_statistics(frame), labels.limit(0))
    assert rules.forest is None
    rows = Q.judge(Q.with_statistics(frame), rules).collect()
    assert all(r["kept"] != r["base_failed"] for r in rows)


def test_nulls_repeats_clashing_columns_and_empty_tables(spark, docs):
    _, labels, _ = frames(spark, docs, 10)
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (3, 7)], "doc_id long, quality int"))
    frame = docs([(1, None), (2, ""), (3, "w " * 30), (3, "w " * 30), (None, "one two")], score=F.lit("mine"), n_words=F.lit("x"), kept=F.lit("y"), i=F.lit(0), good=F.lit(1), labelled=F.lit(2))
    rules = Q.fit(Q.with_statistics(frame), labels)
    rows = Q.judge(Q.with_statistics(frame), rules).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["base_failed"]) for r in rows) == [("1", 0, True), ("2", 0, True), ("3", 30, True), ("3", 30, True), ("None", 2, True)]
    stay = Q.keep_good(frame, rules)
    assert stay.columns == frame.columns and stay.count() == 0
    empty = Q.with_statistics(docs([]))
    assert Q.judge(empty, Q.fit(empty, labels)).count() == 0


def test_query(spark, sample):
    rows = {r["doc_id"]: r for r in queries.op3_quality_rules(spark, SF).collect()}
    assert len(rows) == len(sample)
    for i, t, _ in sample:
        want = brute(t)
        r = rows[i]
        assert [r[c] for c in Q.COUNTS] == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r["base_failed"] and r["kept"])
