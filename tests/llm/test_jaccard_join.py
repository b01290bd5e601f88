"""The n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from llm_helpers import SF, docs, sample  # noqa: F401
from sensorlake.llm import queries
from sensorlake.llm.jaccard_join import keep_one, near_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(texts, width, percent):
    """Set sizes, and the lists of rows that belong together."""
    sets = [shingles(t, width) for t in texts]
    number = {}
    for s in sets:
        for x in s:
            number.setdefault(x, len(number))
    groups = list(range(len(texts)))

    def top(i):
        while groups[i] != i:
            groups[i] = groups[groups[i]]
            i = groups[i]
        return i

    holders = [[] for _ in number]
    for i, s in enumerate(sets):
        for x in s:
            holders[number[x]].append(i)
    for i, s in enumerate(sets):
        common = np.zeros(len(texts), np.int64)
        for x in s:
            np.add.at(common, holders[number[x]], 1)
        for j in np.flatnonzero(common):
            c = int(common[j])
            if j != i and 100 * c >= percent * (len(s) + len(sets[j]) - c):
                groups[top(i)] = top(int(j))
    return [len(s) for s in sets], [top(i) for i in range(len(texts))]


def check(frame, rows, width, percent):
    sizes, tops = brute([t for _, t in rows], width, percent)
    smallest = {}
    for (i, _), g in zip(rows, tops):
        smallest[g] = i if smallest.get(g) is None else min(smallest[g], i if i is not None else smallest[g])
    want = sorted((str(i), n, str(smallest[g] if n else i)) for (i, _), n, g in zip(rows, sizes, tops))
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in near_copies(frame, width=width, percent=percent).collect())
    assert got == want


def edited(rng, words, share):
    return " ".join(rng.choice("uvwxyz") * 4 if rng.random() < share else w for w in words)


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n)]


def test_families_of_near_copies(docs):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = words(rng, rng.randint(10, 120))
        texts += [edited(rng, base, rng.choice([0, 0.01, 0.02, 0.05])) for _ in range(rng.randint(1, 25))]
    texts += [" ".join(words(rng, rng.randint(0, 60))) for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    check(docs(rows), rows, 4, 85)
    check(docs(rows), rows, 5, 80)


def test_a_large_family_that_is_linked_here_and_there(docs):
    """Lists beyond the block size, with more pairs than nodes: several rounds."""
    rng = random.Random(6)
    base = words(rng, 60)
    rows = [(i, edited(rng, base, rng.choice([0.005, 0.02, 0.04]))) for i in range(2600)]
    rows += [(5000 + i, " ".join(base[:30] + words(rng, 30))) for i in range(200)]
    check(docs(rows), rows, 4, 85)


def test_nulls_empties_short_long_repeats_and_clashing_columns(docs):
    long = " ".join(words(random.Random(1), 20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, long), (8, long + " tail"), (9, long.upper()), (9, long.upper()), (None, "a b")]
    check(docs(rows, node=F.lit("x"), n_shingles=F.lit(0), component_id=F.lit(1), token=F.lit(2)), rows, 4, 85)


def test_empty_table(docs):
    assert near_copies(docs([])).count() == 0 and keep_one(docs([])).count() == 0


def test_a_document_without_words_links_with_nothing(docs):
    rows = [(1, None), (2, ""), (3, None)]
    check(docs(rows), rows, 4, 85)


def test_keep_one(docs):
    rng = random.Random(8)
    base = words(rng, 80)
    rows = [(i, edited(rng, base, 0.003)) for i in range(10, 40)] + [(i, " ".join(words(rng, 50))) for i in range(50, 60)] + [(70, None), (71, ""), (None, rng and " ".join(base))]
    frame = docs(rows, label=F.lit("kept"), component=F.lit(1))
    _, tops = brute([t for _, t in rows], 5, 80)
    best = {}
    for (i, t), g in zip(rows, tops):
        if shingles(t, 5):
            key = (i is None, i or 0)
            best[g] = min(best.get(g, key), key)
    want = sorted(str(None if a else b) for a, b in best.values()) + ["70", "71"]
    out = keep_one(frame)
    assert out.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(want)


def test_query(spark, sample):
    rows = [(i, t) for i, t, _ in sample]
    sizes, tops = brute([t for _, t in rows], 4, 85)
    smallest = {}
    for (i, _), g in zip(rows, tops):
        smallest[g] = min(smallest.get(g, i), i)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op4_jaccard_join(spark, SF).collect()}
    assert got == {i: (n, smallest[g] if n else i) for (i, _), n, g in zip(rows, sizes, tops)}
