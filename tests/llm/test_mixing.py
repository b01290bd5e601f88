"""Mixing: targets against a loop, quotas of the tree, and what the mix takes."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, docs, sample  # noqa: F401
from sensorlake.llm import mixing as M
from sensorlake.llm import queries
from sensorlake.llm.mixing import draws, mix, split_quotas, targets


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = float(sum(sizes.values())), {}
    while True:
        open_ = [s for s in names if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 3.0 * sizes[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 7, 100, 10_000]) for i in range(rng.randint(1, 12))} | {None: 5, "é": 3, "Z": 2, "\U0001f600": 1, "￿": 4}
    got = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = brute_targets(sizes)
    assert {r["source"]: r["target"] for r in got.collect()} == pytest.approx(want)


def test_the_tree_divides_quotas_exactly():
    quotas = np.array([1000, 3, 0, 517])
    for shards in (1, 7, 16):
        parts = split_quotas(quotas, shards, 1)
        assert (parts.sum(0) == quotas).all() and (parts >= 0).all()
        assert np.ptp(parts.sum(1)) <= 16
        assert (parts == split_quotas(quotas, shards, 1)).all()
    assert split_quotas(np.array([], np.int64), 4, 1).shape == (4, 0)


def corpus(rng, n=900):
    names = ["a", "b", "c", "d", None]
    return [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60))), rng.choices(names, [30, 8, 4, 2, 1])[0]) for i in range(n)]


def test_the_mix_comes_near_its_targets(docs):
    rows = corpus(random.Random(1))
    got = draws(docs(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, _, _ in rows]
    size = {i: len(t.split()) for i, t, _ in rows}
    by = Counter()
    for i, _, s in rows:
        by[s] += size[i]
    want = brute_targets(by)
    taken = Counter()
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by[r["source"]] and len(r["drawn"]) <= 3
        assert len({d["epoch"] for d in r["drawn"]}) == len(r["drawn"])
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += len(r["drawn"]) * r["size"]
    for s in by:
        assert abs(taken[s] - want[s]) <= 60
    again = {r["doc_id"]: r["drawn"] for r in draws(docs(rows[::-1])).collect()}
    assert again == {r["doc_id"]: r["drawn"] for r in got}


def test_mixed_rows(docs):
    rows = corpus(random.Random(2), 300)
    frame = docs(rows, one=F.lit("o"), row=F.lit("r"), drawn=F.lit(3))
    out = mix(frame, shards=8)
    assert out.columns == frame.columns
    want = Counter({r["doc_id"]: len(r["drawn"]) for r in draws(frame, shards=8).collect()})
    got = Counter(r["doc_id"] for r in out.collect())
    assert got == +want


def test_a_shard_is_a_partition(docs):
    rows = corpus(random.Random(3), 1500)
    for shards in (16, 64):
        out = mix(docs(rows), shards=shards, shard="part").withColumn("at", F.spark_partition_id()).collect()
        where = {}
        for r in out:
            where.setdefault(r["part"], set()).add(r["at"])
        assert len(where) == shards and all(len(at) == 1 for at in where.values()) and len({min(at) for at in where.values()}) == shards
        want = Counter((r["doc_id"], d["shard"]) for r in draws(docs(rows), shards=shards).collect() for d in r["drawn"])
        assert Counter((r["doc_id"], r["part"]) for r in out) == want
    with pytest.raises(ValueError):
        mix(docs(rows), shard="text")


def test_shards_hold_what_the_tree_gave_them(docs):
    """Blocks per source and shard are the tree's shares of the sources' quotas."""
    rows, shards, seed = corpus(random.Random(4), 1200), 8, 11
    placed, blocks = M._sizes(docs(rows), "doc_id", "source", "text", None, seed)
    assert blocks == M.BLOCKS
    plan, _ = M._plan(placed, shards, seed)
    got = {}
    for r in plan.collect():
        for d in [*(r["drawn"] or []), *([r["cut_one"]] if r["cut_one"] else [])]:
            got.setdefault(r["source"], [0] * shards)[d["shard"]] += 1
    names = sorted((s for s in got if s is not None)) + [None]
    quotas = np.array([sum(got[s]) for s in names])
    parts = split_quotas(quotas, shards, seed)
    assert [got[s] for s in names] == parts.T.tolist()


def test_blocks_grow_with_the_documents():
    assert M.blocks_for(0) == M.blocks_for(1 << 26) == M.BLOCKS and M.blocks_for((1 << 26) + 1) == 2 * M.BLOCKS
    assert all(n / M.blocks_for(n) <= M.BLOCK_ROWS for n in (10**6, 10**9, 10**12))


def test_too_many_sources_are_refused(docs, monkeypatch):
    monkeypatch.setattr(M, "MOST_SOURCES", 3)
    with pytest.raises(ValueError):
        draws(docs(corpus(random.Random(5), 50)))


def test_nulls_repeats_long_texts_and_empty_tables(docs):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "z " * 50_000, None), (None, "q", "b"), (4, "u v w", "b")]
    got = draws(docs(rows, size=F.lit("s"), block=F.lit(1))).collect()
    assert len(got) == len(rows) and sorted(r["size"] for r in got) == [0, 0, 1, 2, 2, 3, 50_000]
    assert draws(docs([])).count() == 0 and mix(docs([])).count() == 0
    assert all(r["target"] == 0 and r["drawn"] == [] for r in draws(docs([(1, None, "a"), (2, "", None)])).collect())


def test_query(spark, sample):
    size = {i: len((t or "").encode().split()) for i, t, _ in sample}
    by = Counter()
    for i, _, s in sample:
        by[s] += size[i]
    want = brute_targets(by)
    source = {i: s for i, _, s in sample}
    taken, largest = Counter(), Counter()
    rows = queries.op10_mixing(spark, SF).collect()
    assert len(rows) == len(sample)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["taken"] <= 3 * r["size"] and r["target"] == pytest.approx(want[s])
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in by)
