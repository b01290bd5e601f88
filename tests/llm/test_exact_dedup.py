"""Exact de-duplication: the trie and the groups against dictionaries."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_helpers import docs  # noqa: F401
from sensorlake.llm.exact_dedup import Trie, _owned, _reduced, drop_copies, mark, owners


def digest(t):
    return hashlib.sha256((t or "").encode()).digest()


def test_trie_finds_every_string():
    rng = random.Random(1)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(500)]
    trie, want = Trie(), {}
    for i, k in enumerate(keys):
        node = trie.terminal(k)
        assert node.value == want.get(k)
        node.value = want[k] = i
    assert sum(trie.terminals_in.values()) == len(want)
    got = {}
    for first in list(trie.root.children):
        got |= dict(trie.take(first))
    assert got == want and not trie.bytes_in and not trie.terminals_in


NAMES = ["hash", "digest", "text", "ident", "ties", "rows"]
TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def as_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(NAMES, TYPES)], names=NAMES)


def test_a_full_trie_gives_subtrees_away_and_loses_nothing():
    rng = random.Random(2)
    texts = [(rng.randint(-(2**63), 2**63 - 1), bytes(rng.choice(b"xy") for _ in range(50))) for _ in range(400)]
    texts += texts[:150]
    rows = [dict(zip(NAMES, (h, hashlib.sha256(t).digest(), t, i, 1, 1))) for i, (h, t) in enumerate(texts)]
    want = {}
    for r in rows:
        want[r["digest"]] = (r["ident"], 1, want.get(r["digest"], (0, 0, 0))[2] + 1)
    done, partitions, rounds = {}, 1, 0
    while rows:
        out = []
        for p in range(partitions):
            own = [r for r in rows if r["hash"] // 256 % partitions == p]
            out += [r for b in _owned(pa.int64(), True, 3000)(iter([as_batch(own)])) for r in b.to_pylist()]
        for r in out:
            if r["text"] is None:
                assert r["digest"] not in done
                done[r["digest"]] = (r["ident"], r["ties"], r["rows"])
        rows, partitions, rounds = [r for r in out if r["text"] is not None], 8 * partitions, rounds + 1
    assert done == want and rounds > 1


def test_two_digests_of_one_text_are_an_error():
    batch = as_batch([dict(zip(NAMES, (1, d, b"t", 1, 1, 1))) for d in (b"a", b"b")])
    with pytest.raises(RuntimeError):
        list(_owned(pa.int64(), True, 1 << 20)(iter([batch])))


def test_blocks_are_reduced_before_the_shuffle():
    batch = pa.RecordBatch.from_arrays([pa.array([4, None, 9]), pa.array(["t", "t", "t"]), pa.array([1, 1, 1]), pa.array([b"d"] * 3)], names=["ident", "text", "hash", "digest"])
    (out,) = _reduced(pa.int64(), True)(iter([batch]))
    assert out.to_pylist() == [{"hash": 1, "digest": b"d", "text": b"t", "ident": 9, "ties": 1, "rows": 3}]
    (out,) = _reduced(pa.int64(), False)(iter([batch]))
    assert out.to_pylist()[0]["ident"] == 4


ROWS = [(1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, "long " * 40_000), (7, "long " * 40_000), (8, "long " * 40_000 + "."), (None, "a"), (None, "n"), (9, "é"), (9, "é"), (9, "x")]


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("budget", [1 << 26, 100])
def test_marks(docs, largest, budget):
    groups = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    pick = lambda ids: (max if largest else min)([i for i in ids if i is not None], default=None)
    want = sorted((str(i), str(pick(groups[t or ""])), len(groups[t or ""]), i == pick(groups[t or ""])) for i, t in ROWS)
    frame = docs(ROWS, keep_id=F.lit(0), hash=F.lit("h"), text_hash=F.lit(1), rows=F.lit(2))
    got = mark(frame, largest=largest, budget=budget).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in got) == want
    text = {str(i): digest(t) for i, t in ROWS if i != 9 and i is not None}
    assert all(bytes(r["digest"]) == text[str(r["doc_id"])] for r in got if str(r["doc_id"]) in text)


def test_small_budgets_need_more_rounds(docs, monkeypatch):
    import sensorlake.llm.exact_dedup as module

    made = []
    real = module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, name: made.append(name) or real(df, name))
    rows = [(i, f"text {i // 2} " * 20) for i in range(300)]
    held = owners(docs(rows), budget=500)
    assert held.count() == 150 and all(r["group_size"] == 2 and r["keep_id"] % 2 for r in held.collect())
    assert len(made) > 1


def test_drop_copies(docs):
    frame = docs(ROWS, row=F.lit("r"), digest=F.lit("d"), ident=F.lit("i"))
    out = drop_copies(frame)
    assert out.columns == frame.columns
    got = sorted((str(r["doc_id"]), (r["text"] or "")[:9]) for r in out.collect())
    assert got == sorted([("2", "a"), ("3", "A"), ("5", ""), ("7", "long long"), ("8", "long long"), ("None", "n"), ("9", "é"), ("9", "x")])


def test_empty_table(docs):
    assert mark(docs([])).count() == 0 and drop_copies(docs([])).count() == 0
