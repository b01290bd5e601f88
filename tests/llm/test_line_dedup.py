"""Line de-duplication: the filters, the index after insertions and deletions, and cleaned texts."""

import random

from pyspark.sql import functions as F

from llm_helpers import docs  # noqa: F401
from sensorlake.llm.line_dedup import Cuckoo, LineIndex, line_key

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, min_docs=3, min_chars=20, index=None):
    holders = {}
    for i, t in index if index is not None else rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    many = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in many or many[key(x)] == i]
        out.append((str(i), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def cleaned(index, frame):
    return sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in index.clean(frame).collect())


def random_rows(rng, ids):
    pool = [f"Common line number {i} of this corpus" for i in range(12)] + ["short", "", "  ", "exactly twenty chars", "exactly 19 charsss!", "é" * 20, "é" * 19]
    change = [lambda x: x, str.upper, lambda x: "\t " + x + " \r"]
    line = lambda: rng.choice(change)(rng.choice(pool)) if rng.random() < 0.6 else f"own line {rng.random()} goes here"
    return [(i, "\n".join(line() for _ in range(rng.randint(0, 8)))) for i in ids]


def test_cuckoo_filter_never_forgets_and_can_delete():
    rng = random.Random(1)
    keys = list({rng.randbytes(16) for _ in range(20_000)})
    f = Cuckoo.of(keys)
    assert all(map(f.holds, keys)) and f.count == len(keys)
    assert sum(f.holds(rng.randbytes(16)) for _ in range(20_000)) < 60
    for k in keys[:10_000]:
        f.delete(k)
    assert all(map(f.holds, keys[10_000:]))
    assert sum(map(f.holds, keys[:10_000])) < 60 and f.count == len(keys) - 10_000
    again = Cuckoo.of(keys[10_000:])
    assert again.count == f.count


def test_line_key():
    assert line_key(b"x" * 19, 20) is None and line_key(b"x" * 20, 20)
    assert line_key("é".encode() * 19, 20) is None and line_key("é".encode() * 20, 20)
    assert line_key(b"  Some Line Of Twenty Chars\r", 20) == line_key(b"some line of twenty chars", 20)


def test_clean_equals_brute_force(docs):
    rng = random.Random(3)
    rows = random_rows(rng, range(80))
    assert cleaned(LineIndex.build(docs(rows)), docs(rows)) == brute(rows)


def test_insertions_and_deletions_are_reversible(spark, docs):
    rng = random.Random(4)
    first, second = random_rows(rng, range(0, 40)), random_rows(rng, range(40, 90))
    index = LineIndex.build(docs(first))
    both = index.insert(docs(second))
    assert cleaned(both, docs(first + second)) == brute(first + second)
    twice = both.insert(docs(second))
    assert sorted(map(tuple, twice.counts.collect())) == sorted(map(tuple, both.counts.collect()))
    gone = spark.range(40, 90).toDF("id")
    back = both.delete(gone)
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, index.counts.collect()))
    assert sum(r["count"] for r in back.filters.collect()) == sum(r["count"] for r in index.filters.collect())
    assert cleaned(back, docs(first)) == brute(first)
    some = both.delete(spark.createDataFrame([(3,), (77,), (89,)], "id long"))
    left = [r for r in first + second if r[0] not in (3, 77, 89)]
    assert cleaned(some, docs(left)) == brute(left)


def test_full_filters_are_built_anew(docs):
    rows = [(i, "only a few lines at first here") for i in range(3)]
    more = [(10 + i, "\n".join(f"another repeated line {j} of many" for j in range(600))) for i in range(3)]
    index = LineIndex.build(docs(rows)).insert(docs(more))
    assert cleaned(index, docs(rows + more)) == brute(rows + more)


def test_nulls_repeats_long_texts_and_clashing_columns(docs):
    line = "a line that many documents have"
    rows = [(1, None), (2, ""), (None, line), (3, line), (3, line), (4, line + "\n" + line), (5, "\n".join([line] * 3 + ["w" * 300_000])), (6, "\n\n")]
    frame = docs(rows, n_lines=F.lit("mine"), row=F.lit("r"), keys=F.lit("k"), doc=F.lit("d"))
    out = LineIndex.build(frame).clean(frame)
    assert {"row", "keys", "doc"} <= set(out.columns)
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()) == brute(rows)


def test_empty_table(docs):
    assert LineIndex.build(docs([])).clean(docs([])).count() == 0
    assert cleaned(LineIndex.build(docs([])), docs([(1, "x")])) == [("1", 1, 0, "x")]
