"""Periodic runs against a search of every period word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, docs, sample  # noqa: F401
from sensorlake.llm.periodic_runs import collapsed, find_runs, fragments, word_parts, z_function
from sensorlake.llm.queries import op12_periodic_runs


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def brute(words, least=6, exponent=4):
    """Every run, by start and period: the stretches of each period, of equal ones the smallest."""
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def shortened(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def stitched(stretches):
    by_period, out = {}, {}
    for q, a, b in sorted(stretches):
        own = by_period.setdefault(q, [])
        if own and a <= own[-1][1]:
            own[-1][1] = max(own[-1][1], b)
        else:
            own.append([a, b])
    for q in sorted(by_period):
        for a, b in by_period[q]:
            if b - a + q >= max(6, 4 * q):
                out.setdefault((a, b - a + q), q)
    return sorted((s, length, q) for (s, length), q in out.items())


def random_words(rng):
    n, letters, kind = rng.randint(0, 250), rng.randint(1, 4), rng.random()
    if kind < 0.3:
        return [rng.randrange(letters) for _ in range(n)]
    if kind < 0.8:
        out = []
        while len(out) < n:
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 40))]
            out += unit * rng.randint(1, 7) + unit[: rng.randint(0, len(unit))]
        return out
    out = [0] * n
    for _ in range(rng.randint(0, 3) if n else 0):
        out[rng.randrange(n)] = 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_fragments_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(80):
        many = [random_words(rng) for _ in range(rng.randint(1, 5))]
        x = np.array([w for ws in many for w in ws], np.int64)
        doc, *stretch = fragments(x, np.cumsum([0, *map(len, many)]), block=rng.choice([1, 4, 64, 1 << 15]))
        rows = list(zip(doc.tolist(), *(a.tolist() for a in stretch)))
        for i, words in enumerate(many):
            assert stitched([r[1:] for r in rows if r[0] == i]) == brute(words)


def test_multiples_of_a_period_do_not_pile_up():
    one, _, first, last = fragments(np.zeros(4000, np.int64), np.array([0, 4000]))
    assert len(one) < 40 and first.min() == 0 and last.max() == 3999
    square = np.array(([0] * 700 + [1]) * 6)
    assert len(fragments(square, np.array([0, len(square)]))[0]) < 6 * 40


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randint(0, 30))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert z_function(s) == want


def test_parts_and_collapse_of_long_texts():
    text = b" ".join(b"w%d" % (i % 37) for i in range(5000)) + b"\x0b" + b"x" * 900 + b"\n\t y"
    for most in (50, 700, 1 << 20):
        assert [w for part in word_parts(text, most) for w in part] == text.split()
    words = [str(i).encode() for i in range(40)]
    runs = [{"start": 2, "length": 12, "period": 3}, {"start": 10, "length": 12, "period": 2}, {"start": 34, "length": 6, "period": 1}]
    assert collapsed(b" ".join(words), runs) == shortened([w.decode() for w in words], [(2, 12, 3), (10, 12, 2), (34, 6, 1)]).encode()


CASES = [
    (1, "a a a a a a"), (2, "a a a a a"), (3, "x\x0ba b\ta b a b\r\na b y"), (4, None), (5, ""), (6, " \n "), (7, "A a A a A a A a"), (None, "z " * 9),
    (7, "one " * 300 + "two"), (8, " ".join(f"w{i % 100}" for i in range(437)) + " end"), (9, "é è " * 20 + "\x1c  "), (3, "x\x0ba b\ta b a b\r\na b y"),
]


def test_rows_against_brute_force(spark, docs):  # noqa: F811
    frame = docs(CASES, **{c: F.lit("x") for c in ("ident", "key", "words", "runs", "n_words", "collapsed")})
    for block in (8, 1 << 15):
        got = find_runs(frame, block=block).collect()
        shown = [(r["doc_id"], r["n_words"], tuple((x["start"], x["length"], x["period"]) for x in r["runs"]), r["collapsed"]) for r in got]
        want = []
        for ident, text in CASES:
            words = words_of(text)
            want.append((ident, len(words), tuple(brute(words)), shortened(words, brute(words))))
        assert sorted(shown, key=repr) == sorted(want, key=repr)
    assert find_runs(frame.filter(F.lit(False))).collect() == []
    with pytest.raises(ValueError):
        find_runs(frame, exponent=2)


def test_query_on_the_given_table(spark, sample):  # noqa: F811
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(sample)
    with_runs = 0
    for ident, text, _ in sample:
        words = words_of(text)
        h, n = zlib.crc32(str(ident).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs, r = brute(words), got[ident]
        best = max(((length, -s, -q) for s, length, q in runs), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["length"], r["start"], r["period"]) == ((best[0], -best[1], -best[2]) if best else (None, None, None))
        assert r["exponent_milli"] == (1000 * best[0] // -best[2] if best else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert r["collapsed_sha256"] == sha(shortened(words, runs))
        with_runs += bool(runs)
    assert with_runs > 5
