"""Quality rules: an isolation forest on rule statistics.

The statistics of a text (words, symbols, repeated lines and windows, and
shares made of them) are computed over whole texts.  The forest is fitted on
labelled documents, a sample bounded by ``FIT_ROWS`` and chosen by hash; each
tree splits a few of them at random places of random shares.  A document that
is isolated after few splits is unlike most others.  The score is the usual
``2 ** -(mean path / expected path)``.  Rows a tree (one of ``SUBSAMPLES``) and
threshold are the ones at which, over all labelled documents, the share of bad
ones rejected exceeds twice the share of clean ones rejected most, under the
condition that at most ``CLEAN_LOSS`` of the clean ones go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.common import SPACES, materialise, slices, utf8

#: Characters that count as symbols (fixed value).
SYMBOLS = b"#*$%&|<>"
#: Rows on which the forest is fitted, at most; trees; rows a tree; classes of the score for the threshold.
FIT_ROWS, TREES, SUBSAMPLES, CLASSES = 20_000, 128, (32, 64, 128, 256), 4096
#: Share of the clean labelled rows that the threshold may reject.
CLEAN_LOSS = 0.01
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: A further count that only the forest uses.
MORE = ("n_upper",)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside ``width``-word windows that occur twice or more, exactly: windows are
    numbered by pairing the numbers of their halves."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    rank = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    step = 1
    while step < width:
        _, rank = np.unique(rank[:-step] * len(words) + rank[step:], return_inverse=True)
        step *= 2
    twice = np.bincount(rank)[rank] > 1
    if not twice.any():
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + width, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``COUNTS`` and ``MORE`` per text; null counts as empty."""
    out = np.zeros((len(texts), len(COUNTS) + len(MORE)), np.int64)
    code_points = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    for i, text in enumerate(utf8(texts)):
        words = text.split()
        n = len(text)
        blank = n - len(text.translate(None, SPACES))
        out[i] = (
            len(words),
            code_points[i] - blank,
            n - len(text.translate(None, SYMBOLS)),
            duplicate_lines(text),
            repeated_words(words),
            n - len(text.translate(None, _UPPER)),
        )
    return out


def features(s: np.ndarray) -> np.ndarray:
    """Shares from a document's statistics: characters a word, symbols a word, capitals a character.  What the base
    rules judge, length and repetition, is left to them: their wide spread among clean documents would hide the rest."""
    words, chars = np.maximum(s[:, 0], 1), np.maximum(s[:, 1], 1)
    return np.column_stack([s[:, 1] / words, s[:, 2] / words, s[:, 5] / chars])


def base_failed(s: np.ndarray) -> np.ndarray:
    return (s[:, 0] < MIN_WORDS) | (100 * s[:, 4] > MAX_REPEATED_PERCENT * s[:, 0])


def _expected(n: np.ndarray) -> np.ndarray:
    """Mean length of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays (tree, node): split column (-1: leaf), place, left child, and the leaves' path length."""

    column: np.ndarray
    place: np.ndarray
    child: np.ndarray
    path: np.ndarray
    expected: float

    @classmethod
    def fit(cls, rows: np.ndarray, seed: int = 7, trees: int = TREES, subsample: int = 256) -> Forest:
        rng = np.random.default_rng(seed)
        take = min(subsample, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(take, 2)))))
        size = 2 ** (depth + 1)
        column, child = np.full((trees, size), -1), np.zeros((trees, size), np.int64)
        place, path = np.zeros((trees, size)), np.zeros((trees, size))
        for t in range(trees):
            used = 1
            stack = [(0, rows[rng.choice(len(rows), take, replace=False)], 0)]
            while stack:
                node, x, level = stack.pop()
                low, high = (x.min(0), x.max(0)) if len(x) else (np.zeros(rows.shape[1]),) * 2
                open_ = np.flatnonzero(high > low)
                if level == depth or not open_.size:
                    path[t, node] = level + float(_expected(len(x)))
                    continue
                c = int(rng.choice(open_))
                p = rng.uniform(low[c], high[c])
                column[t, node], place[t, node], child[t, node] = c, p, used
                stack += [(used, x[x[:, c] <= p], level + 1), (used + 1, x[x[:, c] > p], level + 1)]
                used += 2
        return cls(column, place, child, path, max(float(_expected(take)), 1e-9))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the larger, the easier to isolate."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for t in range(len(self.column)):
            at = np.zeros(len(rows), np.int64)
            while True:
                c = self.column[t, at]
                inner = c >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(c, 0)] > self.place[t, at]
                at = np.where(inner, self.child[t, at] + right, at)
            total += self.path[t, at]
        return 2.0 ** (-total / len(self.column) / self.expected)


@dataclass(frozen=True)
class Rules:
    """Fitted forest (None: there were no labelled rows, so only the base rules reject) and threshold."""

    forest: Forest | None
    threshold: float

    def scores(self, s: np.ndarray) -> np.ndarray:
        return np.zeros(len(s)) if self.forest is None else self.forest.score(features(s))

    def keeps(self, s: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return ~base_failed(s) & (scores < self.threshold)


def _added(docs: DataFrame, text: str, added: dict[str, T.DataType], make: Callable) -> DataFrame:
    """``docs`` without ``text`` and with the columns that ``make`` yields for its statistics."""
    kept = [c for c in docs.columns if c != text and c not in added]
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(k, t, False) for k, t in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, make(batch.column(text)))], names=[*kept, *added])

    return docs.select(*(docs[c] for c in [*kept, text])).mapInArrow(run, schema)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with its statistics as long columns, which replace columns of the same names."""
    return _added(docs, text, dict.fromkeys([*COUNTS, *MORE], T.LongType()), lambda texts: statistics(texts).T.copy())


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*COUNTS, *MORE)]).astype(np.int64)


def fit(stats: DataFrame, labels: DataFrame, ident: str = "doc_id", quality: str = "quality", clean_loss: float = CLEAN_LOSS) -> Rules:
    """Rules from ``stats`` (``ident`` and the statistics) and ``labels`` (``ident``, ``quality`` 1 for clean, 0 for not).

    Rows without a label, and documents that the base rules reject, take no part.  The
    threshold counts all labelled rows, in ``CLASSES`` classes of the score.
    """
    names = [*COUNTS, *MORE]
    marked = labels.select(labels[ident].alias("labelled"), labels[quality].cast("int").alias("good")).filter("good in (0, 1)")
    own = stats.select(stats[ident].alias("i"), *(stats[c] for c in names))
    rows = own.join(marked, F.col("i") == F.col("labelled")).select("i", "good", *names)
    rows = materialise(rows.filter((F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEATED_PERCENT * F.col("n_words"))), "labelled")
    # A share by hash, chosen for fewer than FIT_ROWS rows; the limit holds where rows repeat in masses.
    share = min(1.0, 0.95 * FIT_ROWS / max(1, rows.count()))
    chosen = rows.filter(F.pmod(F.xxhash64(F.lit(7), "i", *names), F.lit(1_000_000)) < int(1_000_000 * share))
    sample = sorted(chosen.select(*names).limit(FIT_ROWS).collect())
    if not sample:
        return Rules(None, 2.0)
    fitted = features(np.array([tuple(r) for r in sample], np.int64))
    forests = [Forest.fit(fitted, subsample=n) for n in SUBSAMPLES]

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, good = features(_matrix(batch)), batch.column("good").to_numpy(zero_copy_only=False)
            for which, forest in enumerate(forests):
                place = np.minimum((forest.score(x) * CLASSES).astype(np.int64), CLASSES - 1)
                found, n = np.unique((which * CLASSES + place) * 2 + good, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["class", "n"])

    counted = rows.mapInArrow(classes, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(len(forests) * CLASSES * 2)
    for r in counted:
        n[r["class"]] = r["n"]
    above = np.cumsum(n.reshape(len(forests), CLASSES, 2)[:, ::-1], axis=1)[:, ::-1]  # bad, clean with at least this score
    bad, clean = np.moveaxis(above / np.maximum(above[:, :1], 1), 2, 0)
    gain = np.where(clean <= clean_loss, bad - 2 * clean, -1.0)
    which, best = np.unravel_index(gain.argmax(), gain.shape)
    return Rules(forests[which], best / CLASSES if gain[which, best] > 0 else 2.0)


def judge(stats: DataFrame, rules: Rules) -> DataFrame:
    """``stats`` with ``base_failed``, ``score`` and ``kept``, which replace columns of the same names.  The statistics are
    never null (a null text has those of an empty one, which the base rules reject); other columns pass as they are."""
    added = T.StructType([T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    kept = [c for c in stats.columns if c not in added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _matrix(batch)
            scores = rules.scores(s)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(base_failed(s)), pa.array(scores), pa.array(rules.keeps(s, scores))], names=[*kept, *added.names])

    return stats.select(*kept).mapInArrow(run, T.StructType([*(stats.schema[c] for c in kept), *added]))


def keep_good(docs: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; the texts are read once.
    Null text has no words, so the base rules reject it; repeated rows are judged each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                s = statistics(batch.column(text))
                yield batch.filter(pa.array(rules.keeps(s, rules.scores(s))))

    return docs.mapInArrow(run, docs.schema)
