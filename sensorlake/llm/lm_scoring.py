"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Words are counted over all training documents.  Every word that occurs
``least_count`` times (and the ``CLASSES`` most frequent ones whatever their
counts, and the end of a text) is a class of the model, as target and as
context; every other word is the class of rare words.  That count is ``LEAST``
for small corpora and grows with the 2/3 power of the tokens, so the model's
words follow the corpus and are never more than ``SPREAD`` times the cube root
of its tokens, whatever its words: that bounds what the driver and a worker
hold (140 bytes a word).  The model predicts a word's class from the two classes before it: the
score of class w is b[w] + R[w] . (C0 * Q[w1] + C1 * Q[w2]).  Classes lie in
about as many groups as the root of their number, and groups have vectors of
their own: P(class) = P(group) * P(class in its group), each normalised over
its level, so the probabilities of all classes sum to one and a token costs
two small products.

Training goes in ``ROUNDS`` rounds, each over its own share of the documents:
every task starts from the round's parameters, trains over its documents in
minibatches that share their noise words, and the tasks' parameters, averaged
by their numbers of tokens, are the next round's start.  Inside the class of
rare words a word has its add-one share, so the probabilities of all words,
and one for the unknown, sum to one.

The counts of rare words are not sent to the workers: documents send each of
their rare words to the partition that holds its count, and the logarithms
come back as sums.  The model's words, others up to ``TOP`` of the most
frequent ones, and the parameters are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.common import materialise, slices, utf8
from sensorlake.llm.words import word_hashes

#: Words of the model, with the end of a text, at least; classes 0 and 1 are the rare words and the end.
CLASSES = 1024
#: Every word that occurs so often is a word of the model, in corpora of up to some 33 million tokens.
LEAST = 128
#: Beyond, of n tokens, one that occurs n^(2/3) / SPREAD times; so there are at most SPREAD * n^(1/3) of them.
SPREAD = 800
#: Words whose counts every worker holds, besides the model's.
TOP = 1 << 18
#: Rounds of training; each document belongs to one of them.
ROUNDS = 4
WIDTH, NOISE, MINIBATCH, RATE, SQUARES = 16, 64, 1024, 0.3, 1e-4
RARE, END_CLASS = 0, 1
#: The end of a text among the word hashes (a number of our own).
END = np.uint64(0x5EED0F7E47E4D000)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each followed by ``END``, and each text's first place, plus the end."""
    words, ends = word_hashes(texts)
    out = np.insert(words, ends[1:], END)
    return out, ends + np.arange(len(ends))


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent words: hashes in order, their counts and classes; and the corpus totals."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    class_counts: np.ndarray
    n: int
    v: int

    def places(self, words: np.ndarray) -> np.ndarray:
        """Place of each word among ``words``, -1 where it is not among them."""
        if not len(self.words):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def classes_of(self, places: np.ndarray) -> np.ndarray:
        return np.where(places >= 0, self.classes[places], RARE) if len(self.words) else np.full(len(places), RARE)


def count_words(training: DataFrame) -> DataFrame:
    """``word`` (hash) and ``c`` over the column ``text`` of ``training``, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.unique(tokens(utf8(x.column("text")))[0], return_counts=True) for x in slices(batch, "text")]
            if parts:
                words, where = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
                counts = np.bincount(where, np.concatenate([c for _, c in parts]), len(words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "c"])

    return training.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def least_count(n: int) -> int:
    return max(LEAST, -int(-(n ** (2 / 3)) // SPREAD))


def vocabulary(counts: DataFrame, classes: int = CLASSES, top: int = TOP, least: int | None = None) -> Vocabulary:
    """The most frequent words, and the totals of all of them.

    Counts fall into classes of a sixteenth of a doubling; the words above the
    lowest boundary that leaves no more than ``top`` are taken, and the end.
    Those that occur ``least`` times (``least_count`` of the corpus) are taken in
    any case and are classes of the model, as the first of the others up to ``classes``."""
    size = F.floor(F.log2("c") * 16)
    spread = counts.groupBy(size.alias("size")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    n = sum(r["n"] for r in spread)
    least = least_count(n) if least is None else least
    above, lowest = 0, None
    for r in sorted(spread, key=lambda r: -r["size"]):
        above += r["v"]
        if above > top - 1:
            break
        lowest = r["size"]
    taken = (F.col("word") == int(END.view(np.int64))) | (F.col("c") >= least)
    rows = counts.filter(taken if lowest is None else taken | (size >= lowest)).select("word", "c").toArrow()
    words, c = (rows.column(x).to_numpy().astype(np.int64) for x in ("word", "c"))
    order = np.lexsort((words, -c))
    words, c = words[order].view(np.uint64), c[order]
    own, others = np.full(len(words), RARE), np.flatnonzero(words != END)
    others = others[: max(classes - 2, int((c[others] >= least).sum()))]
    own[others], own[words == END] = np.arange(2, 2 + len(others)), END_CLASS
    class_counts = np.bincount(own, c, max(classes, 2 + len(others))).astype(np.int64)
    class_counts[RARE] = n - class_counts[1:].sum()
    order = np.argsort(words)
    return Vocabulary(words[order], c[order], own[order], class_counts, int(n), int(sum(r["v"] for r in spread)))


def groups_of(class_counts: np.ndarray) -> np.ndarray:
    """Group of each class: about the root of their number, cut from the classes by falling counts
    so that the roots of the counts share out evenly (frequent words lie in small groups)."""
    order = np.argsort(-class_counts, kind="stable")
    roots = np.sqrt(class_counts[order] + 1.0)
    place = ((np.cumsum(roots) - roots / 2) * (np.ceil(np.sqrt(len(roots))) / roots.sum())).astype(np.int64)
    out = np.empty(len(roots), np.int64)
    out[order] = np.unique(place, return_inverse=True)[1]
    return out


@dataclass
class Model:
    """Parameters: target and context vectors, the two places' weights, biases, and the groups' vectors and
    biases; and the group of each class."""

    target: np.ndarray
    context: np.ndarray
    place: np.ndarray
    bias: np.ndarray
    group_target: np.ndarray
    group_bias: np.ndarray
    group: np.ndarray

    @classmethod
    def start(cls, vocab: Vocabulary, seed: int = 5, width: int = WIDTH) -> Model:
        rng = np.random.default_rng(seed)
        k, group = len(vocab.class_counts), groups_of(vocab.class_counts)
        share = (vocab.class_counts + 1) / (vocab.class_counts + 1).sum()
        small = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        bias, group_bias = (np.log(x).astype(np.float32) for x in (share, np.bincount(group, share)))
        return cls(small(k, width), small(k, width), np.ones((2, width), np.float32), bias, small(len(group_bias), width), group_bias, group)

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)[:-1]]

    def predicted(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        return self.place[0] * self.context[near] + self.place[1] * self.context[far]


def contexts(classes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; before a text's begin stands its end."""
    near, far = np.roll(classes, 1), np.roll(classes, 2)
    first = begin[:-1]
    near[first] = far[first] = END_CLASS
    second = first[first + 1 < begin[1:]] + 1
    far[second] = END_CLASS
    return near, far


def _flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays])


def _unflat(like: list[np.ndarray], values: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum([a.size for a in like])
    return [x.reshape(a.shape).astype(np.float32) for x, a in zip(np.split(values, ends[:-1]), like)]


def start_sums(model: Model) -> list[np.ndarray]:
    """Adagrad's sums of squares before the first step, one a row."""
    return [np.full(len(a), SQUARES, np.float32) for a in model.arrays()]


class Trainer:
    """Noise-contrastive estimation of classes and of groups by Adagrad, with one sum of squares a row,
    on minibatches that share their noise."""

    def __init__(self, model: Model, vocab: Vocabulary, seed: int, sums: list[np.ndarray] | None = None):
        self.m = Model(*(a.copy() for a in model.arrays()), model.group)
        self.arrays = self.m.arrays()
        self.sums = [a.copy() for a in sums or start_sums(model)]
        share = (vocab.class_counts + 1) / (vocab.class_counts + 1).sum()
        self.noise = [(np.cumsum(x), np.log(NOISE * x).astype(np.float32)) for x in (share, np.bincount(model.group, share))]
        self.rng = np.random.default_rng(seed)
        self.n = 0

    def _step(self, which: int, rows: np.ndarray | slice, grad: np.ndarray) -> None:
        array, sums = self.arrays[which], self.sums[which]
        if grad.ndim == 1:
            sums[rows] += grad * grad
            array[rows] += RATE * grad / np.sqrt(sums[rows])
        else:
            sums[rows] += np.einsum("ij,ij->i", grad, grad) / grad.shape[1]
            array[rows] += (RATE / np.sqrt(sums[rows]))[:, None] * grad

    @staticmethod
    def _summed(rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows once each, and the sums of their gradients."""
        # Numbers of 16 bits are sorted by counting.
        order = np.argsort(rows.astype(np.uint16) if len(rows) and rows.max() < 1 << 16 else rows, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        return rows[first], np.add.reduceat(grads[order], first, axis=0)

    def _contrast(self, level: int, target: np.ndarray, q: np.ndarray) -> np.ndarray:
        """One step of the targets of a level (0 classes, 1 groups) against noise; the gradient of ``q``."""
        vectors, biases = (0, 3) if level == 0 else (4, 5)
        table, bias = self.arrays[vectors], self.arrays[biases]
        cdf, log_noise = self.noise[level]
        noise, weight = np.unique(np.searchsorted(cdf[:-1], self.rng.random(NOISE) * cdf[-1], "right"), return_counts=True)
        r, against = table[target], table[noise]
        own = 1 / (1 + np.exp(np.einsum("ij,ij->i", q, r) + bias[target] - log_noise[target]))
        scale = np.float32(1 / len(target))
        own *= scale
        others = q @ -against.T
        others += log_noise[noise] - bias[noise]
        np.exp(others, out=others)
        others += 1
        np.divide(weight.astype(np.float32) * scale, others, out=others)
        to_q = own[:, None] * r - others @ against
        # The gradients of a row's vector and, in the last column, of its bias.
        n, width = q.shape
        grads = np.empty((n + len(noise), width + 1), np.float32)
        np.multiply(own[:, None], q, out=grads[:n, :width])
        grads[:n, width] = own
        np.negative(others.T @ q, out=grads[n:, :width])
        np.negative(others.sum(0), out=grads[n:, width])
        rows, grads = self._summed(np.concatenate([target, noise]), grads)
        self._step(vectors, rows, grads[:, :width])
        self._step(biases, rows, grads[:, width])
        return to_q

    def learn(self, target: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        m = self.m
        q_near, q_far = m.context[near], m.context[far]
        q = m.place[0] * q_near + m.place[1] * q_far
        to_q = self._contrast(0, target, q) + self._contrast(1, m.group[target], q)
        self._step(1, *self._summed(np.concatenate([near, far]), np.concatenate([to_q * m.place[0], to_q * m.place[1]])))
        self._step(2, slice(None), np.stack([(to_q * q_near).sum(0), (to_q * q_far).sum(0)]))
        self.n += len(target)


#: Parameters that are averaged together.
SLICE = 1 << 16


def train(training: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Model:
    """``rounds`` rounds over the documents (column ``text``), each document in one of them by its hash;
    a round's start is the average of the tasks' parameters of the round before, by tokens.

    A task trains over as many tokens a round as there are parameters, or more,
    so what the tasks send follows the corpus and not tasks times words; but
    there are as many tasks as the cluster has cores at least."""
    model = Model.start(vocab)
    sums = start_sums(model)
    tasks = max(training.sparkSession.sparkContext.defaultParallelism, vocab.n // (rounds * sum(a.size for a in model.arrays() + sums)))
    text = training.select("text")
    for k in range(rounds):
        share = text.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).coalesce(tasks)
        model, sums = _round(share, vocab, model, sums, 3 + k)
    return model


def _round(share: DataFrame, vocab: Vocabulary, start: Model, sums: list[np.ndarray], seed: int) -> tuple[Model, list[np.ndarray]]:
    """The average of the parameters, and of the sums of squares, of every task that trains over its part of ``share``.
    A slice's parameters are added in the order of the tasks, so reruns agree to the last bit."""
    sent: Broadcast = share.sparkSession.sparkContext.broadcast((vocab, start, sums))
    n_slices = -(-sum(a.size for a in start.arrays() + sums) // SLICE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = None
        for whole in batches:
            for batch in slices(whole, "text"):
                own, model, squares = sent.value
                trainer = trainer or Trainer(model, own, seed, squares)
                words, begin = tokens(utf8(batch.column("text")))
                target = own.classes_of(own.places(words))
                near, far = contexts(target, begin)
                for a in range(0, len(target), MINIBATCH):
                    part = slice(a, a + MINIBATCH)
                    trainer.learn(target[part], near[part], far[part])
        if trainer:
            task = TaskContext.get().partitionId()
            for i, p in enumerate(np.array_split(_flat(trainer.m.arrays() + trainer.sums), n_slices)):
                columns = [pa.array([i], pa.int32()), pa.array([task], pa.int32()), pa.array([p.tobytes()], pa.binary()), pa.array([trainer.n], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "task", "values", "n"])

    def mean(part: int, total: np.ndarray, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())], names=["part", "mean"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, n = None, None, 0
        for batch in batches:
            for part, values, k in zip(batch.column("part").to_pylist(), batch.column("values"), batch.column("n").to_pylist()):
                own = np.frombuffer(values.as_py(), np.float32).astype(np.float64) * k
                if part != at:
                    if at is not None:
                        yield mean(at, total, n)
                    at, total, n = part, own, k
                else:
                    total, n = total + own, n + k
        if at is not None:
            yield mean(at, total, n)

    trained = share.mapInArrow(run, "part int, task int, values binary, n long")
    rows = trained.repartition("part").sortWithinPartitions("part", "task").mapInArrow(add, "part int, mean binary").collect()
    sent.unpersist()
    if not rows:
        return start, sums
    means = np.concatenate([np.frombuffer(r["mean"], np.float32) for r in sorted(rows, key=lambda r: r["part"])])
    means = _unflat(start.arrays() + sums, means)
    return Model(*means[: len(sums)], start.group), means[len(sums) :]


class Scorer:
    """Normalised natural log-probabilities of classes: that of the group, and that of the class inside it."""

    def __init__(self, model: Model):
        self.m = model
        order = np.argsort(model.group, kind="stable")
        self.members = np.split(order, np.flatnonzero(np.diff(model.group[order])) + 1)

    @staticmethod
    def _log_sum(q: np.ndarray, vectors: np.ndarray, bias: np.ndarray) -> np.ndarray:
        out = np.empty(len(q), np.float32)
        step = max(1, (1 << 19) // len(bias))
        for a in range(0, len(q), step):
            s = q[a : a + step] @ vectors.T
            s += bias
            top = s.max(1)
            s -= top[:, None]
            out[a : a + step] = top + np.log(np.exp(s, out=s).sum(1))
        return out

    def log_probabilities(self, target: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        out, k = np.empty(len(target)), len(self.m.bias)
        for a in range(0, len(target), 1 << 17):
            t, pair = target[a : a + (1 << 17)], near[a : a + (1 << 17)] * k + far[a : a + (1 << 17)]
            pair, which = np.unique(pair, return_inverse=True)
            q = self.m.predicted(pair // k, pair % k)
            groups = self._log_sum(q, self.m.group_target, self.m.group_bias)
            q, g = q[which], self.m.group[t]
            log_p = np.einsum("ij,ij->i", q, self.m.group_target[g]) + self.m.group_bias[g] - groups[which]
            log_p += np.einsum("ij,ij->i", q, self.m.target[t]) + self.m.bias[t]
            order = np.argsort(g, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(g[order])) + 1) if len(t) else []:
                own = self.members[g[rows[0]]]
                log_p[rows] -= self._log_sum(q[rows], self.m.target[own], self.m.bias[own])
            out[a : a + len(t)] = log_p
        return out


#: One scorer a worker process, for the model it was last given.
_SCORER: list = [None, None]


def _scorer(sent: Broadcast) -> Scorer:
    if _SCORER[0] is not sent.value:
        _SCORER[:] = [sent.value, Scorer(sent.value[1])]
    return _SCORER[1]


def _scored(sent: Broadcast, id_type: pa.DataType) -> Callable:
    """Per document a row with what its frequent words and the model give, and a row for each of its rare words."""
    types = [pa.int64(), pa.int64(), pa.int64(), id_type, pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = ["key", "word", "times", "ident", "n_tokens", "n_top", "base", "model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, _ = sent.value
        scorer = _scorer(sent)
        base_all = np.log10(vocab.n + vocab.v + 1)
        in_classes = int((vocab.classes != RARE).sum())
        rare_all = np.log10(vocab.class_counts[RARE] + (vocab.v - in_classes) + 1)
        top_log = np.log10(vocab.counts + 1.0)
        for whole in batches:
            for batch in slices(whole, "text"):
                key = batch.column("key").to_numpy()
                words, begin = tokens(utf8(batch.column("text")))
                at = vocab.places(words)
                target = vocab.classes_of(at)
                log_p = scorer.log_probabilities(target, *contexts(target, begin)) / np.log(10)
                top = at >= 0
                log_c = np.where(top, top_log[at], 0.0) if len(top_log) else np.zeros(len(words))
                rare = target == RARE
                add = lambda x: np.add.reduceat(x, begin[:-1])  # noqa: E731  every text has a token, its end
                n, n_top = np.diff(begin), add(top.astype(np.int64))
                base = add(log_c) - n * base_all
                model = add(log_p + np.where(rare, log_c - rare_all, 0.0))
                # Rows of documents go by a place of their own; they ask for no word.
                columns = [key, key * np.int64(-7046029254386353131), np.zeros(len(key), np.int64), batch.column("ident"), n, n_top, base, model]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names)
                where = np.repeat(np.arange(len(key)), n)[~top]
                asked = words[~top]
                order = np.lexsort((asked, where))
                where, asked = where[order], asked[order]
                first = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (asked[1:] != asked[:-1])])) if len(where) else np.empty(0, int)
                times = np.diff(np.append(first, len(where)))
                columns = [pa.array(key[where[first]]), pa.array(asked[first].view(np.int64)), pa.array(times, pa.int64()), *(pa.nulls(len(first), t) for t in types[3:])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def score(docs: DataFrame, training: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``ident``, ``n_tokens``, ``n_known`` (tokens that ``training`` has),
    ``train_tokens``, ``base_score`` (add-one unigram) and ``score`` (the model), both sums of log10 probabilities.

    Words are cut at ASCII white space, A-Z lower-cased; the end of a text is a
    token.  Null counts as empty, which is one token.  Repeated rows are scored
    each.  Without training documents every word is unknown and of equal score.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    learned = training.select(training[text].alias("text"))
    counts = materialise(count_words(learned), "word-counts")
    vocab = vocabulary(counts)
    model = train(learned, vocab)
    sent = spark.sparkContext.broadcast((vocab, model))
    id_type = docs.schema[ident].dataType
    schema = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("key", "word", "times")]
        + [T.StructField("ident", id_type)]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_top")]
        + [T.StructField(c, T.DoubleType()) for c in ("base", "model")]
    )
    rows = docs.select(F.monotonically_increasing_id().alias("key"), docs[ident].alias("ident"), docs[text].alias("text"))
    asked = rows.mapInArrow(_scored(sent, to_arrow_type(id_type)), schema)
    answered = asked.join(counts.select(F.col("word").alias("w"), "c"), F.col("word") == F.col("w"), "left")
    known = F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)
    summed = answered.groupBy("key").agg(
        F.max("ident").alias(ident),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_top") + F.sum(known)).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.max("base") + F.sum(F.coalesce(F.col("times") * F.log10(F.col("c") + 1), F.lit(0.0)))).alias("base_score"),
        (F.max("model") + F.sum(F.coalesce(F.col("times") * F.log10(F.col("c") + 1), F.lit(0.0)))).alias("score"),
    )
    return summed.drop("key")
