"""Runs of repeated word sequences, by tiles of every scale.

A run is a stretch of words with smallest period q (words q apart are the
same) of at least ``EXPONENT`` periods and ``LEAST`` words that no neighbouring
word extends.  Periods fall into octaves, from P to 2 P - 1 for every power of
two P.  For an octave a document is laid out in tiles: one about each boundary,
a multiple of P, from P words before it to 4 P words behind, so neighbouring
tiles overlap.  A tile asks how far the words on both sides of its boundary
agree with those q further on: the values at q of the Z-function of the words
from the boundary, and of the words before it read backwards.  Where both end
inside the tile the stretch is known, else it is a fragment.

A tile is only looked at for periods whose P words behind the boundary come
again (equal block hashes, made for each octave from the one below); every
longer agreement is compared word by word, so hashes decide nothing.  With few
such periods the Z-values are read off by comparing; with many by the linear
algorithm, which also tells the periods that are multiples of a smaller one.

Fragments of tiles that lie together are merged in the task; all of them are
then shuffled by document and period and stitched where they touch.  Of equal
stretches the smallest period stays (the others are its multiples).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.common import slices, utf8
from sensorlake.llm.words import mixed
from sensorlake.session import scratch_path

LEAST, EXPONENT = 6, 4
#: Candidates of a boundary up to which their Z-values are read off by comparing.
FEW = 16
#: Words of a document whose tiles are merged before the shuffle.
BLOCK = 1 << 15
#: Elements of a comparison at once.
AT_ONCE = 1 << 20
#: Bytes of a text that are split into words at once.
PART = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"

#: Numbers of the word at which it starts, of words, and of words in its period.
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_FRAGMENT = T.StructType([T.StructField(c, T.LongType(), False) for c in ("period", "first", "last")])
_ARROW_FRAGMENT = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in ("period", "first", "last")]))


def word_parts(text: bytes, most: int = PART) -> Iterator[list[bytes]]:
    """The words of a text, part by part; a part ends at white space."""
    at = 0
    while len(text) - at > most:
        end = max(text.rfind(bytes([s]), at + 1, at + most) for s in SPACES)
        if end < 0:  # one word as long as that: up to its end
            ends = [e for e in (text.find(bytes([s]), at + most) for s in SPACES) if e >= 0]
            end = min(ends, default=len(text))
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def z_function(s: list[int]) -> list[int]:
    """For every place of ``s`` the length of the longest common prefix of ``s`` and of what begins there."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _agreeing(x: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many of the words at ``a``, ``a + step`` ... are those at ``b``, ``b + step`` ..., up to ``room``."""
    out = np.empty(len(a), np.int64)
    width = int(room.max(initial=0))
    if width == 0:
        out[:] = 0
        return out
    along = np.arange(width)
    rows = max(1, AT_ONCE // width)
    for i in range(0, len(a), rows):
        inside = along < room[i : i + rows, None]
        places = np.where(inside, along * step, 0)
        same = (x[a[i : i + rows, None] + places] == x[b[i : i + rows, None] + places]) & inside
        out[i : i + rows] = np.where(same.all(1), width, same.argmin(1))
    return np.minimum(out, room)


def _tile(x: np.ndarray, c: int, begin: int, end: int, p: int, periods: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tile at boundary ``c`` by Z-functions: of ``periods`` those that are no multiples of a period of their
    words, with the numbers of agreeing words behind and before the boundary."""
    ahead = z_function(x[c : min(end, c + 4 * p)].tolist())
    own = [q for q in periods.tolist() if not any(q % d == 0 and ahead[d] >= q - d for d in range(1, q // 2 + 1) if ahead[d])]
    low = max(begin, c - p)
    before, high = x[low:c][::-1].tolist(), min(end, c + 2 * p - 1)
    behind = z_function([*before, -1, *x[low:high][::-1].tolist()])
    f = np.array([min(ahead[q], 2 * p) for q in own], np.int64)
    b = np.array([min(behind[len(before) + 1 + high - c - q], len(before)) for q in own], np.int64)
    return np.array(own, np.int64), f, b


def _merged(doc: np.ndarray, period: np.ndarray, first: np.ndarray, last: np.ndarray, left: np.ndarray, right: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of a document, period and block that touch, as one; ``left`` and ``right`` tell whether an end may go on."""
    order = np.lexsort((last, first, block, period, doc))
    doc, period, first, last, left, right, block = (a[order] for a in (doc, period, first, last, left, right, block))
    new = np.ones(len(doc), bool)
    same = (doc[1:] == doc[:-1]) & (period[1:] == period[:-1]) & (block[1:] == block[:-1])
    # Within one document and period the stretches' ends rise with their beginnings: each is as long as words agree.
    new[1:] = ~(same & (first[1:] <= last[:-1]))
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(doc))[: len(heads)] - 1
    return doc[heads], period[heads], first[heads], last[tails], left[heads], right[tails]


def fragments(x: np.ndarray, begin: np.ndarray, least: int = LEAST, exponent: int = EXPONENT, block: int = BLOCK) -> tuple[np.ndarray, ...]:
    """Over documents whose words, as numbers, lie one behind the other in ``x`` (``begin``: first places, and the end):
    document, period, and first and last + 1 of the words that agree with those a period further on, of all
    stretches that are, or may belong to, a run."""
    found: list[tuple[np.ndarray, ...]] = []
    docs = np.arange(len(begin) - 1)
    lengths = np.diff(begin)
    starts = begin[:-1]
    hashes = mixed(x.astype(np.uint64))
    p = 1
    while True:
        long = lengths >= max(least, exponent * p)
        if not long.any():
            break
        if lengths[long].sum() < 0.75 * len(x):  # the shorter documents are done
            take = np.repeat(long, lengths)
            x, hashes = x[take], hashes[take]
            docs, lengths = docs[long], lengths[long]
            starts = np.cumsum(lengths) - lengths
            long = np.ones(len(docs), bool)
        ends = starts + lengths
        which = np.repeat(np.arange(len(docs)), lengths)
        place = np.arange(len(x))
        own = place - starts[which]
        boundary = starts[which] + (own // p) * p - p
        may = (own >= p) & (place + p <= ends[which])
        may[may] = hashes[place[may]] == hashes[boundary[may]]
        at = place[may]
        if len(at):
            c = boundary[at]
            q, d = at - c, which[at]
            n_candidates = np.bincount(c, minlength=0)[c]
            parts = []
            few = n_candidates <= FEW
            if few.any():
                c1, q1, d1 = c[few], q[few], d[few]
                f = _agreeing(x, c1, c1 + q1, np.minimum(2 * p, ends[d1] - c1 - q1), 1)
                b = _agreeing(x, c1 - 1, c1 + q1 - 1, np.minimum(p, c1 - starts[d1]), -1)
                parts.append((d1, c1, q1, f, b))
            for tile in np.unique(c[~few]).tolist():
                mine = c == tile
                doc = int(d[mine][0])
                own_q, f, b = _tile(x, tile, int(starts[doc]), int(ends[doc]), p, q[mine])
                parts.append((np.full(len(own_q), doc), np.full(len(own_q), tile), own_q, f, b))
            d, c, q, f, b = (np.concatenate([part[i] for part in parts]) for i in range(5))
            real = f >= p  # equal hashes of other words
            d, c, q, f, b = (a[real] for a in (d, c, q, f, b))
            own = c - starts[d]
            left = (b == p) & (own > p)
            right = (f == 2 * p) & (c + q + f < ends[d])
            d, q, first, last, left, right = _merged(d, q, own - b, own + f, left, right, own // block)
            counts = left | right | (last - first >= np.maximum((exponent - 1) * q, least - q))
            found.append((docs[d[counts]], q[counts], first[counts], last[counts]))
        if len(hashes) > p:
            hashes = np.concatenate([mixed(hashes[:-p] * np.uint64(0x9E3779B97F4A7C15) + hashes[p:]), hashes[-p:]])
        p *= 2
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate([part[i] for part in found]) for i in range(4))


def collapsed(words: bytes, runs: list[dict]) -> bytes:
    """``words`` (joined by one space) without those that a run holds behind its first period."""
    edges: dict[int, int] = defaultdict(int)
    for r in runs:
        edges[r["start"] + r["period"]] += 1
        edges[r["start"] + r["length"]] -= 1
    cuts, depth, spans = sorted(edges), 0, []
    for a, b in zip(cuts, cuts[1:]):
        depth += edges[a]
        if depth:
            spans.append((a, b))
    kept, n, k = [], 0, 0
    for part in word_parts(words):
        at, stop = 0, n + len(part)
        while k < len(spans) and spans[k][0] < stop:
            kept.extend(part[at : max(at, spans[k][0] - n)])
            at = min(spans[k][1], stop) - n
            if spans[k][1] > stop:
                break
            k += 1
        kept.extend(part[at:])
        kept, n = [b" ".join(kept)] if kept else [], stop
    return b" ".join(kept)


def _numbered(texts: list[bytes], idents: list, reorder: Callable | None) -> tuple[list[bytes], list[np.ndarray]]:
    """Per text its words joined by one space, and their numbers (equal words have equal ones)."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    joined, numbers = [], []
    for ident, text in zip(idents, texts):
        said, own = [], []
        for part in word_parts(text):
            if part:
                said.append(b" ".join(part))
                own.append(np.fromiter(map(number.__getitem__, part), np.int64, len(part)))
        words, ids = b" ".join(said), np.concatenate(own) if own else np.empty(0, np.int64)
        order = reorder(ident, len(ids)) if reorder and len(ids) else None
        if order is not None:
            each = words.split(b" ")
            words, ids = b" ".join([each[i] for i in order.tolist()]), ids[order]
        joined.append(words)
        numbers.append(ids)
    return joined, numbers


def find_runs(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    reorder: Callable[[object, int], np.ndarray | None] | None = None,
    least: int = LEAST,
    exponent: int = EXPONENT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``ident``, ``n_words``, ``runs`` (start, length, period, by start and period) and
    ``collapsed``, its words joined by one space without those that a run repeats.

    Words are cut at ASCII white space and compared byte by byte.  Null counts
    as empty, which has no words and no runs.  Rows that repeat an identifier
    are each taken by themselves; other columns are not read.  ``reorder``
    (identifier, number of words) may give the numbers of the original words
    that the text is to consist of.  A task holds some thirty bytes for each
    word of the documents at hand, the longest whole.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    if least < 2 or exponent < 3:
        raise ValueError("a run has two words and three periods at least")
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("key"), docs[ident].alias("ident"), docs[text].alias("text"))
    said = T.StructType(
        [
            T.StructField("key", T.LongType()),
            rows.schema["ident"],
            T.StructField("n_words", T.LongType()),
            T.StructField("words", T.StringType()),
            T.StructField("fragments", T.ArrayType(_FRAGMENT, False)),
        ]
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words, numbers = _numbered(utf8(batch.column("text")), batch.column("ident").to_pylist(), reorder)
                begin = np.cumsum([0, *map(len, numbers)])
                doc, *stretch = fragments(np.concatenate(numbers), begin, least, exponent, block)
                order = np.argsort(doc, kind="stable")
                offsets = np.searchsorted(doc[order], np.arange(len(words) + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array(a[order], pa.int64()) for a in stretch], fields=list(_ARROW_FRAGMENT.value_type))
                lists = pa.ListArray.from_arrays(pa.array(offsets), values)
                columns = [batch.column("key"), batch.column("ident"), pa.array(np.diff(begin), pa.int64()), pa.array(words, pa.binary()).cast(pa.string()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=said.names)

    path = scratch_path(spark, "run-fragments")
    rows.mapInArrow(solve, said).write.option("compression", "zstd").parquet(path)
    tiled = spark.read.schema(said).parquet(path)

    pieces = tiled.select("key", F.explode("fragments").alias("f")).select("key", "f.*")
    along = Window.partitionBy("key", "period").orderBy("first", "last")
    reach = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(reach >= F.col("first"), 0).otherwise(1)
    stretches = (
        pieces.withColumn("apart", apart)
        .withColumn("nth", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("key", "period", "nth")
        .agg(F.min("first").alias("start"), F.max("last").alias("last"))
        .withColumn("length", F.col("last") - F.col("start") + F.col("period"))
        .filter((F.col("length") >= least) & (F.col("length") >= exponent * F.col("period")))
    )
    runs = stretches.groupBy("key", "start", "length").agg(F.min("period").alias("period"))
    by_doc = runs.groupBy(F.col("key").alias("of")).agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    ordered = F.transform("found", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))

    none = F.array().cast(T.ArrayType(RUN, False))
    out = T.StructType([rows.schema["ident"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    id_type = to_arrow_type(rows.schema["ident"].dataType)

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "words"):
                runs_of = batch.column("runs")
                texts = [collapsed(w, r) for w, r in zip(utf8(batch.column("words")), runs_of.to_pylist())]
                columns = [batch.column("ident").cast(id_type), batch.column("n_words"), runs_of, pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    plain = tiled.filter(F.size("fragments") == 0).select("ident", "n_words", none.alias("runs"), F.col("words").alias("collapsed"))
    broken = tiled.filter(F.size("fragments") > 0).select("key", "ident", "n_words", "words").join(by_doc, F.col("key") == F.col("of"), "left")
    shortened = broken.select("ident", "n_words", "words", F.coalesce(ordered, none).alias("runs")).mapInArrow(collapse, out)
    return plain.unionByName(shortened).withColumnRenamed("ident", ident)
