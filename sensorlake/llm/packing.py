"""Packing documents into training sequences of several context sizes.

A document is its token ids and an end id.  What fills windows of the longest
context is cut off at once; the rest is routed to the shortest context that
holds it.  Each tier is packed from the longest down: a window begins with a
document of its tier, longest first, and its gap is filled with the longest
pieces of shorter tiers that fit.  When none fits, the shortest is cut to
measure and its rest goes back to the tier of its length.  So every window is
filled to the last token as long as there are pieces.  The sequences of a pool
are then dealt to step groups, each to the group with the fewest tokens, so
that the steps of a training run are of one size although contexts are not.

Tasks pack their own documents, pool by pool, and what is left at the end of a
task, less than a window, is packed once more with that of other tasks.  At the
very end fewer tokens than the shortest context may be left: they make the one
sequence that is padded.  Nothing but these rests is shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.byte_bpe import byte_bpe
from sensorlake.llm.common import materialise, slices, utf8

#: Context sizes, each twice the next.
CONTEXTS = (2048, 1024, 512, 256, 128)
#: Tokens of a step group.
STEP_TOKENS = 1 << 18
#: Tokens that a task packs at once.
POOL = 1 << 21
#: Tasks whose rests are packed together: less than so many windows.
TASKS = 512
#: Shards of the second round are numbered from here.
SECOND = 1 << 30


@dataclass
class Piece:
    """Tokens ``ids`` of the document ``ident`` from its place ``start`` on; ``total`` are the document's."""

    ident: object
    start: int
    total: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.ident, self.start, self.total, self.ids[:n]), Piece(self.ident, self.start + n, self.total, self.ids[n:])


@dataclass
class Shelf:
    """Pieces by length, with a bit for each length that is there."""

    pieces: dict[int, list[Piece]] = field(default_factory=dict)
    lengths: int = 0

    def put(self, piece: Piece) -> None:
        n = len(piece.ids)
        self.pieces.setdefault(n, []).append(piece)
        self.lengths |= 1 << n

    def take(self, n: int) -> Piece:
        own = self.pieces[n]
        piece = own.pop()
        if not own:
            self.lengths &= ~(1 << n)
        return piece

    def longest(self, low: int, high: int) -> int:
        """The greatest length above ``low`` and up to ``high`` that is there, else 0."""
        found = (self.lengths & ((1 << (high + 1)) - 1)) >> (low + 1)
        return found.bit_length() + low if found else 0

    def shortest(self, low: int, high: int) -> int:
        """The smallest such length, else 0."""
        found = (self.lengths & ((1 << (high + 1)) - 1)) >> (low + 1)
        return (found & -found).bit_length() + low if found else 0


Sequence = tuple[int, list[Piece]]


def pack_tiers(shelf: Shelf, contexts: tuple[int, ...] = CONTEXTS) -> tuple[list[Sequence], list[Piece]]:
    """Full sequences (context and pieces) of all that lies on the shelf, and the pieces of a window that they did not fill."""
    full: list[Sequence] = []
    for c, shorter in zip(contexts, (*contexts[1:], 0)):
        while n := shelf.longest(shorter, c):
            window = [shelf.take(n)]
            gap = c - n
            while gap:
                # Shorter tiers first, the own one when they are empty.
                fits = shelf.longest(0, min(gap, shorter)) or shelf.longest(0, gap)
                if fits:
                    window.append(shelf.take(fits))
                    gap -= fits
                    continue
                longer = shelf.shortest(gap, shorter) or shelf.shortest(gap, c)
                if not longer:
                    return full, window
                piece, rest = shelf.take(longer).cut(gap)
                window.append(piece)
                shelf.put(rest)
                gap = 0
            full.append((c, window))
    return full, []


def pack_rest(pieces: list[Piece], contexts: tuple[int, ...] = CONTEXTS) -> list[Sequence]:
    """Fewer tokens than the longest context, cut into full windows of falling size; what is less than the shortest
    context is a sequence of its own, to be padded."""
    out: list[Sequence] = []
    pieces = list(reversed(pieces))
    left = sum(len(p.ids) for p in pieces)
    for c in [*contexts, 0]:
        while left and left >= c:
            window, gap = [], c or left
            left -= gap
            while gap:
                piece = pieces.pop()
                if len(piece.ids) > gap:
                    piece, rest = piece.cut(gap)
                    pieces.append(rest)
                window.append(piece)
                gap -= len(piece.ids)
            out.append((c or contexts[0], window))
    return out


def step_groups(sequences: list[Sequence], step_tokens: int = STEP_TOKENS) -> list[int]:
    """The group of each sequence: of about ``step_tokens`` tokens each, equal but for one sequence."""
    total = sum(c for c, _ in sequences)
    load = [(0, g) for g in range(max(1, round(total / step_tokens)))]
    out = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: -sequences[i][0]):
        tokens, g = load[0]
        heapq.heapreplace(load, (tokens + sequences[i][0], g))
        out[i] = g
    return out


class Packer:
    """The sequences of one shard."""

    def __init__(self, shard: int, contexts: tuple[int, ...], step_tokens: int):
        self.shard, self.contexts, self.step_tokens = shard, contexts, step_tokens
        self.shelf, self.whole, self.tokens = Shelf(), [], 0
        self.n_sequences = self.n_steps = 0

    def add(self, ident: object, ids: np.ndarray) -> None:
        window, n = self.contexts[0], len(ids)
        end = n - n % window
        for a in range(0, end, window):
            self.whole.append((window, [Piece(ident, a, n, ids[a : a + window])]))
        if end < n:
            self.shelf.put(Piece(ident, end, n, ids[end:]))
        self.tokens += n

    def flush(self) -> Iterator[tuple]:
        """Rows (``_ROWS``) of the pool's full sequences; a window that is not full goes back on the shelf."""
        full, rest = pack_tiers(self.shelf, self.contexts)
        yield from self.rows(self.whole + full)
        self.whole, self.tokens = [], 0
        for piece in rest:
            self.shelf.put(piece)

    def rows(self, sequences: list[Sequence], is_open: bool = False) -> Iterator[tuple]:
        groups = step_groups(sequences, self.step_tokens)
        base = self.shard << 32
        for (context, pieces), group in zip(sequences, groups):
            offset = 0
            for p in pieces:
                yield p.ident, p.start, len(p.ids), p.total, base + self.n_sequences, offset, context, base + self.n_steps + group, is_open, p.ids.astype("<u4").tobytes()
                offset += len(p.ids)
            self.n_sequences += 1
        self.n_steps += max(groups, default=-1) + 1

    def end(self) -> Iterator[tuple]:
        """Rows of what is left, as one open sequence."""
        left = [p for own in self.shelf.pieces.values() for p in own]
        if left:
            yield from self.rows([(self.contexts[0], sorted(left, key=lambda p: -len(p.ids)))], True)


_COUNTS = ("start", "length", "doc_tokens", "sequence_id", "offset", "context", "step")
_ROWS = ("ident", *_COUNTS, "open", "ids")


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("ident", id_type)]
        + [T.StructField(c, T.LongType(), False) for c in _COUNTS]
        + [T.StructField("open", T.BooleanType(), False), T.StructField("ids", T.BinaryType(), False)]
    )


def _batches(rows: Iterator[tuple], schema: pa.Schema, at_once: int = 1 << 14, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) >= at_once or size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    ident: str = "doc_id",
    text: str = "text",
    contexts: tuple[int, ...] = CONTEXTS,
    step_tokens: int = STEP_TOKENS,
    pool: int = POOL,
    columns: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """One row per piece: ``ident``, ``start`` (its document's tokens before it), ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` there, ``context`` (the sequence's padded size), ``step`` (its step group) and
    ``columns``, by default ``ids``: the tokens as little-endian unsigned 32-bit numbers.

    ``path``: a byte-level BPE ``.json`` file that every worker can read.
    ``columns`` are functions of the binary column of ids, for callers that need
    digests and not the ids themselves; they alone are stored.  Null and empty
    texts are the end id alone.  Rows that repeat an identifier are each packed;
    other columns are not read.  A task holds one pool's ids and its longest
    document.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if list(contexts) != [contexts[0] >> i for i in range(len(contexts))] or contexts[-1] < 2:
        raise ValueError(f"contexts must halve from one to the next, not {contexts}")
    columns = columns or {"ids": lambda ids: ids}
    taken = {"ident", *_COUNTS, "open"} & set(columns)
    if taken or ident in columns or ident in _COUNTS:
        raise ValueError(f"column names in use: {sorted(taken) or ident}")
    rows = docs.select(docs[ident].alias("ident"), docs[text].alias("text"))
    schema = _schema(rows.schema["ident"].dataType)
    arrow = to_arrow_schema(schema)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, packer = byte_bpe(path), Packer(TaskContext.get().partitionId(), contexts, step_tokens)
        end = np.array([end_id], np.uint32)

        def found() -> Iterator[tuple]:
            for whole in batches:
                for batch in slices(whole, "text"):
                    for name, said in zip(batch.column("ident").to_pylist(), utf8(batch.column("text"))):
                        packer.add(name, np.concatenate([bpe.encode(said.decode()), end]))
                        if packer.tokens >= pool:
                            yield from packer.flush()
            yield from packer.flush()
            yield from packer.end()

        yield from _batches(found(), arrow)

    def second(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(SECOND + key[0].as_py(), contexts, step_tokens)
        left = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["sequence_id"], r["offset"]))
        for r in left:
            packer.shelf.put(Piece(r["ident"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4")))
        full, rest = pack_tiers(packer.shelf, contexts)
        yield from _batches(packer.rows(full + pack_rest(rest, contexts)), arrow)

    # Kept of the ids: all of the open pieces', and the columns asked for of the others.
    said = {name: F.when(~F.col("open"), make(F.col("ids"))).alias(name) for name, make in columns.items() if name != "ids"}
    kept = F.col("ids") if "ids" in columns else F.when(F.col("open"), F.col("ids")).alias("ids")
    once = materialise(rows.mapInArrow(first, schema).select("ident", *_COUNTS, "open", kept, *said.values()), "packed")
    rests = once.filter("open").select("ident", *_COUNTS, "open", "ids")
    bucket = F.shiftright(F.shiftright("sequence_id", 32), TASKS.bit_length() - 1).cast("long")
    again = rests.groupBy(bucket.alias("bucket")).applyInArrow(second, schema)
    out = lambda df, made: df.select(F.col("ident").alias(ident), *_COUNTS, *made)
    closed = out(once.filter("not open"), columns)
    return closed.unionByName(out(again, [make(F.col("ids")).alias(name) for name, make in columns.items()]))
