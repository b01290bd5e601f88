"""SentencePiece encoding and decoding for merge-type vocabularies.

A text gets the leading white space that the format adds, and is cut at
proven boundaries (``pieces.segment_pattern``).  Each distinct segment is
encoded by an agenda of adjacent symbol pairs: the pair whose joined piece has
the highest score is merged first, the leftmost of equals, and each merge puts
the pairs with the new neighbours on the agenda.  Symbols that are no piece
become byte pieces.  Segments are remembered in two generations of bounded
size; what is forgotten is computed anew.

In each Arrow batch every newly encoded segment is checked against the
``sentencepiece`` library, ids and decoded text; a difference is an error.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sensorlake.llm.common import slices, utf8
from sensorlake.llm.pieces import SPACE, is_normal, processor, segment_pattern

#: Segments kept in each of two generations, and the longest kept: together some 60 MB a worker.
REMEMBERED, LONGEST = 250_000, 24


def merge_agenda(segment: str, score: dict[str, float]) -> list[str]:
    """The symbols left when no adjacent pair joins to a piece any more.

    An agenda entry is stale, and skipped, when its symbols have changed since."""
    symbols: list[str] = list(segment)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = [(-score[p], i, p) for i, p in enumerate(map(str.__add__, symbols, symbols[1:])) if p in score]
    heapq.heapify(agenda)
    while agenda:
        _, i, piece = heapq.heappop(agenda)
        j = after[i]
        if j >= n or not symbols[i] or symbols[i] + symbols[j] != piece:
            continue
        symbols[i], symbols[j] = piece, ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (p := piece + symbols[k]) in score:
                heapq.heappush(agenda, (-score[p], i, p))
        h = before[i]
        if h >= 0 and (p := symbols[h] + piece) in score:
            heapq.heappush(agenda, (-score[p], h, p))
    return [s for s in symbols if s]


class Codec:
    """Encoder and decoder for one vocabulary file; holds what a worker remembers.

    Visible white space is written as a space throughout, as in the texts."""

    def __init__(self, path: str):
        self.sp = sp = processor(path)
        pieces = {i: sp.id_to_piece(i).replace(SPACE, " ") for i in range(sp.get_piece_size())}
        self.id = {p: i for i, p in pieces.items() if is_normal(sp, i)}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.byte = {int(p[1:-1], 16): i for i, p in pieces.items() if sp.is_byte(i)}
        if len(self.byte) != 256 or any("\n" in p for p in self.id):
            raise ValueError("a merge-type vocabulary with byte pieces and none that holds a line feed is needed")
        self.surface = [p.encode() for p in pieces.values()]
        for b, i in self.byte.items():
            self.surface[i] = bytes([b])
        self.cut = segment_pattern(path).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.unchecked: list[tuple[str, list[int]]] = []

    def encode_segment(self, segment: str) -> list[int]:
        out: list[int] = []
        for s in merge_agenda(segment, self.score):
            i = self.id.get(s)
            out.extend([i] if i is not None else map(self.byte.__getitem__, s.encode()))
        return out

    def _found(self, segment: str) -> bytes:
        value = self.old.get(segment)
        if value is None:
            ids = self.encode_segment(segment)
            self.unchecked.append((segment, ids))
            value = np.array(ids, np.int32).tobytes()
        if len(segment) <= LONGEST:
            if len(self.young) >= REMEMBERED:
                self.young, self.old = {}, self.young
            self.young[segment] = value
        return value

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text, int32."""
        if not text:
            return np.empty(0, np.int32)
        if SPACE in text:
            text = text.replace(SPACE, " ")
        found = []
        for segment in self.cut(" " + text):
            found.append(self.young.get(segment) or self._found(segment))
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, byte pieces read as UTF-8, the added white space taken off."""
        return b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")

    def check(self) -> None:
        """Holds all segments encoded since the last call against the library, behind a line feed, which nothing joins."""
        if not self.unchecked:
            return
        theirs = self.sp.encode(["\n" + s for s, _ in self.unchecked], num_threads=1)
        for (segment, ids), other, back in zip(self.unchecked, theirs, self.sp.decode(theirs)):
            if other[2:] != ids or back != "\n" + segment:
                raise RuntimeError(f"{segment!r}: own ids {ids}, the library's {other[2:]}, which decode to {back!r}")
        self.unchecked = []


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every column of ``docs`` but ``text``, then ``token_ids`` (array of int) and ``decoded`` (the text decoded from them).

    ``path``: a merge-type ``.model`` file that every worker can read.  Null
    counts as empty: no ids, empty text.  Repeated rows are encoded each.  An
    input column with one of the two names is replaced.
    """
    added = {"token_ids": T.ArrayType(T.IntegerType(), False), "decoded": T.StringType()}
    kept = [c for c in docs.columns if c != text and c not in added]
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(k, t, False) for k, t in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for whole in batches:
            for batch in slices(whole, text):
                ids = [own.encode(x.decode()) for x in utf8(batch.column(text))]
                own.check()
                ends = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
                decoded = pa.array(map(own.decode, ids), pa.string())
                columns = [*(batch.column(c) for c in kept), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids))), decoded]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return docs.select(*(docs[c] for c in [*kept, text])).mapInArrow(run, schema)
