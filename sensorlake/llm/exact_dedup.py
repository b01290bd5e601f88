"""Exact de-duplication by Patricia tries that own the texts.

Every text is reduced, inside the task that reads it, to one row per distinct
text of a block, with the identifier that stays and the number of rows.  These
rows are partitioned by length and content hash, and each partition inserts
the full byte strings, behind hash and length, into a compressed radix trie;
a terminal node holds the surviving identifier and the row counts.  Texts are
equal only when the trie says so, byte by byte; the SHA-256 digest names a
terminal for the rows that look for their owner, and two digests of one
terminal, or two terminals of one digest, are an error.

A trie holds about ``budget`` bytes: beyond it the heaviest subtree of the
root with two terminals or more is emptied, and what it held, and what still
comes for it, goes on as rows to a further round with eight times the
partitions, until no row is left over.  Rounds are written to the shared
checkpoint folder.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import materialise, slices, utf8

#: Bytes of keys that one trie may hold before it gives subtrees away.
BUDGET = 64 << 20
#: Bytes of text that a reading task reduces at once.
BLOCK = 16 << 20


class Node:
    """The bytes on the edge above a node, its children by their first byte, and a terminal's value."""

    __slots__ = ("children", "edge", "value")

    def __init__(self, edge: bytes):
        self.edge, self.children, self.value = edge, {}, None


class Trie:
    """Compressed radix trie from byte strings to values; ``bytes_in`` and ``terminals_in`` count by first byte."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes_in: dict[int, int] = {}
        self.terminals_in: dict[int, int] = {}

    def terminal(self, key: bytes) -> Node:
        """The node of ``key``, made where it is new (its value is then None)."""
        node, at, first = self.root, 0, key[0]
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.bytes_in[first] = self.bytes_in.get(first, 0) + len(key) - at
            elif not key.startswith(child.edge, at):
                same = len(os.path.commonprefix((child.edge, key[at : at + len(child.edge)])))
                fork = node.children[key[at]] = Node(child.edge[:same])
                child.edge = child.edge[same:]
                fork.children[child.edge[0]] = child
                child = fork
            node, at = child, at + len(child.edge)
        if node.value is None:
            self.terminals_in[first] = self.terminals_in.get(first, 0) + 1
        return node

    def heaviest(self) -> int | None:
        """First byte of the heaviest subtree with two terminals or more."""
        return max((b for b, n in self.terminals_in.items() if n > 1), key=self.bytes_in.__getitem__, default=None)

    def take(self, first: int) -> Iterator[tuple[bytes, tuple]]:
        """Removes a subtree of the root; its strings and values."""
        self.bytes_in.pop(first), self.terminals_in.pop(first)
        stack = [(b"", self.root.children.pop(first))]
        while stack:
            before, node = stack.pop()
            key = before + node.edge
            if node.value is not None:
                yield key, node.value
            stack += [(key, child) for child in node.children.values()]


def _merge(a: tuple | None, b: tuple, largest: bool) -> tuple:
    """Two values ``(identifier, rows that carry it, rows)`` as one; a null identifier gives way to any other."""
    if a is None:
        return b
    if a[0] == b[0]:
        return a[0], a[1] + b[1], a[2] + b[2]
    better = a if b[0] is None or a[0] is not None and (a[0] > b[0]) == largest else b
    return better[0], better[1], a[2] + b[2]


#: A text on its way to its terminal: hash, digest, text, identifier, rows that carry it, rows.
_PART = "hash long, digest binary, text binary, ident {id}, ties long, rows long"
_NAMES = ["hash", "digest", "text", "ident", "ties", "rows"]


def _reduced(id_type: pa.DataType, largest: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", BLOCK):
                found: dict[bytes, tuple] = {}
                names: dict[bytes, tuple] = {}
                idents, hashes, digests = (batch.column(c).to_pylist() for c in ("ident", "hash", "digest"))
                for text, ident, h, d in zip(utf8(batch.column("text")), idents, hashes, digests):
                    found[text] = _merge(found.get(text), (ident, 1, 1), largest)
                    names[text] = h, d
                rows = [(*names[x], x, *v) for x, v in found.items()]
                yield _batch(rows, id_type)

    return run


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.binary(), id_type, pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=_NAMES)


def _owned(id_type: pa.DataType, largest: bool, budget: int) -> Callable:
    """One partition's trie; rows with a text are left over, rows without are terminals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, given_away = Trie(), set()

        def left_over(first: int) -> list[tuple]:
            given_away.add(first)
            return [(int.from_bytes(k[:8], "big", signed=True), v[3], k[16:], *v[:3]) for k, v in trie.take(first)]

        for whole in batches:
            for batch in slices(whole, "text"):
                out = []
                for row in zip(*(batch.column(c).to_pylist() for c in _NAMES)):
                    h, digest, text = row[:3]
                    key = h.to_bytes(8, "big", signed=True) + len(text).to_bytes(8, "big") + text
                    if key[0] in given_away:
                        out.append(row)
                        continue
                    node = trie.terminal(key)
                    if node.value and node.value[3] != digest:
                        raise RuntimeError("one text has two digests")
                    node.value = (*_merge(node.value and node.value[:3], row[3:], largest), digest)
                    while sum(trie.bytes_in.values()) > budget and (heavy := trie.heaviest()) is not None:
                        out += left_over(heavy)
                if out:
                    yield _batch(out, id_type)
        named: set[bytes] = set()
        for first in list(trie.root.children):
            rows = [(int.from_bytes(k[:8], "big", signed=True), v[3], None, *v[:3]) for k, v in trie.take(first)]
            for r in rows:
                if r[1] in named:
                    raise RuntimeError("one digest names two texts")
                named.add(r[1])
            yield _batch(rows, id_type)

    return run


def owners(docs: DataFrame, ident: str = "doc_id", text: str = "text", largest: bool = True, budget: int = BUDGET) -> DataFrame:
    """One row per distinct text: ``digest`` (SHA-256, binary), ``keep_id``, ``ties`` (rows that carry
    ``keep_id``) and ``group_size``.  See ``mark`` for nulls and ties."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema[ident].dataType
    arrow_id, schema = to_arrow_type(id_type), _PART.format(id=id_type.simpleString())
    content = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(
        docs[ident].alias("ident"), content.alias("text"), F.xxhash64(content).alias("hash"), digest(content).alias("digest")
    ).mapInArrow(_reduced(arrow_id, largest), schema)
    partitions, done = None, None
    while True:
        by = (F.octet_length("text"), F.col("hash"))
        dealt = rows.repartition(*by) if partitions is None else rows.repartition(partitions, *by)
        partitions = 8 * (partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        tried = materialise(dealt.mapInArrow(_owned(arrow_id, largest, budget), schema), "tries")
        ended = tried.filter(F.col("text").isNull())
        done = ended if done is None else done.unionByName(ended)
        rows = tried.filter(F.col("text").isNotNull())
        if rows.isEmpty():
            return done.select("digest", F.col("ident").alias("keep_id"), "ties", F.col("rows").alias("group_size"))


def digest(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def mark(docs: DataFrame, ident: str = "doc_id", text: str = "text", largest: bool = True, budget: int = BUDGET) -> DataFrame:
    """One row per row of ``docs``: ``ident``, ``digest``, ``keep_id``, ``ties``, ``group_size`` and ``kept``.

    Of the rows with the same text the one with the largest identifier stays
    (the smallest unless ``largest``).  Null text counts as empty; a null
    identifier stays only where the group has no other.  Rows that repeat text
    and identifier are one document: all are marked kept, ``ties`` counts them.
    """
    held = owners(docs, ident, text, largest, budget)
    rows = docs.select(docs[ident].alias("ident"), digest(F.coalesce(docs[text], F.lit(""))).alias("digest"))
    return rows.join(held, "digest").select(
        F.col("ident").alias(ident), "digest", "keep_id", "ties", "group_size", F.col("ident").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def drop_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text", largest: bool = True, budget: int = BUDGET) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; of rows that repeat text and identifier, one."""
    held = owners(docs, ident, text, largest, budget)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[ident].alias("ident"), digest(F.coalesce(docs[text], F.lit(""))).alias("digest"))
    stay = rows.join(held, "digest").filter(F.col("ident").eqNullSafe(F.col("keep_id")))
    once = stay.filter("ties = 1").unionByName(stay.filter("ties > 1").dropDuplicates(["digest"]))
    return once.select(*(F.col("row")[c].alias(c) for c in docs.columns))
