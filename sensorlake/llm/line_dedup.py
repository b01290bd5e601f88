"""Incremental, reversible line de-duplication.

The index holds, in the shared folder, an exact reference table (one row per
line key and document) and, per shard of the key space, a cuckoo filter of the
keys that at least ``min_docs`` documents hold.  Inserting documents adds
references and puts the keys that reach ``min_docs`` into their shard's
filter; deleting documents takes references away and removes the fingerprints
of the keys that fall below it, so the index is as if those documents had
never come.  To clean documents, their distinct keys are tried on the filters;
the few that pass are looked up in the exact counts, so a false positive of a
filter costs a lookup and never a line.

A line's key is the line without ASCII white space at its ends, A-Z in lower
case; it is held as a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.common import SPACES, materialise, slices, utf8

#: Keys a shard is made for; filters grow beyond it by doubling.
KEYS_PER_SHARD = 200_000
SLOTS, KICKS = 4, 500


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit key of a line, None if it has fewer than ``min_chars`` code points."""
    key = line.strip(SPACES).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


class Cuckoo:
    """Cuckoo filter: 16-bit fingerprints (0: free) in buckets of four; a fingerprint may lie in either of two buckets."""

    def __init__(self, table: np.ndarray, count: int = 0):
        self.table, self.count = table, count

    @classmethod
    def sized(cls, n: int) -> Cuckoo:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, n) / (SLOTS * 0.8)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, keys: list[bytes]) -> Cuckoo:
        n = len(keys)
        while True:
            out = cls.sized(n)
            if all(map(out.insert, keys)):
                return out
            n = 2 * max(n, 1)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        h = int.from_bytes(key[8:], "little")
        mark = (h & 0xFFFF) or 1
        one = (h >> 16) % len(self.table)
        return mark, one, self._other(one, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ ((mark * 0x5BD1E995) % len(self.table))

    def _put(self, place: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[place] == 0)
        if free.size:
            self.table[place, free[0]] = mark
        return bool(free.size)

    def insert(self, key: bytes) -> bool:
        """Adds a key; False when no place was found and the filter must be built larger."""
        mark, one, other = self._places(key)
        self.count += 1
        if self._put(one, mark) or self._put(other, mark):
            return True
        place = other
        for kick in range(KICKS):
            slot = (kick * 7 + mark) % SLOTS
            mark, self.table[place, slot] = int(self.table[place, slot]), mark
            place = self._other(place, mark)
            if self._put(place, mark):
                return True
        return False

    def delete(self, key: bytes) -> None:
        """Takes out one fingerprint of a key that was inserted."""
        mark, one, other = self._places(key)
        for place in (one, other):
            at = np.flatnonzero(self.table[place] == mark)
            if at.size:
                self.table[place, at[0]] = 0
                self.count -= 1
                return
        raise KeyError("the key is not in the filter")

    def holds(self, key: bytes) -> bool:
        mark, one, other = self._places(key)
        return bool((self.table[one] == mark).any() or (self.table[other] == mark).any())


def _shard(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")


def references(docs: DataFrame, ident: str, text: str, min_chars: int) -> DataFrame:
    """Distinct (key, doc) of the lines of ``docs`` with at least ``min_chars`` code points."""
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("doc", docs.schema[ident].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                keys, rows = [], []
                for i, text in enumerate(utf8(batch.column("text"))):
                    own = {line_key(x, min_chars) for x in text.split(b"\n")} - {None}
                    keys += own
                    rows += [i] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("doc").take(pa.array(rows, pa.int64()))], names=["key", "doc"])

    return docs.select(docs[ident].alias("doc"), docs[text].alias("text")).mapInArrow(run, schema).distinct()


@dataclass(frozen=True)
class LineIndex:
    """References (key, doc), counts (key, refs, owner) and filters (shard, buckets, table, count)."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int

    @classmethod
    def build(cls, docs: DataFrame, ident: str = "doc_id", text: str = "text", min_docs: int = 3, min_chars: int = 20) -> LineIndex:
        """Index of ``docs``.  A null identifier is a document like others, the smallest; rows with one identifier are one document."""
        refs = materialise(references(docs, ident, text, min_chars), "line-refs")
        counts = materialise(_counted(refs), "line-counts")
        repeated = counts.filter(F.col("refs") >= min_docs).select("key")
        shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-counts.count() // KEYS_PER_SHARD))
        filters = materialise(_changed(None, repeated.withColumn("added", F.lit(True)), shards), "line-filters")
        return cls(refs, counts, filters, shards, min_docs, min_chars)

    def insert(self, docs: DataFrame, ident: str = "doc_id", text: str = "text") -> LineIndex:
        """The index with ``docs`` added; references that it has already change nothing."""
        new = references(docs, ident, text, self.min_chars).join(self.refs.withColumnRenamed("key", "k").withColumnRenamed("doc", "d"), F.col("key").eqNullSafe(F.col("k")) & F.col("doc").eqNullSafe(F.col("d")), "left_anti")
        return self._with(self.refs.unionByName(new))

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose identifiers are in the only column of ``ids``."""
        gone = ids.select(F.col(ids.columns[0]).alias("d")).distinct()
        return self._with(self.refs.join(gone, F.col("doc").eqNullSafe(F.col("d")), "left_anti"))

    def _with(self, refs: DataFrame) -> LineIndex:
        refs = materialise(refs, "line-refs")
        counts = materialise(_counted(refs), "line-counts")
        was = self.counts.filter(F.col("refs") >= self.min_docs).select("key", F.lit(True).alias("was"))
        now = counts.filter(F.col("refs") >= self.min_docs).select("key", F.lit(True).alias("now"))
        changes = was.join(now, "key", "full_outer").filter("was is null or now is null").select("key", F.col("now").isNotNull().alias("added"))
        filters = materialise(_changed(self.filters, changes, self.shards, now.select("key")), "line-filters")
        return LineIndex(refs, counts, filters, self.shards, self.min_docs, self.min_chars)

    def repeated(self, keys: DataFrame) -> DataFrame:
        """Of the distinct ``keys``, those that ``min_docs`` documents hold, with ``owner``: the filters first, then the exact counts."""

        def run(asked: pa.Table, filters: pa.Table) -> pa.Table:
            wanted = asked.column("key").to_pylist()
            if filters.num_rows == 0:
                return asked.select(["key"]).slice(0, 0)
            own = _cuckoo(filters)
            return pa.table({"key": pa.array([k for k in wanted if own.holds(k)], pa.binary())})

        asked = keys.select("key", _shard(self.shards).alias("shard")).groupBy("shard")
        maybe = asked.cogroup(self.filters.groupBy("shard")).applyInArrow(run, "key binary")
        return self.counts.filter(F.col("refs") >= self.min_docs).join(maybe, "key").select("key", "owner")

    def clean(self, docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
        """Every column of ``docs``, its text cleaned, then ``n_lines`` (before) and ``n_dropped``.

        All lines of a repeated key go except in its largest document.  Null
        and empty text are one empty line.  Repeated rows are cleaned each.
        Input columns with one of the two names are replaced.
        """
        held = references(docs, ident, text, self.min_chars)
        dropped = (
            held.join(self.repeated(held.select("key").distinct()), "key")
            .filter(~F.col("doc").eqNullSafe(F.col("owner")))
            .groupBy("doc")
            .agg(F.collect_list("key").alias("keys"))
        )
        kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
        inner = F.struct(*(docs[c] for c in kept if c != text)).alias("row")
        rows = docs.select(docs[ident].alias("ident"), docs[text].alias("text"), inner)
        joined = rows.join(dropped, F.col("ident").eqNullSafe(F.col("doc")), "left").select("row", "text", "keys")
        schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
        min_chars = self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, "text"):
                    texts, lines, gone = [], [], []
                    for body, keys in zip(utf8(batch.column("text")), batch.column("keys").to_pylist()):
                        every = body.split(b"\n")
                        drop = set(keys or ())
                        stay = [x for x in every if line_key(x, min_chars) not in drop] if drop else every
                        texts.append(b"\n".join(stay))
                        lines.append(len(every))
                        gone.append(len(every) - len(stay))
                    columns = [batch.column("row"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(gone, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_lines", "n_dropped"])

        out = joined.mapInArrow(run, schema)
        return out.select(*(F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in kept), "n_lines", "n_dropped")


def _counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count(F.lit(1)).alias("refs"), F.max("doc").alias("owner"))


def _cuckoo(filters: pa.Table) -> Cuckoo:
    row = filters.to_pylist()[0]
    return Cuckoo(np.frombuffer(row["table"], np.uint16).reshape(row["buckets"], SLOTS).copy(), row["count"])


_FILTER = "shard int, buckets int, table binary, count long"


def _changed(filters: DataFrame | None, changes: DataFrame, shards: int, every: DataFrame | None = None) -> DataFrame:
    """Filters after ``changes`` (key, added).  A shard's filter that is full is built anew from
    ``every`` (the keys it must hold), which is sent along as its additions for that case."""

    def write(shard: int, own: Cuckoo) -> pa.Table:
        row = {"shard": [shard], "buckets": [len(own.table)], "table": [own.table.tobytes()], "count": [own.count]}
        return pa.table(row, schema=pa.schema([("shard", pa.int32()), ("buckets", pa.int32()), ("table", pa.binary()), ("count", pa.int64())]))

    def made(key: tuple, keys: pa.Table) -> pa.Table:
        return write(key[0].as_py(), Cuckoo.of(keys.column("key").to_pylist()))

    def merged(key: tuple, old: pa.Table, rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, added = rows.column("key").to_pylist(), rows.column("added").to_pylist()
        if old.num_rows:
            own = _cuckoo(old)
            for k, a in zip(keys, added):
                if a is False:
                    own.delete(k)
            if all(own.insert(k) for k, a in zip(keys, added) if a):
                return write(shard, own)
            keys = [k for k, a in zip(keys, added) if a is None]
        else:
            keys = [k for k, a in zip(keys, added) if a]
        return write(shard, Cuckoo.of(keys))

    if filters is None:
        return changes.select("key", _shard(shards).alias("shard")).groupBy("shard").applyInArrow(made, _FILTER)
    rows = changes.unionByName(every.withColumn("added", F.lit(None).cast("boolean"))).withColumn("shard", _shard(shards))
    return filters.groupBy("shard").cogroup(rows.groupBy("shard")).applyInArrow(merged, _FILTER)
