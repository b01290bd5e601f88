"""Similarity join on word n-grams: which documents are near copies of each other.

A document is the set of its shingles, held as 64-bit hashes; documents with
one set are one node.  All shingles are put in one global order, the rarest
first: by the document frequency of the shingle's bucket in a table of
``buckets`` counters over all documents, then by hash.  Two sets of Jaccard
similarity t or more share a shingle among the first n - ceil(t n) + 1 of each,
so only those prefixes are joined.  A list of the nodes that share a prefix
shingle is worked on inside one task, at most ``BLOCK`` nodes against as many
others at once, with these filters on each pair:

* length: the smaller set has at least t times the larger one's shingles;
* position: what can still be common after the two places is enough;
* suffix: the two sets' counts in 512 fixed parts of the hash range, kept
  modulo 4, differ by no more than the overlap allows (the distance of the
  counts around the circle is a lower bound of the sets' difference).

A list with many pairs left (more than its nodes, in later rounds ``FURTHER``
times as many) gives only those of its nodes with most pairs, up to that
number, and comes again in the next round without these nodes.  Pairs inside a
component that the links so far connect are left out, so a large group of near
copies takes a few rounds of a few pairs a node, and no link between
components is lost.  Each pair is verified once, on the full sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import materialise, slices, utf8
from sensorlake.llm.components import connected
from sensorlake.llm.words import shingle_sets

#: Counters of the frequency table, a power of two; each is collected and sent to every worker.
BUCKETS = 1 << 20
#: Counters that travel in one row.
SPAN = 1 << 16
#: Parts of the hash range that the suffix filter counts, each modulo 4 in two bits.
PARTS = 512
#: Nodes of a list that meet as many others in one task at once.
BLOCK = 2048
#: Lists up to this size are worked on many at a time, and give all their pairs at once.
SMALL = 8
#: Pairs for each of its nodes that a list may give in the rounds after the first.
FURTHER = 8
#: Pairs of a larger list that are looked at in one step.
PAIRS = 1 << 16
#: Bits of the table that tells which nodes may be wanted.
WANTED_BITS = 1 << 24


def signature(own: np.ndarray) -> bytes:
    """128-bit name of a sorted set."""
    return xxhash.xxh3_128_digest(own.tobytes())


def _short(node: bytes) -> int:
    """The first half of a node's name, which postings carry.  Two nodes of one short name would both be
    looked at wherever one of them occurs."""
    return int.from_bytes(node[:8], "little", signed=True)


def _parts(own: np.ndarray) -> bytes:
    """Members in each part of the hash range modulo 4, four parts a byte."""
    n = (np.bincount((own >> np.uint64(55)).astype(np.int64), minlength=PARTS) & 3).astype(np.uint8).reshape(-1, 4)
    return (n[:, 0] | n[:, 1] << 2 | n[:, 2] << 4 | n[:, 3] << 6).tobytes()


#: The low bit of each two-bit count in a word.
_LOW = np.uint64(0x5555555555555555)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row of two arrays of packed counts, the sum of their distances around the circle: counts that
    differ in the low bit are one apart, those that differ in the high bit alone two."""
    differ = a ^ b
    one = differ & _LOW
    two = (differ >> np.uint64(1)) & _LOW & ~one
    return (np.bitwise_count(one) + 2 * np.bitwise_count(two)).sum(1, dtype=np.int64)


def _bucket(own: np.ndarray, buckets: int) -> np.ndarray:
    return (own >> np.uint64(17)).astype(np.int64) & (buckets - 1)


def _described(width: int, buckets: int) -> Callable:
    """Per document its node, size and part counts; at a task's end its share of the frequency table."""
    names = ["doc", "text_hash", "name", "node", "n", "parts", "span", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, doc_type = np.zeros(buckets, np.uint32), None
        for whole in batches:
            doc_type = whole.schema.field("doc").type
            for batch in slices(whole, "text"):
                sets = shingle_sets(utf8(batch.column("text")), width)
                if any(map(len, sets)):
                    counts += np.bincount(_bucket(np.concatenate(sets), buckets), minlength=buckets).astype(np.uint32)
                nodes = [signature(s) for s in sets]
                columns = [
                    batch.column("doc"),
                    batch.column("text_hash"),
                    pa.array(map(_short, nodes), pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_parts(s) for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if doc_type is not None:
            n = max(1, buckets // SPAN)
            packed = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, n)]
            empty = [pa.nulls(n, doc_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(n), pa.int32()), pa.array(packed, pa.binary())], names=names)

    return run


def _frequencies(described: DataFrame, buckets: int) -> np.ndarray:
    """The whole frequency table: ``buckets`` counters, whatever the input."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(min(buckets, SPAN), np.int64)
        for batch in batches:
            for packed in batch.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(packed), np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["span", "total"])

    rows = described.filter("span is not null").select("span", "counts").groupBy("span").applyInArrow(run, "span int, total binary").collect()
    out = np.zeros((max(1, buckets // SPAN), min(buckets, SPAN)), np.int64)
    for r in rows:
        out[r["span"]] = np.frombuffer(r["total"], np.int64)
    return np.minimum(out.reshape(-1), 2**32 - 1).astype(np.uint32)


def _postings(width: int, percent: int, table) -> Callable:
    """Prefix shingles of each distinct set that a task meets: token, short name of the node, size and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, met = table.value, set()
        for whole in batches:
            for batch in slices(whole, "text"):
                tokens, names, sizes, places = [], [], [], []
                for own in shingle_sets(utf8(batch.column("text")), width):
                    n = len(own)
                    if not n or (node := signature(own)) in met:
                        continue
                    if len(met) >= 1 << 20:
                        met.clear()
                    met.add(node)
                    key = (frequency[_bucket(own, len(frequency))].astype(np.uint64) << np.uint64(32)) | (own >> np.uint64(32))
                    length = n - -(-percent * n // 100) + 1
                    tokens.append(own[np.argsort(key, kind="stable")[:length]])
                    names.append(np.full(length, _short(node), np.int64))
                    sizes.append(np.full(length, n, np.int32))
                    places.append(np.arange(length, dtype=np.int32))
                if names:
                    columns = [np.concatenate(tokens).view(np.int64), *map(np.concatenate, (names, sizes, places))]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["token", "name", "n", "place"])

    return run


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and name, each node once, and only tokens with two nodes or more.
    The last row of a batch is held back, as the next batch may go on with its token."""
    held, given = [], False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _joined([*held, batch])
        token = rows.column("token").to_numpy()
        name = rows.column("name").to_numpy()
        again = (token[1:] == token[:-1]) & (name[1:] == name[:-1])
        first = np.flatnonzero(np.concatenate([[True], ~again]))
        alike = token[first][1:] == token[first][:-1]
        shared = np.concatenate([alike, [False]]) | np.concatenate([[False], alike])
        give = shared.copy()
        if given:
            give[0] = False
        given = bool(shared[-1]) or len(first) == 1 and given
        held = [rows.take(pa.array(first[-1:]))]
        if give.any():
            yield rows.take(pa.array(first[give]))


def _hopeful(percent: int) -> Callable:
    """Of rows sorted by token, those that the length and position filters leave with a partner in their list.
    Lists of more than ``BLOCK`` rows pass as they are."""

    def partners(n: np.ndarray, rest: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = n[i], n[j]
        return (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (np.minimum(rest[i], rest[j]) >= _needed(a, b, percent))

    def chosen(rows: pa.RecordBatch) -> pa.RecordBatch:
        n = rows.column("n").to_numpy().astype(np.int64)
        rest = n - rows.column("place").to_numpy()
        begin, end = _runs(rows.column("token").to_numpy()[:, None])
        size = end - begin
        keep = np.repeat(size > BLOCK, size)
        stop = np.repeat(end, size)
        at = np.flatnonzero(np.repeat(size <= SMALL, size))
        for step in range(1, SMALL):
            i = at[at + step < stop[at]]
            i = i[partners(n, rest, i, i + step)]
            keep[i] = keep[i + step] = True
        for a, b in zip(begin[(size > SMALL) & (size <= BLOCK)], end[(size > SMALL) & (size <= BLOCK)]):
            step = max(1, PAIRS // (b - a))
            for r in range(a, b, step):
                i, j = _later(r, min(r + step, b), b)
                ok = partners(n, rest, i, j)
                keep[i[ok]] = keep[j[ok]] = True
        return rows.filter(pa.array(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        passing = None  # token of a long list whose rows are under way
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _joined([*held, batch])
            token = rows.column("token").to_numpy()
            if passing is not None:
                n = int(np.argmax(token != passing)) if (token != passing).any() else len(token)
                yield rows.slice(0, n)
                rows, token = rows.slice(n), token[n:]
                held = []
                if not len(token):
                    continue
                passing = None
            last = int(np.flatnonzero(token != token[-1]).max(initial=-1)) + 1
            if last:
                yield chosen(rows.slice(0, last))
            held = [rows.slice(last)]
            if len(token) - last > BLOCK:
                passing = token[-1]
                yield held.pop()
        if held:
            yield chosen(held[0])

    return run


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of equal rows of ``key``."""
    cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])


def _names(column: pa.Array) -> np.ndarray:
    """16-byte names as two numbers each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _sets(width: int, wanted) -> Callable:
    """The sets of the documents whose nodes may be wanted, each once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, met = np.frombuffer(wanted.value, np.uint8), set()
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = {}
                for own in shingle_sets(utf8(batch.column("text")), width):
                    node = signature(own)
                    at = int.from_bytes(node[:8], "little") % WANTED_BITS
                    if bits[at >> 3] >> (at & 7) & 1 and node not in met:
                        if len(met) >= 1 << 20:
                            met.clear()
                        met.add(node)
                        rows[node] = own.tobytes()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.binary()), pa.array(list(rows.values()), pa.binary())], names=["node", "members"])

    return run


def _wanted(nodes: DataFrame) -> bytes:
    """A table of ``WANTED_BITS`` bits, whatever the input, with the bit of every node set."""
    size = WANTED_BITS // 8

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, np.uint8)
        for batch in batches:
            at = (_names(batch.column("node"))[:, 0] % np.uint64(WANTED_BITS)).astype(np.int64)
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        packed = [zlib.compress(x.tobytes(), 1) for x in bits.reshape(-1, SPAN)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(packed)), pa.int32()), pa.array(packed, pa.binary())], names=["span", "bits"])

    def join(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(SPAN, np.uint8)
        for batch in batches:
            for packed in batch.column("bits").to_pylist():
                bits |= np.frombuffer(zlib.decompress(packed), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["span", "bits"])

    rows = nodes.mapInArrow(mark, "span int, bits binary").groupBy("span").applyInArrow(join, "span int, bits binary").collect()
    return b"".join(bytes(r["bits"]) for r in sorted(rows, key=lambda r: r["span"])) or bytes(size)


def _needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of two sets of ``n`` and ``m`` members that links them."""
    return -(-percent * (n + m) // (100 + percent))


class _Lists:
    """Nodes of some lists, and the filters on pairs of them (given as two arrays of rows)."""

    def __init__(self, batch: pa.RecordBatch, percent: int):
        self.percent = percent
        self.n = batch.column("n").to_numpy().astype(np.int64)
        self.place = batch.column("place").to_numpy().astype(np.int64)
        self.parts = np.frombuffer(b"".join(batch.column("parts").to_pylist()), np.uint64).reshape(-1, PARTS // 32)
        self.label = _names(batch.column("label" if "label" in batch.schema.names else "node"))
        self.side = batch.column("side").to_numpy()
        self.nodes = batch.column("node").to_pylist()

    def passing(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, place = self.n, self.place
        a, b = n[i], n[j]
        ok = (self.label[i] != self.label[j]).any(1) & (100 * np.minimum(a, b) >= self.percent * np.maximum(a, b))
        # In a list that two blocks of nodes share, pairs inside a block belong to the block's own list.
        ok &= (self.side[i] != self.side[j]) | (self.side[i] == 0)
        ok &= np.minimum(a - place[i], b - place[j]) >= _needed(a, b, self.percent)
        i, j = i[ok], j[ok]
        ok = np.ones(len(i), bool)
        for k in range(0, len(i), PAIRS):
            part = slice(k, k + PAIRS)
            apart = _apart(self.parts[i[part]], self.parts[j[part]])
            both = n[i[part]] + n[j[part]]
            ok[part] = (both - apart) // 2 >= _needed(n[i[part]], n[j[part]], self.percent)
        return i[ok], j[ok]


def _later(first: int, last: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows ``first`` to ``last`` with every later row before ``end``."""
    i, j = np.meshgrid(np.arange(first, last), np.arange(first, end), indexing="ij")
    return i[j > i], j[j > i]


def _candidates(percent: int, most: int) -> Callable:
    """Rows sorted by list (token, one, two) to candidate pairs, about ``most`` times the rows of a list at most,
    and the rows of lists that come again (``x`` null)."""

    def work(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key = np.column_stack([rows.column(c).to_numpy() for c in ("token", "one", "two")])
        begin, end = _runs(key)
        size = end - begin
        lists = _Lists(rows, percent)
        stop = np.repeat(end, size)
        at = np.flatnonzero(np.repeat(size <= SMALL, size))
        found_i, found_j = [], []
        for step in range(1, SMALL):
            i = at[at + step < stop[at]]
            i, j = lists.passing(i, i + step)
            found_i.append(i)
            found_j.append(j)
        again = []
        for a, b in zip(begin[size > SMALL], end[size > SMALL]):
            k = b - a
            step = max(1, PAIRS // k)  # rows of the list against all later ones
            found = [lists.passing(*_later(r, min(r + step, b), b)) for r in range(a, b, step)]
            i, j = (np.concatenate(x) for x in zip(*found))
            if len(i) > most * k:
                degree = np.bincount(np.concatenate([i, j]) - a, minlength=k)
                hubs = np.zeros(k, bool)
                order = np.argsort(-degree, kind="stable")
                hubs[order[: max(1, int(np.searchsorted(np.cumsum(degree[order]), most * k)))]] = True
                own = hubs[i - a] | hubs[j - a]
                i, j = i[own], j[own]
                again += (a + np.flatnonzero(~hubs)).tolist()
            found_i.append(i)
            found_j.append(j)
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        pairs = {tuple(sorted((lists.nodes[a], lists.nodes[b]))) for a, b in zip(i.tolist(), j.tolist())}
        yield out(rows.slice(0, 0), list(pairs))
        if again:
            yield out(rows.take(pa.array(again)), [])

    def out(rows: pa.RecordBatch, pairs: list[tuple]) -> pa.RecordBatch:
        columns = {"x": pa.array([x for x, _ in pairs], pa.binary()), "y": pa.array([y for _, y in pairs], pa.binary())}
        if rows.num_rows:
            columns = {c: pa.nulls(rows.num_rows, pa.binary()) for c in columns}
        for c, t in (("token", pa.int64()), ("one", pa.int32()), ("two", pa.int32()), ("name", pa.int64()), ("place", pa.int32()), ("side", pa.int32())):
            columns[c] = rows.column(c) if rows.num_rows else pa.nulls(len(pairs), t)
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _joined([*held, batch])
            key = np.column_stack([rows.column(c).to_numpy() for c in ("token", "one", "two")])
            last = int(np.flatnonzero((key != key[-1]).any(1)).max(initial=-1)) + 1
            if last:
                yield from work(rows.slice(0, last))
            held = [rows.slice(last)]
        if held:
            yield from work(held[0])

    return run


_ROUND = "x binary, y binary, token long, one int, two int, name long, place int, side int"


def _verified(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "a"):
                keep = []
                for r, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * common >= percent * (len(a) + len(b) - common):
                        keep.append(r)
                yield batch.select(["x", "y"]).take(pa.array(keep, pa.int64()))

    return run


def _links(listed: DataFrame, nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Verified pairs (``x``, ``y``) that connect what is similar, by rounds over the lists (token, name, place);
    ``nodes``: name, node, n and parts of all that occur there."""
    sizes = listed.groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    dealt = listed.join(sizes, "token").select("token", "name", "place", blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
    # A list of several blocks becomes one list for each block and each two blocks; one block meets each other once.
    spread = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lists = spread.select(
        "token",
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        "name",
        "place",
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
    )
    labels = links = tried = None
    while True:
        described = lists.join(nodes, "name")
        if labels is not None:  # else every node is a component of its own
            now = labels.select(F.col("node").alias("at"), F.col("label"))
            described = described.join(now, F.col("node") == F.col("at"), "left").drop("at").withColumn("label", F.coalesce("label", "node"))
        ordered = described.repartition("token", "one", "two").sortWithinPartitions("token", "one", "two")
        done = materialise(ordered.mapInArrow(_candidates(percent, 1 if labels is None else FURTHER), _ROUND), "candidates")
        pairs = done.filter("x is not null").select("x", "y").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["x", "y"], "left_anti")
        pairs = materialise(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        lists = done.filter("x is null").select("token", "one", "two", "name", "place", "side")
        sets = sets_of(pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct())
        a, b = (sets.select(F.col("node").alias(c), F.col("members").alias(m)) for c, m in (("x", "a"), ("y", "b")))
        found = materialise(pairs.join(a, "x").join(b, "y").mapInArrow(_verified(percent), "x binary, y binary"), "found")
        links = found if links is None else links.unionByName(found)
        if lists.isEmpty():
            return links
        labels = connected(links)


def _grouped(docs: DataFrame, ident: str, text: str, width: int, percent: int, buckets: int) -> DataFrame:
    """Per row of ``docs``: ``doc``, ``text_hash``, ``n`` and ``component`` (a node's name; null without words)."""
    spark = docs.sparkSession
    rows = docs.select(docs[ident].alias("doc"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("text_hash"))
    doc_type = docs.schema[ident].dataType.simpleString()
    schema = f"doc {doc_type}, text_hash long, name long, node binary, n long, parts binary, span int, counts binary"
    described = materialise(rows.mapInArrow(_described(width, buckets), schema), "described")
    table = spark.sparkContext.broadcast(_frequencies(described, buckets))
    posting = "token long, name long, n int, place int"
    posted = rows.select("text").mapInArrow(_postings(width, percent, table), posting)
    by_token = posted.repartition("token").sortWithinPartitions("token", "name")
    listed = materialise(by_token.mapInArrow(_shared, posting).mapInArrow(_hopeful(percent), posting), "lists").drop("n")

    def sets_of(chosen: DataFrame) -> DataFrame:
        """The sets of the chosen nodes, from the texts: they are read once more in each round, and the
        partitions by node are those of the joins with the pairs, so nothing is written for them."""
        wanted = spark.sparkContext.broadcast(_wanted(chosen))
        sets = rows.select("text").mapInArrow(_sets(width, wanted), "node binary, members binary")
        return sets.join(chosen, "node", "left_semi").dropDuplicates(["node"])

    met = listed.select("name").distinct()
    members = described.filter("span is null").select("doc", "text_hash", "name", "node", "n", "parts")
    nodes = materialise(members.select("name", "node", "n", "parts").join(met, "name", "left_semi").dropDuplicates(["node"]), "nodes")
    labels = connected(_links(listed, nodes, sets_of, percent)).withColumnRenamed("node", "at")
    component = F.when(F.col("n") > 0, F.coalesce("label", "node"))
    return members.join(labels, F.col("node") == F.col("at"), "left").select("doc", "text_hash", "n", component.alias("component"))


def near_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: ``ident``, ``n_shingles`` (size of its set) and ``component_id``, the
    smallest identifier reachable by links.

    Two documents link when 100 * intersection >= percent * union of their sets
    of ``width``-word shingles (words cut at ASCII white space, A-Z
    lower-cased).  A text with fewer words is one shingle; one without words,
    or null, has none and links with nothing.  Rows that repeat an identifier
    each link by their own text.  A null identifier names a component only
    where it has no other.
    """
    placed = materialise(_grouped(docs, ident, text, width, percent, buckets), "placed")
    # Written, so that the join has a shuffle of its own on either side and a component of many rows can be split.
    smallest = materialise(placed.filter("n > 0").groupBy("component").agg(F.min("doc").alias("component_id")), "smallest")
    named = placed.join(smallest, "component", "left")
    return named.select(
        F.col("doc").alias(ident), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each component (see ``near_copies``) the document with the
    smallest identifier, a null one last; of equal identifiers the text with the smallest hash.  Texts without words
    stay, and so do all rows that repeat identifier and text of one that stays."""
    placed = materialise(_grouped(docs, ident, text, width, percent, buckets).filter("n > 0"), "placed")
    order = F.struct(F.col("doc").isNull().alias("last"), "doc", "text_hash")
    first = materialise(placed.groupBy("component").agg(F.min(order).alias("first")), "first")
    gone = placed.join(first, "component").filter(order != F.col("first")).select(F.col("doc").alias("d"), F.col("text_hash").alias("h")).distinct()
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[ident].alias("i"), F.xxhash64(docs[text]).alias("x"))
    stay = rows.join(gone, F.col("i").eqNullSafe(F.col("d")) & (F.col("x") == F.col("h")), "left_anti")
    return stay.select(*(F.col("row")[c].alias(c) for c in docs.columns))
