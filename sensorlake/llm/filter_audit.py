"""Audit of how document filters act on each other, over every order in which they can be applied.

Each document has a mask: one bit for each filter that it fails.  Of the
documents only the counts by part and mask are needed, at most 2^m rows a part
for m filters.  The audit of a part is then matrix work: a mask matrix (0
where the filter fails, m elsewhere) and the matrix of each filter's position
in each order (the inverse permutations) are combined by the min-plus
product, whose entry (mask, order) is the step at which that order removes the
documents of that mask.  Scattering the counts by (order, step) gives what each
step removes; a filter's failures that were removed before its own step are its
redundancies.

Whether a text repeats an earlier one is asked of the text's digest, by
aggregates: rows that share text, part and identifier are counted first, then
the smallest identifier of each text and part, then that of the text.  No task
gets the rows of one text, only one row for each of its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.common import slices, utf8

#: The filters, a bit each: too few words, too few distinct words, capitals, symbols, a copy of an earlier text.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COPY = 1 << FILTERS.index("E")
#: Orders are enumerated: m! of them.
MOST_FILTERS = 8


def _mask(text: bytes, length: int) -> int:
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * length,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def text_masks(docs: DataFrame, ident: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``ident``, ``part``, ``digest`` (SHA-256 of the text) and ``mask`` of the filters that judge a text alone, one row per row.

    Null text counts as empty (which has too few words); a null part is the empty string."""
    kept = docs.select(docs[ident].alias("ident"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), docs[text].alias("text"))
    schema = T.StructType([*kept.schema.fields[:2], T.StructField("digest", T.BinaryType()), T.StructField("mask", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = utf8(batch.column("text"))
                lengths = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
                masks = pa.array([_mask(t, n) for t, n in zip(texts, lengths)], pa.int32())
                digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("ident"), batch.column("part"), digests, masks], names=schema.names)

    return kept.mapInArrow(run, schema)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` and the counts ``n``, ``good``, ``toxic`` of documents, from ``text_masks`` and ``labels``
    (``doc_id``, ``quality``, ``toxic``), with the copies' bit set.

    A copy has a smaller identifier's text.  Rows without identifier are no
    copies, and nothing is a copy of them; rows that repeat an identifier are
    each as much a copy as the others.  A document that is labelled several
    times is good, or toxic, if one label says so; null labels say nothing."""
    once = masks.groupBy("ident", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    said = labels.groupBy(labels["doc_id"].alias("labelled")).agg(
        F.max((F.coalesce(labels["quality"] == 1, F.lit(False))).cast("long")).alias("q"),
        F.max((F.coalesce(labels["toxic"] == 1, F.lit(False))).cast("long")).alias("t"),
    )
    known = once.join(said, F.col("ident") == F.col("labelled"), "left")
    counted = known.select(
        "ident", "digest", "part", "mask", "n", (F.col("n") * F.coalesce("q", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("t", F.lit(0))).alias("toxic")
    )
    counts = ("n", "good", "toxic")
    own = F.struct("ident", *counts)
    by_text = counted.groupBy("digest", "part", "mask").agg(
        *(F.sum(c).alias(c) for c in counts),
        F.min(F.when(F.col("ident").isNotNull(), own)).alias("least"),
        *(F.sum(F.when(F.col("ident").isNull(), F.col(c)).otherwise(0)).alias(f"{c}_unnamed") for c in counts),
    )
    first = by_text.withColumn("first", F.min("least.ident").over(Window.partitionBy("digest")))
    originals = [
        (F.when(F.col("least.ident") == F.col("first"), F.col(f"least.{c}")).otherwise(0) + F.col(f"{c}_unnamed")).alias(c) for c in counts
    ]
    split = first.select(
        "part",
        F.explode(
            F.array(
                F.struct(F.col("mask"), *originals),
                F.struct(F.col("mask").bitwiseOR(COPY).alias("mask"), *((F.col(o_name) - o).alias(o_name) for o_name, o in zip(counts, originals))),
            )
        ).alias("side"),
    ).select("part", "side.*")
    return split.filter("n > 0").groupBy("part", "mask").agg(*(F.sum(c).cast("long").alias(c) for c in counts))


def orders_of(m: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of ``m`` filters (rows), and the inverse permutations: each filter's position in each order."""
    if not 1 <= m <= MOST_FILTERS:
        raise ValueError(f"from 1 to {MOST_FILTERS} filters, not {m}: every order is looked at")
    orders = np.array(list(permutations(range(m))), np.int64)
    return orders, np.argsort(orders, axis=1)


def min_plus(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The min-plus product: the least of ``left[i, k] + right[k, j]`` over k."""
    return (left[:, :, None] + right[None, :, :]).min(axis=1)


def audit_counts(masks: np.ndarray, counts: np.ndarray, m: int) -> dict[str, np.ndarray]:
    """From masks and their counts (columns all, good, toxic): for each order (row) and step (column) ``kept``,
    ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``."""
    orders, position = orders_of(m)
    fails = (masks[:, None] >> np.arange(m)) & 1
    # 0 where the filter fails, m elsewhere: a mask without failures is removed at step m or later, that is never.
    removal = np.minimum(min_plus((1 - fails) * m, position.T), m)
    lost = np.zeros((3, len(orders), m + 1), np.int64)
    order = np.broadcast_to(np.arange(len(orders)), removal.shape)
    for k in range(3):
        np.add.at(lost[k], (order, removal), counts[:, k, None])
    removed, good, toxic = lost[:, :, :m]
    redundant = np.zeros_like(removed)
    shapley = np.zeros(m, np.int64)
    for f in range(m):
        earlier = (removal < position[:, f]) & (fails[:, f, None] == 1)
        redundant[np.arange(len(orders)), position[:, f]] = (earlier * counts[:, 0, None]).sum(0)
        shapley[f] = removed[np.arange(len(orders)), position[:, f]].sum()
    alone = np.array([counts[masks == 1 << f, 0].sum() for f in range(m)], np.int64)
    return {
        "kept": counts[:, 0].sum() - removed.cumsum(1),
        "removed": removed,
        "redundant": redundant,
        "unique_fails": alone[orders],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": shapley[orders],
    }


MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order of ``filters`` and step, zeros included, from ``mask_counts``: ``part``, ``filter_order``
    (letters), ``step`` (from 1; its filter is that letter), ``kept`` after it, ``removed`` by it, ``redundant`` (failing
    its filter, removed earlier), ``unique_fails`` (failing its filter only), ``good_lost``, ``toxic_lost`` and ``shapley``
    (what its filter removes, summed over all orders).  Without documents there is no part and no row."""
    m = len(filters)
    names = ["".join(filters[f] for f in o) for o in orders_of(m)[0]]
    schema = T.StructType(
        [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in MEASURES]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = pa.array([name for name in names for _ in range(m)])
        step = pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(names)))
        for batch in batches:
            for row in batch.to_pylist():
                found = np.array([[c["mask"], c["n"], c["good"], c["toxic"]] for c in row["counts"]], np.int64)
                measures = audit_counts(found[:, 0], found[:, 1:], m)
                part = pa.array([row["part"]] * len(order), pa.string())
                yield pa.RecordBatch.from_arrays([part, order, step, *(pa.array(measures[c].ravel()) for c in MEASURES)], names=schema.names)

    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return by_part.mapInArrow(run, schema)
