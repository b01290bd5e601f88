"""Mixing sources to target weights by a splitting tree of exact block quotas.

Each source's documents are dealt by hash into blocks.  A source draws from
its blocks in permuted order, through all of them once before any is drawn
again (an epoch), as many as its target needs; of the block in which the
target falls it draws documents, again in permuted order, up to the target.
The numbers of blocks are exact quotas.  They are divided among the output
shards by a binary tree: at each node the left half receives a multivariate
hypergeometric share of every source's quota, as if the drawn blocks had been
shuffled as a whole and cut in two.  A shard's share of a source is the next
run of that source's permuted blocks, so the shards' blocks are disjoint; a
shard shuffles what it holds by itself.

Block sums, permutations and running totals are Spark aggregates and windows;
only the quotas, one number a source, pass through the driver, and the sources
are ranked in one task: there may be up to ``MOST_SOURCES`` of them, which is
checked.  Finer keys than that (a page's address) are no sources to be weighed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.common import materialise, slices, utf8

#: No document is drawn more often.
EPOCHS = 3
#: Blocks into which each source is dealt, at least; a block that the target cuts is divided by documents.
BLOCKS = 1024
#: Documents of a block on the average, at most: with more documents there are more blocks.
BLOCK_ROWS = 1 << 16
#: Sources that are mixed.
MOST_SOURCES = 100_000


def blocks_for(rows: int) -> int:
    """A power of two of blocks, ``BLOCKS`` at least, so that a source with all rows has ``BLOCK_ROWS`` in each at most."""
    return max(BLOCKS, 1 << max(0, -(-rows // BLOCK_ROWS) - 1).bit_length())


def n_words(texts: pa.Array) -> pa.Array:
    """Runs of bytes other than ASCII white space."""
    return pa.array([len(x.split()) for x in utf8(texts)], pa.int64())


def sized(docs: DataFrame, text: str = "text", name: str = "size") -> DataFrame:
    """``docs`` without ``text``, with its number of words."""
    kept = [c for c in docs.columns if c not in (text, name)]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), n_words(batch.column(text))], names=[*kept, name])

    return docs.select(*(docs[c] for c in [*kept, text])).mapInArrow(run, schema)


def targets(sizes: DataFrame, share: float = 1.0) -> DataFrame:
    """``source``, ``source_size``, ``weight`` and ``target`` from one row per source (``source``, ``source_size``).

    Sources in code point order, null last, weigh 1, 2, 3, repeating, and share
    ``share`` of all sizes; a target stops at ``EPOCHS`` times its source's size
    and the excess is shared again by weight.  In closed form: with the sources
    in order of limit over weight, those before some place are at their limit,
    and the rest share by weight what those leave; the place is the first whose
    source the shared rate no longer fills.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weighed = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("long"))
    limit = F.col("source_size") * EPOCHS
    ranked = weighed.withColumn("limit", limit).withColumn("full_at", limit / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").isNull(), F.encode("source", "utf-8"))
    every = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(every) * F.lit(share) - (F.sum("limit").over(before) - F.col("limit"))
    weight_left = F.sum("weight").over(every) - (F.sum("weight").over(before) - F.col("weight"))
    rated = ranked.withColumn("rate", (left / weight_left).cast("double"))
    shared = F.max(F.when(F.col("rate") < F.col("full_at"), F.col("rate"))).over(every)
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("weight") * shared, F.col("limit").cast("double")))
    return rated.select("source", "source_size", "weight", target.alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """``shards`` rows that sum to ``quotas``: the splitting tree."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(node: int, first: int, count: int, have: np.ndarray) -> None:
        if count == 1:
            out[first] = have
            return
        left = count // 2
        part = np.random.default_rng([seed, node]).multivariate_hypergeometric(have, int(have.sum()) * left // count, method="marginals")
        split(2 * node, first, left, part)
        split(2 * node + 1, first + left, count - left, have - part)

    split(1, 0, shards, quotas.astype(np.int64))
    return out


def _unit(seed: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


#: Rows of the plan (sources times blocks) up to which it is sent to every task instead of being joined by a shuffle of the texts.
PLAN_ROWS = 200_000


def _placed(docs: DataFrame, ident: str, blocks: int, seed: int) -> DataFrame:
    """``docs`` with each row's ``_block`` and its ``_order`` inside the block."""
    return docs.withColumns(
        {"_block": F.pmod(_unit(seed, docs[ident]), F.lit(blocks)).cast("int"), "_order": _unit(seed + 2, docs[ident])}
    )


def _plan(placed: DataFrame, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """What is drawn, from rows (``ident``, ``source``, ``size``, ``_block``, ``_order``): per source and block
    ``drawn`` (epoch and shard of each time), and where the target falls in the block ``cut_one`` and the
    highest ``_order`` that is taken, ``cut_at``; and the sources' sizes and targets."""
    spark = placed.sparkSession
    source_type = placed.schema["source"].dataType
    sums = materialise(placed.groupBy("source", "_block").agg(F.sum("size").alias("size")), "block-sizes")
    shares = materialise(targets(sums.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")

    by_source = sums.join(shares.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    epochs = by_source.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))))
    turn = Window.partitionBy("source").orderBy("epoch", _unit(seed + 1, F.col("epoch"), F.col("_block")), "_block")
    order = epochs.withColumn("until", F.sum("size").over(turn)).withColumn("nth", F.row_number().over(turn))
    drawn = order.filter(F.col("until") - F.col("size") < F.col("target")).withColumn("whole", F.col("until") <= F.col("target"))

    by_quota = drawn.groupBy("source").agg(F.max("nth").cast("long").alias("quota")).orderBy(F.col("source").isNull(), "source")
    quotas = by_quota.limit(MOST_SOURCES + 1).collect()
    if len(quotas) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    shares_of = split_quotas(np.array([q["quota"] for q in quotas], np.int64), shards, seed) if quotas else np.zeros((shards, 0), np.int64)
    ends = spark.createDataFrame(
        [(q["source"], np.cumsum(shares_of[:, i]).tolist()) for i, q in enumerate(quotas)],
        T.StructType([T.StructField("s", source_type), T.StructField("ends", T.ArrayType(T.LongType()))]),
    )
    sharded = drawn.join(ends, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "shard", F.size(F.filter("ends", lambda e: e < F.col("nth"))).cast("int")
    )
    one = F.struct("epoch", "shard")
    by_block = sharded.groupBy("source", "_block").agg(
        F.sort_array(F.collect_list(F.when(F.col("whole"), one))).alias("drawn"),
        F.max(F.when(~F.col("whole"), F.struct(one.alias("one"), (F.col("target") - F.col("until") + F.col("size")).alias("room")))).alias("cut"),
    )
    by_block = materialise(by_block, "blocks")
    cut = by_block.filter("cut is not null").select(F.col("source").alias("s"), F.col("_block").alias("b"), "cut.room")
    inside = Window.partitionBy("source").orderBy("_order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = placed.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("_block") == F.col("b"))).withColumn("until", F.sum("size").over(inside))
    # The document in which the target falls comes along when that brings the sum nearer to it.
    taken = reached.filter(F.col("until") - F.col("size") / 2 <= F.col("room"))
    highest = taken.groupBy(F.col("source").alias("s"), F.col("_block").alias("b")).agg(F.max("_order").alias("cut_at"))
    plan = by_block.join(highest, F.col("source").eqNullSafe(F.col("s")) & (F.col("_block") == F.col("b")), "left").drop("s", "b")
    return materialise(plan.withColumn("cut_one", F.col("cut.one")).drop("cut"), "plan"), shares


def _drawn(rows: DataFrame, plan: DataFrame, source: str) -> DataFrame:
    """``rows`` (with ``_block`` and ``_order``) with ``_drawn``: an array of (epoch, shard)."""
    keyed = plan.select(F.col("source").alias("_s"), F.col("_block").alias("_b"), F.col("drawn").alias("_whole"), "cut_one", "cut_at")
    if plan.count() <= PLAN_ROWS:
        keyed = F.broadcast(keyed)
    joined = rows.join(keyed, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")), "left")
    none = F.array().cast(plan.schema["drawn"].dataType)
    part = F.when(F.col("_order") <= F.col("cut_at"), F.array("cut_one")).otherwise(none)
    return joined.withColumn("_drawn", F.concat(F.coalesce("_whole", none), part)).drop("_s", "_b", "_whole", "cut_one", "cut_at")


def _sizes(docs: DataFrame, ident: str, source: str, text: str, blocks: int | None, seed: int) -> tuple[DataFrame, int]:
    """Every row's source, size and place, and the number of blocks."""
    named = docs.select(docs[ident].alias("ident"), docs[source].alias("source"), docs[text].alias("text"))
    sizes = materialise(sized(named), "sizes")
    blocks = blocks or blocks_for(sizes.count())
    return _placed(sizes, "ident", blocks, seed), blocks


def draws(docs: DataFrame, ident: str = "doc_id", source: str = "source", text: str = "text", shards: int = 64, seed: int = 11, blocks: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``ident``, ``source``, ``size``, ``source_size``, ``target``
    and ``drawn``, an array of (epoch, shard), one element for each time that the mix takes the document.

    Null text has size 0; a null source is a source of its own, the last; a
    null identifier is hashed like others.  Rows that repeat an identifier share
    their place and are drawn together.  Documents of size 0 cost nothing and
    are drawn with their block.  Reruns agree.
    """
    placed, _ = _sizes(docs, ident, source, text, blocks, seed)
    plan, shares = _plan(placed, shards, seed)
    info = shares.select(F.col("source").alias("s"), "source_size", "target")
    known = _drawn(placed, plan, "source").join(info, F.col("source").eqNullSafe(F.col("s")))
    return known.select(F.col("ident").alias(ident), F.col("source").alias(source), "size", "source_size", "target", F.col("_drawn").alias("drawn"))


def mix(
    docs: DataFrame,
    ident: str = "doc_id",
    source: str = "source",
    text: str = "text",
    shards: int = 64,
    seed: int = 11,
    blocks: int | None = None,
    shard: str | None = None,
) -> DataFrame:
    """The mixed rows with the columns of ``docs``, a row as often as it is drawn, dealt to the output
    shards and shuffled inside each.  See ``draws``.  ``shard``: name of a further column with the shard's number.

    A shard is one partition.  What is drawn depends on a row's source and hash
    and on the plan alone, so the texts are moved once, to their shards.  Null
    and empty texts have size 0 and go with their block."""
    if shard in docs.columns:
        raise ValueError(f"column name in use: {shard}")
    placed, blocks = _sizes(docs, ident, source, text, blocks, seed)
    plan, _ = _plan(placed, shards, seed)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), docs[ident].alias("_ident"), docs[source].alias("_source"))
    taken = _drawn(_placed(rows, "_ident", blocks, seed), plan, "_source").select("_row", "_ident", F.explode("_drawn").alias("_one"))
    dealt = taken.repartitionById(shards, F.col("_one.shard")).sortWithinPartitions(_unit(seed + 3, F.col("_one.epoch"), F.col("_ident")))
    return dealt.select(*(F.col("_row")[c].alias(c) for c in docs.columns), *([F.col("_one.shard").alias(shard)] if shard else []))
