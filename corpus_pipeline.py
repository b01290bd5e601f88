"""The corpus pipeline: documents that pass the quality rules, without copies and near copies,
mixed to the sources' target weights and encoded.

``STAGES`` holds ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and works on all that its predecessor kept.  Between two stages the
documents are written as Parquet and read again.  Every stage but the last
returns the columns of ``docs``; an empty table passes through all of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import exact_dedup, jaccard_join, mixing
from sensorlake.llm import quality_rules as rules
from sensorlake.llm.common import materialise, prepare, table
from sensorlake.llm.sentencepiece_codec import encode_decode

VOCABULARY = "piece_bpe_32k.model"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go; null and empty texts have too few words."""
    prepare(spark)
    stats = materialise(rules.with_statistics(docs.select("doc_id", "text")), "statistics")
    return rules.keep_good(docs, rules.fit(stats, table(spark, sf_dir, "labels")))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest ``doc_id`` stays."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def keep_dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles the one with the smallest ``doc_id`` stays."""
    prepare(spark)
    return jaccard_join.keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, dealt to as many output shards as there are shuffle partitions, 16 at least."""
    prepare(spark)
    return mixing.mix(docs, shards=max(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per mixed row: its ids and the digest of its decoded text."""
    prepare(spark)
    coded = encode_decode(docs.select("doc_id", "source", "text"), public_tokenizers.path(VOCABULARY))
    return coded.select(
        "doc_id",
        "source",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", keep_quality),
    ("exact dedup", keep_distinct),
    ("n-gram Jaccard join", keep_dissimilar),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode),
]

#: Forest, tries, link components and hypergeometric draws are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def registry() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
