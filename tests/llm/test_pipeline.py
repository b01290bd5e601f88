"""The corpus pipeline, stage by stage, on the smallest table; and its edge cases."""

from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

from llm_helpers import SF, docs  # noqa: F401
import corpus_pipeline as P
from sensorlake.llm import quality_rules as Q
from sensorlake.llm.mixing import draws
from sensorlake.llm.pieces import processor
from test_jaccard_join import brute as near_groups
from test_quality_rules import brute as rule_counts


def stage_rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, stage_rows(docs)

    good = P.keep_quality(spark, docs, SF).cache()
    assert good.columns == columns
    stay = stage_rows(good)
    stats = Q.with_statistics(docs.select("doc_id", "text"))
    rules = Q.fit(stats, spark.read.parquet(f"{SF}/labels.parquet"))
    verdict = {r["doc_id"]: r["kept"] for r in Q.judge(stats, rules).collect()}
    assert sorted(stay) == sorted(x for x in given if verdict[x[0]])
    for _, t in stay:
        n, _, _, _, repeated = rule_counts(t)
        assert n >= 20 and 100 * repeated <= 30 * n

    once = P.keep_distinct(spark, good, SF).cache()
    assert once.columns == columns
    last = {}
    for i, t in stay:
        last[t] = max(i, last.get(t, i))
    assert sorted(stage_rows(once)) == sorted((i, t) for t, i in last.items())

    apart = P.keep_dissimilar(spark, once, SF).cache()
    assert apart.columns == columns
    kept = sorted(stage_rows(once))
    _, tops = near_groups([t for _, t in kept], 5, 80)
    first = {}
    for x, g in zip(kept, tops):
        first.setdefault(g, x)
    assert sorted(stage_rows(apart)) == sorted(first.values())

    mixed = P.mix_sources(spark, apart, SF).cache()
    assert mixed.columns == columns
    shards = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    times = {r["doc_id"]: len(r["drawn"]) for r in draws(apart, shards=shards).collect()}
    assert Counter(stage_rows(mixed)) == +Counter({x: times[x[0]] for x in first.values()})

    sp = processor(public_tokenizers.path(P.VOCABULARY))
    coded = P.encode(spark, mixed, SF).collect()
    text = dict(given)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in coded) == sorted((i, len(sp.encode(text[i]))) for i, _ in stage_rows(mixed))


def test_run_gives_the_rows_of_the_stages(spark):
    rows = P.run(spark, SF).collect()
    again = P.run(spark, SF).collect()
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert [n for n, _ in P.STAGES] and len(P.STAGES) in (4, 5)


def test_stages_on_nulls_repeats_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(5).unionByName(docs.limit(5)).unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    odd = odd.unionByName(docs.limit(4).withColumn("doc_id", F.lit(None).cast("long")).withColumn("source", F.lit(None).cast("string")))
    odd = odd.withColumn("score", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("digest", F.lit("d"))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and out.count() <= 3 * odd.count(), name
        assert stage(spark, odd.limit(0), SF).count() == 0
    assert P.encode(spark, odd, SF).count() == odd.count()
