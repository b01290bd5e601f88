"""Thin queries over the operators: one ``opN_<name>`` each, on its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.chat_format import format_chats, read_back
from sensorlake.llm import exact_dedup, filter_audit, lm_scoring, mixing, packing, periodic_runs, quality_rules
from sensorlake.llm.common import materialise, table
from sensorlake.llm.jaccard_join import near_copies
from sensorlake.llm.line_dedup import LineIndex
from sensorlake.llm.pii import BASE, find_pii
from sensorlake.llm.sentencepiece_codec import encode_decode
from sensorlake.llm.token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "piece_bpe_32k.model"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = count_tokens(docs, public_tokenizers.path(VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "n_parts", "n_widened")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    case = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = format_chats(turns.unionByName(case))
    back = read_back(chats.select("conv_id", "formatted", "loss_spans", F.length("formatted").cast("long").alias("formatted_chars")), keep=("formatted_chars",))
    said_by_turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said_by_turn, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = materialise(quality_rules.with_statistics(docs), "statistics")
    rules = quality_rules.fit(stats, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(stats, rules)
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "score")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, percent=85)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _name_if(kind: str) -> Callable:
    return lambda s: F.when(s["kind"] == kind, kind).otherwise("")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of_kind = {k: F.transform("pii_base", _name_if(k)) for k in BASE}
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *(F.size(F.array_remove(kinds, "")).cast("long").alias(f"n_{k}") for k, kinds in of_kind.items()),
        F.sha2(written(F.col("pii_base")), 256).alias("base_sha256"),
        written(F.concat("pii_base", "pii_added")).alias("spans"),
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_scoring.score(docs, docs.filter(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = LineIndex.build(docs, min_docs=3, min_chars=20).clean(docs)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draws(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    shards = F.array_join(F.transform("drawn", lambda d: F.concat_ws(":", d["epoch"], d["shard"])), ",")
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("drawn")).alias("taken"), shards.alias("shards"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(BYTE_VOCABULARY), end_id=1, columns={"ids_crc32": F.crc32})


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's planted tails: in one document of ten the words from some place on repeat the first of them."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g, i = h // 10, np.arange(n)
    a = g % n
    return np.where(i >= a, a + (i - a) % (1 + (n - a) // (3 + g % 8)), i)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), reorder=periodic_tail)
    of = lambda r, *names: F.concat_ws(",", *(r[x].cast("string") for x in names))
    written = F.transform("runs", lambda r: F.concat(of(r, "start", "length", "period"), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return found.select("doc_id", "n_words", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_audit.text_masks(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return filter_audit.audit(filter_audit.mask_counts(masks, table(spark, sf_dir, "labels")))


def registry() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_chat_format": op2_chat_format,
        "op3_quality_rules": op3_quality_rules,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_pii": op6_pii,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_line_dedup": op9_line_dedup,
        "op10_mixing": op10_mixing,
        "op11_packing": op11_packing,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_filter_audit": op13_filter_audit,
    }


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": _OP2,
        "op13_filter_audit": _OP13,
        "op5_exact_dedup": """
            SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, g.h AS text_sha256
            FROM (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents) d
            JOIN (SELECT sha256(coalesce(text, '')) AS h, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1) g
            ON d.h = g.h
        """,
        "op9_line_dedup": f"""
            WITH split AS (
                SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
            keyed AS (SELECT doc_id, i, line, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM split),
            many AS (SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
            marked AS (SELECT doc_id, i, line, many.k IS NOT NULL AND doc_id <> owner AS gone FROM keyed LEFT JOIN many USING (k))
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
                   sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
            FROM marked GROUP BY doc_id
        """,
    }


_OP2 = r"""
    WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
    escaped AS (SELECT *,
        replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/') AS body,
        replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/') AS head,
        lag(role) OVER w IS DISTINCT FROM role AS first
        FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length(body) + 7 + CASE WHEN first THEN 4 + length(head) + 7 + 1 ELSE 0 END) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id
"""


_OP13 = r"""
    WITH said AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad FROM labels GROUP BY doc_id),
    split AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    marked AS (SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, {
        'A': len(words) < 50,
        'B': 100 * len(list_distinct(words)) < 65 * len(words),
        'C': 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body),
        'D': regexp_matches(body, '[#$%&*|]'),
        'E': coalesce(split.doc_id > min(split.doc_id) OVER (PARTITION BY body), FALSE)} AS f
        FROM split LEFT JOIN said ON split.doc_id = said.doc_id),
    masked AS (SELECT part, (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END) || (CASE WHEN f.C THEN 'C' ELSE '' END)
        || (CASE WHEN f.D THEN 'D' ELSE '' END) || (CASE WHEN f.E THEN 'E' ELSE '' END) AS mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad
        FROM marked GROUP BY 1, 2),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    steps AS (SELECT o, s, substr(o, s, 1) AS x FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
    removal AS (SELECT part, mask, n, good, bad, o,
        coalesce((SELECT min(instr(o, substr(mask, k, 1))) FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE k <= length(mask)), 6) AS at FROM masked, orders),
    counted AS (SELECT r.part, t.o, t.s, t.x,
        sum(CASE WHEN r.at > t.s THEN n ELSE 0 END) AS kept, sum(CASE WHEN r.at = t.s THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN r.at < t.s AND instr(r.mask, t.x) > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN r.mask = t.x THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN r.at = t.s THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN r.at = t.s THEN bad ELSE 0 END) AS toxic_lost
        FROM removal r JOIN steps t ON r.o = t.o GROUP BY 1, 2, 3, 4)
    SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
        CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
        CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
    FROM counted
"""
