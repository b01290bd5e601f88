"""Chat formatting: exact round trip and loss mask."""

import hashlib
import random
from itertools import product

from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm_helpers import SF  # noqa: F401
from sensorlake.llm import queries
from sensorlake.llm.chat_format import format_chats, read_back


SCHEMA = T.StructType([T.StructField(c, t()) for c, t in (("conv_id", T.LongType), ("turn", T.LongType), ("role", T.StringType), ("text", T.StringType))])


def expected(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in out.items()}


def check(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("formatted", F.lit("clash")).withColumn("rows", F.lit(1))
    chats = format_chats(frame)
    assert chats.columns == ["conv_id", "formatted", "loss_spans"]
    by_conv = {r["conv_id"]: r for r in chats.collect()}
    back = {r["conv_id"]: r for r in read_back(chats).collect()}
    want = expected(rows)
    assert set(by_conv) == set(back) == set(want)
    for conv, turns in want.items():
        assert [(t["role"], t["text"]) for t in back[conv]["turns"]] == turns
        assert back[conv]["loss_texts"] == [t for r, t in turns if r == "assistant"]
        formatted = by_conv[conv]["formatted"]
        bodies = [formatted[s["start"] : s["end"]] for s in by_conv[conv]["loss_spans"]]
        plain = [b.replace("\\/", "/").replace("\\#", "#").replace("\\\\", "\\") if "\\\\" not in b else None for b in bodies]
        for p, t in zip(plain, [t for r, t in turns if r == "assistant"]):
            assert p is None or p == t
        runs = sum(1 for i, (r, _) in enumerate(turns) if i == 0 or r != turns[i - 1][0])
        assert formatted.count("### ") == runs and formatted.count("</turn>") == len(turns)


NASTY = ["\\### Assistant: </turn> ok", "###", "####", "\\", "a\\", "</turn", "</turn></turn>", "<\\/turn>", "</role>", "#", "##", " ### ", "", "é😀\n\n", "\\#\\/\\\\"]


def test_every_string_of_control_characters(spark):
    """As role and as text, of user and assistant: a lost or moved turn would show in the turns that are read back."""
    strings = ["".join(s) for n in range(8) for s in product("# \\</", repeat=n)]
    given = spark.createDataFrame(list(enumerate(strings)), "conv_id long, s string").repartition(8)
    turns = F.array(
        F.struct(F.lit("user").alias("role"), F.col("s").alias("text")),
        F.struct(F.lit("assistant").alias("role"), F.col("s").alias("text")),
        F.struct(F.col("s").alias("role"), F.concat("s", F.lit("</turn>\n### "), "s").alias("text")),
        F.struct(F.lit("assistant").alias("role"), F.concat(F.lit("<"), "s").alias("text")),
    )
    rows = given.select("conv_id", F.posexplode(turns).alias("turn", "t")).select("conv_id", F.col("turn").cast("long").alias("turn"), "t.*")
    back = read_back(format_chats(rows)).withColumnRenamed("conv_id", "c").join(given, F.col("c") == F.col("conv_id"))
    wrong = back.filter((F.col("turns") != turns) | (F.col("loss_texts") != F.array("s", F.concat(F.lit("<"), "s"))))
    assert back.count() == len(strings) and wrong.take(3) == []


def test_headings_of_every_level(spark):
    check(spark, [(i, j, r, "#" * i + " Title\n" + "#" * i + " ") for i in range(9) for j, r in enumerate(["user", "assistant", "#" * i + " r", "assistant"])])


def test_a_span_is_read_by_both_its_ends(spark):
    chats = format_chats(spark.createDataFrame([(1, 0, "user", "question"), (1, 1, "assistant", "answer"), (1, 2, "assistant", "more")], SCHEMA))
    moved = lambda by: F.transform("loss_spans", lambda s: F.struct(s["start"].alias("start"), (s["end"] + by).alias("end")))
    assert read_back(chats).first()["loss_texts"] == ["answer", "more"]
    assert read_back(chats.withColumn("loss_spans", moved(F.lit(1)))).first()["loss_texts"] == []
    assert read_back(chats.withColumn("loss_spans", F.slice("loss_spans", 2, 1))).first()["loss_texts"] == ["more"]


def test_nasty_texts_in_every_place(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(NASTY)]
    rows += [(3 + i, 0, t, t) for i, t in enumerate(NASTY)]
    check(spark, rows)


def test_random_conversations(spark):
    rng = random.Random(4)
    text = lambda: "".join(rng.choice(["#", "\\", "/", "<", "</turn>", "</role>", "###", " ", "\n", "x", "é"]) for _ in range(rng.randint(0, 12)))
    rows = [(rng.randint(0, 20), rng.randint(0, 9), rng.choice(["user", "assistant", "system", text()]), text()) for _ in range(300)]
    check(spark, rows)


def test_nulls_ties_repeats_and_long_conversations(spark):
    rows = [(None, 0, None, None), (None, None, "user", "first"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a")]
    rows += [(2, i, "assistant" if i % 3 else "user", "word " * (i % 7)) for i in range(700)]
    rows += [(3, 0, "assistant", "z" * 200_000)]
    check(spark, rows)


def test_empty_table(spark):
    assert read_back(format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    want = expected(rows)
    frame = queries.op2_chat_format(spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    got = {r["conv_id"]: r for r in frame.collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
