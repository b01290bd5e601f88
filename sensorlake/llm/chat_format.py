r"""Chat formatting as relational expressions.

The turns of a conversation are collected as structs and sorted; turns that
follow each other with the same role are merged under one header, and all is
concatenated by Spark's own array and string functions::

    ### user</role>first text</turn>second text</turn>
    ### assistant</role>answer</turn>

Inside roles and texts ``\`` is written ``\\``, ``#`` is written ``\#`` and
``</`` is written ``<\/``, so neither two hashes in a row nor the beginning of
a closing mark occurs in them, and taking away the backslash before each
escaped character restores them.  The loss mask is the list of code point spans
of the trained bodies inside the formatted text.

A conversation becomes one text, so its turns meet in one row by definition;
nothing larger than a conversation is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import prefix_sums

HEADER, ROLE_END, TURN_END, RUN_END = "### ", "</role>", "</turn>", "\n"


def escape(text: Column) -> Column:
    for plain, written in (("\\", "\\\\"), ("#", "\\#"), ("</", "<\\/")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#/])", "$1")


def _placed(turns: Column) -> Column:
    """Turns (role, body, first and last of their run) with the code point at which each body starts."""
    before = lambda t: F.when(t["first"], len(HEADER) + F.length(t["role"]) + len(ROLE_END)).otherwise(0)
    after = lambda t: len(TURN_END) + F.when(t["last"], len(RUN_END)).otherwise(0)
    ends = prefix_sums(F.transform(turns, lambda t: before(t) + F.length(t["body"]) + after(t)))
    return F.transform(
        F.arrays_zip(turns.alias("t"), ends.alias("e")),
        lambda z: F.struct(
            z["t"]["role"].alias("role"),
            z["t"]["body"].alias("body"),
            z["t"]["first"].alias("first"),
            z["t"]["last"].alias("last"),
            (z["e"] - after(z["t"]) - F.length(z["t"]["body"])).alias("start"),
        ),
    )


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant"
) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``loss_spans`` (start and end, in code points, of each trained body).

    Null role and text count as empty, a null ``conv`` is a conversation of its
    own, a null ``turn`` comes first; rows of the same turn are ordered by role,
    then text, and repeated rows stay.  Without rows there is no conversation.
    Other columns are not read.
    """
    row = F.struct(
        turns[turn].alias("turn"), F.coalesce(turns[role], F.lit("")).alias("role"), F.coalesce(turns[text], F.lit("")).alias("text")
    )
    sorted_rows = turns.select(turns[conv].alias("conv"), row.alias("row")).groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    rows = F.col("rows")
    runs = F.transform(
        rows,
        lambda x, i: F.struct(
            escape(x["role"]).alias("role"),
            escape(x["text"]).alias("body"),
            ((i == 0) | (F.get(rows, i - 1)["role"] != x["role"])).alias("first"),
            ((i == F.size(rows) - 1) | (F.get(rows, i + 1)["role"] != x["role"])).alias("last"),
            (x["role"] == trained).alias("trained"),
        ),
    )
    placed = sorted_rows.select("conv", runs.alias("runs")).select("conv", "runs", _placed(F.col("runs")).alias("placed"))
    written = F.transform(
        F.col("runs"),
        lambda t: F.concat(
            F.when(t["first"], F.concat(F.lit(HEADER), t["role"], F.lit(ROLE_END))).otherwise(F.lit("")),
            t["body"],
            F.lit(TURN_END),
            F.when(t["last"], F.lit(RUN_END)).otherwise(F.lit("")),
        ),
    )
    spans = F.transform(
        F.filter(F.arrays_zip("runs", "placed"), lambda z: z["runs"]["trained"]),
        lambda z: F.struct(z["placed"]["start"].alias("start"), (z["placed"]["start"] + F.length(z["placed"]["body"])).alias("end")),
    )
    return placed.select(F.col("conv").alias(conv), F.array_join(written, "").alias("formatted"), spans.alias("loss_spans"))


def read_back(chats: DataFrame, conv: str = "conv_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``conv``, the columns ``keep``, ``turns`` (role and text) and ``loss_texts`` (texts under the mask), taken from
    ``formatted`` and ``loss_spans`` alone.  A span that does not begin and end with a text is under no text."""
    runs = F.slice(F.split("formatted", HEADER), 2, F.greatest(F.size(F.split("formatted", HEADER)) - 1, F.lit(0)))
    role = lambda r: F.substring_index(r, ROLE_END, 1)
    bodies = lambda r: F.split(F.substr(r, F.length(role(r)) + len(ROLE_END) + 1), TURN_END)
    parsed = F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(
                F.slice(bodies(r), 1, F.size(bodies(r)) - 1),
                lambda b, i: F.struct(
                    role(r).alias("role"), b.alias("body"), (i == 0).alias("first"), (i == F.size(bodies(r)) - 2).alias("last")
                ),
            ),
        )
    )
    turns = chats.select(conv, *keep, "loss_spans", parsed.alias("parsed")).select(conv, *keep, "loss_spans", _placed(F.col("parsed")).alias("placed"))
    # Bodies and spans in one sorted array: a span stands right behind the body that begins and ends where it does.
    entry = lambda start, end, kind, text: F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), text.alias("text"))
    bodies = F.transform("placed", lambda t: entry(t["start"], t["start"] + F.length(t["body"]), 0, t["body"]))
    spans = F.transform("loss_spans", lambda s: entry(s["start"], s["end"], 1, F.lit("")))
    merged = turns.select(conv, *keep, "placed", F.sort_array(F.concat(bodies, spans)).alias("merged"))

    def under_mask(e: Column, i: Column) -> Column:
        behind = F.get("merged", i + 1)
        return F.coalesce((e["kind"] == 0) & (behind["kind"] == 1) & (behind["start"] == e["start"]) & (behind["end"] == e["end"]), F.lit(False))

    return merged.select(
        conv,
        *keep,
        F.transform("placed", lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["body"]).alias("text"))).alias("turns"),
        F.transform(F.filter("merged", under_mask), lambda e: unescape(e["text"])).alias("loss_texts"),
    )
