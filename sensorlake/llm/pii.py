r"""Personal data by proposal, validation and context, in Spark expressions only.

For each kind a regular expression proposes spans, a validator confirms them
(digit counts, octets, the Luhn sum, the remainder by 97) and words near the
span adjust its score.  The base kinds (email, ip, card, phone) report every
confirmed span, whatever its score; the further kinds (iban, card_short,
phone_local) report those whose score reaches ``threshold`` and that touch no
base span.

Positions come without Python from the text between matches: a match starts
after all earlier gaps and matches (``common.prefix_sums``).  The patterns
need time in proportion to the text: quantifiers that nothing may take from
are possessive, and an email is only tried where a run of its first part
starts, or where the last match ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import prefix_sums

_LOCAL = "[A-Za-z0-9._%+-]"
#: Kind: (a string that every match contains or None, pattern).
PATTERNS = {
    "email": ("@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (".", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": (None, r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "iban": (None, r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"),
    "card_short": (None, r"(?<![0-9+])[0-9](?:[\x20-]?[0-9])++"),
    "phone_local": (None, r"(?<![0-9+])\(?[0-9](?:[\x20().-]{0,2}[0-9])++"),
}
BASE = ("email", "ip", "card", "phone")

#: Kind: (score of a confirmed span, words that raise it, words that lower it).
CONTEXT = {
    "email": (0.9, "mail|contact|write", "example"),
    "ip": (0.6, r"\bip\b|address|host|server|login", "version|release|build|section"),
    "card": (0.8, "card|visa|master|credit|payment", "order|invoice|serial"),
    "phone": (0.7, "phone|tel|call|mobile|fax|whatsapp", "order|invoice|serial"),
    "iban": (0.9, "iban|bank|account|konto|transfer", "serial"),
    "card_short": (0.4, "card|visa|amex|credit|payment", "order|invoice|serial|phone"),
    "phone_local": (0.2, "phone|tel[:. ]|call|mobile|fax", "order|invoice|serial|card|version"),
}
RAISE, LOWER, NEAR_BEFORE, NEAR_AFTER = 0.3, 0.3, 40, 20


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substr(number, n - i, F.lit(1))) - 48
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def remainder_97(code: Column) -> Column:
    """Remainder by 97 of an IBAN, its first four characters moved to the end and letters read as 10 to 35."""
    moved = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(c >= 65, rest * 100 + c - 55).otherwise(rest * 10 + c - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def _confirmed(kind: str, found: Column) -> Column:
    n = F.length(digits(found))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        octet = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return found.rlike(rf"^{octet}(?:\.{octet}){{3}}$")
    if kind == "card":
        return F.when(n.between(16, 19), luhn(digits(found))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    if kind == "iban":
        code = F.replace(found, F.lit(" "), F.lit(""))
        return F.when(F.length(code).between(15, 34), remainder_97(code) == 1).otherwise(False)
    if kind == "card_short":
        return F.when(n.between(13, 15), luhn(digits(found))).otherwise(False)
    return n.between(7, 12)


def _spans(kind: str, parts: Column) -> Column:
    """Confirmed spans of one kind from ``parts``: matches and the text between them."""
    found, gaps = parts["found"], parts["gaps"]
    ends = prefix_sums(F.transform(found, lambda m, i: F.length(m) + F.length(F.get(gaps, i))))
    score, raised, lowered = CONTEXT[kind]
    near = F.transform(found, lambda m, i: F.lower(F.concat(F.right(F.get(gaps, i), F.lit(NEAR_BEFORE)), F.lit("\n"), F.left(F.get(gaps, i + 1), F.lit(NEAR_AFTER)))))
    rated = F.transform(
        F.arrays_zip(found.alias("m"), ends.alias("e"), near.alias("c")),
        lambda z: F.struct(
            F.lit(kind).alias("kind"),
            (z["e"] - F.length(z["m"])).alias("start"),
            z["e"].alias("end"),
            F.round(
                F.lit(score)
                + F.when(z["c"].rlike(raised), F.lit(RAISE)).otherwise(F.lit(0.0))
                - F.when(z["c"].rlike(lowered), F.lit(LOWER)).otherwise(F.lit(0.0)),
                2,
            ).alias("score"),
            _confirmed(kind, z["m"]).alias("ok"),
        ),
    )
    kept = F.transform(F.filter(rated, lambda s: s["ok"]), lambda s: s.dropFields("ok"))
    return F.when(F.size(found) > 0, kept).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def find_pii(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Every column of ``docs`` but ``text``, then ``pii_base`` and ``pii_added``: spans (kind, start, end, score).

    Spans are in code points, the end exclusive, by kind in the order of
    ``PATTERNS``, then by start.  Null text counts as empty and has none.
    Repeated rows are searched each.  Input columns with one of the two names
    are replaced.
    """
    kept = [docs[c] for c in docs.columns if c not in (text, "pii_base", "pii_added")]
    content = F.coalesce(docs[text], F.lit(""))

    def parts(kind: str) -> Column:
        sign, pattern = PATTERNS[kind]
        there = F.contains(content, F.lit(sign)) if sign else F.lit(True)
        empty = F.array().cast("array<string>")
        return F.struct(
            F.when(there, F.regexp_extract_all(content, F.lit(pattern), F.lit(0))).otherwise(empty).alias("found"),
            F.when(there, F.split(content, pattern)).otherwise(empty).alias("gaps"),
        ).alias(f"parts_{kind}")

    inner = F.struct(*kept).alias("row")
    split = docs.select(inner, *(parts(k) for k in PATTERNS))
    rated = split.select("row", *(_spans(k, F.col(f"parts_{k}")).alias(f"spans_{k}") for k in PATTERNS))
    base = F.concat(*(F.col(f"spans_{k}") for k in BASE))
    together = rated.select("row", base.alias("base"), F.concat(*(F.col(f"spans_{k}") for k in PATTERNS if k not in BASE)).alias("more"))
    added = F.filter(
        "more",
        lambda s: (s["score"] >= threshold) & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return together.select("row", F.col("base").alias("pii_base"), added.alias("pii_added")).select("row.*", "pii_base", "pii_added")
