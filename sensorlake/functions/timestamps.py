"""Timestamp clean-up and parsing.

Rule: the wall clock written by the sensor is kept.  The date and the time
fields at the start of the text are taken, ',' is read as the decimal point,
precision is cut to milliseconds, and the zone that follows is ignored, never
applied: an offset in any form, ``Z``, a known abbreviation or a name of the
zone database, the last two behind a time only.  A date alone may be followed
by ``Z`` or an offset of four digits.  Any other text behind makes the value
unreadable, ``AM`` and ``PM`` among it.

Only the fields are parsed, by one ``try_cast`` of the taken text: a mismatch
is NULL (a rejected row) instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


#: Areas of the zone database (fixed values).
ZONE_AREAS = (
    "Africa", "America", "Antarctica", "Arctic", "Asia", "Atlantic", "Australia", "Brazil", "Canada", "Chile", "Etc",
    "Europe", "Indian", "Mexico", "Pacific", "SystemV", "US",
)
#: Abbreviations of zones (fixed values).
ZONE_ABBREVIATIONS = (
    "UTC", "UT", "GMT", "WET", "WEST", "CET", "CEST", "MEZ", "MESZ", "EET", "EEST", "MSK", "BST", "IST", "JST", "KST", "HKT", "SGT", "PKT",
    "EST", "EDT", "CST", "CDT", "MST", "MDT", "PST", "PDT", "AST", "ADT", "NST", "NDT", "AKST", "AKDT", "HST", "BRT", "ART", "CLT",
    "SAST", "EAT", "CAT", "WAT", "AEST", "AEDT", "ACST", "ACDT", "AWST", "NZST", "NZDT",
)

_DATE = r"\d{4}-\d{2}-\d{2}"
_TIME = r"[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?"
_OFFSET = r"[+-]\d{1,2}(?::?\d{2}(?::?\d{2})?)?"
_NAME = rf"(?:(?:{'|'.join(ZONE_AREAS)})(?:/[A-Za-z0-9_+-]+)+|{'|'.join(ZONE_ABBREVIATIONS)}|[Zz])(?![A-Za-z])"
_ZONE = rf"\s*(?:{_OFFSET}|{_NAME}|\[(?:{_NAME})\])"
_SHORT_ZONE = r"\s*(?:[Zz]|[+-]\d{2}:?\d{2})"
#: The fields, where nothing but zones stands behind them.
_READABLE = rf"^({_DATE}(?:{_TIME}(?=(?:{_ZONE})*$)|(?=(?:{_SHORT_ZONE})?$)))"


def clean_timestamp_text(c: Column) -> Column:
    """The date and time fields of the text; empty where it has another form."""
    return F.regexp_extract(F.translate(F.trim(c), ",", "."), _READABLE, 1)


def parse_timestamp(c: Column) -> Column:
    """Wall-clock TIMESTAMP (millisecond precision) of the text, else NULL."""
    return F.date_trunc("millisecond", clean_timestamp_text(c).try_cast("timestamp"))


def require_fixed_zone(spark: SparkSession) -> None:
    """Wall clocks are kept as they are only in a session zone without offset changes."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if not spark.sparkContext._jvm.java.time.ZoneId.of(zone, spark.sparkContext._jvm.java.time.ZoneId.SHORT_IDS).getRules().isFixedOffset():
        raise ValueError(f"spark.sql.session.timeZone is {zone}, whose offset changes and would move wall clocks; set UTC")
