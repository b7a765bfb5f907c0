"""Keys and null marks as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_MARKS = ["---", "", "NONE"]

#: White space around a key, of any script (Java's \\s alone holds ASCII only).
EDGE_SPACE = r"^[\s\u00A0\u1680\u2000-\u200B\u202F\u205F\u3000\uFEFF]+|[\s\u00A0\u1680\u2000-\u200B\u202F\u205F\u3000\uFEFF]+$"


def stripped(text: Column) -> Column:
    """Text without white space around it; null stays null."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def real_value(text: Column) -> Column:
    """Trimmed text, or null for a null mark."""
    value = stripped(text)
    return F.when(~F.upper(value).isin(NULL_MARKS), value)


def normal_key(text: Column) -> Column:
    """The form under which two spellings of a key are equal: trimmed, upper case, null marks null."""
    return F.upper(real_value(text))


def wall_micros(at: Column) -> Column:
    """Microseconds of a timestamp without zone since 1970, whatever the zone of the session.

    A cast to an instant would read it in the session's zone, in which some times of
    day don't exist and others come twice.
    """
    seconds = (F.unix_date(at.cast("date")).cast("long") * 24 + F.hour(at)) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")
