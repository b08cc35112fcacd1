"""Date parsing as native expressions (no Python UDFs).

Both parsers return ``DATE``. Lenient mode (default) turns unparseable text
into NULL; strict mode fails the task, like the original scripts did.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

# Fixed formats of the two input feeds.
# message time, e.g. "Sat Dec 14 07:24:08 +0000 2009"; weekday cut off first
MESSAGE_TIME_FORMAT = "MMM d HH:mm:ss Z yyyy"
# clinical time, e.g. "2010-05-06T23:30:00-04:00"; only the part before "T" is used
CLINICAL_DAY_FORMAT = "yyyy-M-d"

_SECONDS_PER_DAY = 86400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strict(raw: Column, parsed: Column, what: str) -> Column:
    return F.when(
        raw.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit(f"unparseable {what}: "), raw)),
    ).otherwise(parsed)


def message_day(c: Column | str, strict: bool = False) -> Column:
    """UTC calendar day of a message timestamp text.

    The weekday token is dropped (Spark cannot parse day-of-week text), the
    rest parsed with its zone offset, and the instant mapped to its UTC day
    without depending on the session time zone.
    """
    raw = _col(c)
    t = F.trim(raw)
    body = F.ltrim(F.substr(t, F.locate(" ", t) + 1))
    ts = F.try_to_timestamp(body, F.lit(MESSAGE_TIME_FORMAT))
    day = F.date_from_unix_date(F.floor(F.unix_seconds(ts) / _SECONDS_PER_DAY).cast("int"))
    return _strict(raw, day, "message time") if strict else day


def clinical_day(c: Column | str, strict: bool = False) -> Column:
    """Local calendar day of a clinical date/time text: the text before ``T``."""
    raw = _col(c)
    day = F.try_to_date(F.split_part(F.trim(raw), F.lit("T"), F.lit(1)), CLINICAL_DAY_FORMAT)
    return _strict(raw, day, "clinical date") if strict else day


def as_day(c: str, dtype: DataType, parser, strict: bool = False) -> Column:
    """Bring a column of any supported type to ``DATE``."""
    if isinstance(dtype, DateType):
        return F.col(c)
    if isinstance(dtype, TimestampType):  # the UTC day of the instant, whatever the session zone
        return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(c)) / _SECONDS_PER_DAY).cast("int"))
    if isinstance(dtype, TimestampNTZType):
        return F.to_date(F.col(c))
    if isinstance(dtype, StringType):
        return parser(c, strict)
    raise TypeError(f"column {c!r} has type {dtype.simpleString()}, expected date, timestamp or string")
