"""Reading ISO-8601 message times that arrive in several notations and offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted notation: date, ``T`` or blank, time, optional fraction, optional zone (``Z``, ``+hh``, ``+hhmm``, ``+hh:mm``).
ISO_INSTANT = r"^(\d{4}-\d{2}-\d{2})[Tt ]+(\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)\s*([Zz]|[+-]\d{2}(?::?\d{2})?)?$"


#: The common notation, which a cast reads as it is.
PLAIN_INSTANT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})$"


def instant_us(ts: Column) -> Column:
    """Microseconds since 1970 UTC of an ISO-8601 string; null where missing or unreadable.

    A time without zone counts as UTC. Digits beyond microseconds are cut off.
    """
    s = F.regexp_replace(ts, r"(?U)^\s+|\s+$", "")
    part = lambda i: F.regexp_extract(s, ISO_INSTANT, i)
    zone = F.upper(part(3))
    digits = F.regexp_replace(zone, "[^0-9]", "")
    zone = (
        F.when((zone == "") | (zone == "Z"), F.lit("+00:00"))
        .when(F.length(digits) == 2, F.concat(F.substring(zone, 1, 1), digits, F.lit(":00")))
        .otherwise(F.concat(F.substring(zone, 1, 1), F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2)))
    )
    time = F.regexp_replace(F.regexp_replace(part(2), ",", "."), r"(\.\d{6})\d+$", "$1")
    full = F.concat(part(1), F.lit("T"), time, zone)
    return F.when(ts.rlike(PLAIN_INSTANT), F.unix_micros(ts.try_cast("timestamp"))).when(s.rlike(ISO_INSTANT), F.unix_micros(full.try_cast("timestamp")))


def month_family(source: Column, ts_us: Column) -> Column:
    """``<source>/<yyyy-MM>`` of an instant (UTC)."""
    return F.concat_ws("/", source, F.date_format(F.timestamp_micros(ts_us), "yyyy-MM"))


def apple_epoch_us(ns: Column) -> Column:
    """Nanoseconds since 2001-01-01 UTC to microseconds since 1970."""
    # as a decimal: a double would lose the last digits
    return F.floor(ns.cast("decimal(20,0)") / F.lit(1000)).cast("bigint") + F.lit(978307200000000)


def days_between(later_us: Column, earlier_us: Column) -> Column:
    """Whole calendar days (UTC) between two instants."""
    return F.datediff(F.timestamp_micros(later_us), F.timestamp_micros(earlier_us))
