"""Time columns, all in UTC wall time (NTZ) and independent of the session's zone."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per unit of a duration, and where each bucket cuts "YYYY-MM-DD HH:MM:SS".
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}
BUCKETS = ("minute", "hour", "day")
EXTENDED_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"


def duration(text: str) -> timedelta:
    """``30s``, ``2m``, ``3h``, ``4d``, ``1w``; positive, and no longer than a timedelta can be."""
    found = re.fullmatch(r"\s*(\d+)\s*([smhdw])\s*", text)
    if not found or int(found[1]) == 0:
        raise ValueError("a duration is a positive number and one of s, m, h, d, w")
    try:
        return timedelta(seconds=int(found[1]) * UNIT_SECONDS[found[2]])
    except OverflowError:
        raise ValueError("the duration is too long") from None


def duration_seconds(text: Column) -> Column:
    """Column form of ``duration``: seconds, null for what isn't a positive duration."""
    number = F.regexp_extract(text, r"^\s*(\d+)\s*[smhdw]\s*$", 1).try_cast("bigint")
    unit = F.regexp_extract(text, r"([smhdw])\s*$", 1)
    scale = F.create_map(*[F.lit(x) for pair in UNIT_SECONDS.items() for x in pair])
    return F.when(number > 0, number * F.try_element_at(scale, unit))


def utc_from_micros(micros: Column) -> Column:
    """NTZ of microseconds since 1970; no session zone takes part."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros.cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)"))


# ISO 8601 forms that casts don't know: a calendar or week date with or without dashes, then a time with or without colons.
ODD_ISO = (
    r"^(?:(\d{4})(\d\d)(\d\d)|(\d{4})-(\d\d)-(\d\d)|(\d{4})W(\d\d)(\d?)|(\d{4})-W(\d\d)(?:-(\d))?)"
    r"(?:.(\d\d)(?::(\d\d)(?::(\d\d))?|(\d\d)(\d\d)?)?(?:[.,](\d+))?(Z|[+-]\d\d(?::?\d\d)?)?)?$"
)


def odd_iso_micros(text: Column) -> Column:
    """Micros of the ISO forms of ``ODD_ISO``, null for other texts and days or times that don't exist."""
    # One look at the text gives all parts: year, month, day, year of the week, week, its day, hour, minute, second, fraction, zone.
    found = F.split(F.regexp_replace(text, ODD_ISO, "$1$4|$2$5|$3$6|$7$10|$8$11|$9$12|$13|$14$16|$15$17|$18|$19"), r"\|")

    def micros(parts: Column) -> Column:
        part = lambda i: F.get(parts, F.lit(i))
        of_week, week, day = part(3), F.coalesce(part(4).try_cast("int"), F.lit(0)), F.coalesce(part(5).try_cast("int"), F.lit(1))
        monday = F.date_add(F.trunc(F.concat(of_week, F.lit("-01-04")).try_cast("date"), "week"), (week - 1) * 7)
        # A week belongs to the year of its Thursday.
        exists = day.between(1, 7) & (F.year(F.date_add(monday, 3)) == of_week.try_cast("int"))
        date = F.when(of_week != "", F.when(exists, F.date_add(monday, day - 1))).otherwise(F.concat_ws("-", part(0), part(1), part(2)).try_cast("date"))
        clock, zone = F.concat_ws(":", *[F.lpad(part(i), 2, "0") for i in (6, 7, 8)]), F.replace(part(10), F.lit(":"), F.lit(""))
        offset = F.when(F.length(zone) < 3, F.lit("+00:00")).otherwise(F.concat(F.substring(zone, 1, 3), F.lit(":"), F.rpad(F.substring(zone, 4, 2), 2, "0")))
        stamp = F.concat(date.cast("string"), F.lit("T"), clock, F.lit("."), F.rpad(F.substring(part(9), 1, 6), 6, "0"), offset)
        return F.unix_micros(stamp.try_cast("timestamp"))

    return F.when(text.rlike(ODD_ISO), F.get(F.transform(F.array(found), micros), F.lit(0)))


def parse_timestamp(value: Column, dtype: str, odd_forms: bool = False) -> Column:
    """NTZ in UTC of a timestamp, epoch seconds or ISO-8601 text; null where it can't be read.

    Text without a zone is UTC. ``odd_forms`` also reads basic and week-date forms, where the cast
    leaves null.
    """
    if dtype == "timestamp_ntz":
        return value
    if dtype == "timestamp":
        return utc_from_micros(F.unix_micros(value))
    if dtype == "date":
        return value.cast("timestamp_ntz")
    if dtype.startswith(("int", "bigint", "smallint", "tinyint", "double", "float", "decimal")):
        return utc_from_micros(F.round(value.try_cast("decimal(24,6)") * 1_000_000))
    if dtype != "string":
        return F.lit(None).cast("timestamp_ntz")
    text = F.trim(value)
    zoned = F.when(text.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$") & text.rlike("[T ]"), text).when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z"))).otherwise(F.concat(text, F.lit("Z")))
    micros = F.when(text.rlike(EXTENDED_ISO), F.unix_micros(zoned.try_cast("timestamp")))
    if odd_forms:
        micros = F.coalesce(micros, odd_iso_micros(F.when(micros.isNull(), text)))
    return utc_from_micros(micros)


def bucket_of(timestamp: Column, bucket: str) -> Column:
    """Start of the minute, hour or day as ``2026-05-30T07:00:00+00:00``."""
    if bucket not in BUCKETS:
        raise ValueError("time_bucket must be minute, hour, or day")
    text = timestamp.cast("string")
    clock = {"minute": F.concat(F.substring(text, 12, 5), F.lit(":00")), "hour": F.concat(F.substring(text, 12, 2), F.lit(":00:00")), "day": F.lit("00:00:00")}[bucket]
    return F.concat(F.substring(text, 1, 10), F.lit("T"), clock, F.lit("+00:00"))


def iso_z(timestamp: Column) -> Column:
    """``2026-05-30T07:00:00Z``, with six fractional digits only if they aren't zero."""
    text = timestamp.cast("string")
    fraction = F.regexp_extract(text, r"\.(\d+)$", 1)
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.when(fraction != "", F.concat(F.lit("."), F.rpad(fraction, 6, "0"))).otherwise(""), F.lit("Z"))
