"""Calendar and clock parts of dates, times, timestamps and intervals (SQL functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE, NEGATIVE = "POS_INFINITY", "NEG_INFINITY"
DAY_MICROS = 86_400_000_000


def date_parts(d: Column) -> Column:
    parts = F.struct(F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"))
    return F.when(d.isNotNull(), parts)


def time_micros(ts: Column) -> Column:
    """Microseconds since midnight."""
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60
    return clock.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def timestamp_parts(ts: Column, zone_offset: Column | None = None) -> Column:
    """year, month, day, hour, minute, second, micro, and zoneOffset (seconds east) if given."""
    micros = time_micros(ts)
    fields = [
        F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), F.second(ts).alias("second"),
        (micros % 1_000_000).cast("int").alias("micro"),
    ]
    if zone_offset is not None:
        fields.append(zone_offset.cast("int").alias("zoneOffset"))
    return F.when(ts.isNotNull(), F.struct(*fields))


def zone_offset(ts: Column, zone: str | Column = "UTC") -> Column:
    """Seconds east of UTC of ``zone`` at the instant ``ts``."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone) if isinstance(zone, str) else zone, F.to_timestamp_ntz(ts))
    return F.timestamp_diff("SECOND", F.to_timestamp_ntz(ts), local)


def time_tz(micros: Column, offset_east: Column) -> Column:
    return F.when(
        micros.isNotNull(), F.struct(micros.cast("long").alias("micro"), offset_east.cast("int").alias("zoneOffset"))
    )


def interval_parts(months: Column, days: Column, micros: Column) -> Column:
    """The seven integers of an interval kept as months, days and microseconds.

    Parts truncate towards zero, so each has the sign of what it is a part of.
    """
    part = lambda x, per, within=None: (
        F.signum(x) * (F.floor(F.abs(x) / per) if within is None else F.floor(F.abs(x) / per) % within)
    ).cast("int")
    m, u = months.cast("long"), micros.cast("long")
    return F.struct(
        part(m, 12).alias("year"), part(m, 1, 12).alias("month"), days.cast("int").alias("day"),
        part(u, 3_600_000_000).alias("hour"), part(u, 60_000_000, 60).alias("minute"),
        part(u, 1_000_000, 60).alias("second"), part(u, 1, 1_000_000).alias("micro"),
    )


def special_of(text: Column) -> Column:
    """Enum symbol of an infinite date or timestamp given as text, else null."""
    folded = F.lower(F.trim(text))
    return F.when(folded.isin("infinity", "+infinity"), F.lit(POSITIVE)).when(folded == "-infinity", F.lit(NEGATIVE))
