"""Calendar helpers that stay valid under Spark 4 ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def iso_weekday(c: Column) -> Column:
    """Monday = 1 .. Sunday = 7 (the old 'u' pattern, removed in Spark 3+)."""
    return (F.weekday(c) + 1).cast("int")


# English day and month abbreviations (what the 'E' and 'MMM'
# patterns print). Reading them from the calendar fields instead of
# date_format keeps every helper free of the session time zone: date_format
# converts a TIMESTAMP_NTZ to a zoned timestamp first, which moves times that
# fall in a daylight-saving gap.
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def weekday_name(c: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.weekday(c) + 1)


def hour_text(c: Column) -> Column:
    return F.format_string("%02d", F.hour(c))


def month_text(c: Column) -> Column:
    return F.format_string("%02d", F.month(c))


def month_name(c: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(c))


# ``yyyy-MM-dd HH:mm:ss`` split into its six fields.
_TIME_PARTS = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"


def parse_time(c: Column) -> Column:
    """Wall-clock timestamp (TIMESTAMP_NTZ) from ``yyyy-MM-dd HH:mm:ss`` text.

    Built from the six fields, so the result never passes through the session
    time zone (no daylight-saving gap can move it); malformed text or an
    impossible date gives null instead of failing the job."""
    ok = c.rlike(_TIME_PARTS)
    part = [F.regexp_extract(c, _TIME_PARTS, i).cast("int") for i in range(1, 7)]
    ts = F.try_make_timestamp_ntz(years=part[0], months=part[1], days=part[2],
                                  hours=part[3], mins=part[4], secs=part[5].cast("decimal(8,6)"))
    return F.when(ok, ts)
