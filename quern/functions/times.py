"""Dates and times of logs and tickets, all wall-clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Month abbreviations of web server logs.
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def parse_apache_time(c: Column) -> Column:
    """``01/Aug/1995:00:00:01 -0400`` as ``timestamp_ntz``; the zone is ignored, bad text is null."""
    month_of = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, i)])

    def number(start: int, length: int) -> Column:
        return F.substring(c, start, length).try_cast("int")

    return F.try_make_timestamp_ntz(
        number(8, 4),
        F.try_element_at(month_of, F.substring(c, 4, 3)),
        number(1, 2),
        number(13, 2),
        number(16, 2),
        number(19, 2).cast("decimal(16,6)"),
    )


def dash_to_zero(c: Column) -> Column:
    """Size field of a log line: ``-`` is 0, other text that is no number is null."""
    return F.when(c == "-", F.lit(0).cast("bigint")).otherwise(c.try_cast("bigint"))


def _utc(ms: Column) -> Column:
    # NTZ arithmetic keeps the result in UTC whatever the session zone is.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=(ms / F.lit(1000)).cast("decimal(18,6)"))


def epoch_ms_hour(ms: Column) -> Column:
    """Hour 0-23 in UTC of epoch milliseconds."""
    return F.hour(_utc(ms))


def iso_weekday(c: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(c) + 1


def epoch_ms_weekday(ms: Column) -> Column:
    return iso_weekday(_utc(ms))


def yyyymmdd_to_date(c: Column) -> Column:
    """Integer 20160912 to a date; impossible dates are null."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def is_weekday(c: Column) -> Column:
    return F.weekday(c) < 5


def month_floor(c: Column) -> Column:
    return F.trunc(c, "month")


def hhmm_to_minute(c: Column) -> Column:
    """Integer HHMM, read zero padded, to ``HH:MM``; times that do not exist are null."""
    hour, minute = F.floor(c / 100), F.pmod(c, F.lit(100))
    label = F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), F.lpad(minute.cast("string"), 2, "0"))
    return F.when((c >= 0) & (hour < 24) & (minute < 60), label)
