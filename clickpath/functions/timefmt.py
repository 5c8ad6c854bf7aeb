"""Time Column helpers (X1-X4). Session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FMT = "yyyy-MM-dd"
TIME_FMT = "yyyy-MM-dd HH:mm:ss"


def format_time(ts_ms: Column, fmt: str = TIME_FMT) -> Column:
    """Epoch milliseconds to a formatted string."""
    return F.date_format(F.timestamp_millis(ts_ms), fmt)


def format_date(ts: Column, fmt: str = DATE_FMT) -> Column:
    """Timestamp to a formatted string."""
    return F.date_format(ts, fmt)


def parse_time_ms(s: Column, fmt: str = TIME_FMT) -> Column:
    """Formatted string to epoch milliseconds; null on bad input."""
    return F.unix_millis(F.try_to_timestamp(s, F.lit(fmt)))


# "yyyy-MM-dd HH:mm:ss" as a lenient parser reads it: any digits, blanks before a field, anything behind.
_LENIENT = r"^[ \t]*(\d{1,9})-[ \t]*(\d{1,9})-[ \t]*(\d{1,9}) [ \t]*(\d{1,9}):[ \t]*(\d{1,9}):[ \t]*(\d{1,9})"


def civil_days(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970-01-01 of a date whose month and day may lie outside their ranges.

    Months beyond the year move on to other years, then days count on from the month's first.
    Proleptic Gregorian, in exact bigint arithmetic: years begin in March, so that
    a leap day is a year's last.
    """
    months = year * 12 + month - 3
    y, m = floor_div(months, 12), F.pmod(months, F.lit(12))
    era = floor_div(y, 400)
    of_era = y - era * 400
    of_year = floor_div(m * 153 + 2, 5) + day - 1
    return era * 146097 + of_era * 365 + floor_div(of_era, 4) - floor_div(of_era, 100) + of_year - 719468


def parse_time_lenient_ms(s: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to epoch milliseconds with a lenient calendar.

    Fields beyond their range roll over, as the reference's parser has it: 30 February is
    1 or 2 March, 25:61 is 02:01 on the next day. Blanks before a field and text behind
    the seconds don't matter. What has no such fields, or a sign, is null.
    """
    year, month, day, hour, minute, second = (
        F.nullif(F.regexp_extract(s, _LENIENT, k), F.lit("")).cast("bigint") for k in range(1, 7))
    return (civil_days(year, month, day) * 86_400 + hour * 3_600 + minute * 60 + second) * 1000


def floor_10s_text(time_str: Column) -> Column:
    """Replace the last digit of a time string with ``0`` (X4, string form)."""
    return F.concat(F.substring(time_str, F.lit(1), F.length(time_str) - 1), F.lit("0"))


def floor_seconds(ts_ms: Column, seconds: int) -> Column:
    """Epoch ms floored to a multiple of ``seconds``, as epoch seconds.

    Exact integer arithmetic (floor, also before 1970).
    """
    return floor_div(ts_ms, 1000 * seconds) * F.lit(seconds)


def floor_div(c: Column, m: int) -> Column:
    """Exact integer floor division of a bigint Column by a positive constant."""
    return ((c - F.pmod(c, F.lit(m))) / F.lit(m)).cast("bigint")
