"""Timestamps, calendar parts and labels."""

from pyspark.sql import functions as F

# Fixed value: the shape of a trip's dates.
MINUTE_TEXT = "^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}$"


def parse_minute_ts(text):
    """``dd/MM/yyyy HH:mm`` text to a local timestamp; anything else is null.

    Built from the digits rather than with a zoned parser, so the session zone and its clock
    changes cannot shift a value.
    """
    def digits(position, length):
        return F.substring(text, position, length).try_cast("int")

    parsed = F.try_make_timestamp_ntz(
        digits(7, 4), digits(4, 2), digits(1, 2), digits(12, 2), digits(15, 2), F.lit(0)
    )
    return F.when(F.col(text).rlike(MINUTE_TEXT), parsed)


def calendar_parts(ts, prefix):
    """Name -> column for the five parts kept beside a timestamp (day of week: 1 = Sunday)."""
    return {
        f"{prefix}year": F.year(ts),
        f"{prefix}month": F.month(ts),
        f"{prefix}day": F.dayofmonth(ts),
        f"{prefix}day_of_week": F.dayofweek(ts),
        f"{prefix}hour": F.hour(ts),
    }


def month_key(year, month):
    """Unpadded text such as ``2016-3``. It does not sort by time; sort on the numbers."""
    return F.concat(F.col(year).cast("string"), F.lit("-"), F.col(month).cast("string"))


def month_label(year, month):
    """``March 2016``; null where either part is null or no such month exists."""
    first_day = F.make_date(F.col(year), F.col(month), F.lit(1))
    return F.when(F.col(month).between(1, 12), F.date_format(first_day, "MMMM yyyy"))


def minutes_label(seconds):
    """Whole minutes as an axis label, ``90min``."""
    return F.format_string("%.0fmin", seconds / 60)
