"""Raw trips to the prepared trip table."""

from pyspark.sql import functions as F

from spokeframe.functions.calendar import calendar_parts, parse_minute_ts
from spokeframe.schemas import TRIP_COLUMN_NAMES, TRIPS


def rename_raw(raw):
    return raw.withColumnsRenamed(TRIP_COLUMN_NAMES)


def distinct_trips(raw):
    """Typed trips of positive duration, exact duplicates removed, without their calendar parts.

    Copies collapse before they are shuffled, however many there are of one trip.
    """
    return (
        rename_raw(raw)
        .where("duration > 0")
        .withColumns({"start_ts": parse_minute_ts("start_date"),
                      "end_ts": parse_minute_ts("end_date")})
        .drop("start_date", "end_date")
        .dropDuplicates()
    )


def with_calendar(distinct):
    """The prepared trip table of ``distinct_trips``."""
    return distinct.withColumns(
        {**calendar_parts("start_ts", "start_"), **calendar_parts("end_ts", "end_")}
    ).select(*TRIPS.names)


def prepare_trips(raw):
    """Typed trips of positive duration, exact duplicates removed.

    The calendar parts follow from the two timestamps, so rows equal before the parts are added are
    equal after. Duplicates are therefore dropped on nine columns and the parts are added behind
    the shuffle.
    """
    return with_calendar(distinct_trips(raw))


def with_trip_type(trips):
    """Add ``trip_type``, decided by station names; an unnamed end counts as point to point."""
    same = F.col("start_station_name") == F.col("end_station_name")
    return trips.withColumn("trip_type", F.when(same, "Round Trip").otherwise("Point to Point"))
