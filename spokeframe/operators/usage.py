"""Trips over time, by station, by route and by type.

All are plain grouped aggregates: Spark combines rows before the shuffle, so a station or month
holding much of the data sends one partial row per task.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spokeframe.operators.prepare import with_trip_type

ROUTE = ("start_station_name", "end_station_name")


def _in_thousands(df):
    return df.withColumn("cnt_thousands", F.col("cnt") / 1000)


def trips_by_year(trips):
    counts = trips.groupBy("start_year").agg(F.count("*").alias("cnt"))
    return _in_thousands(counts).orderBy("start_year")


def trips_by_month(trips):
    """Trips and mean duration of each month."""
    counts = trips.groupBy("start_year", "start_month").agg(
        F.count("*").alias("cnt"), F.avg("duration").alias("duration")
    )
    return _in_thousands(counts).orderBy("start_year", "start_month")


def trips_month_pivot(trips, years=None):
    """Months down, one column of trip counts per year.

    With ``years`` nothing runs before the result is asked for and the trips are read once; without
    them a first pass collects the years.
    """
    monthly = trips.where(F.col("start_year").isNotNull()).groupBy("start_year", "start_month")
    counts = monthly.agg(F.count("*").alias("cnt"))
    return (
        counts.groupBy("start_month").pivot("start_year", years).agg(F.sum("cnt"))
        .orderBy("start_month")
    )


def _busiest(trips, station, k):
    counts = trips.groupBy(station).agg(F.count("*").alias("cnt"))
    top = counts.orderBy(F.desc("cnt"), station).limit(k)
    return _in_thousands(top).orderBy("cnt", F.desc(station))


def top_start_stations(trips, k=10):
    """The ``k`` stations most trips start from, shown in ascending order; ties go by name."""
    return _busiest(trips, "start_station_name", k)


def top_end_stations(trips, k=10):
    return _busiest(trips, "end_station_name", k)


def trip_counts(trips):
    """Trips and total duration of every recorded route."""
    return trips.groupBy(*ROUTE).agg(
        F.count("*").alias("trip_count"), F.sum("duration").alias("duration")
    )


def top_trips(trips, k=10):
    return trip_counts(trips).orderBy(F.desc("trip_count"), *ROUTE).limit(k)


def bottom_trips(trips, k=10):
    return trip_counts(trips).orderBy("trip_count", *ROUTE).limit(k)


def trip_type_totals(trips):
    return with_trip_type(trips).groupBy("trip_type").agg(
        F.count("*").alias("trip_count"), F.sum("duration").alias("duration")
    )


def trip_type_share(trips):
    """Each type's percentage of trips and of time. The window spans the two totals only."""
    def share(column):
        total = F.sum(column).over(Window.partitionBy())
        return F.round(F.lit(100.0) * F.col(column) / total, 1)

    return trip_type_totals(trips).select(
        "trip_type",
        share("trip_count").alias("trip_share"),
        share("duration").alias("duration_share"),
    )


def preview(df, n=10, order=()):
    """The first ``n`` rows by the columns ``order``; any ``n`` rows if there are none."""
    return (df.orderBy(*order) if order else df).limit(n)
