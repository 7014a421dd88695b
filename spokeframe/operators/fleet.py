"""How much of the fleet is used, and the hardest-worked bikes."""

from pyspark.sql import functions as F

from spokeframe.functions.calendar import month_key, month_label
from spokeframe.functions.random_pick import pick_one

BIKE_DAY = ("bike_id", "start_year", "start_month", "start_day")


def monthly_bikes(trips):
    """Distinct bikes and trips of each month."""
    return (
        trips.groupBy("start_year", "start_month")
        .agg(F.countDistinct("bike_id").alias("bike_count"), F.count("*").alias("trip_count"))
        .withColumns({"month": month_key("start_year", "start_month"),
                      "month_label": month_label("start_year", "start_month")})
        .orderBy("start_year", "start_month")
    )


def daily_bikes(trips):
    """Distinct bikes of each day that has trips."""
    return trips.groupBy("start_year", "start_month", "start_day").agg(
        F.countDistinct("bike_id").alias("bike_count")
    )


def daily_usage(trips):
    """Bikes used each day, against the bikes seen at all that month.

    "Available" is an estimate: a bike nobody rode that month cannot be seen. One pass and no join:
    each bike's days of a month become the bits of one number, and counting bikes per bit gives
    every day of the month beside the month's own count.
    """
    bike_months = (
        trips.where(F.col("start_year").isNotNull())
        .groupBy("bike_id", "start_year", "start_month")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), "start_day"))
             .alias("days"))
    )
    used = ", ".join(
        f"struct({day} AS start_day, max(getbit(days, {day})) AS ridden,"
        f" count(CASE WHEN getbit(days, {day}) = 1 THEN bike_id END) AS bikes_used)"
        for day in range(1, 32)
    )
    return (
        bike_months.groupBy("start_year", "start_month")
        .agg(F.count("bike_id").alias("bikes_available"), F.expr(f"array({used})").alias("used"))
        .select("start_year", "start_month", "bikes_available", F.inline("used"))
        .where("ridden = 1")
        .select("bikes_used", "bikes_available",
                (F.col("bikes_available") - F.col("bikes_used")).alias("unused_bikes"),
                "start_year", "start_month", "start_day")
    )


def utilisation(trips):
    """Least, most and mean bikes used and unused per day of each month."""
    def spread(column):
        return [F.min(column).alias(f"{column}_min"), F.max(column).alias(f"{column}_max"),
                F.avg(column).alias(f"{column}_avg")]

    return (
        daily_usage(trips).groupBy("start_year", "start_month")
        .agg(*spread("bikes_used"), F.max("bikes_available").alias("bikes_available"),
             *spread("unused_bikes"))
        .withColumn("month_label", month_label("start_year", "start_month"))
        .orderBy("start_year", "start_month")
    )


def busy_bikes(trips):
    """Minutes ridden and trips of each bike on each day."""
    return trips.groupBy(*BIKE_DAY).agg(
        (F.sum("duration") / 60).alias("duration"), F.count("*").alias("trip_count")
    )


def dated(trips):
    """Trips whose start could be read; the others belong to no day."""
    return trips.where(F.col("start_year").isNotNull())


def top_bike_days(trips, k=20):
    """The ``k`` bike-days with the most trips. Undated trips are no day of any bike."""
    return busy_bikes(dated(trips)).orderBy(F.desc("trip_count"), *BIKE_DAY).limit(k)


def pick_busy_bike(trips, k=20, seed=0):
    """One of the ``k`` busiest bike-days, the same one for the same seed."""
    return pick_one(top_bike_days(trips, k), BIKE_DAY, seed)


def bike_journeys(trips, stations, bike_id, year, month, day):
    """One bike's trips of one day with the coordinates of both ends, in time order.

    The chosen day is given as values or columns (such as scalar subqueries); the four equalities
    are on stored columns and reach the scan, the month as folders. Trips with an end that is not a
    listed station are left out. Trips that start in the same minute are ordered by what follows,
    so that the sort can also split a minute over tasks.
    """
    def ends(side):
        return stations.select(F.col("id").cast("bigint").alias(f"{side}_station_id"),
                               F.col("latitude").alias(f"{side}_lat"),
                               F.col("longitude").alias(f"{side}_lon"))

    chosen = trips.where(
        (F.col("bike_id") == bike_id) & (F.col("start_year") == year)
        & (F.col("start_month") == month) & (F.col("start_day") == day)
    )
    return (
        chosen.join(ends("start"), "start_station_id").join(ends("end"), "end_station_id")
        .select("start_ts", "start_station_name", "end_ts", "end_station_name", "duration",
                "start_lat", "start_lon", "end_lat", "end_lon")
        .orderBy("start_ts", "end_ts", "start_station_name", "end_station_name", "duration")
    )


def journey_count(journeys):
    return journeys.agg(F.count("start_ts").alias("journeys"))
