"""Histograms and a density curve, computed from counts of distinct values."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from spokeframe.functions.calendar import minutes_label
from spokeframe.operators.fleet import BIKE_DAY, dated
from spokeframe.operators.prepare import with_trip_type

# Defaults of the distributions: trips below two hours, in at most 50 bins.
LIMIT_SECONDS = 7200
MAX_BINS = 50


def _bin(value, low, high, bins):
    """Index of the equal-width bin; the upper edge belongs to the last one."""
    return F.least(F.floor((value - low) * bins / (high - low)), bins - 1).cast("int")


def _widen(low, high):
    """A range of no width becomes one of width 1 around its value."""
    flat = low == high
    return (F.when(flat, low - 0.5).otherwise(low).cast("double"),
            F.when(flat, high + 0.5).otherwise(high).cast("double"))


def trip_count_hist(trips, bins=20, shown=None):
    """How many dated bike-days have how many trips, in equal bins from least to most.

    ``shown`` is the first and last bin to return; the bins themselves do not depend on it.

    Bike-days are first reduced to one row per distinct trip count. The range is a scalar subquery
    on that; both read the same shuffled bike-days.
    """
    bike_days = dated(trips).groupBy(*BIKE_DAY).agg(F.count("*").alias("trip_count"))
    values = bike_days.groupBy("trip_count").agg(F.count("*").alias("bike_days"))
    low, high = _widen(values.select(F.min("trip_count")).scalar(),
                       values.select(F.max("trip_count")).scalar())

    def edge(position):
        return F.col("_low") + position * (F.col("_high") - F.col("_low")) / bins

    hist = (
        values.withColumns({"_low": low, "_high": high})
        .withColumn("bin", _bin(F.col("trip_count"), F.col("_low"), F.col("_high"), F.lit(bins)))
        .groupBy("bin", "_low", "_high").agg(F.sum("bike_days").alias("bike_days"))
        .select("bin", edge(F.col("bin")).alias("bin_start"),
                edge(F.col("bin") + 1).alias("bin_end"), "bike_days")
    )
    return hist if shown is None else hist.where(F.col("bin").between(*shown))


def _duration_counts(trips, limit):
    """Trips per type and whole second below ``limit`` seconds.

    This loses nothing and has at most ``limit - 1`` rows per type, so the windows over it are small.
    """
    return (
        with_trip_type(trips.where(F.col("duration") < limit))
        .groupBy("trip_type", "duration").agg(F.count("*").alias("trips"))
    )


def duration_hist(trips, max_bins=MAX_BINS, limit_seconds=LIMIT_SECONDS, shown=None):
    """Normalised histogram of durations below ``limit_seconds`` per trip type.

    Bin widths follow the Freedman-Diaconis rule, which asks for ever more bins as trips are added;
    ``max_bins`` is the most there are (None: no bound). ``shown`` is the first and last bin to
    return. With no spread between
    the quartiles the number of bins is the root of the number of trips.
    """
    by_type = Window.partitionBy("trip_type")
    quartiles = F.percentile("duration", F.array(F.lit(0.25), F.lit(0.75)), F.col("trips"))
    counts = _duration_counts(trips, limit_seconds).withColumns({
        "n": F.sum("trips").over(by_type),
        "_min": F.min("duration").over(by_type),
        "_max": F.max("duration").over(by_type),
        "_q": quartiles.over(by_type),
    })
    low, high = _widen(F.col("_min"), F.col("_max"))
    step = 2 * (F.col("_q")[1] - F.col("_q")[0]) * F.pow("n", F.lit(-1 / 3))
    bins = F.when(step > 0, F.ceil((F.col("_max") - F.col("_min")) / step)).otherwise(
        F.floor(F.sqrt("n")))
    if max_bins is not None:
        bins = F.least(bins, F.lit(max_bins))
    hist = (
        counts.withColumns({"_low": low, "_high": high, "bins": bins.cast("int")})
        .withColumns({"bin": _bin(F.col("duration"), F.col("_low"), F.col("_high"), F.col("bins")),
                      "width": (F.col("_high") - F.col("_low")) / F.col("bins")})
        .groupBy("trip_type", "bins", "bin", "n", "_low", "width")
        .agg(F.sum("trips").alias("trips"))
        .select("trip_type", "bins", "bin",
                (F.col("_low") + F.col("bin") * F.col("width")).alias("bin_start"), "width",
                "trips", (F.col("trips") / (F.col("n") * F.col("width"))).alias("density"))
    )
    return hist if shown is None else hist.where(F.col("bin").between(*shown))


def duration_density(trips, step=60, limit_seconds=LIMIT_SECONDS):
    """Smoothed density of durations per trip type, on a grid of seconds from 0 to the limit.

    A Gaussian kernel with Scott's bandwidth. Each distinct duration adds its weighted kernel to
    every grid point; null where a type has no spread.
    """
    by_type = Window.partitionBy("trip_type")
    trips_of = F.col("trips").cast("double")
    counts = _duration_counts(trips, limit_seconds).withColumns({
        "n": F.sum("trips").over(by_type),
        "_mean": F.sum(trips_of * F.col("duration")).over(by_type)
        / F.sum("trips").over(by_type),
    })
    off = F.col("duration") - F.col("_mean")
    variance = F.try_divide(F.sum(trips_of * off * off).over(by_type), F.col("n") - 1)
    bandwidth = F.sqrt(variance) * F.pow("n", F.lit(-1 / 5))
    z = F.try_divide(F.col("seconds") - F.col("duration"), F.col("_h"))
    return (
        counts.withColumn("_h", bandwidth)
        .select("trip_type", "n", "_h", "duration", "trips",
                F.explode(F.sequence(F.lit(0), F.lit(limit_seconds), F.lit(step)))
                .alias("seconds"))
        .groupBy("trip_type", "n", "_h", "seconds")
        .agg(F.sum(F.col("trips") * F.exp(-z * z / 2)).alias("_weight"))
        .select("trip_type", "seconds", minutes_label(F.col("seconds")).alias("label"),
                F.try_divide("_weight", F.col("n") * F.col("_h") * math.sqrt(2 * math.pi))
                .alias("density"))
    )
