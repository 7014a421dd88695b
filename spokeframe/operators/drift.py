"""What preparation silently turns into nulls or leaves out, counted.

Raw files drift over the years: dates in other forms, columns that move or are missing. The counts
come from the pass that prepares the trips, or file by file in a pass of their own.
"""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from spokeframe.functions.calendar import parse_minute_ts
from spokeframe.operators.prepare import prepare_trips, rename_raw


def _counts(start="start_date", end="end_date"):
    """Aggregates over raw trips, named as after ``rename_raw``."""
    def times(condition, name):
        return F.count(F.when(condition, 1)).alias(name)

    def unreadable(column):
        return F.col(column).isNotNull() & parse_minute_ts(column).isNull()

    return [
        F.count(F.lit(1)).alias("raw_rows"),
        times(unreadable(start), "unreadable_starts"),
        times(unreadable(end), "unreadable_ends"),
        times(F.col(start).isNull(), "no_start"),
        # A row that ends early lacks what stands last in it.
        times(F.col("start_station_id").isNull() & F.col("start_station_name").isNull(), "short_rows"),
        times(F.col("end_station_id").isNull() & F.col("end_station_name").isNull(), "no_end_station"),
        times(F.col("duration").isNull(), "no_duration"),
        times(F.col("duration") <= 0, "no_time_passed"),
    ]


def drift_by_file(raw, file="file"):
    """The counts of each raw file, ``raw`` having a column that names it."""
    return rename_raw(raw).groupBy(file).agg(*_counts())


def with_file(raw):
    """Add ``file``: the path of the file each raw row was read from."""
    return raw.select("*", F.col("_metadata.file_path").alias("file"))


def prepare_observed(raw, name="drift"):
    """``prepare_trips`` with its drift counts: ``trips, observation``.

    ``observation.get`` has the counts once the trips have been written; they are made in the same
    pass over the files. Tasks that ran twice, as after a lost executor, may count twice; use
    ``drift_by_file`` for exact numbers.
    """
    observation = Observation(name)
    # Under names of its own, so that preparation can rename the columns as always.
    return prepare_trips(rename_raw(raw).observe(observation, *_counts())), observation
