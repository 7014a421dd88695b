"""Raw trip files and the prepared trip table."""

from pyspark.sql import functions as F

from spokeframe.functions.calendar import calendar_parts
from spokeframe.operators.prepare import distinct_trips, prepare_trips, with_calendar
from spokeframe.schemas import RAW_TRIPS, TRIP_COLUMN_NAMES, TRIPS
from spokeframe.session import through_table
from spokeframe.sources.versions import current_version, make_current, new_version

MONTH_PARTITIONS = ("start_year", "start_month")

# Rows of a month folder lie by bike; a row group of this size holds few bikes.
ROW_GROUP_BYTES = 32 << 20

# Most rows of a compressed raw file.
PACKED_ROWS = 1 << 20

# Most rows of a month that one merging task takes.
PART_ROWS = 1 << 20

# The columns of a prepared trip that the others follow from.
BARE = ("rental_id", "duration", "bike_id", "end_station_id", "end_station_name",
        "start_station_id", "start_station_name", "start_ts", "end_ts")


def read_trips_csv(spark, path):
    """Raw trips under ``path`` (a file, folder or glob, or a list of them).

    Columns are taken by position: header text is ignored, surplus columns on the right are
    dropped, short rows and unreadable numbers become null.
    """
    return spark.read.csv(path, schema=RAW_TRIPS, header=True, mode="PERMISSIVE")


def write_trips_csv(raw, path, by=(), compression=None):
    """Raw trips, named as after ``rename_raw``, to files ``read_trips_csv`` takes.

    ``by`` names further columns of which each value gets a folder of its own. Compressed files are
    read whole by one task, so they are kept short.
    """
    headers = {name: header for header, name in TRIP_COLUMN_NAMES.items()}
    files = raw.select(*headers, *by).withColumnsRenamed(headers).write.partitionBy(*by)
    if compression:
        files = files.option("compression", compression).option("maxRecordsPerFile", PACKED_ROWS)
    files.csv(path, header=True)


def _by_bike(trips, row_group_bytes):
    """A writer of month folders, of rows that lie by month already, by bike inside each file.

    A file's row groups hold few bikes each: their ranges and bloom filters tell which to read.
    """
    return (
        trips.sortWithinPartitions(*MONTH_PARTITIONS, "bike_id", "start_ts")
        .write.partitionBy(*MONTH_PARTITIONS)
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.bloom.filter.enabled#bike_id", "true")
        .option("parquet.bloom.filter.expected.ndv#bike_id", "20000")
    )


def _gathered(trips):
    """The rebalance gathers a month into few files and splits a month too big for one task."""
    return trips.hint("rebalance", *MONTH_PARTITIONS)


def _with_month(bare):
    parts = calendar_parts("start_ts", "start_")
    return bare.withColumns({c: parts[c] for c in MONTH_PARTITIONS})


def write_trips(trips, path, by_month=False, row_group_bytes=ROW_GROUP_BYTES):
    """Replace the prepared table at ``path``; until all is written, readers see the old rows.

    ``by_month`` lays it out in year and month folders, by bike inside them, for readers that ask for
    few months or one bike.
    """
    version = new_version(path)
    (_by_bike(_gathered(trips), row_group_bytes) if by_month else trips.write).parquet(version)
    make_current(trips.sparkSession, path, version)


def write_raw_trips(raw, path, row_group_bytes=ROW_GROUP_BYTES):
    """Prepare raw trips and replace the table at ``path`` by them, laid out by month.

    As ``write_trips`` of the prepared trips, but the calendar parts follow the shuffle to the months.
    """
    version = new_version(path)
    trips = with_calendar(_gathered(_with_month(distinct_trips(raw))))
    _by_bike(trips, row_group_bytes).parquet(version)
    make_current(raw.sparkSession, path, version)


def read_trips(spark, path):
    """The prepared table, in its own column order whichever layout it was written in."""
    return spark.read.schema(TRIPS).parquet(current_version(spark, path)).select(*TRIPS.names)


def _month():
    """The month folder as one number, 0 where the start could not be read."""
    return F.coalesce(F.col("start_year") * 100 + F.col("start_month"), F.lit(0))


def merge_trips(spark, path, trips, row_group_bytes=ROW_GROUP_BYTES):
    """Add prepared trips to a table laid out by month, those it has already left out.

    Only the months of the new trips are read and written again, which finds all copies, as a copy
    starts when its original does; other months keep their files. One shuffle brings copies together
    and rows to their months, a big month in several parts, without the calendar parts. The old files
    are replaced when all new ones are written.
    """
    fresh = _with_month(through_table(trips.select(*BARE)))
    # At most one row for each month of the calendar.
    months = [row[0] for row in fresh.select(_month()).distinct().collect()]
    if not months:
        return
    old = read_trips(spark, path).where(_month().isin(months))
    both = old.select(*BARE, *MONTH_PARTITIONS).union(fresh)
    # Rows of the largest month set how many parts a month is dealt into, never a trip's copies.
    parts = both.groupBy(*MONTH_PARTITIONS).agg(F.count("*").alias("rows")).select(
        F.ceil(F.max("rows") / PART_ROWS)).first()[0]
    part = F.pmod(F.xxhash64("rental_id", "start_ts"), F.lit(parts))
    merged = both.withColumn("_part", part).repartition(*MONTH_PARTITIONS, "_part").dropDuplicates()
    _by_bike(with_calendar(merged), row_group_bytes).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").parquet(current_version(spark, path))


def _ledger(path):
    return f"{path}/_merged"


def merged_files(spark, path):
    """``file``: the raw files that the table at ``path`` has been given by ``merge_files``."""
    files = spark._jvm.org.apache.hadoop.fs.Path(_ledger(path))
    if not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
        return spark.createDataFrame([], "file string")
    return spark.read.schema("file string").parquet(_ledger(path))


def merge_files(spark, path, files):
    """Prepare the raw files that the table has not been given yet and merge their trips.

    Returns the files that were new. They are noted after their trips are in the table, so a run
    that fails between the two merges them again, which changes nothing: copies are dropped.
    """
    given = spark.createDataFrame([(f,) for f in files], "file string").distinct()
    new = [row.file for row in given.join(
        merged_files(spark, path), "file", "left_anti").orderBy("file").collect()]
    if not new:
        return []
    raw = read_trips_csv(spark, new)
    if current_version(spark, path) == path:
        write_raw_trips(raw, path)
    else:
        merge_trips(spark, path, prepare_trips(raw))
    spark.createDataFrame([(f,) for f in new], "file string").write.mode("append").parquet(_ledger(path))
    return new


def register_views(trips, stations):
    """Name the two tables for SQL users."""
    trips.createOrReplaceTempView("trips")
    stations.createOrReplaceTempView("bike_points")
