"""Explicit schemas. File columns are matched by position, never by header text."""

from pyspark.sql import types as T

# Column order of the raw trip files. Later files rename "Duration" and add columns
# on the right; both are absorbed because the mapping is positional.
RAW_TRIPS = T.StructType([
    T.StructField("Rental Id", T.LongType()),
    T.StructField("Duration", T.IntegerType()),
    T.StructField("Bike Id", T.IntegerType()),
    T.StructField("End Date", T.StringType()),
    T.StructField("EndStation Id", T.LongType()),
    T.StructField("EndStation Name", T.StringType()),
    T.StructField("Start Date", T.StringType()),
    T.StructField("StartStation Id", T.LongType()),
    T.StructField("StartStation Name", T.StringType()),
])

# Raw header -> column name.
TRIP_COLUMN_NAMES = {
    "Rental Id": "rental_id",
    "Duration": "duration",
    "Bike Id": "bike_id",
    "End Date": "end_date",
    "EndStation Id": "end_station_id",
    "EndStation Name": "end_station_name",
    "Start Date": "start_date",
    "StartStation Id": "start_station_id",
    "StartStation Name": "start_station_name",
}

# Column order of the prepared trip table.
TRIPS = T.StructType([
    T.StructField("rental_id", T.LongType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("bike_id", T.IntegerType()),
    T.StructField("end_station_id", T.LongType()),
    T.StructField("end_station_name", T.StringType()),
    T.StructField("start_station_id", T.LongType()),
    T.StructField("start_station_name", T.StringType()),
    T.StructField("start_ts", T.TimestampNTZType()),
    T.StructField("start_year", T.IntegerType()),
    T.StructField("start_month", T.IntegerType()),
    T.StructField("start_day", T.IntegerType()),
    T.StructField("start_day_of_week", T.IntegerType()),
    T.StructField("start_hour", T.IntegerType()),
    T.StructField("end_ts", T.TimestampNTZType()),
    T.StructField("end_year", T.IntegerType()),
    T.StructField("end_month", T.IntegerType()),
    T.StructField("end_day", T.IntegerType()),
    T.StructField("end_day_of_week", T.IntegerType()),
    T.StructField("end_hour", T.IntegerType()),
])

# Station file layout.
STATIONS = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("osgb_x", T.DoubleType()),
    T.StructField("osgb_y", T.DoubleType()),
    T.StructField("num_docks", T.LongType()),
    T.StructField("num_bikes", T.LongType()),
    T.StructField("num_empty", T.LongType()),
])

# Layout of a station snapshot.
STATION_SNAPSHOT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("commonName", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("additionalProperties", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
])

# Monthly weather layout.
WEATHER = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("maximum_temp", T.DoubleType()),
    T.StructField("minimum_temp", T.DoubleType()),
    T.StructField("days_of_air_frost", T.DoubleType()),
    T.StructField("total_rainfall", T.DoubleType()),
    T.StructField("total_sunshine", T.DoubleType()),
])

# The one element of a file listing that is read.
FILE_LISTING = T.StructType([T.StructField("Key", T.StringType())])
