"""Station snapshots (JSON) and the station file (CSV)."""

from pyspark.sql import functions as F

from spokeframe.functions.grid import with_grid
from spokeframe.functions.ordering import numbered
from spokeframe.schemas import STATION_SNAPSHOT, STATIONS

# Id prefix and property names of a snapshot.
ID_PREFIX = "BikePoints_"
PROPERTIES = {"num_docks": "NbDocks", "num_bikes": "NbBikes", "num_empty": "NbEmptyDocks"}


def read_station_snapshot(spark, path, multi_line=True):
    """Snapshots as published: each file one array of stations.

    With ``multi_line=False`` each line is an array or a station, and big files are split.
    """
    return spark.read.schema(STATION_SNAPSHOT).json(path, multiLine=multi_line)


def stations_from_snapshot(snapshot):
    """One typed row per station: the last of repeated properties counts, a missing one is 0."""
    def prop(key):
        found = F.filter("additionalProperties", lambda p: p["key"] == key)
        value = F.try_element_at(found, F.lit(-1))["value"]
        return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))

    located = snapshot.select(
        F.replace("id", F.lit(ID_PREFIX), F.lit("")).try_cast("int").alias("id"),
        F.col("commonName").alias("name"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        *(prop(key).alias(name) for name, key in PROPERTIES.items()),
    )
    return with_grid(located).select(*STATIONS.names[1:])


def with_row_index(stations):
    """Number the stations from 0 in order of id and name, nulls first, as column ``idx``."""
    return numbered(stations, "idx", "id", "name").select(
        F.col("idx").cast("int").alias("idx"), *stations.columns)


def write_stations_csv(stations, path):
    """Stations with their row number first, header on."""
    with_row_index(stations).select(*STATIONS.names).write.csv(path, header=True)


def read_stations_csv(spark, path, infer=False):
    """The station file: ten columns by position, or with ``infer`` by header and guessed types."""
    if infer:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, schema=STATIONS, header=True, mode="PERMISSIVE")
