"""Trip, station, weather and listing tables derived from the test data (see FIXTURES.md)."""

from pyspark.sql import functions as F

from spokeframe.functions.grid import with_grid
from spokeframe.schemas import STATIONS
from spokeframe.session import shared_folder
from spokeframe.sources.trips import read_trips, write_raw_trips

# (application, test-data folder) -> path of the prepared trips
_prepared = {}


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark, sf_dir):
    """Trips as a feed delivers them, names and text dates included, one to two per line item.

    A feed carries its station names, so the names are written from the ids by the rule the
    supplier table follows; joining 600 trips per supplier to look them up would shuffle every trip.
    """
    def name(station):
        return F.concat(F.lit("Supplier#"), F.lpad(F.col(station).cast("string"), 9, "0"))

    def date_text(iso):
        text = F.concat(F.substring(iso, 9, 2), F.lit("/"), F.substring(iso, 6, 2), F.lit("/"),
                        F.substring(iso, 1, 4), F.substring(iso, 11, 6))
        return F.when(F.col("_unreadable"), "n/a").otherwise(text)

    def after(ts, amount, unit):
        return F.timestamp_add(unit, amount, ts)

    open_ends = table(spark, sf_dir, "supplier").select(
        F.floor(F.count("*") * 9 / 10).cast("bigint")).scalar()
    # The fleet grows with the parts.
    bikes = table(spark, sf_dir, "part").select(
        (F.lit(97) + F.floor(F.count("*") / 20)).cast("bigint")).scalar()
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    unreadable = (line == 6) & (quantity == 50)
    unnamed = (line == 7) & (quantity == 49)
    offset = (F.col("l_orderkey") * 37 + line * 101) % 1440
    rental_id = F.col("l_orderkey") * 10 + line
    copies = F.when(rental_id % 50 == 1, 2).otherwise(1)
    return (
        table(spark, sf_dir, "lineitem")
        # Some trips are delivered twice; repeated here, while the rows are narrow.
        .select("*", F.explode(F.sequence(F.lit(1), copies)))
        .select(
            rental_id.alias("rental_id"),
            ((quantity - 1) * 180).cast("int").alias("duration"),
            (F.col("l_partkey") % bikes).cast("int").alias("bike_id"),
            F.when(~unnamed, (F.col("l_partkey") * 7 + line) % open_ends).alias("end_station_id"),
            F.col("l_suppkey").alias("start_station_id"),
            after(F.col("l_shipdate"), offset, "MINUTE").alias("_start"),
            unreadable.alias("_unreadable"),
        )
        .withColumn("_end", after(F.col("_start"), F.col("duration"), "SECOND"))
        # Cast in a step of their own: written once per row, and in no session zone.
        .withColumns({"_start": F.col("_start").cast("string"),
                      "_end": F.col("_end").cast("string")})
        .withColumns({
            "end_date": date_text("_end"),
            "end_station_name": name("end_station_id"),
            "start_date": date_text("_start"),
            "start_station_name": name("start_station_id"),
        })
        .select("rental_id", "duration", "bike_id", "end_date", "end_station_id",
                "end_station_name", "start_date", "start_station_id", "start_station_name")
    )


def trips(spark, sf_dir):
    """The prepared trips, written once per application to the shared folder and read from there.

    The copy cuts the lineage and outlives lost executors; each reader prunes its columns and, by
    the month folders, its rows.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _prepared:
        path = shared_folder(spark)
        write_raw_trips(raw_trips(spark, sf_dir), path)
        _prepared[key] = path
    return read_trips(spark, _prepared[key])


def stations(spark, sf_dir):
    """Stations in service: suppliers with a balance that is not negative, as file columns 2-10."""
    key = F.col("s_suppkey")
    placed = (
        table(spark, sf_dir, "supplier").where("s_acctbal >= 0")
        .select(
            key.cast("int").alias("id"),
            F.col("s_name").alias("name"),
            (F.lit(51.45) + (key * 37 % 100) / 1000).alias("latitude"),
            (F.lit(-0.22) + (key * 53 % 200) / 1000).alias("longitude"),
            (15 + key % 30).alias("num_docks"),
            (key % 15).alias("num_bikes"),
        )
        .withColumn("num_empty", F.col("num_docks") - F.col("num_bikes"))
    )
    return with_grid(placed).select(*STATIONS.names[1:])


def station_snapshot_lines(spark, sf_dir):
    """The stations as snapshot text, one array of up to 100 stations a line.

    The bike count comes twice, so that the last one must win, and a station without empty docks
    does not list them.
    """
    def prop(name, value):
        return F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))

    properties = F.array(
        prop("NbBikes", F.lit(99)), prop("NbDocks", F.col("num_docks")),
        prop("NbBikes", F.col("num_bikes")), prop("NbEmptyDocks", F.col("num_empty")),
    )
    given = F.filter(properties, lambda p: (p["key"] != "NbEmptyDocks") | (p["value"] != "0"))
    station = F.struct(
        F.concat(F.lit("BikePoints_"), F.col("id").cast("string")).alias("id"),
        F.col("name").alias("commonName"), F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"), given.alias("additionalProperties"),
    )
    return (
        stations(spark, sf_dir).groupBy(F.floor(F.col("id") / 100))
        .agg(F.collect_list(station).alias("page"))
        .select(F.to_json("page").alias("value"))
    )


def weather_lines(spark, sf_dir):
    """Monthly weather text from the orders, with the quirks of the published files."""
    year = (F.year("o_orderdate") + 18).alias("y")
    month = F.month("o_orderdate").alias("m")
    by_month = table(spark, sf_dir, "orders").groupBy(year, month).agg(
        F.round(5 + F.avg("o_totalprice") / 20000, 1).alias("t"),
        F.count("*").alias("n"),
        F.round(F.sum("o_totalprice") / 1e6, 1).alias("r"),
    )
    maximum = F.format_string("%6.1f", "t")
    return by_month.select(F.format_string(
        "   %d  %2d  %s  %6.1f  %6s  %6.1f  %6.1f%s",
        "y", "m",
        F.when(F.col("m") == 2, F.concat(maximum, F.lit("*"))).otherwise(maximum),
        F.col("t") - 18,
        F.when(F.col("m") == 7, "---").otherwise((F.col("n") % 20).cast("string")),
        "r", F.col("n").cast("double"),
        F.when(F.col("m") % 2 == 0, "#").otherwise("  Provisional"),
    ).alias("value"))


def file_listing(spark, sf_dir):
    """One listing entry per page: trip files, and spreadsheets for pages asked with a query."""
    kind = F.when(F.instr("url", "?") > 0, "xlsx").otherwise("csv")
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("usage-stats/"), F.col("page_id").cast("string"),
                 F.lit(" Journey Data."), kind).alias("Key"))


def landed_files(spark, sf_dir):
    """Files already fetched: those of pages served over https."""
    return table(spark, sf_dir, "pages").where(F.col("url").startswith("https:")).select(
        F.concat(F.col("page_id").cast("string"), F.lit("_Journey_Data.csv")).alias("file_name"))
