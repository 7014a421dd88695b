"""Every registered query: name -> function of (session, test-data folder)."""

from pyspark.sql import functions as F

from spokeframe.operators import dead_trips as dead
from spokeframe.operators import distributions, drift, fleet, prepare, stations, usage, weather
from spokeframe.plans import fixtures
from spokeframe.session import shared_folder
from spokeframe.sources import listing as listing_files
from spokeframe.sources import stations as station_files
from spokeframe.sources import trips as trip_files
from spokeframe.sources import weather as weather_files

BASE_URL = "https://example.org/"

# The years that the trips made from the test data start in.
YEARS = list(range(1995, 2002))

VIEW_SQL = """
    SELECT b.id, b.name, t.trips_started, t.seconds
    FROM bike_points b
    JOIN (SELECT start_station_id, count(*) AS trips_started, sum(duration) AS seconds
          FROM trips GROUP BY start_station_id) t ON t.start_station_id = b.id
"""


def _through_files(df, write, read, **options):
    """``df`` written to the shared folder and read back."""
    path = shared_folder(df.sparkSession)
    write(df, path)
    return read(df.sparkSession, path, **options)


def _rounded(df, digits, *columns):
    """For comparison between engines, whose last digits differ."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _of_trips(operator):
    return lambda spark, sf_dir: operator(fixtures.trips(spark, sf_dir))


def _of_both(operator):
    return lambda spark, sf_dir: operator(
        fixtures.trips(spark, sf_dir), fixtures.stations(spark, sf_dir))


def read_trips_csv(spark, sf_dir):
    return _through_files(prepare.rename_raw(fixtures.raw_trips(spark, sf_dir)),
                          trip_files.write_trips_csv, trip_files.read_trips_csv)


def prepare_trips(spark, sf_dir):
    return prepare.prepare_trips(fixtures.raw_trips(spark, sf_dir))


def write_trips(spark, sf_dir):
    def by_month(trips, path):
        trip_files.write_trips(trips, path, by_month=True)

    return _through_files(fixtures.trips(spark, sf_dir), by_month, trip_files.read_trips)


def merge_trips(spark, sf_dir):
    """A feed in two deliveries, of which the second repeats a third of the first."""
    raw = fixtures.raw_trips(spark, sf_dir)
    top = fixtures.table(spark, sf_dir, "lineitem").select(F.max("l_orderkey") * 10).scalar()
    first, second = (raw.where(part) for part in (
        F.col("rental_id") * 3 < top * 2, F.col("rental_id") * 3 >= top))
    path, folders = shared_folder(spark), []
    for delivery in (first, second):
        folders.append(shared_folder(spark))
        trip_files.write_trips_csv(prepare.rename_raw(delivery), folders[-1], compression="gzip")
        trip_files.merge_files(spark, path, folders)
    return trip_files.read_trips(spark, path)


def drift_by_file(spark, sf_dir):
    """Drift counts of raw files, a folder of them for each year that trips start in."""
    raw = prepare.rename_raw(fixtures.raw_trips(spark, sf_dir))
    folder = shared_folder(spark)
    year = F.when(F.col("start_date") == "n/a", "unreadable").otherwise(
        F.substring("start_date", 7, 4))
    trip_files.write_trips_csv(raw.withColumn("year", year), folder, by=("year",))
    read = drift.with_file(trip_files.read_trips_csv(spark, folder))
    year = F.regexp_extract("file", "/year=([^/]*)/", 1)
    return drift.drift_by_file(read.withColumn("year", year), "year")


def prepare_drift(spark, sf_dir):
    """The drift counts of a preparation, from the pass that writes the trips."""
    folder = shared_folder(spark)
    trip_files.write_trips_csv(prepare.rename_raw(fixtures.raw_trips(spark, sf_dir)), folder)
    trips, observation = drift.prepare_observed(trip_files.read_trips_csv(spark, folder))
    trip_files.write_trips(trips, shared_folder(spark))
    return spark.createDataFrame([observation.get], ", ".join(f"{c} bigint" for c in observation.get))


def duration_hist_shown(spark, sf_dir):
    hist = distributions.duration_hist(fixtures.trips(spark, sf_dir), shown=(2, 11))
    return _rounded(_rounded(hist, 6, "bin_start", "width"), 12, "density")


def register_views(spark, sf_dir):
    trip_files.register_views(fixtures.trips(spark, sf_dir), fixtures.stations(spark, sf_dir))
    return spark.sql(VIEW_SQL)


def bike_points(spark, sf_dir):
    read = _through_files(fixtures.stations(spark, sf_dir), station_files.write_stations_csv,
                          station_files.read_stations_csv)
    return _rounded(read, 3, "osgb_x", "osgb_y")


def bike_points_inferred(spark, sf_dir):
    read = _through_files(fixtures.stations(spark, sf_dir), station_files.write_stations_csv,
                          station_files.read_stations_csv, infer=True)
    return _rounded(read, 3, "osgb_x", "osgb_y")


def stations_from_json(spark, sf_dir):
    snapshot = _through_files(
        fixtures.station_snapshot_lines(spark, sf_dir), lambda df, path: df.write.text(path),
        station_files.read_station_snapshot, multi_line=False)
    return _rounded(station_files.stations_from_snapshot(snapshot), 3, "osgb_x", "osgb_y")


def stations_grid(spark, sf_dir):
    grid = stations.stations_grid(fixtures.stations(spark, sf_dir))
    return _rounded(grid.select("id", "name", "geometry.x", "geometry.y", "geometry.srid"),
                    3, "x", "y")


def stations_by_name(spark, sf_dir):
    points = fixtures.stations(spark, sf_dir)
    routes = usage.top_trips(fixtures.trips(spark, sf_dir))
    ends = routes.select(F.explode(F.array(*usage.ROUTE)).alias("name"))
    found = stations.stations_by_name(points, ends)
    return _rounded(found, 3, "osgb_x", "osgb_y")


def _weather_lines(spark, sf_dir):
    return _through_files(fixtures.weather_lines(spark, sf_dir),
                          lambda df, path: df.write.text(path), weather_files.read_weather_text)


def weather_parse(spark, sf_dir):
    return weather_files.parse_weather(_weather_lines(spark, sf_dir))


def weather_parse_unsigned(spark, sf_dir):
    return weather_files.parse_weather(_weather_lines(spark, sf_dir), keep_sign=False)


def weather_monthly(spark, sf_dir):
    table = _through_files(weather_parse(spark, sf_dir), weather_files.write_weather_csv,
                           weather_files.read_weather_csv)
    return weather.weather_monthly(table)


def file_manifest(spark, sf_dir):
    entries = _through_files(fixtures.file_listing(spark, sf_dir), listing_files.write_listing,
                             listing_files.read_listing)
    return listing_files.file_manifest(entries, BASE_URL)


def manifest_new_files(spark, sf_dir):
    return listing_files.new_files(file_manifest(spark, sf_dir),
                                   fixtures.landed_files(spark, sf_dir))


def bike_journeys(spark, sf_dir):
    trips = fixtures.trips(spark, sf_dir)
    chosen = fleet.pick_busy_bike(trips).select(F.struct(*fleet.BIKE_DAY)).scalar()
    return fleet.bike_journeys(trips, fixtures.stations(spark, sf_dir),
                               *(chosen[c] for c in fleet.BIKE_DAY))


def bike_journey_lines(spark, sf_dir):
    return _with_line_ends(stations.trip_lines(bike_journeys(spark, sf_dir)))


def bike_journey_count(spark, sf_dir):
    return fleet.journey_count(bike_journeys(spark, sf_dir))


def _with_line_ends(lines):
    """The array of two points as four columns."""
    ends = {f"line_{part}{i + 1}": F.col("geometry")[i][part] for i in (0, 1)
            for part in ("lon", "lat")}
    return lines.withColumns(ends).drop("geometry")


def station_map(spark, sf_dir):
    placed = _of_both(stations.station_map)(spark, sf_dir)
    flat = placed.withColumns({"point_lon": F.col("geometry.lon"),
                               "point_lat": F.col("geometry.lat")}).drop("geometry")
    return _rounded(flat, 9, "colour_value")


def trip_lines(spark, sf_dir):
    points = stations.with_place(fixtures.stations(spark, sf_dir))
    pairs = dead.dead_trips(fixtures.trips(spark, sf_dir), points, carried=stations.PLACE)
    return _with_line_ends(stations.trip_lines(pairs))


def dead_trips_message(spark, sf_dir):
    trips, points = fixtures.trips(spark, sf_dir), fixtures.stations(spark, sf_dir)
    return dead.dead_trips_message(dead.dead_trips_summary(trips, points),
                                   dead.pick_dead_trip(trips, points))


def trip_count_hist(spark, sf_dir):
    hist = distributions.trip_count_hist(fixtures.trips(spark, sf_dir))
    return _rounded(hist, 6, "bin_start", "bin_end")


def duration_hist(spark, sf_dir):
    hist = distributions.duration_hist(fixtures.trips(spark, sf_dir))
    return _rounded(_rounded(hist, 6, "bin_start", "width"), 12, "density")


def duration_density(spark, sf_dir):
    return _rounded(distributions.duration_density(fixtures.trips(spark, sf_dir)), 12, "density")


QUERIES = {
    "read_trips_csv": read_trips_csv,
    "prepare_trips": prepare_trips,
    "write_trips": write_trips,
    "trips": fixtures.trips,
    "merge_trips": merge_trips,
    "drift_by_file": drift_by_file,
    "prepare_drift": prepare_drift,
    "register_views": register_views,
    "bike_points": bike_points,
    "bike_points_inferred": bike_points_inferred,
    "stations_from_json": stations_from_json,
    "stations_grid": stations_grid,
    "stations_by_name": stations_by_name,
    "weather_parse": weather_parse,
    "weather_parse_unsigned": weather_parse_unsigned,
    "weather_monthly": weather_monthly,
    "file_manifest": file_manifest,
    "manifest_new_files": manifest_new_files,
    "trips_with_type": _of_trips(prepare.with_trip_type),
    "trips_by_year": _of_trips(usage.trips_by_year),
    "trips_by_month": _of_trips(usage.trips_by_month),
    "trips_month_pivot": _of_trips(lambda trips: usage.trips_month_pivot(trips, YEARS)),
    "top_start_stations": _of_trips(usage.top_start_stations),
    "top_end_stations": _of_trips(usage.top_end_stations),
    "trip_counts": _of_trips(usage.trip_counts),
    "top_trips": _of_trips(usage.top_trips),
    "bottom_trips": _of_trips(usage.bottom_trips),
    "trip_type_totals": _of_trips(usage.trip_type_totals),
    "trip_type_share": _of_trips(usage.trip_type_share),
    "preview": _of_trips(lambda trips: usage.preview(trips, order=("rental_id", "start_ts"))),
    "monthly_bikes": _of_trips(fleet.monthly_bikes),
    "daily_bikes": _of_trips(fleet.daily_bikes),
    "daily_usage": _of_trips(fleet.daily_usage),
    "utilisation": _of_trips(fleet.utilisation),
    "busy_bikes": _of_trips(fleet.busy_bikes),
    "top_bike_days": _of_trips(fleet.top_bike_days),
    "pick_busy_bike": _of_trips(fleet.pick_busy_bike),
    "bike_journeys": bike_journeys,
    "bike_journey_count": bike_journey_count,
    "bike_journey_lines": bike_journey_lines,
    "trip_count_hist": trip_count_hist,
    "duration_hist": duration_hist,
    "duration_hist_shown": duration_hist_shown,
    "duration_density": duration_density,
    "station_totals": _of_trips(stations.station_totals),
    "station_map": station_map,
    "possible_trips": lambda spark, sf_dir: dead.possible_trips(fixtures.stations(spark, sf_dir)),
    "pair_matrix": _of_both(dead.pair_matrix),
    "dead_trips": _of_both(dead.dead_trips),
    "dead_trips_sample": _of_both(dead.dead_trips_sample),
    "pick_dead_trip": _of_both(dead.pick_dead_trip),
    "dead_trips_summary": _of_both(dead.dead_trips_summary),
    "dead_trips_message": dead_trips_message,
    "trip_lines": trip_lines,
}
