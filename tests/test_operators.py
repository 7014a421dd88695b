"""Operators against brute force on small and lopsided tables."""

import collections
import itertools
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokeframe.operators import dead_trips as dead
from spokeframe.operators import distributions, fleet, prepare, stations, usage, weather
from spokeframe.plans import fixtures
from spokeframe.schemas import TRIPS


def make_trips(spark, rows):
    """Trips from (bike, start name, end name, duration, year, month, day); ids from the names."""
    def ident(name):
        return None if name is None else int(name[1:])

    full = [(i, dur, bike, ident(end), end, ident(start), start, None, y, m, d, None, None,
             None, None, None, None, None, None)
            for i, (bike, start, end, dur, y, m, d) in enumerate(rows)]
    return spark.createDataFrame(full, TRIPS)


def make_stations(spark, rows):
    return spark.createDataFrame(
        [(i, n, 51.0 + i / 100, i / 100) for i, n in rows],
        "id int, name string, latitude double, longitude double")


@pytest.fixture(scope="module")
def sample(spark):
    """Two thousand trips, a third of them by one bike between the same two stations."""
    rng = random.Random(1)
    rows = []
    for i in range(2000):
        start, end = f"s{rng.randrange(12)}", f"s{rng.randrange(12)}"
        bike = rng.choice([1, 2, 3, 4, 5, 6, None])
        if i % 3 == 0:
            bike, start, end = 9, "s1", "s2"
        day = (2016, rng.choice([1, 2]), rng.randrange(1, 32)) if rng.random() > 0.02 else (None,) * 3
        rows.append((bike, rng.choice([start, None]) if i % 50 == 0 else start, end,
                     rng.randrange(1, 9000), *day))
    return rows, make_trips(spark, rows)


def test_prepare_keeps_rows_that_differ_anywhere(spark):
    raw = spark.createDataFrame(
        [(1, 60, 1, "01/01/2016 00:01", 1, "a", "01/01/2016 00:00", 2, "b")] * 500
        + [(1, 60, 1, "01/01/2016 00:01", 1, "a", "01/01/2016 00:00", 2, None)] * 2
        + [(1, 60, 1, "bad", 1, "a", "01/01/2016 00:00", 2, "b"),
           (1, 60, 1, "worse", 1, "a", "01/01/2016 00:00", 2, "b")],
        "rental_id long, duration int, bike_id int, end_date string, end_station_id long, "
        "end_station_name string, start_date string, start_station_id long, "
        "start_station_name string")
    # Two unreadable dates are both null, so those two rows are one.
    assert prepare.prepare_trips(raw).count() == 3


def test_trip_type_of_unnamed_stations(spark):
    trips = make_trips(spark, [(1, "s1", "s1", 1, 2016, 1, 1), (1, None, None, 1, 2016, 1, 1),
                               (1, "s1", "s2", 1, 2016, 1, 1)])
    kinds = [r.trip_type for r in prepare.with_trip_type(trips).orderBy("rental_id").collect()]
    assert kinds == ["Round Trip", "Point to Point", "Point to Point"]


def test_usage_counts(sample):
    rows, trips = sample
    top = usage.top_start_stations(trips, 3).collect()
    counted = collections.Counter(r[1] for r in rows)
    best = sorted(counted.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or ""))[:3]
    assert [(r.start_station_name, r.cnt) for r in reversed(top)] == best
    assert top[-1].cnt_thousands == best[0][1] / 1000
    routes = collections.Counter((r[1], r[2]) for r in rows)
    assert {(r.start_station_name, r.end_station_name): r.trip_count
            for r in usage.trip_counts(trips).collect()} == routes
    assert usage.bottom_trips(trips, 1).first().trip_count == min(routes.values())
    shares = usage.trip_type_share(trips).collect()
    assert sum(r.trip_share for r in shares) == pytest.approx(100, abs=0.11)
    assert sum(r.duration_share for r in shares) == pytest.approx(100, abs=0.11)


def test_month_pivot(sample):
    rows, trips = sample
    pivot = {r.start_month: r["2016"] for r in usage.trips_month_pivot(trips).collect()}
    assert pivot == collections.Counter(r[5] for r in rows if r[4] is not None)
    named = usage.trips_month_pivot(trips, [2015, 2016])
    assert named.columns == ["start_month", "2015", "2016"]
    assert named.where("`2015` IS NOT NULL").count() == 0


def test_daily_usage_is_the_join_of_daily_and_monthly_counts(sample):
    _, trips = sample
    monthly = fleet.monthly_bikes(trips).select(
        "start_year", "start_month", F.col("bike_count").alias("bikes_available"))
    joined = (
        fleet.daily_bikes(trips).join(monthly, ["start_year", "start_month"])
        .select(F.col("bike_count").alias("bikes_used"), "bikes_available",
                (F.col("bikes_available") - F.col("bike_count")).alias("unused_bikes"),
                "start_year", "start_month", "start_day"))
    got = fleet.daily_usage(trips)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect()))
    assert got.where("bikes_used + unused_bikes <> bikes_available").count() == 0


def test_a_day_of_unknown_bikes_is_still_a_day(spark):
    trips = make_trips(spark, [(None, "s1", "s2", 1, 2016, 1, 31), (4, "s1", "s2", 1, 2016, 1, 2)])
    got = {r.start_day: (r.bikes_used, r.unused_bikes) for r in fleet.daily_usage(trips).collect()}
    assert got == {31: (0, 1), 2: (1, 0)}


def test_utilisation(sample):
    rows, trips = sample
    days = collections.defaultdict(set)
    for bike, *_, year, month, day in rows:
        if year is not None and bike is not None:
            days[(month, day)].add(bike)
    for row in fleet.utilisation(trips).collect():
        used = [len(b) for (m, _), b in days.items() if m == row.start_month]
        assert (row.bikes_used_min, row.bikes_used_max) == (min(used), max(used))
        assert row.bikes_used_avg == pytest.approx(statistics.mean(used))
        assert row.bikes_available == 7
        assert row.unused_bikes_avg == pytest.approx(7 - statistics.mean(used))
        assert row.month_label == {1: "January 2016", 2: "February 2016"}[row.start_month]


def test_journeys_follow_the_clock_and_need_listed_ends(spark):
    trips = make_trips(spark, [
        (7, "s1", "s2", 60, 2016, 1, 1), (7, "s2", "s1", 90, 2016, 1, 1),
        (7, "s2", "s99", 5, 2016, 1, 1), (8, "s1", "s2", 60, 2016, 1, 1),
        (7, "s1", "s2", 60, 2016, 1, 2)])
    hour = F.make_timestamp_ntz(F.lit(2016), F.lit(1), F.lit(1), F.lit(20) - F.col("rental_id"),
                                F.lit(0), F.lit(0))
    trips = trips.withColumn("start_ts", hour)
    points = make_stations(spark, [(1, "s1"), (2, "s2")])
    journeys = fleet.bike_journeys(trips, points, 7, 2016, 1, 1)
    assert [r.duration for r in journeys.collect()] == [90, 60]
    assert journeys.first().start_lat == pytest.approx(51.02)
    assert fleet.journey_count(journeys).first()[0] == 2
    assert fleet.bike_journeys(trips, points, 7, None, 1, 1).count() == 0


def test_station_map_colours(spark, sample):
    rows, trips = sample
    points = make_stations(spark, [(i, f"s{i}") for i in range(8)])
    counts = collections.Counter(r[1] for r in rows if r[1] in {f"s{i}" for i in range(8)})
    low, high = min(counts.values()), max(counts.values())
    got = {r.id: r for r in stations.station_map(trips, points).collect()}
    assert len(got) == 8
    for i, row in got.items():
        assert row.trip_count == counts[f"s{i}"]
        assert row.colour_value == pytest.approx((counts[f"s{i}"] - low) / (high - low))
        assert (row.geometry.lon, row.geometry.lat) == (row.longitude, row.latitude)
    single = stations.station_map(trips, points.where("id = 1")).collect()
    assert len(single) == 1 and single[0].colour_value is None


@pytest.mark.parametrize("side", [1, 3, 256])
def test_pairs_against_brute_force(spark, sample, monkeypatch, side):
    monkeypatch.setattr(dead, "BLOCK_SIDE", side)
    rows, trips = sample
    # Stations not ridden, two of one name, and one without a name.
    listed = [(i, f"s{i}") for i in range(2, 15)] + [(40, "s3"), (41, None)]
    points = make_stations(spark, listed)
    names = [n for _, n in listed]
    pairs = collections.Counter(itertools.product(names, names))
    routes = collections.Counter((r[1], r[2]) for r in rows)
    known = {p for p in routes if None not in p}

    def counted(df):
        return collections.Counter(tuple(r) for r in df.collect())

    assert counted(dead.possible_trips(points)) == pairs
    lonely = collections.Counter({p: c for p, c in pairs.items() if p not in known})
    assert counted(dead.dead_trips(trips, points)) == lonely
    matrix = dead.pair_matrix(trips, points)
    assert counted(matrix.select("start_station_name", "end_station_name", "trip_count")) == {
        (*p, routes[p] if p in known else 0): c for p, c in pairs.items()}
    summary = dead.dead_trips_summary(trips, points).first()
    assert summary.stations == len(names) and summary.possible_pairs == len(names) ** 2
    assert summary.recorded_pairs == len(routes)
    assert summary.unrecorded_estimate == len(names) ** 2 - len(routes)
    assert summary.dead_pairs == sum(lonely.values())
    assert counted(dead.dead_trips_sample(trips, points, 1.0)) == lonely
    picked = {tuple(dead.pick_dead_trip(trips, points, seed).first()) for seed in range(6)}
    assert picked <= set(lonely) and len(picked) > 2
    few = counted(dead.dead_trips_sample(trips, points, 0.1, 3))
    assert few <= lonely and abs(sum(few.values()) - 0.1 * sum(lonely.values())) <= 1
    uneven = counted(dead.dead_trips_sample(trips, points, 0.7))
    assert uneven <= lonely and sum(uneven.values()) > 0.5 * sum(lonely.values())
    assert dead.dead_trips_sample(trips, points, 0.0).collect() == []


def test_lines_of_carried_texts_are_the_same(spark):
    points = spark.createDataFrame(
        [(1, "a", -0.1, 51.5), (2, "b", None, 51.6), (3, "c", -0.2, None), (4, None, None, None),
         (5, "a", 9.0, 9.0), (6, "d", -0.00000049, 51.4999995)],
        "id int, name string, longitude double, latitude double")
    placed = stations.with_place(points)
    pairs = dead.possible_trips(placed, stations.PLACE)
    texts = [c for c in pairs.columns if c.endswith("_text")]
    carried, written = (stations.trip_lines(df) for df in (pairs, pairs.drop(*texts)))
    assert len(texts) == 4 and carried.columns == written.columns
    rows = collections.Counter(map(str, carried.collect()))
    assert rows == collections.Counter(map(str, written.collect())) and sum(rows.values()) == 36
    lines = {(r.start_station_name, r.end_station_name): (r.wkt, r.start_text, r.end_text)
             for r in carried.collect()}
    assert lines["a", "d"] == ("LINESTRING (-0.100000 51.500000, -0.000000 51.500000)",
                               "51.500000, -0.100000", "51.500000, -0.000000")
    assert lines["a", "c"] == ("LINESTRING (-0.100000 51.500000, -0.100000 51.500000)",
                               "51.500000, -0.100000", None)
    assert lines["b", "a"] == (None, None, "51.500000, -0.100000")


def test_nothing_to_pick_where_all_pairs_were_ridden(spark):
    trips = make_trips(spark, [(1, a, b, 1, 2016, 1, 1) for a in ("s1", "s2") for b in ("s1", "s2")])
    points = make_stations(spark, [(1, "s1"), (2, "s2")])
    assert dead.pick_dead_trip(trips, points).collect() == []
    assert dead.dead_trips_sample(trips, points, 1.0).collect() == []
    three = make_stations(spark, [(1, "s1"), (2, "s2"), (3, "s0")])
    assert len(dead.dead_trips_sample(trips, three, 1.0).collect()) == 5


def test_no_stations_no_pairs(spark, sample):
    _, trips = sample
    none = make_stations(spark, [(1, "x")]).where("id = 2")
    assert dead.possible_trips(none).count() == 0
    assert dead.dead_trips_summary(trips, none).first().dead_pairs == 0
    assert dead.pick_dead_trip(trips, none).collect() == []
    assert dead.dead_trips_sample(trips, none, 0.5).collect() == []


def test_message(spark):
    summary = spark.createDataFrame(
        [(1200, 1440000, 1, 1439999, 5)],
        "stations long, possible_pairs long, recorded_pairs long, unrecorded_estimate long, "
        "dead_pairs long")
    pick = spark.createDataFrame([("A", "B")], "start_station_name string, end_station_name string")
    assert dead.dead_trips_message(summary, pick).first()[0] == (
        "5 of the 1,440,000 pairs among 1200 stations are unridden, such as A to B.")
    ridden = summary.withColumn("dead_pairs", F.lit(0).cast("bigint"))
    assert dead.dead_trips_message(ridden, pick.where("false")).first()[0] == (
        "All 1,440,000 pairs among 1200 stations have been ridden.")


def test_undated_trips_are_no_bike_day(spark):
    days = [(7, "s1", "s2", 60, 2016, 1, 1)] * 2 + [(8, "s1", "s2", 60, None, None, None)] * 9
    trips = make_trips(spark, days)
    assert [r.bike_id for r in fleet.top_bike_days(trips).collect()] == [7]
    pick = fleet.pick_busy_bike(trips).first()
    assert (pick.bike_id, pick.start_year) == (7, 2016)
    assert [r.bike_days for r in distributions.trip_count_hist(trips).collect()] == [1]
    assert fleet.busy_bikes(trips).count() == 2


def test_histogram_bounds_are_arguments(spark):
    trips = make_trips(spark, [(1, "s1", "s2", n, 2016, 1, 1) for n in range(1, 4001)])
    assert distributions.duration_hist(trips).first().bins <= 50
    few = distributions.duration_hist(trips, max_bins=4).collect()
    assert len(few) == 4 and sum(r.trips for r in few) == 4000
    assert distributions.duration_hist(trips, max_bins=4, shown=(1, 2)).count() == 2
    short = distributions.duration_hist(trips, limit_seconds=100).collect()
    assert sum(r.trips for r in short) == 99
    assert distributions.duration_density(trips, limit_seconds=600).count() == 11


def test_coordinates_of_pairs(spark):
    points = make_stations(spark, [(1, "s1"), (2, "s2"), (3, "s2")])
    pairs = spark.createDataFrame([("s1", "s2"), ("s2", "s9")],
                                  "start_station_name string, end_station_name string")
    rows = stations.with_coordinates(pairs, points).collect()
    assert len(rows) == 1 and rows[0].end_lat == pytest.approx(51.02)
    wanted = spark.createDataFrame([("s2",), ("s2",)], "name string")
    assert {r.id for r in stations.stations_by_name(points, wanted).collect()} == {2, 3}


def test_trip_count_histogram_is_numpy_s(sample):
    rows, trips = sample
    per_day = collections.Counter((r[0], *r[4:]) for r in rows if r[4] is not None)
    counts, edges = np.histogram(list(per_day.values()), bins=20)
    got = {r.bin: r for r in distributions.trip_count_hist(trips).collect()}
    assert {b: r.bike_days for b, r in got.items()} == {
        b: c for b, c in enumerate(counts) if c}
    for b, row in got.items():
        assert (row.bin_start, row.bin_end) == pytest.approx((edges[b], edges[b + 1]))


def test_equal_values_share_the_middle_bin(spark):
    trips = make_trips(spark, [(b, "s1", "s2", 60, 2016, 1, 1) for b in range(5)])
    counts, _ = np.histogram([1] * 5, bins=20)
    row = distributions.trip_count_hist(trips).collect()
    assert [(r.bin, r.bike_days) for r in row] == [(int(np.argmax(counts)), 5)]
    flat = distributions.duration_hist(trips).collect()
    assert [(r.bins, r.bin, r.trips) for r in flat] == [(2, 1, 5)]
    assert {r.density for r in distributions.duration_density(trips).collect()} == {None}


def durations(rows, kind):
    return np.array([r[3] for r in rows if r[3] < 7200 and (
        (r[1] is not None and r[1] == r[2]) == (kind == "Round Trip"))], dtype=float)


@pytest.mark.parametrize("kind", ["Round Trip", "Point to Point"])
def test_duration_histogram_is_numpy_s(sample, kind):
    rows, trips = sample
    x = durations(rows, kind)
    q1, q3 = np.percentile(x, [25, 75])
    bins = min(50, math.ceil((x.max() - x.min()) / (2 * (q3 - q1) * len(x) ** (-1 / 3))))
    density, edges = np.histogram(x, bins=bins, density=True)
    got = {r.bin: r for r in distributions.duration_hist(trips).where(
        F.col("trip_type") == kind).collect()}
    assert sum(r.trips for r in got.values()) == len(x)
    for b, row in got.items():
        assert row.bins == bins
        assert row.density == pytest.approx(density[b])
        assert row.bin_start == pytest.approx(edges[b])


@pytest.mark.parametrize("kind", ["Round Trip", "Point to Point"])
def test_duration_density_is_the_kernel_sum(sample, kind):
    rows, trips = sample
    x = durations(rows, kind)
    h = x.std(ddof=1) * len(x) ** -0.2
    got = distributions.duration_density(trips).where(F.col("trip_type") == kind).collect()
    assert len(got) == 121
    for row in got:
        want = np.exp(-((row.seconds - x) / h) ** 2 / 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
        assert row.density == pytest.approx(want)
        assert row.label == f"{row.seconds // 60}min"
    assert 0.8 < sum(r.density for r in got) * 60 <= 1


def test_weather_months(spark):
    table = spark.createDataFrame([(2014, 12), (2015, 2), (2015, 1)], "year int, month int")
    assert [r.month_label for r in weather.weather_monthly(table).collect()] == [
        "January 2015", "February 2015"]
    assert weather.weather_monthly(table, min_year=2013).count() == 3


def test_prepared_trips_are_unique(spark, sf_dir):
    trips = fixtures.trips(spark, sf_dir)
    assert trips.distinct().count() == trips.count()
