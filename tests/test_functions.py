"""Column builders."""

import math

import pytest
from pyspark.sql import functions as F

from spokeframe.functions import calendar, geometry, grid, ordering, random_pick
from spokeframe.operators.stations import trip_lines


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/London"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    cases = {
        "10/01/2016 00:04": "2016-01-10 00:04:00",
        "13/03/2016 02:30": "2016-03-13 02:30:00",  # no such time in New York
        "27/03/2016 01:30": "2016-03-27 01:30:00",  # nor in London
        "29/02/2016 23:59": "2016-02-29 23:59:00",
        "10/01/2016 00:04:30": None, "31/02/2016 00:00": None, "1/2/2016 00:00": None,
        "2016-01-10 00:04": None, "10/13/2016 00:00": None, "10/01/2016 24:00": None,
        " 1/01/2016 00:00": None, "n/a": None, "": None, None: None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in cases], "t string")
        got = df.select("t", calendar.parse_minute_ts("t").cast("string").alias("ts")).collect()
        assert {r.t: r.ts for r in got} == cases
        label = spark.sql("SELECT 2016 AS y, 3 AS m").select(calendar.month_label("y", "m"))
        assert label.first()[0] == "March 2016"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_labels(spark):
    df = spark.createDataFrame([(2016, 3), (2016, 13), (None, 1), (2016, None)], "y int, m int")
    rows = df.select(calendar.month_key("y", "m").alias("k"),
                     calendar.month_label("y", "m").alias("l")).collect()
    assert [tuple(r) for r in rows] == [
        ("2016-3", "March 2016"), ("2016-13", None), (None, None), (None, None)]
    assert spark.range(1).select(calendar.minutes_label(F.lit(5400))).first()[0] == "90min"


def test_transverse_mercator_at_the_published_point(spark):
    lat = 52 + 39 / 60 + 27.2531 / 3600
    lon = 1 + 43 / 60 + 4.5177 / 3600
    point = spark.createDataFrame([(math.radians(lon), math.radians(lat))],
                                  "_airy_lam double, _airy_phi double")
    row = grid.transverse_mercator(point).first()
    assert row.osgb_x == pytest.approx(651409.903, abs=0.001)
    assert row.osgb_y == pytest.approx(313177.270, abs=0.001)


def test_grid_of_wgs84_points(spark):
    df = spark.createDataFrame([(-0.12, 51.5), (None, 51.5)], "longitude double, latitude double")
    known, unknown = grid.with_grid(df).collect()
    assert known.osgb_x == pytest.approx(530591.166, abs=0.01)
    assert known.osgb_y == pytest.approx(179571.066, abs=0.01)
    assert unknown.osgb_x is None


def test_points_and_lines(spark):
    df = spark.createDataFrame(
        [(-0.1, 51.5, -0.2, 51.6), (-0.1, 51.5, -0.1, 51.5), (-0.1, 51.5, None, None),
         (-0.0001, 51.5, -0.2, None), (None, 51.5, -0.2, 51.6), (-0.1, None, -0.2, 51.6)],
        "start_lon double, start_lat double, end_lon double, end_lat double")
    rows = trip_lines(df).collect()
    assert [r.wkt for r in rows] == [
        "LINESTRING (-0.100000 51.500000, -0.200000 51.600000)",
        "LINESTRING (-0.100000 51.500000, -0.100000 51.500000)",
        "LINESTRING (-0.100000 51.500000, -0.100000 51.500000)",
        "LINESTRING (-0.000100 51.500000, -0.000100 51.500000)", None, None]
    assert (rows[0].start_text, rows[0].end_text) == (
        "51.500000, -0.100000", "51.600000, -0.200000")
    assert [r.end_text for r in rows[2:4]] == [None, None]
    assert rows[4].start_text is None and rows[4].geometry is None
    assert rows[0].geometry[1].lat == 51.6
    point = df.select(geometry.point("start_lon", "start_lat").alias("p"),
                      geometry.point_wkt("start_lon", "start_lat").alias("w"),
                      geometry.grid_point("start_lon", "start_lat").alias("g")).first()
    null = df.select(geometry.point_wkt("end_lon", "end_lat").alias("w"),
                     geometry.point("end_lon", "end_lat").alias("p")).collect()[3]
    assert (null.w, null.p) == (None, None)
    assert (point.p.lon, point.w, point.g.srid) == (-0.1, "POINT (-0.100000 51.500000)", 27700)


def test_picks_repeat_on_any_partitioning(spark):
    df = spark.range(1000).withColumn("b", F.col("id") * 3)
    one = random_pick.pick_one(df, ("id", "b"), 5).collect()
    assert one == random_pick.pick_one(df.repartition(7), ("id", "b"), 5).collect()
    assert one != random_pick.pick_one(df, ("id", "b"), 6).collect()
    assert random_pick.pick_one(df.where("id < 0"), ("id", "b")).collect() == []
    kept = random_pick.sample_rows(df, ("id",), 0.2, 1)
    assert sorted(kept.collect()) == sorted(
        random_pick.sample_rows(df.repartition(5), ("id",), 0.2, 1).collect())
    assert 130 < kept.count() < 270
    assert random_pick.sample_rows(df, ("id",), 1.0).count() == 1000
    assert random_pick.sample_rows(df, ("id",), 0.0).count() == 0


def test_numbers_and_totals_along_an_order(spark):
    rows = [(k % 7 if k % 3 else None, f"n{k % 11}", k) for k in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, v int").repartition(5)
    got = ordering.numbered(df, "nth", "a", "b", partitions=4).collect()
    assert sorted(r.nth for r in got) == list(range(500))
    order = [(r.a is not None, r.a or 0, r.b) for r in sorted(got, key=lambda r: r.nth)]
    assert order == sorted(order)
    total = 0
    summed = ordering.running_total(df, "v", "before", "v", partitions=4).orderBy("v").collect()
    for r in summed:
        assert r.before == total
        total += r.v
    assert ordering.numbered(df.where("false"), "nth", "a").collect() == []


def test_rows_equal_in_the_order_are_dealt_over_partitions(spark):
    many = spark.range(40_000).select(F.lit(None).cast("int").alias("id"), F.lit("x").alias("name"))
    few = spark.range(800).select(F.lit(5).alias("id"), F.lit("y").alias("name"))
    ranges = ordering.in_ranges(many.union(few), "id", "name", partitions=8)
    sizes = sorted(r["count"] for r in ranges.groupBy("_part").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
