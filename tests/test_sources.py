"""Golden rows through the readers and writers."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spokeframe.operators import drift, prepare
from spokeframe.operators.prepare import prepare_trips
from spokeframe.plans import fixtures
from spokeframe.schemas import STATIONS, TRIPS
from spokeframe.session import through_table
from spokeframe.sources import listing, stations, trips, weather

OLD_FILE = """Rental Id,Duration,Bike Id,End Date,EndStation Id,EndStation Name,Start Date,StartStation Id,StartStation Name
1,60,10,10/01/2016 00:04,5,"A, b",10/01/2016 00:00,6,B
1,60,10,10/01/2016 00:04,5,"A, b",10/01/2016 00:00,6,B
2,0,10,10/01/2016 00:04,5,A,10/01/2016 00:00,6,B
3,,10,,5,A,10/01/2016 00:00,6,B
x,90,10,10/01/2016 00:04:30,,A,31/02/2016 00:00,6,
"""
NEW_FILE = """Rental Id,Duration_Seconds,Bike Id,End Date,EndStation Id,EndStation Name,Start Date,StartStation Id,StartStation Name,Extra,More
7,120,11,11/02/2017 10:04,5,A,11/02/2017 10:00,6,B,zz,1
8,120,11,11/02/2017 10:04
"""


def drifting_trips(spark, tmp_path):
    (tmp_path / "a.csv").write_text(OLD_FILE)
    (tmp_path / "b.csv").write_text(NEW_FILE)
    return prepare_trips(trips.read_trips_csv(spark, f"{tmp_path}/*.csv"))


def test_drifting_trip_files(spark, tmp_path):
    rows = {r.rental_id: r for r in drifting_trips(spark, tmp_path).collect()}
    assert len(rows) == 4 and set(rows) == {1, None, 7, 8}
    assert rows[1].end_station_name == "A, b"
    assert str(rows[1].start_ts) == "2016-01-10 00:00:00"
    assert (rows[1].start_year, rows[1].start_month, rows[1].start_day) == (2016, 1, 10)
    assert (rows[1].start_day_of_week, rows[1].end_hour) == (1, 0)
    broken = rows[None]
    assert broken.start_ts is None and broken.end_ts is None and broken.start_year is None
    assert broken.end_station_id is None and broken.start_station_name is None
    assert rows[7].duration == 120 and rows[7].start_station_name == "B"
    assert rows[8].start_station_name is None and str(rows[8].end_ts) == "2017-02-11 10:04:00"


def test_column_order_and_types(spark, tmp_path):
    df = drifting_trips(spark, tmp_path)
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in TRIPS]


def test_prepared_table_is_replaced_in_both_layouts(spark, tmp_path, folder):
    df = drifting_trips(spark, tmp_path)
    expected = sorted(map(str, df.collect()))
    for by_month in (False, True):
        trips.write_trips(df, folder, by_month=by_month)
        back = trips.read_trips(spark, folder)
        assert back.columns == df.columns
        assert sorted(map(str, back.collect())) == expected


@pytest.mark.parametrize("by_month", [False, True])
def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, folder, by_month):
    df = drifting_trips(spark, tmp_path)
    trips.write_trips(df, folder, by_month=by_month)
    expected = sorted(map(str, trips.read_trips(spark, folder).collect()))
    failing = df.repartition(4).withColumn("bike_id", F.when(
        F.col("rental_id") == 8, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("bike_id")))
    with pytest.raises(Exception, match="lost"):
        trips.write_trips(failing, folder, by_month=by_month)
    assert sorted(map(str, trips.read_trips(spark, folder).collect())) == expected
    # The next write goes through, and what the failed one left is gone.
    trips.write_trips(df.limit(1), folder, by_month=by_month)
    assert trips.read_trips(spark, folder).count() == 1
    assert len([p for p in os.listdir(folder) if p.startswith("v-")]) == 2


def test_a_table_written_plainly_is_read(spark, tmp_path, folder):
    df = drifting_trips(spark, tmp_path)
    df.write.parquet(folder)
    assert trips.read_trips(spark, folder).count() == df.count()


def trip_line(i, bike, day, month=1):
    return f"{i},60,{bike},{day:02d}/{month:02d}/2016 00:04,5,A,{day:02d}/{month:02d}/2016 00:00,6,B\n"


def test_two_deliveries_equal_one(spark, tmp_path, folder):
    header = OLD_FILE.split("\n")[0] + "\n"
    one = header + trip_line(1, 7, 1) + trip_line(2, 7, 2, 3) + "3,60,7,bad,5,A,n/a,6,B\n"
    two = header + trip_line(1, 7, 1) + trip_line(4, 8, 9) + "3,60,7,bad,5,A,n/a,6,B\n" * 2
    (tmp_path / "one.csv").write_text(one)
    (tmp_path / "two.csv").write_text(two)
    files = [f"{tmp_path}/{n}.csv" for n in ("one", "two")]
    assert trips.merge_files(spark, folder, files[:1]) == files[:1]
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(
        f"{trips.current_version(spark, folder)}/**/*.parquet", recursive=True)}
    assert trips.merge_files(spark, folder, files) == files[1:]
    assert trips.merge_files(spark, folder, files) == []
    want = prepare_trips(trips.read_trips_csv(spark, files))
    assert sorted(map(str, trips.read_trips(spark, folder).collect())) == sorted(
        map(str, want.collect()))
    after = {f: os.stat(f).st_mtime_ns for f in before if os.path.exists(f)}
    # March is not in the second delivery; its file is as it was. The others are new.
    assert list(after) == [f for f in before if "start_month=3" in f] and after.items() <= before.items()


def test_one_bike_is_in_few_row_groups(spark, folder):
    day = F.make_timestamp_ntz(F.lit(2016), F.lit(1), 1 + F.col("id") % 28, F.lit(5), F.lit(0), F.lit(0))
    made = spark.range(60_000).select("id", (F.xxhash64("id") % 500).alias("bike"), day.alias("ts"))
    values = {"rental_id": F.col("id"), "bike_id": F.abs("bike"), "start_ts": F.col("ts"),
              "start_year": F.lit(2016), "start_month": F.lit(1)}
    table = made.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TRIPS))
    trips.write_trips(table, folder, by_month=True, row_group_bytes=64 << 10)
    groups = holding = 0
    for path in glob.glob(f"{trips.current_version(spark, folder)}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        at = [meta.schema.column(k).name for k in range(meta.num_columns)].index("bike_id")
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(at)
            groups += 1
            holding += column.statistics.min <= 77 <= column.statistics.max
    assert groups >= 5 and holding <= 2
    assert trips.read_trips(spark, folder).where("bike_id = 77").count() == table.where(
        "bike_id = 77").count()


def test_drift_counts(spark, tmp_path):
    (tmp_path / "a.csv").write_text(OLD_FILE)
    (tmp_path / "b.csv").write_text(NEW_FILE)
    raw = trips.read_trips_csv(spark, f"{tmp_path}/*.csv")
    got = {r.file.rsplit("/")[-1]: r for r in drift.drift_by_file(drift.with_file(raw)).collect()}
    assert tuple(got["a.csv"])[1:] == (5, 1, 1, 0, 0, 0, 1, 1)
    assert tuple(got["b.csv"])[1:] == (2, 0, 0, 1, 1, 1, 0, 0)
    prepared, observation = drift.prepare_observed(raw)
    assert sorted(map(str, prepared.collect())) == sorted(
        map(str, prepare_trips(raw).collect()))
    assert list(observation.get.values()) == [7, 1, 1, 1, 1, 1, 1, 1]


def test_month_layout_prunes_folders(spark, sf_dir, folder):
    from spokeframe.plans import fixtures
    trips.write_trips(fixtures.trips(spark, sf_dir), folder, by_month=True)
    month = trips.read_trips(spark, folder).where("start_year = 1996 AND start_month = 3")
    assert all("start_year=1996/start_month=3" in f for f in [
        r.f for r in month.select(F.input_file_name().alias("f")).distinct().collect()])
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_year" in plan


SNAPSHOT = """[
 {"id": "BikePoints_12", "commonName": "Here", "lat": 51.5, "lon": -0.12, "additionalProperties": [
   {"key": "NbBikes", "value": "3"}, {"key": "NbDocks", "value": "20"},
   {"key": "NbBikes", "value": "4"}, {"key": "NbEmptyDocks", "value": "16"}]},
 {"id": "BikePoints_3", "commonName": "There", "lat": 51.52, "lon": -0.1, "additionalProperties": []}
]"""


def test_station_snapshot(spark, tmp_path):
    path = tmp_path / "stations.json"
    path.write_text(SNAPSHOT)
    found = stations.stations_from_snapshot(stations.read_station_snapshot(spark, str(path)))
    rows = {r.id: r for r in found.collect()}
    assert (rows[12].num_docks, rows[12].num_bikes, rows[12].num_empty) == (20, 4, 16)
    assert (rows[3].num_docks, rows[3].num_bikes, rows[3].num_empty) == (0, 0, 0)
    assert rows[3].name == "There"


def test_station_file_is_numbered_by_id_and_read_by_position(spark, tmp_path, folder):
    path = tmp_path / "stations.json"
    path.write_text(SNAPSHOT)
    found = stations.stations_from_snapshot(stations.read_station_snapshot(spark, str(path)))
    stations.write_stations_csv(found, folder)
    back = stations.read_stations_csv(spark, folder)
    assert back.columns == STATIONS.names
    assert {r.idx: r.id for r in back.collect()} == {0: 3, 1: 12}
    inferred = dict(stations.read_stations_csv(spark, folder, infer=True).dtypes)
    assert inferred["num_docks"] == "int" and inferred["latitude"] == "double"


def test_header_text_of_the_station_file_is_ignored(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        ",id,name,latitude,longitude,osgb_x,osgb_y,anything,num_bikes,num_empty\n"
        "0,7,X,51.5,-0.1,1.0,2.0,20,5,15\n")
    row = stations.read_stations_csv(spark, str(tmp_path)).first()
    assert (row.idx, row.id, row.num_docks) == (0, 7, 20)


def test_row_numbers_over_many_partitions(spark):
    df = spark.range(5, 400, 3).select(F.col("id").cast("int").alias("id"),
                                       F.lit("n").alias("name"))
    rows = stations.with_row_index(df).orderBy("id").collect()
    assert [r.idx for r in rows] == list(range(len(rows)))


LINES = [
    "Heading of the file",
    "              degC    degC    days      mm   hours",
    "   1948   1    8.9     3.3    ---     85.0    ---",
    "   1963   1    0.8    -4.4      25    33.8    52.0#",
    "   2018   9   21.2*   11.9       0    28.9   196.7  Provisional",
    "   2018  10   17.2     9.1       1    42.4   137.0  Provisional",
]


def test_weather_text(spark, tmp_path, folder):
    (tmp_path / "w.txt").write_text("\n".join(LINES))
    lines = weather.read_weather_text(spark, str(tmp_path / "w.txt"))
    expected = {
        (1948, 1): (8.9, 3.3, None, 85.0, None),
        (1963, 1): (0.8, -4.4, 25.0, 33.8, 52.0),
        (2018, 10): (17.2, 9.1, 1.0, 42.4, 137.0),
    }
    signed = weather.parse_weather(lines)
    assert {tuple(r[:2]): tuple(r[2:]) for r in signed.collect()} == expected
    unsigned = weather.parse_weather(lines, keep_sign=False)
    expected[(1963, 1)] = (0.8, 4.4, 25.0, 33.8, 52.0)
    assert {tuple(r[:2]): tuple(r[2:]) for r in unsigned.collect()} == expected
    marked = weather.parse_weather(lines, keep_marked=True)
    assert (2018, 9, 21.2) in {tuple(r[:3]) for r in marked.collect()}
    weather.write_weather_csv(signed, folder)
    back = weather.read_weather_csv(spark, folder)
    assert sorted(map(str, back.collect())) == sorted(map(str, signed.collect()))


LISTING = """<?xml version="1.0" encoding="UTF-8"?>
<ListBucketResult xmlns="http://example.org/doc"><Name>bucket</Name>
<Contents><Key>usage-stats/01a Journey Data.csv</Key><Size>1</Size></Contents>
<Contents><Key>usage-stats/x.xlsx</Key><Size>2</Size></Contents>
<Contents><Key>other/02.csv</Key></Contents>
<Contents><Key>usage-stats/2016/03 b.csv</Key></Contents>
</ListBucketResult>"""


def test_listing(spark, tmp_path):
    (tmp_path / "index.xml").write_text(LISTING)
    manifest = listing.file_manifest(
        listing.read_listing(spark, str(tmp_path / "index.xml")), "https://example.org/")
    assert {tuple(r) for r in manifest.collect()} == {
        ("usage-stats/01a Journey Data.csv", "01a_Journey_Data.csv",
         "https://example.org/usage-stats/01a Journey Data.csv"),
        ("usage-stats/2016/03 b.csv", "03_b.csv",
         "https://example.org/usage-stats/2016/03 b.csv"),
    }
    landed = spark.createDataFrame([("03_b.csv",), ("03_b.csv",)], "file_name string")
    assert [r.file_name for r in listing.new_files(manifest, landed).collect()] == [
        "01a_Journey_Data.csv"]


def test_views(spark, sf_dir):
    from spokeframe.plans import fixtures
    trips.register_views(fixtures.trips(spark, sf_dir), fixtures.stations(spark, sf_dir))
    assert spark.sql("SELECT count(*) FROM trips").first()[0] > 0
    assert spark.sql("SELECT count(*) FROM bike_points").first()[0] > 0


def test_raw_files_may_be_compressed(spark, sf_dir, folder, monkeypatch):
    monkeypatch.setattr(trips, "PACKED_ROWS", 700)
    raw = prepare.rename_raw(fixtures.raw_trips(spark, sf_dir))
    trips.write_trips_csv(raw, folder, compression="gzip")
    read = trips.read_trips_csv(spark, folder)
    assert all(f.endswith(".csv.gz") for f in read.inputFiles())
    assert len(read.inputFiles()) >= raw.count() / 700
    named = prepare.rename_raw(read).select(*raw.columns)
    assert named.exceptAll(raw).isEmpty() and raw.exceptAll(named).isEmpty()


@pytest.mark.parametrize("part_rows", [1 << 20, 10])
def test_merging_shuffles_once_and_writes_no_copy(spark, tmp_path, monkeypatch, part_rows):
    """A month of many rows is dealt into parts, undated trips too; copies still meet."""
    monkeypatch.setattr(trips, "PART_ROWS", part_rows)
    written = []
    monkeypatch.setattr(trips, "through_table", lambda df: written.append(df) or through_table(df))
    rows = [(i, 60, i % 3, "bad" if i % 5 == 0 else "01/02/2016 00:01", 1, "a",
             "bad" if i % 5 == 0 else "01/02/2016 00:00", 2, None if i % 4 == 0 else "b")
            for i in range(200)]
    columns = ("rental_id long, duration int, bike_id int, end_date string, end_station_id long, "
               "end_station_name string, start_date string, start_station_id long, "
               "start_station_name string")
    first, second = (spark.createDataFrame(part, columns) for part in (rows[:150], rows[100:]))
    path = str(tmp_path / "table")
    trips.write_raw_trips(first, path)
    assert trips.read_trips(spark, path).exceptAll(prepare.prepare_trips(first)).isEmpty()
    trips.merge_trips(spark, path, prepare.prepare_trips(second))
    assert len(written) == 1
    both = prepare.prepare_trips(spark.createDataFrame(rows, columns))
    merged = trips.read_trips(spark, path)
    assert merged.count() == 200 and merged.exceptAll(both).isEmpty()
