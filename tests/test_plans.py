"""Properties of the physical plans, which small data cannot show by its results."""

import re

import pytest

from spokeframe.operators import dead_trips as dead
from spokeframe.operators import drift, fleet
from spokeframe.plans import fixtures
from spokeframe.plans.catalog import QUERIES
from spokeframe.session import choose_root, shared_folder
from spokeframe.sources import trips
from spokeframe.sources.trips import read_trips_csv


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_and_no_nested_loops(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_trips_are_read_by_column(spark, sf_dir):
    plan = plan_of(QUERIES["trips_by_year"](spark, sf_dir))
    # Years are folder names; no column is read to count by them.
    assert "ReadSchema: struct<>" in plan
    plan = plan_of(QUERIES["top_start_stations"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan and "ReadSchema: struct<start_station_name:string>" in plan


def test_filters_reach_the_scan(spark, sf_dir):
    trips, points = fixtures.trips(spark, sf_dir), fixtures.stations(spark, sf_dir)
    plan = plan_of(fleet.bike_journeys(trips, points, 7, 1996, 3, 2))
    for pushed in ("EqualTo(bike_id,7)", "EqualTo(start_day,2)"):
        assert pushed in plan
    folders = re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]
    assert "= 1996" in folders and "= 3" in folders


def test_the_chosen_day_prunes_the_month_folders(spark, sf_dir):
    df = QUERIES["bike_journeys"](spark, sf_dir)
    assert re.search(r"PartitionFilters: \[[^\]]*start_year[^\]]*subquery", plan_of(df), re.I)


JOINS = ["bike_journeys", "station_map", "stations_by_name", "trip_lines", "dead_trips",
         "pair_matrix", "dead_trips_summary", "manifest_new_files"]


@pytest.mark.parametrize("name", JOINS)
def test_joins_without_broadcasts_compare_keys(spark, sf_dir, name):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    if name == "trip_lines":
        # The pairs' blocks and the anti join are the only joins; coordinates come along.
        assert len(re.findall(r"(?:SortMerge|ShuffledHash|BroadcastHash)Join", plan)) == 2


def test_the_duration_limit_reaches_the_scan(spark, sf_dir):
    assert "LessThan(duration,7200)" in plan_of(QUERIES["duration_hist"](spark, sf_dir))


def test_duplicates_collapse_before_the_only_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["prepare_trips"](spark, sf_dir)).split("Subquery")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "HashAggregate" in before and "HashAggregate" in after


def test_the_fleet_report_is_one_scan(spark, sf_dir):
    plan = plan_of(QUERIES["utilisation"](spark, sf_dir))
    assert plan.count("FileScan") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", ["station_map", "trip_count_hist"])
def test_ranges_do_not_scan_the_trips_again(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReusedExchange \[(bike_id|start_station)", plan)


@pytest.mark.parametrize("name", ["dead_trips_sample", "pick_dead_trip", "dead_trips_message"])
def test_picks_of_never_ridden_pairs_list_no_pairs(spark, sf_dir, name):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for node in ("Anti", "NestedLoop", "Cartesian", "row#"):
        assert node not in plan


def test_drift_is_counted_in_the_pass_that_prepares(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Rental Id\n1\n")
    raw = read_trips_csv(spark, str(tmp_path))
    plan = plan_of(drift.prepare_observed(raw)[0])
    assert "CollectMetrics" in plan and plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_dead_trips_is_an_anti_join(spark, sf_dir):
    assert "LeftAnti" in plan_of(QUERIES["dead_trips"](spark, sf_dir))


def test_pair_blocks_are_joined_by_equality_without_broadcast(spark, sf_dir):
    plan = plan_of(QUERIES["possible_trips"](spark, sf_dir))
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan


def test_prepared_trips_are_written_once_to_the_shared_folder(spark, sf_dir):
    top = shared_folder(spark).rsplit("/", 1)[0]
    assert shared_folder(spark) != shared_folder(spark)
    assert shared_folder(spark).rsplit("/", 1)[0] == top
    files = fixtures.trips(spark, sf_dir).inputFiles()
    assert files and all(top in f for f in files)
    assert fixtures.trips(spark, sf_dir).inputFiles() == files


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        choose_root(None, master)
    assert choose_root("hdfs://all/of/it/", master) == "hdfs://all/of/it"


def test_one_process_may_use_a_temporary_folder():
    assert choose_root(None, "local[4]") != choose_root(None, "local[4]")


@pytest.mark.parametrize("name", ["pair_matrix", "dead_trips", "trip_lines"])
def test_pairs_are_not_shuffled(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    # The join on the blocks alone makes the pairs; nothing is dealt out above it.
    above = re.split(r"ShuffledHashJoin \[row#\d+, column#\d+\], \[row#\d+, column#\d+\], Inner", plan)[0]
    assert above != plan and "Exchange" not in above and "Sort" not in above


@pytest.mark.parametrize("name", ["pair_matrix", "dead_trips", "trip_lines"])
def test_repeated_starts_are_not_broadcast(spark, sf_dir, name, monkeypatch):
    """Repeated for the blocks, the starts were taken for as few as the stations and broadcast."""
    plans = []
    keep = dead.through_table
    monkeypatch.setattr(dead, "through_table", lambda df: plans.append(plan_of(df)) or keep(df))
    plans.append(plan_of(QUERIES[name](spark, sf_dir)))
    assert len(plans) == 2 and "LeftAnti" in plans[1]
    for plan in plans:
        keys = r"Join \[start_station_name#\d+, column#\d+\]"
        assert re.search("SortMerge" + keys, plan) and not re.search("Broadcast(?:Hash)?" + keys, plan)


def test_coordinates_are_written_out_per_station_not_per_pair(spark, sf_dir):
    """Formatting numbers took nearly all the time of the lines."""
    plan = plan_of(QUERIES["trip_lines"](spark, sf_dir))
    pairs = plan.split("Generate inline(ends#")[0]
    assert pairs != plan and "LINESTRING" in pairs and "format_string" not in pairs


def test_long_lists_are_cut_into_no_more_blocks_than_tasks_need(spark, monkeypatch):
    monkeypatch.setattr(dead, "BLOCK_SIDE", 1)
    monkeypatch.setattr(dead, "BLOCKS_PER_ROOT", 2)
    points = spark.range(500).selectExpr("cast(id as int) id", "concat('s', id) name")
    # Eight partitions: six blocks a side, not five hundred.
    assert dead._starts(points).count() == 6 * 500
    assert dead.possible_trips(points).distinct().count() == 500 * 500


def test_a_start_meets_the_ends_of_its_block_as_one_array(spark, sf_dir, monkeypatch):
    """Matched one by one, a pair cost the more the longer the list was."""
    for name in ("possible_trips", "pair_matrix", "dead_trips", "trip_lines"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        above = re.split(r"ShuffledHashJoin \[row#\d+, column#\d+\], \[row#\d+, column#\d+\], Inner", plan)[0]
        assert above != plan and "Generate inline(ends#" in above
    monkeypatch.setattr(dead, "BLOCK_SIDE", 1)
    monkeypatch.setattr(dead, "BLOCKS_PER_ROOT", 2)
    points = spark.range(500).selectExpr("cast(id as int) id", "if(id < 490, concat('s', id), null) name")
    ends = dead._ends(points, ["id"])
    assert ends.count() == 6 * 6
    each = ends.selectExpr("row", "inline(ends)")
    assert each.count() == 6 * 500 and each.distinct().count() == 6 * 500
    assert each.where("end_station_name is null").count() == 6 * 10
    assert each.where("end_station_name <> concat('s', end_id)").count() == 0


def test_pairs_are_made_in_many_tasks_where_partitions_are_few(spark, sf_dir):
    """Eight tasks of minutes each took a third more CPU than many short ones."""
    for name in ("possible_trips", "pair_matrix", "dead_trips", "trip_lines"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        dealt = re.findall(r"Exchange hashpartitioning\(row#\d+, column#\d+, (\d+)\)", plan)
        assert len(dealt) == 2 and set(dealt) == {str(dead.PAIR_TASKS)}


def test_stations_are_dealt_before_they_are_repeated(spark, sf_dir):
    """One task repeated them for all blocks where one had read them."""
    plan = plan_of(QUERIES["possible_trips"](spark, sf_dir))
    repeated = plan.split("Generate explode(sequence(")[1:]
    assert len(repeated) == 2
    assert all("REPARTITION_BY_NUM" in below for below in repeated)


def test_calendar_parts_follow_the_shuffle_to_the_months(spark, tmp_path, monkeypatch):
    """The table of months is gathered on the columns that the parts follow from."""
    gathered = []
    keep = trips._gathered
    monkeypatch.setattr(trips, "_gathered", lambda df: gathered.append(df.columns) or keep(df))
    trips.write_raw_trips(fixtures.raw_trips(spark, "/root/testdata/sf0.001"), str(tmp_path / "t"))
    assert sorted(gathered[0]) == sorted([*trips.BARE, "start_year", "start_month"])


def test_draws_are_made_behind_the_shuffle_of_recorded_ends(spark, sf_dir):
    """Not where starts are few: all draws were made by the one task that held the starts."""
    plan = plan_of(QUERIES["dead_trips_sample"](spark, sf_dir))
    above = re.split(r"Exchange hashpartitioning\(start_station_name#\d+, \d+\), REPARTITION_BY_NUM", plan)[0]
    below = plan[len(above):]
    assert below and "explode(array_distinct" in above and "explode(array_distinct" not in below
