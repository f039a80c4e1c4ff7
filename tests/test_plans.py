"""What the plans have to look like for large data."""

import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import skymetrics
from checks.registry import QUERIES
from checks import derived
from skymetrics.operators import counts, enrich, filters
from skymetrics.operators.ranking import largest_first, top_n
from skymetrics.operators.zones import assign_by_tiles, assign_zone, zone_tiles
from skymetrics.plans.jobs import QUESTIONS, answer, ingest
from skymetrics.schemas import TABLES
from skymetrics.sources.landing import accepted, read_feed
from skymetrics.sources.snapshots import read_snapshot, write_snapshot
from tests.conftest import SF_SMALL
from tests.helpers import final_plan

AT = datetime(2024, 3, 5, 7)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    write_snapshot(derived.flights(spark, SF_SMALL), root, "flights", AT)
    write_snapshot(derived.airports(spark, SF_SMALL, country=True), root, "airports", AT)
    write_snapshot(derived.airlines(spark, SF_SMALL, country=True), root, "airlines", AT)
    zoned = enrich.zoned_airports(
        derived.airports(spark, SF_SMALL, country=True), derived.zones(spark)
    )
    write_snapshot(zoned, root, "zoned_airports", AT)
    return root


@pytest.fixture(scope="module")
def plans(spark, store):
    return {name: final_plan(answer(spark, name, store, AT)) for name in QUESTIONS}


def scan(plan, column):
    """The scan lines that read a column."""
    return [line for line in plan.splitlines() if "FileScan" in line and column in line]


@pytest.mark.parametrize("question", QUESTIONS)
def test_nothing_runs_in_python_or_pairs_all_rows(plans, question):
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in plans[question]


@pytest.mark.parametrize(
    ("question", "columns"),
    [
        ("kpi1", {"airlineCode", "flightStatus"}),
        ("kpi2", {"airlineCode", "airportOrigineCode", "airportDestinationCode"}),
        ("kpi4", {"airportOrigineCode", "airportDestinationCode"}),
        ("kpi5", {"aircraft", "flightStatus"}),
        ("kpi6", {"airlineCode", "aircraft"}),
    ],
)
def test_the_fact_scan_reads_the_columns_it_needs(spark, store, question, columns):
    plan = answer(spark, question, store, AT)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"flights.*ReadSchema: struct<([^>]*)>", plan)
    assert schemas and {c.split(":")[0] for c in schemas[0].split(",")} == columns


@pytest.mark.parametrize("question", ["kpi1", "kpi3", "kpi5"])
def test_the_status_filter_reaches_the_scan(plans, question):
    assert "EqualTo(flightStatus,0)" in plans[question]


@pytest.mark.parametrize("question", QUESTIONS)
def test_small_dimensions_leave_the_fact_table_where_it_is(plans, question):
    """No exchange lies between the flights scan and the first aggregation or top-1."""
    lines = plans[question].splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "flights" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    below = depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < below:
            below = depth(line)
            text = line.lstrip(" :+-*()0123456789")
            assert not text.startswith(("Exchange", "SortMergeJoin"))
            if text.startswith(("HashAggregate", "TakeOrderedAndProject")):
                return
    raise AssertionError("no aggregation above the scan")


def test_longest_flight_joins_inner_and_keeps_one_row_per_task(plans):
    assert "TakeOrderedAndProject(limit=1" in plans["kpi3"]
    assert "LeftOuter" not in plans["kpi3"] and "ReusedExchange" in plans["kpi3"]


@pytest.mark.parametrize("question", ["kpi2", "kpi6"])
def test_groups_are_cut_to_their_top_before_they_move(plans, question):
    assert len(re.findall(r"WindowGroupLimit .* Partial", plans[question])) == 1
    assert len(re.findall(r"WindowGroupLimit .* Final", plans[question])) == 1


@pytest.mark.parametrize("question", ["kpi1", "kpi5"])
def test_a_global_top_needs_no_window(plans, question):
    assert "TakeOrderedAndProject" in plans[question] and "Window" not in plans[question]


def test_flights_take_part_in_no_airline_join(plans):
    for question in ("kpi1", "kpi2", "kpi6"):
        flights_at = plans[question].index("flights/tech_year")
        airline_join = [m.start() for m in re.finditer(r"Join.*\[airlineCode#", plans[question])]
        aggregate = plans[question].rindex("HashAggregate", 0, flights_at)  # the lowest
        assert airline_join and all(at < aggregate for at in airline_join)


def test_a_snapshot_read_plans_from_its_own_folder(spark, store):
    df = read_snapshot(spark, store, "flights", AT, TABLES["flights"])
    assert all("tech_hour=07" in f for f in df.inputFiles())


def test_a_feed_is_parsed_once(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"id": "1", "on_ground": 0}\n')
    good = filters.clean_flights(accepted(read_feed(spark, str(tmp_path), "flights")))
    assert final_plan(good).count("from_json") == 1


def test_a_feed_with_rejects_is_scanned_once(spark, tmp_path):
    landing = tmp_path / "landing" / "flights"
    landing.mkdir(parents=True)
    (landing / "f.json").write_text('{"id": "1", "on_ground": 0}\n{"id"\n')
    reads = []
    text = type(spark.read).text
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "text", lambda *a, **k: reads.append(1) or text(*a, **k))
        spark.sparkContext.setJobGroup("ingest", "ingest")
        assert ingest(spark, str(tmp_path / "landing"), str(tmp_path / "store"), "flights", AT) == 1
    tracker = spark.sparkContext.statusTracker()
    names = [
        tracker.getStageInfo(stage).name
        for job in tracker.getJobIdsForGroup("ingest")
        for stage in tracker.getJobInfo(job).stageIds
    ]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(reads) == 1
    # Both sides are written at once and then moved; rejects are counted from what was written.
    assert sum("parquet" in name for name in names) == 1 and sum("count" in name for name in names) <= 2


def hot_star(spark, store):
    """Stored airports, and flights of which two thirds leave one airport and go to another."""
    airports = read_snapshot(spark, store, "airports", AT, TABLES["airports"])
    hot = F.col("id") % 3 < 2

    def airport(hub, others):
        return F.when(hot, hub).otherwise(F.concat(F.lit("A"), F.col("id") % others))

    flights = spark.range(0, 300_000, numPartitions=8).select(
        F.col("id").cast("string").alias("flightID"),
        F.lit("a").alias("aircraft"),
        F.concat(F.lit("S"), F.col("id") % 9).alias("airlineCode"),
        airport("A7", 140).alias("airportOrigineCode"),
        airport("A20", 130).alias("airportDestinationCode"),
        F.lit("0").alias("flightStatus"),
    )
    return flights, airports


def test_hot_airports_are_split_when_the_dimension_is_too_large_to_broadcast(spark, store, conf):
    flights, airports = hot_star(spark, store)
    want = enrich.with_airports(flights, airports)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    split = enrich.with_airports(flights, airports)
    assert final_plan(split).count("SortMergeJoin(skew=true)") == 2
    assert split.count() == 300_000 and split.exceptAll(want).isEmpty()


def strips(spark, n):
    """Zones from pole to pole, side by side, some twenty tiles each."""
    width = 360 / n
    return spark.range(n).selectExpr(
        "cast(id as int) zone_seq", "concat('z', id) continent", "'s' subzone",
        "90e0 tl_y", f"id * {width}e0 - 180 tl_x", "-90e0 br_y", f"(id + 0.5e0) * {width}e0 - 180 br_x",
    )


@pytest.mark.parametrize("stored", [False, True], ids=["cut in the plan", "stored"])
@pytest.mark.parametrize("n, join", [(9, "BroadcastHashJoin"), (100_000, "SortMergeJoin")])
def test_the_size_of_the_tiles_decides_their_join(spark, tmp_path, conf, stored, n, join):
    # The many are too large as tiles, the points on either side of the join always.
    conf("spark.sql.autoBroadcastJoinThreshold", "1MB")
    points = spark.range(40_000).selectExpr("id / 300e0 - 70e0 lat", "id % 359 - 179.5e0 lon")
    zones = strips(spark, n)
    if stored:
        zone_tiles(zones).write.parquet(f"{tmp_path}/tiles")
        tiles = spark.read.parquet(f"{tmp_path}/tiles")
        zoned = assign_by_tiles(points, tiles, "lat", "lon", "zone")
    else:
        zoned = assign_zone(points, zones, "lat", "lon", "zone")
    joins = re.findall(r"(\w+Join)(?:\(skew=true\))? \[_(?:level|tile_[xy])#", final_plan(zoned))
    assert joins == [join]
    place = (F.col("lon") + 180) / (360 / n)
    strip = F.when(place - F.floor(place) <= 0.5, F.concat(F.lit("z"), F.floor(place).cast("int")))
    edge = F.abs(F.abs(place * 2 - F.round(place * 2))) < 1e-6
    assert zoned.filter(~edge & ~F.col("zone").eqNullSafe(strip)).isEmpty()


def test_no_join_is_prescribed():
    for path in Path(skymetrics.__file__).parent.glob("[!l]*/**/*.py"):
        assert not re.search(r"hint\(\"(?!rebalance)|broadcast\(", path.read_text()), path


def test_a_hot_airline_is_combined_before_it_moves(spark, store):
    flights, _ = hot_star(spark, store)
    hot = F.when(F.col("flightID") % 10 > 0, "S1").otherwise(F.col("airlineCode"))
    airlines = read_snapshot(spark, store, "airlines", AT, TABLES["airlines"])
    plan = final_plan(counts.usage_by_country(flights.withColumn("airlineCode", hot), airlines))
    first_move = plan[plan.rindex("Exchange hashpartitioning(") :]
    assert "partial_count" in first_move.splitlines()[1]


def test_a_hot_group_is_ranked_without_gathering_it(spark):
    group = F.when(F.col("id") % 10 > 0, "hot").otherwise("cold")
    df = spark.range(0, 100_000, numPartitions=8).select(group.alias("g"), "id")
    top = top_n(df, largest_first("id"), n=3, per=["g"], rank="rank")
    assert re.search(r"Exchange .*\n.*WindowGroupLimit .* Partial", final_plan(top))
    hot = top.filter("g = 'hot'").orderBy("rank")
    assert [r.id for r in hot.collect()] == [99_999, 99_998, 99_997]


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("src", "snap", "res"))])
def test_no_registered_query_runs_python_code(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop", "ExistingRDD"):
        assert word not in plan
