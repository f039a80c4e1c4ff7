import random
import re

import pytest
from pyspark.sql import functions as F

from skymetrics.operators.zones import FINEST, _tile, assign_by_tiles, assign_zone, settle_tiles, zone_tiles
from tests.helpers import AFRICA, BOXES, EUROPE, OVERLAP, first_zone, tuples, zones


def assigned(spark, points, boxes):
    df = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(points)], "i int, lat double, lon double"
    )
    out = assign_zone(df, zones(spark, boxes), "lat", "lon", "zone")
    assert out.columns == ["i", "lat", "lon", "zone"]
    rows = sorted(out.select("i", "zone").collect())
    assert [r.i for r in rows] == list(range(len(points)))
    return [r.zone for r in rows]


def test_edges_and_corners_belong_to_the_box(spark):
    _, name, _, top, left, bottom, right = AFRICA
    inside = [(top, 0.0), (bottom, 0.0), (0.0, left), (0.0, right), (top, left), (bottom, right)]
    outside = [(top + 1e-9, 0.0), (bottom - 1e-9, 0.0), (0.0, left - 1e-9), (0.0, right + 1e-9)]
    got = assigned(spark, inside + outside, [AFRICA])
    assert got == [name] * len(inside) + [None] * len(outside)


def test_first_zone_wins_in_sequence_not_row_order(spark):
    point = [(65.0, 20.0)]
    assert assigned(spark, point, [EUROPE, OVERLAP]) == ["europe"]
    assert assigned(spark, point, [OVERLAP, EUROPE]) == ["europe"]
    swapped = [(9, *EUROPE[1:]), OVERLAP]
    assert assigned(spark, point, swapped) == ["arctic"]


def test_date_line_box_holds_nothing(spark):
    points = [(-10.0, 170.0), (-10.0, -175.0), (-10.0, 110.0), (0.0, -170.0)]
    assert assigned(spark, points, BOXES) == [None] * 4


def test_missing_and_odd_coordinates(spark):
    nan, inf = float("nan"), float("inf")
    points = [(None, 0.0), (0.0, None), (None, None), (nan, 0.0), (0.0, nan), (inf, 0.0),
              (0.0, -inf), (-0.0, -0.0), (0.0, 0.0)]
    assert assigned(spark, points, BOXES) == [None] * 7 + ["africa"] * 2


def test_boxes_without_a_usable_corner_match_nothing(spark):
    nan = float("nan")
    boxes = [
        (0, "nan top", None, nan, -10.0, -10.0, 10.0),
        (1, "nan right", None, 10.0, -10.0, -10.0, nan),
        (2, "null", None, None, -10.0, -10.0, 10.0),
        (3, "upside down", None, -10.0, -10.0, 10.0, 10.0),
        (4, "whole", None, 90.0, -180.0, -90.0, 180.0),
    ]
    assert assigned(spark, [(0.0, 0.0)], boxes) == ["whole"]


def test_no_zones_at_all(spark):
    assert assigned(spark, [(0.0, 0.0), (None, 1.0)], []) == [None, None]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_boxes_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)

    def corner(limit):
        # Round numbers make points fall on edges and tile borders.
        return rng.choice([round(rng.uniform(-limit, limit)), rng.uniform(-limit, limit)])

    boxes = [
        (i, f"z{i}", None, float(corner(100)), float(corner(200)), float(corner(100)),
         float(corner(200)))
        for i in range(60)
    ]
    points = [(float(corner(100)), float(corner(200))) for _ in range(700)]
    points += [(b[3], b[4]) for b in boxes] + [(b[5], b[6]) for b in boxes]
    points += [(0.0, 0.0)] * 300  # many rows in one place
    got = assigned(spark, points, boxes)
    assert got == [first_zone(*p, boxes) for p in points]
    assert len(set(got)) > 10


def test_zones_without_a_place_in_the_order_are_left_out(spark):
    boxes = [
        (None, "a", None, 10.0, 0.0, 0.0, 10.0),
        (3, "c", None, 10.0, 0.0, 0.0, 10.0),
        (3, "b", None, 10.0, 0.0, 0.0, 10.0),
    ]
    assert assigned(spark, [(5.0, 5.0)], boxes) == ["b"]
    assert assigned(spark, [(5.0, 5.0)], boxes[:1]) == [None]


def test_boxes_of_every_size_meet_their_points(spark):
    inf = float("inf")
    boxes = [(i, f"z{i}", None, 2.0**i, -(2.0**i), -(2.0**i), 2.0**i) for i in range(-8, 12)]
    boxes.append((99, "all", None, inf, -inf, -inf, inf))
    points = [(s * 2.0**i + d, 0.0) for i in range(-8, 12) for s in (1, -1) for d in (0, 1e-9)]
    points += [(1e300, -1e300), (5000.0, 0.0)]
    assert assigned(spark, points, boxes) == [first_zone(*p, boxes) for p in points]


def test_few_and_many_zones_have_one_plan_and_run_nothing_while_it_is_made(spark):
    def boxes(n):
        return spark.range(n).selectExpr(
            "cast(id as int) zone_seq", "concat('z', id) continent", "'s' subzone",
            "id % 90 + 1e0 tl_y", "id % 170 * 1e0 tl_x", "id % 90 * 1e0 br_y",
            "id % 170 + 1e0 br_x",
        )

    points = spark.range(2000).selectExpr("id % 91 * 1e0 lat", "id % 171 * 1e0 lon")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("zones", "zones")
    few, many = (assign_zone(points, boxes(n), "lat", "lon", "zone") for n in (10, 5000))
    assert not tracker.getJobIdsForGroup("zones")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    shape = [re.findall(r"(\w+)(?: |$)", line)[:1] for line in explain(few)]
    assert shape == [re.findall(r"(\w+)(?: |$)", line)[:1] for line in explain(many)]
    assert many.filter("zone IS NOT NULL").count() > few.filter("zone IS NOT NULL").count()


def explain(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def settled(tiles, rounds):
    """Tiles after all rounds of settling."""
    done = tiles.limit(0)
    for _ in range(rounds):
        out = settle_tiles(tiles).localCheckpoint()
        done = done.unionByName(out.where("not crowded").drop("crowded"))
        tiles = out.where("crowded").drop("crowded")
    assert tiles.isEmpty()
    return done


@pytest.mark.parametrize("shared", [False, True], ids=["anywhere", "shared borders"])
def test_overlapping_zones_are_settled_without_changing_any_answer(spark, shared):
    rng = random.Random(5)
    inf = float("inf")
    boxes = []
    for i in range(1500):
        bottom, left = (-3.0, -2.5) if shared else (rng.uniform(-60, 50), rng.uniform(-150, 140))
        top, right = bottom + rng.uniform(20, 40), left + rng.uniform(20, 40)
        boxes.append((rng.randrange(1200), f"z{i}", None, top, left, bottom, right))
    boxes += [(2000, "all", None, inf, -inf, -inf, inf), (1999, "edge", None, 1536.0, 900.0, 900.0, 1536.0)]
    points = [(rng.uniform(-70, 95), rng.uniform(-160, 185)) for _ in range(800)]
    points += [(float(rng.randrange(-64, 64)), float(rng.randrange(-64, 64))) for _ in range(400)]
    points += [c for b in boxes[:200] for c in ((b[3], b[4]), (b[5], b[6]))]
    points += [(1024.0, 1024.0), (1536.0, 1000.0), (5000.0, 5000.0), (-5000.0, 1e300), (1025.0, 1023.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, lat double, lon double")
    tiles = zone_tiles(zones(spark, boxes)).localCheckpoint()
    few = settled(tiles, 2 + 9 - FINEST).localCheckpoint()
    out = assign_by_tiles(df, few, "lat", "lon", "zone", FINEST)
    got = [r.zone for r in sorted(out.select("i", "zone").collect())]
    # Of zones with one number the first by name counts.
    assert got == [first_zone(*p, sorted(boxes, key=lambda b: b[:2])) for p in points]

    def meetings(of, finest):
        spots = df.select(F.col("lat").alias("y"), F.col("lon").alias("x")).withColumn(
            "level", F.explode(F.sequence(F.lit(finest), F.lit(9)))
        )
        at = [_tile(c).alias(f"tile_{c}") for c in "yx"]
        return spots.select("level", *at).join(of, ["level", "tile_y", "tile_x"]).count()

    # Points used to be compared with every zone whose tile they share.
    assert 5 * meetings(few, FINEST) < meetings(tiles, 0)
