"""Counting before a join has to equal joining first, duplicates and unknown codes included."""

import random
from collections import Counter, defaultdict

import pytest

from skymetrics.operators import counts
from tests.helpers import airlines, flights, tuples

LINES = [("A1", "Alpha", "X"), ("A2", "Beta", "Y"), ("A2", "Beta", "X"), ("A2", "Gamma", None),
         ("A3", None, "Y"), (None, "Nobody", "Y")]


def random_flights(seed):
    rng = random.Random(seed)
    # A1 holds far more than a third of the rows.
    codes = ["A1"] * 12 + ["A2", "A2", "A3", "A4", None]
    return [
        (str(i), rng.choice(["m1", "m2", None, ""]), rng.choice(codes), "o", "d",
         rng.choice(["0", "1", None]))
        for i in range(900)
    ]


def matching(code):
    found = [line[1:] for line in LINES if code is not None and line[0] == code]
    return found or [(None, None)]


def test_counts_of_ongoing_flights(spark):
    rows = random_flights(1)
    by_airline = Counter(r[2] for r in rows if r[5] == "0")
    by_aircraft = Counter(r[1] for r in rows if r[5] == "0")
    df = flights(spark, *rows)
    assert dict(tuples(counts.ongoing_by_airline(df))) == by_airline
    assert dict(tuples(counts.ongoing_by_aircraft(df))) == by_aircraft


def test_usage_by_country(spark):
    rows = random_flights(2)
    want = Counter((country, r[1]) for r in rows for _, country in matching(r[2]))
    got = counts.usage_by_country(flights(spark, *rows), airlines(spark, *LINES))
    assert got.columns == ["airlineCountry", "aircraft", "usage_count"]
    assert {(c, a): n for c, a, n in tuples(got)} == want


def test_regional_by_airline(spark):
    rng = random.Random(3)
    places = ["asia", "africa", None]
    rows = [(r[2], rng.choice(places), rng.choice(places)) for r in random_flights(3)]
    df = spark.createDataFrame(
        rows, "airlineCode string, originContinent string, destinationContinent string"
    )
    want = Counter(
        (origin, code, name)
        for code, origin, destination in rows
        if origin is not None and origin == destination
        for name, _ in matching(code)
    )
    got = counts.regional_by_airline(df, airlines(spark, *LINES))
    assert got.columns == [
        "originContinent",
        "airlineCode",
        "airline_name",
        "regional_flight_count",
    ]
    assert {r[:3]: r[3] for r in tuples(got)} == want


def test_mean_distance_leaves_out_what_has_none(spark):
    rows = [("asia", 1.0, 2.0, 100.0), ("asia", 1.0, None, None), ("asia", 1.0, 2.0, 300.0),
            (None, 1.0, 2.0, 50.0), ("africa", 1.0, None, None)]
    df = spark.createDataFrame(
        [(c, a, a, b, b, d) for c, a, b, d in rows],
        "originContinent string, airportLat_origin double, airportLong_origin double, "
        "airportLat_destination double, airportLong_destination double, flightDistance double",
    )
    sums = defaultdict(list)
    for continent, _, _, d in rows:
        if continent and d is not None:
            sums[continent].append(d)
    got = dict(tuples(counts.mean_distance_by_origin(df)))
    assert got == pytest.approx({c: sum(v) / len(v) for c, v in sums.items()})
