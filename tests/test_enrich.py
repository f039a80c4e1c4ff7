import pytest

from skymetrics.operators import enrich
from tests.helpers import BOXES, airlines, airports, arc_km, first_zone, flights, tuples, zones

AIRPORT_ROWS = [
    ("CDG", 49.0, 2.5),
    ("JFK", 40.6, -73.8),
    ("DUP", 10.0, 10.0),
    ("DUP", 55.0, 5.0),
    ("HALF", 10.0, None),
    ("NULL", None, None),
    (None, 1.0, 1.0),
]


def test_roles_rename_the_dimension(spark):
    role = enrich.airport_role(airports(spark, ("CDG", 49.0, 2.5)), "destination")
    assert role.columns == [
        "airportID_destination",
        "airportLat_destination",
        "airportLong_destination",
    ]


def test_airports_join_keeps_unknown_and_fans_out_on_duplicates(spark):
    df = flights(
        spark,
        ("1", "a", "AFR", "CDG", "JFK", "0"),
        ("2", "a", "AFR", "CDG", "XXX", "0"),
        ("3", "a", "AFR", "DUP", "DUP", "0"),
        ("4", "a", "AFR", None, "CDG", "0"),
    )
    joined = enrich.with_airports(df, airports(spark, *AIRPORT_ROWS))
    assert joined.columns == df.columns + [
        "airportID_origin",
        "airportLat_origin",
        "airportLong_origin",
        "airportID_destination",
        "airportLat_destination",
        "airportLong_destination",
    ]
    rows = [(r[0], *r[6:]) for r in tuples(joined)]
    assert rows == [
        ("1", "CDG", 49.0, 2.5, "JFK", 40.6, -73.8),
        ("2", "CDG", 49.0, 2.5, None, None, None),
        ("3", "DUP", 10.0, 10.0, "DUP", 10.0, 10.0),
        ("3", "DUP", 10.0, 10.0, "DUP", 55.0, 5.0),
        ("3", "DUP", 55.0, 5.0, "DUP", 10.0, 10.0),
        ("3", "DUP", 55.0, 5.0, "DUP", 55.0, 5.0),
        ("4", None, None, None, "CDG", 49.0, 2.5),
    ]


@pytest.mark.parametrize("threshold", ["64MB", "-1"])
def test_geography_agrees_with_brute_force(spark, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    codes = ["CDG", "JFK", "DUP", "HALF", "NULL", "XXX", None]
    rows = [(f"{o}-{d}", "a", "AFR", o, d, "0") for o in codes for d in codes]
    got = enrich.with_geography(
        flights(spark, *rows), airports(spark, *AIRPORT_ROWS), zones(spark)
    ).select("flightID", "originContinent", "destinationContinent", "flightDistance")

    def ends(code):
        found = [(a, b) for i, a, b in AIRPORT_ROWS if code is not None and i == code]
        return found or [(None, None)]

    want = []
    for flight, _, _, o, d, _ in rows:
        for p in ends(o):
            for q in ends(d):
                known = None not in (*p, *q)
                distance = arc_km(*p, *q) if known else None
                want.append((flight, first_zone(*p, BOXES), first_zone(*q, BOXES), distance))
    key = lambda r: repr(r[:3]) + f"{r[3] or -1:.3f}"
    a, b = sorted(map(tuple, got.collect()), key=key), sorted(want, key=key)
    assert [r[:3] for r in a] == [r[:3] for r in b]
    for x, y in zip(a, b):
        assert (x[3] is None) == (y[3] is None)
        assert x[3] is None or x[3] == pytest.approx(y[3], abs=1e-2)


def test_airline_joins(spark):
    df = flights(
        spark,
        ("1", "a", "AFR", "A", "B", "0"),
        ("2", "a", "XXX", "A", "B", "0"),
        ("3", "a", "TWO", "A", "B", "0"),
        ("4", "a", None, "A", "B", "0"),
    )
    lines = airlines(
        spark, ("AFR", "Air France", "France"), ("TWO", "Two", "A"), ("TWO", "Deux", None),
        (None, "Nobody", "Z"),
    )
    named = enrich.with_airline_name(df, lines).select("flightID", "airline_name")
    assert tuples(named) == [
        ("1", "Air France"), ("2", None), ("3", "Deux"), ("3", "Two"), ("4", None),
    ]
    located = enrich.with_airline_country(df, lines).select("flightID", "airlineCountry")
    assert tuples(located) == [("1", "France"), ("2", None), ("3", "A"), ("3", None), ("4", None)]
