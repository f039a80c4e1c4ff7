"""The six questions against plain loops over a small random star, ties and all."""

import random
from collections import Counter, defaultdict

import pytest

from skymetrics.operators.enrich import zoned_airports
from skymetrics.plans import kpis
from skymetrics.schemas import FLIGHTS
from tests.helpers import BOXES, airlines, airports, arc_km, first_zone, flights, tuples, zones

LINES = [("L0", "Zero", "X"), ("L1", "One", "X"), ("L2", "Two", "Y"), ("L2", "Deux", None),
         ("L3", None, None)]


class Star:
    def __init__(self, spark, seed, rows=600):
        rng = random.Random(seed)
        place = lambda: (rng.uniform(-60, 85), rng.uniform(-60, 80))
        # Some airports for sure on each of three continents, the others anywhere.
        sure = [(52.0, 1.0), (60.0, 10.0), (10.0, 10.0), (-20.0, 30.0), (75.0, 50.0), (77.0, 5.0)]
        places = sure + [place() for _ in range(6)]
        self.airports = [(f"P{i}", *spot) for i, spot in enumerate(places)]
        self.airports += [("P0", *place()), ("N1", None, 3.0), ("N2", 3.0, None)]
        codes = [f"P{i}" for i in range(12)] + ["P0"] * 10 + ["N1", "N2", "??"]
        self.rows = [
            (f"F{i // 2}", rng.choice(["B1", "B2", "B3", None, ""]),
             rng.choice(["L0", "L1", "L2", "L3", "L4"]), rng.choice(codes), rng.choice(codes),
             rng.choice("01"))
            for i in range(rows)
        ]
        self.df = flights(spark, *self.rows)
        self.df_airports = airports(spark, *self.airports)
        self.df_airlines = airlines(spark, *LINES)
        self.df_zoned = zoned_airports(self.df_airports, zones(spark))

    def ends(self, code):
        return [a for a in self.airports if a[0] == code] or [(None, None, None)]

    def routes(self):
        for row in self.rows:
            for o in self.ends(row[3]):
                for d in self.ends(row[4]):
                    known = None not in (*o, *d)
                    yield row, o, d, arc_km(*o[1:], *d[1:]) if known else None

    def lines(self, code):
        return [line for line in LINES if line[0] == code] or [(code, None, None)]


@pytest.fixture(scope="module", params=[11, 12, 13])
def star(spark, request):
    return Star(spark, request.param)


def nulls_first(value):
    return (value is not None, value or "")


def test_airline_with_most_flights(star):
    n = Counter(r[2] for r in star.rows if r[5] == "0")
    code = min(n, key=lambda c: (-n[c], c))
    want = [(code, line[1], n[code]) for line in LINES if line[0] == code]
    got = kpis.airline_with_most_flights(star.df, star.df_airlines)
    assert got.columns == ["airlineCode", "airline_name", "flight_count"]
    assert tuples(got) == sorted(want, key=repr)


def test_leader_without_an_airline_gives_no_row(spark):
    df = flights(spark, *[(str(i), "a", "ZZ" if i else "L0", "P", "P", "0") for i in range(3)])
    assert kpis.airline_with_most_flights(df, airlines(spark, *LINES)).collect() == []


def test_leader_listed_twice_gives_two_rows(spark):
    df = flights(spark, ("1", "a", "L2", "P", "P", "0"))
    got = kpis.airline_with_most_flights(df, airlines(spark, *LINES))
    assert tuples(got) == [("L2", "Deux", 1), ("L2", "Two", 1)]


@pytest.mark.parametrize("threshold", ["64MB", "-1"])
def test_airline_with_most_regional_flights(star, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    n = Counter()
    for row, o, d, _ in star.routes():
        continent = first_zone(*o[1:], BOXES)
        if continent and continent == first_zone(*d[1:], BOXES):
            n.update((continent, row[2], line[1]) for line in star.lines(row[2]))
    best = {}
    for key in sorted(n, key=lambda k: (-n[k], k[1], nulls_first(k[2]))):
        best.setdefault(key[0], (*key, n[key]))
    got = kpis.airline_with_most_regional_flights(
        star.df, star.df_zoned, star.df_airlines
    )
    assert got.columns == [
        "originContinent",
        "airlineCode",
        "airline_name",
        "regional_flight_count",
    ]
    assert tuples(got) == sorted(best.values(), key=repr) and len(best) > 1


@pytest.mark.parametrize("threshold", ["64MB", "-1"])
def test_longest_ongoing_flight(star, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    routes = [r for r in star.routes() if r[0][5] == "0" and r[3] is not None]
    row, o, d, km = min(routes, key=lambda r: (-round(r[3], 6), *map(nulls_first, r[0])))
    (got,) = kpis.longest_ongoing_flight(star.df, star.df_airports).collect()
    assert list(got.asDict()) == [
        *FLIGHTS.names, "airportID_origin", "airportLat_origin", "airportLong_origin",
        "airportID_destination", "airportLat_destination", "airportLong_destination",
        "flightDistance",
    ]
    assert got.flightDistance == pytest.approx(km, abs=1e-3)
    assert tuple(got)[:6] == row and tuple(got)[6:12] == (*o, *d)


@pytest.mark.parametrize("threshold", ["64MB", "-1"])
def test_average_flight_distance_by_continent(star, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    lengths = defaultdict(list)
    for _, o, _, km in star.routes():
        continent = first_zone(*o[1:], BOXES)
        if continent and km is not None:
            lengths[continent].append(km)
    got = kpis.average_flight_distance_by_continent(star.df, star.df_zoned)
    assert got.columns == ["originContinent", "average_flight_distance"]
    want = {c: sum(v) / len(v) for c, v in lengths.items()}
    assert dict(tuples(got)) == pytest.approx(want, abs=1e-3) and len(want) > 1


def test_aircraft_with_most_active_flights(star):
    n = Counter(r[1] for r in star.rows if r[5] == "0")
    best = min(n, key=lambda a: (-n[a], *nulls_first(a)))
    got = kpis.aircraft_with_most_active_flights(star.df)
    assert got.columns == ["aircraft", "active_flight_count"]
    assert tuples(got) == [(best, n[best])]


def test_unknown_aircraft_can_lead(spark):
    df = flights(spark, *[(str(i), None, "L0", "P", "P", "0") for i in range(2)])
    assert tuples(kpis.aircraft_with_most_active_flights(df)) == [(None, 2)]


def test_top_aircraft_by_country(star):
    n = Counter((line[2], row[1]) for row in star.rows for line in star.lines(row[2]))
    want = []
    for country in {c for c, _ in n}:
        mine = sorted(
            (a for c, a in n if c == country), key=lambda a: (-n[country, a], *nulls_first(a))
        )
        want += [(country, a, n[country, a], i + 1) for i, a in enumerate(mine[:3])]
    got = kpis.top_aircraft_by_country(star.df, star.df_airlines)
    assert got.columns == ["airlineCountry", "aircraft", "usage_count", "rank"]
    assert tuples(got) == sorted(want, key=repr)


def test_nothing_matches_anywhere(spark):
    df = flights(spark, ("1", "a", "L0", "P", "P", "0"))
    nowhere = airports(spark, ("P", None, None))
    lines, zoned = airlines(spark, *LINES), zoned_airports(nowhere, zones(spark))
    assert kpis.longest_ongoing_flight(df, nowhere).collect() == []
    assert kpis.average_flight_distance_by_continent(df, zoned).collect() == []
    assert kpis.airline_with_most_regional_flights(df, zoned, lines).collect() == []
    none = df.filter("false")
    assert kpis.airline_with_most_flights(none, lines).collect() == []
    assert kpis.aircraft_with_most_active_flights(none).collect() == []
    assert kpis.top_aircraft_by_country(none, lines).collect() == []
