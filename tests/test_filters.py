from skymetrics.operators import filters
from tests.helpers import flights, tuples


def ids(df):
    return sorted(row[0] for row in df.collect())


def test_clean_flights_drops_unknown_and_null_codes(spark):
    df = flights(
        spark,
        ("ok", "A320", "AFR", "CDG", "JFK", "0"),
        ("blank airline stays", "A320", " ", "CDG", "JFK", "0"),
        ("N/A airport stays", None, "AFR", "N/A", "N/A", "1"),
        ("no aircraft stays", "", "AFR", "CDG", "JFK", None),
        ("N/A airline", "A320", "N/A", "CDG", "JFK", "0"),
        ("empty airline", "A320", "", "CDG", "JFK", "0"),
        ("null airline", "A320", None, "CDG", "JFK", "0"),
        ("empty origin", "A320", "AFR", "", "JFK", "0"),
        ("null origin", "A320", "AFR", None, "JFK", "0"),
        ("empty destination", "A320", "AFR", "CDG", "", "0"),
        ("null destination", "A320", "AFR", "CDG", None, "0"),
    )
    assert ids(filters.clean_flights(df)) == [
        "N/A airport stays",
        "blank airline stays",
        "no aircraft stays",
        "ok",
    ]


def test_ongoing_is_the_text_zero(spark):
    rows = [(s or "null", None, "AFR", "A", "B", s) for s in ("0", "1", "false", "00", "", None)]
    assert ids(filters.ongoing(flights(spark, *rows))) == ["0"]


def test_regional_and_known_continent(spark):
    df = spark.createDataFrame(
        [("same", "asia", "asia"), ("other", "asia", "africa"), ("half", "asia", None),
         ("late", None, "asia"), ("none", None, None)],
        "flightID string, originContinent string, destinationContinent string",
    )
    assert ids(filters.regional(df)) == ["same"]
    assert ids(filters.known_continent(df)) == ["half", "other", "same"]


def test_measured_drops_null_and_nan(spark):
    df = spark.createDataFrame(
        [("far", 10.0), ("here", 0.0), ("null", None), ("nan", float("nan"))],
        "flightID string, flightDistance double",
    )
    assert ids(filters.measured(df)) == ["far", "here"]


def test_located_is_measured_before_measuring(spark):
    from skymetrics.operators.enrich import with_distance

    values = (1.0, 0.0, None, float("nan"), float("inf"))
    rows = [
        (f"{a}/{b}/{c}", a, b, c, 4.0) for a in values for b in values for c in values
    ]
    df = spark.createDataFrame(
        rows,
        "flightID string, airportLat_origin double, airportLong_origin double, "
        "airportLat_destination double, airportLong_destination double",
    )
    left = ids(filters.measured(with_distance(df)))
    assert left == ids(filters.located(df)) and len(left) == 8


def test_empty_input_keeps_the_schema(spark):
    df = flights(spark, ("x", "a", "b", "c", "d", "1")).filter("false")
    assert filters.ongoing(filters.clean_flights(df)).columns == df.columns
    assert tuples(filters.clean_flights(df)) == []
