"""Joins and projections that widen flights with airport and airline attributes.

No join carries a broadcast hint. Catalyst broadcasts a dimension only when its size, as
estimated from the files or measured by adaptive execution, is below the session's threshold.
Past it the join shuffles, and adaptive execution splits the partitions of a hot code.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymetrics.functions import great_circle_km
from skymetrics.operators.zones import assign_by_tiles, assign_zone

# The flight column that names the airport of each role.
ROLE_CODES = {"origin": "airportOrigineCode", "destination": "airportDestinationCode"}
_ROLE_ATTRIBUTES = ("airportID", "airportLat", "airportLong")


def airport_role(airports: DataFrame, role: str) -> DataFrame:
    """Airports as seen from one end of a flight: key and coordinates, named after the role.

    Airports that carry a ``continent`` keep it, as ``<role>Continent``.
    """
    columns = [F.col(name).alias(f"{name}_{role}") for name in _ROLE_ATTRIBUTES]
    if "continent" in airports.columns:
        columns.append(F.col("continent").alias(f"{role}Continent"))
    return airports.select(*columns)


def with_airport(flights: DataFrame, airports: DataFrame, role: str) -> DataFrame:
    """Left join of one role. Unknown codes keep their flight, repeated airports fan out."""
    dimension = airport_role(airports, role)
    return flights.join(dimension, F.col(ROLE_CODES[role]) == F.col(f"airportID_{role}"), "left")


def with_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    for role in ROLE_CODES:
        flights = with_airport(flights, airports, role)
    return flights


def with_distance(flights: DataFrame) -> DataFrame:
    """Adds ``flightDistance`` in km to flights that have both airports joined."""
    ends = (F.col(f"{c}_{role}") for role in ROLE_CODES for c in ("airportLat", "airportLong"))
    return flights.withColumn("flightDistance", great_circle_km(*ends))


def zoned_airports(airports: DataFrame, zones: DataFrame) -> DataFrame:
    """Airports plus ``continent``.

    A continent depends on coordinates alone, so it is found once per airport and not once
    per flight and end.
    """
    return assign_zone(airports, zones, "airportLat", "airportLong", "continent")


def airports_by_tiles(airports: DataFrame, tiles: DataFrame, finest: int = 0) -> DataFrame:
    """``zoned_airports`` for zones that are stored in tiles."""
    return assign_by_tiles(airports, tiles, "airportLat", "airportLong", "continent", finest)


def with_geography(flights: DataFrame, airports: DataFrame, zones: DataFrame) -> DataFrame:
    """Both airports, both continents and the distance of each flight."""
    return with_distance(with_airports(flights, zoned_airports(airports, zones)))


def _with_airline(flights: DataFrame, airlines: DataFrame, attribute: str, name: str) -> DataFrame:
    dimension = airlines.select(F.col("ICAO").alias("airlineCode"), F.col(attribute).alias(name))
    return flights.join(dimension, on="airlineCode", how="left")


def with_airline_name(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    return _with_airline(flights, airlines, "Name", "airline_name")


def with_airline_country(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    return _with_airline(flights, airlines, "Country", "airlineCountry")
