"""The six questions, each one lazy plan over the star schema.

Continents come with the airports: ``zoned`` are airports that ``enrich.zoned_airports`` has been
over, which ``jobs.extract`` stores once for all questions.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymetrics.operators.counts import (
    mean_distance_by_origin,
    ongoing_by_aircraft,
    ongoing_by_airline,
    regional_by_airline,
    usage_by_country,
)
from skymetrics.operators.enrich import with_airports, with_distance
from skymetrics.operators.filters import located, ongoing
from skymetrics.operators.ranking import largest_first, top_n
from skymetrics.schemas import FLIGHTS


def busiest_airline(flights: DataFrame) -> DataFrame:
    return top_n(ongoing_by_airline(flights), largest_first("flight_count", "airlineCode"))


def airline_with_most_flights(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Airline with the most ongoing flights.

    The name is looked up after the limit: a leader missing from ``airlines`` gives no row.
    """
    names = airlines.select("ICAO", F.col("Name").alias("airline_name"))
    return (
        busiest_airline(flights)
        .join(names, F.col("airlineCode") == F.col("ICAO"))
        .select("airlineCode", "airline_name", "flight_count")
    )


def regional_counts(flights: DataFrame, zoned: DataFrame, airlines: DataFrame) -> DataFrame:
    """Flights that stay on one continent, per continent and airline."""
    return regional_by_airline(with_airports(flights, zoned), airlines)


def airline_with_most_regional_flights(
    flights: DataFrame, zoned: DataFrame, airlines: DataFrame
) -> DataFrame:
    """Per continent, the airline with the most flights that stay on it."""
    counts = regional_counts(flights, zoned, airlines)
    order = largest_first("regional_flight_count", "airlineCode", "airline_name")
    return top_n(counts, order, per=["originContinent"])


def longest_ongoing_flight(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """The ongoing flight with the longest great-circle route, with all its columns."""
    routes = ongoing(flights).transform(with_airports, airports).transform(located)
    routes = with_distance(routes)
    coordinates = [c for c in routes.columns if c.startswith(("airportLat_", "airportLong_"))]
    return top_n(routes, largest_first("flightDistance", *FLIGHTS.names, *coordinates))


def average_flight_distance_by_continent(flights: DataFrame, zoned: DataFrame) -> DataFrame:
    """Mean distance of all flights, per continent of origin."""
    return mean_distance_by_origin(with_distance(with_airports(flights, zoned)))


def aircraft_with_most_active_flights(flights: DataFrame) -> DataFrame:
    """The aircraft code with the most ongoing flights; null and '' are codes like any other."""
    return top_n(ongoing_by_aircraft(flights), largest_first("active_flight_count", "aircraft"))


def top_aircraft_by_country(flights: DataFrame, airlines: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most used aircraft per airline country, ranked."""
    return top_n(
        usage_by_country(flights, airlines),
        largest_first("usage_count", "aircraft"),
        n=n,
        per=["airlineCountry"],
        rank="rank",
    )
