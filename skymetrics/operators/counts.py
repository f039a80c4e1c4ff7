"""Aggregations over flights.

Where an airline attribute is wanted, flights are first counted by airline code and the
attribute is joined to the counts. The fact table then takes part in no airline join, and a
code that holds a large share of the flights is combined on the map side before any shuffle.
Counts are summed after the join, so a code listed twice counts twice, as joining first would.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymetrics.operators.enrich import with_airline_country, with_airline_name
from skymetrics.operators.filters import known_continent, located, ongoing, regional


def ongoing_by_airline(flights: DataFrame) -> DataFrame:
    return ongoing(flights).groupBy("airlineCode").agg(F.count("*").alias("flight_count"))


def ongoing_by_aircraft(flights: DataFrame) -> DataFrame:
    return ongoing(flights).groupBy("aircraft").agg(F.count("*").alias("active_flight_count"))


def usage_by_country(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """All flights per airline country and aircraft; an unknown country is a group too."""
    by_code = flights.groupBy("airlineCode", "aircraft").agg(F.count("*").alias("n"))
    return (
        with_airline_country(by_code, airlines)
        .groupBy("airlineCountry", "aircraft")
        .agg(F.sum("n").alias("usage_count"))
    )


def regional_by_airline(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """Regional flights per continent and airline, for flights with both continents."""
    by_code = (
        regional(flights)
        .groupBy("originContinent", "airlineCode")
        .agg(F.count("*").alias("n"))
    )
    return (
        with_airline_name(by_code, airlines)
        .groupBy("originContinent", "airlineCode", "airline_name")
        .agg(F.sum("n").alias("regional_flight_count"))
    )


def mean_distance_by_origin(flights: DataFrame) -> DataFrame:
    """Mean distance per origin continent, for flights that have geography."""
    return (
        flights.transform(located)
        .transform(known_continent)
        .groupBy("originContinent")
        .agg(F.avg("flightDistance").alias("average_flight_distance"))
    )
