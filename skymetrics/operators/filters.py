"""Row filters. Each takes and returns a DataFrame, so they chain with ``transform``."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymetrics.functions import is_finite

# The status text of a flight in the air, and codes that stand for "unknown".
IN_THE_AIR = "0"
UNKNOWN_AIRLINES = ("N/A", "")


def is_clean() -> Column:
    """Whether a flight has a usable airline and both airports; null or false if not.

    Blank but non-empty codes are usable, and so are airports called 'N/A'.
    """
    return (
        ~F.col("airlineCode").isin(*UNKNOWN_AIRLINES)
        & (F.col("airportOrigineCode") != "")
        & (F.col("airportDestinationCode") != "")
    )


def clean_flights(flights: DataFrame) -> DataFrame:
    """Flights with a usable airline and both airports. Nulls fail the comparisons and go as well."""
    return flights.filter(is_clean())


def ongoing(flights: DataFrame) -> DataFrame:
    return flights.filter(F.col("flightStatus") == IN_THE_AIR)


def known_continent(flights: DataFrame) -> DataFrame:
    return flights.filter(F.col("originContinent").isNotNull())


def measured(flights: DataFrame) -> DataFrame:
    """Flights with a distance. ``NOT isnan(null)`` is true, hence both tests."""
    distance = F.col("flightDistance")
    return flights.filter(distance.isNotNull() & ~F.isnan(distance))


def located(flights: DataFrame) -> DataFrame:
    """Flights whose two airports have coordinates, i.e. those ``measured`` would keep.

    Tested on the coordinates, the filter moves below the joins into the airport scans and
    the distance is computed once, after it.
    """
    for column in (
        "airportLat_origin",
        "airportLong_origin",
        "airportLat_destination",
        "airportLong_destination",
    ):
        flights = flights.filter(is_finite(F.col(column)))
    return flights


def regional(flights: DataFrame) -> DataFrame:
    """Flights that stay on one continent; an unknown continent on either end drops them."""
    return flights.filter(F.col("originContinent") == F.col("destinationContinent"))
