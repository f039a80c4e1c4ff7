"""Every registered query: (spark, folder of Parquet tables) -> DataFrame.

All of them run over whole tables. Distances are rounded here, never in an operator, because
two engines' trigonometry differs in the last bits.
"""

from collections.abc import Callable, Iterator
from datetime import datetime
from functools import partial, reduce
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import derived
from skymetrics.functions import hour_columns
from skymetrics.operators import counts, enrich, filters
from skymetrics.operators.ranking import largest_first, top_n
from skymetrics.plans import kpis
from skymetrics.plans.jobs import QUESTIONS, REJECTED, extract, read_result, run_kpi
from skymetrics.plans.session import file_system, scratch_folder
from skymetrics.schemas import FLIGHTS, TABLES
from skymetrics.sources import landing
from skymetrics.sources.snapshots import (
    read_latest,
    read_snapshot,
    write_snapshot,
    write_snapshots,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The run time of stored tables, and the hour of `events` that is read back.
RUN_HOUR = datetime(2024, 1, 2, 5)
READ_HOUR = datetime(2024, 1, 6, 2)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _km(digits: int = 6, column: str = "flightDistance") -> Column:
    return F.round(column, digits).alias(column)


def _zoned(spark: SparkSession, sf: str, country: bool = False) -> DataFrame:
    return enrich.zoned_airports(derived.airports(spark, sf, country), derived.zones(spark))


def _rounded(df: DataFrame, digits: int = 6, column: str = "flightDistance") -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


# -- sources and sinks ---------------------------------------------------------------------


def _landed(spark: SparkSession, lines: DataFrame, feed: str) -> DataFrame:
    """Writes raw lines as a feed would land, and reads that feed."""
    folder = scratch_folder(spark, feed)
    lines.select("value").write.text(folder)
    return landing.read_feed(spark, folder, feed)


def _land_documents(documents: DataFrame, key: str, folder: str) -> None:
    """Writes each document as a file of its own, named by its key, the way zones land.

    All tasks write at once into one folder. Spark's own writer has a folder for each file, which it makes,
    moves and lists in turn.
    """
    spark = documents.sparkSession
    fs, path = file_system(spark, folder)
    fs.mkdirs(path)
    uri = fs.makeQualified(path).toString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = pyarrow.fs.FileSystem.from_uri(uri)
        for batch in batches:
            for name, text in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                # Readers skip the passing name, so a task that is run again only replaces whole files.
                passing = f"{base}/.{uuid4().hex}"
                with target.open_output_stream(passing) as out:
                    out.write(f"{text}\n".encode())
                target.move(passing, f"{base}/{name}.json")
            yield batch.select([0])

    dealt = documents.repartition(spark.sparkContext.defaultParallelism, key)
    rows = dealt.select(F.col(key).cast("string").alias("name"), "value")
    rows.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()


@query
def src_flights_typed(spark, sf):
    lines = derived.flight_lines(spark, sf)
    return landing.accepted(_landed(spark, lines, "flights"))


@query
def src_airports_typed(spark, sf):
    lines = derived.airport_lines(spark, sf)
    return landing.accepted(_landed(spark, lines, "airports"))


@query
def src_airlines_typed(spark, sf):
    lines = derived.airline_lines(spark, sf)
    return landing.accepted(_landed(spark, lines, "airlines"))


@query
def src_zones_flattened(spark, sf):
    folder = scratch_folder(spark, "zones")
    derived.zone_documents(spark, sf).write.parquet(folder)
    documents = spark.read.parquet(folder)
    return landing.accepted(landing.zones_from_documents(documents, keep=("s_suppkey",)))


@query
def src_zones_feed(spark, sf):
    """Zones through the file reader: one file for each document."""
    folder = scratch_folder(spark, "zones")
    _land_documents(derived.zone_documents(spark, sf), "s_suppkey", folder)
    return landing.accepted(landing.read_feed(spark, folder, "zones"))


@query
def src_quarantine(spark, sf):
    flights = _landed(spark, derived.flight_lines(spark, sf), "flights")
    airports = _landed(spark, derived.airport_lines(spark, sf), "airports")
    return landing.rejected(flights, "flights").unionByName(landing.rejected(airports, "airports"))


def _extracted(spark: SparkSession, sf: str) -> str:
    """A store that ``extract`` has filled from the four landed feeds."""
    root, store = scratch_folder(spark, "landing"), scratch_folder(spark, "store")
    feeds = {
        "flights": derived.flight_lines,
        "airports": derived.airport_lines,
        "airlines": derived.airline_lines,
    }
    for feed, lines in feeds.items():
        lines(spark, sf).write.text(f"{root}/{feed}")
    _land_documents(derived.zone_documents(spark, sf), "s_suppkey", f"{root}/zones")
    extract(spark, root, store, RUN_HOUR)
    return store


@query
def ingest_flights(spark, sf):
    return read_snapshot(spark, _extracted(spark, sf), "flights", RUN_HOUR, FLIGHTS)


@query
def ingest_rejects(spark, sf):
    store = _extracted(spark, sf)
    tables = [read_snapshot(spark, store, f"{REJECTED}_{t}", RUN_HOUR) for t in TABLES]
    return reduce(DataFrame.unionByName, tables)


@query
def ingest_zoned_airports(spark, sf):
    store = _extracted(spark, sf)
    zoned = read_snapshot(spark, store, "zoned_airports", RUN_HOUR)
    return zoned.select("airportID", "airportLat", "airportLong", "continent")


@query
def snapshot_write(spark, sf):
    store = scratch_folder(spark, "store")
    write_snapshot(derived.flights(spark, sf), store, "flights", RUN_HOUR)
    return read_snapshot(spark, store, "flights", RUN_HOUR, FLIGHTS)


def _event_store(spark: SparkSession, sf: str) -> str:
    store = scratch_folder(spark, "events")
    write_snapshots(derived.table(spark, sf, "events"), store, "events", F.col("ts"))
    return store


@query
def snapshot_read_hour(spark, sf):
    return read_snapshot(spark, _event_store(spark, sf), "events", READ_HOUR)


@query
def snapshot_read_latest(spark, sf):
    return read_latest(spark, _event_store(spark, sf), "events")


def _read_back(spark: SparkSession, sf: str, question: str) -> DataFrame:
    """A question answered from a store, stored itself, and read back."""
    store, results = scratch_folder(spark, "store"), scratch_folder(spark, "results")
    tables = {
        "flights": derived.flights,
        "airports": partial(derived.airports, country=True),
        "airlines": partial(derived.airlines, country=True),
        "zoned_airports": partial(_zoned, country=True),
    }
    for name in QUESTIONS[question][1]:
        write_snapshot(tables[name](spark, sf), store, name, RUN_HOUR)
    run_kpi(spark, question, store, results, RUN_HOUR)
    return read_result(spark, question, results, RUN_HOUR)


@query
def results_read(spark, sf):
    return _read_back(spark, sf, "kpi6")


@query
def results_read_kpi1(spark, sf):
    return _read_back(spark, sf, "kpi1")


@query
def results_read_kpi2(spark, sf):
    return _read_back(spark, sf, "kpi2")


@query
def results_read_kpi3(spark, sf):
    return _rounded(_read_back(spark, sf, "kpi3"))


@query
def results_read_kpi4(spark, sf):
    return _rounded(_read_back(spark, sf, "kpi4"), 3, "average_flight_distance")


@query
def results_read_kpi5(spark, sf):
    return _read_back(spark, sf, "kpi5")


# -- filters and projections ---------------------------------------------------------------


@query
def clean_flights(spark, sf):
    return filters.clean_flights(derived.raw_flights(spark, sf).select(*FLIGHTS.names))


@query
def filter_ongoing(spark, sf):
    return filters.ongoing(derived.flights(spark, sf))


@query
def filter_known_continent(spark, sf):
    flights = derived.flights(spark, sf, aircraft=False)
    zoned = enrich.with_airport(flights, _zoned(spark, sf), "origin")
    return filters.known_continent(zoned).select("flightID", "originContinent")


@query
def filter_valid_distance(spark, sf):
    flights = derived.flights(spark, sf, aircraft=False)
    joined = enrich.with_airports(flights, derived.airports(spark, sf))
    return filters.measured(enrich.with_distance(joined)).select("flightID", _km())


@query
def filter_regional(spark, sf):
    columns = ("flightID", "airlineCode", "originContinent", "destinationContinent")
    flights = derived.flights(spark, sf, aircraft=False)
    return filters.regional(enrich.with_airports(flights, _zoned(spark, sf))).select(*columns)


@query
def project_role_airport(spark, sf):
    return enrich.airport_role(derived.airports(spark, sf), "origin")


@query
def project_flight_geo(spark, sf):
    continents = ("originContinent", "destinationContinent")
    airports, zones = derived.airports(spark, sf), derived.zones(spark)
    geography = enrich.with_geography(derived.flights(spark, sf), airports, zones)
    return geography.select(*FLIGHTS.names, _km(), *continents)


# -- joins ---------------------------------------------------------------------------------


@query
def join_origin_airport(spark, sf):
    return enrich.with_airport(derived.flights(spark, sf), derived.airports(spark, sf), "origin")


@query
def join_destination_airport(spark, sf):
    airports = derived.airports(spark, sf)
    return enrich.with_airport(derived.flights(spark, sf), airports, "destination")


@query
def join_flights_airports(spark, sf):
    return enrich.with_airports(derived.flights(spark, sf), derived.airports(spark, sf))


@query
def join_airline_name(spark, sf):
    return enrich.with_airline_name(derived.flights(spark, sf), derived.airlines(spark, sf))


@query
def join_airline_country(spark, sf):
    airlines = derived.airlines(spark, sf, country=True)
    return enrich.with_airline_country(derived.flights(spark, sf), airlines)


@query
def join_top_airline_inner(spark, sf):
    names = derived.airlines(spark, sf).select("ICAO", F.col("Name").alias("airline_name"))
    top = kpis.busiest_airline(derived.flights(spark, sf, aircraft=False))
    return top.join(names, top.airlineCode == names.ICAO).drop("ICAO")


@query
def zone_of_airport(spark, sf):
    return _zoned(spark, sf).select("airportID", "airportLat", "airportLong", "continent")


@query
def zone_of_flight(spark, sf):
    columns = ("originContinent", "destinationContinent")
    flights = enrich.with_airports(derived.flights(spark, sf), _zoned(spark, sf))
    return flights.select(*FLIGHTS.names, *columns)


# -- aggregations, rankings ----------------------------------------------------------------


def _regional_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    return (
        derived.flights(spark, sf, aircraft=False),
        _zoned(spark, sf),
        derived.airlines(spark, sf),
    )


@query
def agg_count_by_airline(spark, sf):
    return counts.ongoing_by_airline(derived.flights(spark, sf, aircraft=False))


@query
def agg_count_by_aircraft(spark, sf):
    return counts.ongoing_by_aircraft(derived.flights(spark, sf))


@query
def agg_count_by_country_aircraft(spark, sf):
    airlines = derived.airlines(spark, sf, country=True)
    return counts.usage_by_country(derived.flights(spark, sf), airlines)


@query
def agg_count_regional(spark, sf):
    return kpis.regional_counts(*_regional_tables(spark, sf))


@query
def agg_avg_distance(spark, sf):
    located = enrich.with_airports(derived.flights(spark, sf, aircraft=False), _zoned(spark, sf))
    means = counts.mean_distance_by_origin(enrich.with_distance(located))
    return _rounded(means, 3, "average_flight_distance")


@query
def win_row_number_global(spark, sf):
    order = largest_first("active_flight_count", "aircraft")
    return top_n(agg_count_by_aircraft(spark, sf), order, rank="rank")


@query
def win_top1_per_continent(spark, sf):
    order = largest_first("regional_flight_count", "airlineCode", "airline_name")
    return top_n(agg_count_regional(spark, sf), order, per=["originContinent"], rank="rank")


@query
def win_top3_per_country(spark, sf):
    order = largest_first("usage_count", "aircraft")
    ranked = agg_count_by_country_aircraft(spark, sf)
    return top_n(ranked, order, n=3, per=["airlineCountry"], rank="rank")


@query
def topk_airline(spark, sf):
    return kpis.busiest_airline(derived.flights(spark, sf, aircraft=False))


@query
def topk_longest_flight(spark, sf):
    return kpi3_longest_ongoing_flight(spark, sf).select("flightID", "flightDistance")


# -- functions -----------------------------------------------------------------------------


@query
def fn_great_circle_km(spark, sf):
    flights = derived.flights(spark, sf, aircraft=False)
    joined = enrich.with_airports(flights, derived.airports(spark, sf))
    ends = [f"{c}_{r}" for r in enrich.ROLE_CODES for c in ("airportLat", "airportLong")]
    return enrich.with_distance(joined).select("flightID", *ends, _km())


@query
def fn_snapshot_keys(spark, sf):
    return derived.table(spark, sf, "events").select("event_id", *hour_columns(F.col("ts")))


# -- the six questions ---------------------------------------------------------------------


@query
def kpi1_airline_most_flights(spark, sf):
    flights = derived.flights(spark, sf, aircraft=False)
    return kpis.airline_with_most_flights(flights, derived.airlines(spark, sf))


@query
def kpi2_regional_airline_by_continent(spark, sf):
    return kpis.airline_with_most_regional_flights(*_regional_tables(spark, sf))


@query
def kpi3_longest_ongoing_flight(spark, sf):
    longest = kpis.longest_ongoing_flight(derived.flights(spark, sf), derived.airports(spark, sf))
    return _rounded(longest)


@query
def kpi4_avg_distance_by_continent(spark, sf):
    means = kpis.average_flight_distance_by_continent(
        derived.flights(spark, sf, aircraft=False), _zoned(spark, sf)
    )
    return _rounded(means, 3, "average_flight_distance")


@query
def kpi5_aircraft_most_active(spark, sf):
    return kpis.aircraft_with_most_active_flights(derived.flights(spark, sf))


@query
def kpi6_top3_aircraft_by_country(spark, sf):
    airlines = derived.airlines(spark, sf, country=True)
    return kpis.top_aircraft_by_country(derived.flights(spark, sf), airlines)
