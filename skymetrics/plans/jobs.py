"""The two batch jobs: bring the landed feeds into the store, answer the questions from it."""

import logging
from collections.abc import Callable, Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.operators.enrich import airports_by_tiles
from skymetrics.operators.filters import is_clean
from skymetrics.operators.zones import FINEST, settle_tiles, zone_tiles
from skymetrics.plans import kpis
from skymetrics.schemas import REJECTED as REJECTS
from skymetrics.schemas import RESULT_NAMES, STORED, TABLES
from skymetrics.sources.landing import in_sequence, landed_files, read_feed, zones_by_file
from skymetrics.sources.manifests import Staged, publish, staging
from skymetrics.sources.snapshots import latest_hour, open_hour, read_snapshot, stage

log = logging.getLogger("skymetrics")

REJECTED = "rejected"

# Each question with the tables it reads, in the order its function takes them.
QUESTIONS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "kpi1": (kpis.airline_with_most_flights, ("flights", "airlines")),
    "kpi2": (kpis.airline_with_most_regional_flights, ("flights", "zoned_airports", "airlines")),
    "kpi3": (kpis.longest_ongoing_flight, ("flights", "airports")),
    "kpi4": (kpis.average_flight_distance_by_continent, ("flights", "zoned_airports")),
    "kpi5": (kpis.aircraft_with_most_active_flights, ("flights",)),
    "kpi6": (kpis.top_aircraft_by_country, ("flights", "airlines")),
}


def _stage_feed(spark: SparkSession, landing: str, table: str, folder: str) -> dict[str, Staged]:
    """Types and cleans one feed, parsed once and written once: good records and rejects each to a
    folder of their own, which is then only moved."""
    path = f"{landing.rstrip('/')}/{table}"
    if table == "zones":
        # Their numbers take two passes. So the many small files are opened once, for both.
        typed = in_sequence(_read_staged(spark, stage(zones_by_file(spark, path), f"{folder}/zones_by_file")))
    else:
        typed = read_feed(spark, path, table)
    bad = F.col("reject_reason").isNotNull()
    usable = is_clean() if table == "flights" else F.lit(True)
    split = typed.where(bad | usable).select(
        *[F.when(~bad, F.col(name)).alias(name) for name in TABLES[table].names],
        F.when(bad, F.lit(table)).alias("feed"),
        F.col("reject_reason").alias("reason"),
        F.when(bad, F.col("record")).alias("record"),
        bad.alias("is_rejected"),
    )
    split.write.partitionBy("is_rejected").parquet(f"{folder}/{table}")
    return {
        table: Staged(f"{folder}/{table}/is_rejected=false", TABLES[table]),
        f"{REJECTED}_{table}": Staged(f"{folder}/{table}/is_rejected=true", REJECTS),
    }


def _read_staged(spark: SparkSession, staged: Staged) -> DataFrame:
    # Of one of the two sides of a feed there may be nothing.
    wanted = staged.folder.rpartition("/")
    if not wanted[2].startswith("is_rejected="):
        return spark.read.schema(staged.schema).parquet(staged.folder)
    both = spark.read.schema(f"{staged.schema.toDDL()}, is_rejected boolean").parquet(wanted[0])
    side = F.col("is_rejected") == (wanted[2] == "is_rejected=true")
    return both.where(side).drop("is_rejected")


def _count_rejects(spark: SparkSession, staged: dict[str, Staged], table: str) -> int:
    n_bad = _read_staged(spark, staged[f"{REJECTED}_{table}"]).count()
    if n_bad:
        log.warning("%s: %d rejected records", table, n_bad)
    return n_bad


def ingest(spark: SparkSession, landing: str, store: str, table: str, at: datetime) -> int:
    """Types, cleans and stores one feed for the hour ``at``; returns how many records it rejected.

    The hour's ``rejected_<table>`` is replaced on every run, so a repaired feed leaves none behind.
    """
    with staging(spark, store) as folder:
        staged = _stage_feed(spark, landing, table, folder)
        n_bad = _count_rejects(spark, staged, table)
        paths = publish(spark, store, at, staged)
    log.info("%s: stored in %s", table, paths[table])
    return n_bad


def _settled(spark: SparkSession, tiles: DataFrame, folder: str) -> DataFrame:
    """Tiles in which no point meets very many zones, written round by round until none is crowded."""
    rounds: list[DataFrame] = []
    while True:
        staged = stage(settle_tiles(tiles), f"{folder}/settled_tiles/{len(rounds)}")
        settled = _read_staged(spark, staged)
        rounds.append(settled.where(~F.col("crowded")).drop("crowded"))
        tiles = settled.where("crowded").drop("crowded")
        if tiles.isEmpty():
            return reduce(DataFrame.unionByName, rounds)


def extract(spark: SparkSession, landing: str, store: str, at: datetime) -> dict[str, int]:
    """Ingests all four feeds and stores the zones' tiles and the airports with their continents;
    returns the rejects of each feed.

    The hour gets all tables at once, or none: until the last one is written it stays as it was. A
    zone feed that landed and gives no zone is an error, as no flight would have a continent.
    """
    with staging(spark, store) as folder:
        staged: dict[str, Staged] = {}
        for table in TABLES:
            staged |= _stage_feed(spark, landing, table, folder)
        rejects = {table: _count_rejects(spark, staged, table) for table in TABLES}
        zones = _read_staged(spark, staged["zones"])
        if zones.isEmpty() and (landed := landed_files(spark, f"{landing.rstrip('/')}/zones")):
            raise ValueError(f"no zone in {landed} files of {landing}/zones, {rejects['zones']} rejected")
        staged["zone_tiles"] = stage(zone_tiles(zones), f"{folder}/zone_tiles")
        airports = _read_staged(spark, staged["airports"])
        tiles = _settled(spark, _read_staged(spark, staged["zone_tiles"]), folder)
        zoned = airports_by_tiles(airports, tiles, FINEST)
        staged["zoned_airports"] = stage(zoned, f"{folder}/zoned_airports")
        publish(spark, store, at, staged)
    log.info("hour %s: %s stored in %s", at, ", ".join(sorted(staged)), store)
    return rejects


def newest_hour(
    spark: SparkSession, store: str, questions: Iterable[str], as_of: datetime | None = None
) -> datetime:
    """Newest hour, not later than ``as_of``, that has all tables of the questions."""
    tables = sorted({table for question in questions for table in QUESTIONS[question][1]})
    while True:
        hours = [latest_hour(spark, store, table, as_of) for table in tables]
        if min(hours) == max(hours):
            return hours[0]
        as_of = min(hours)


def answer(
    spark: SparkSession,
    question: str,
    store: str,
    at: datetime | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """The plan of one question over the tables of one hour: ``at``, else the newest as of a time."""
    at = at or newest_hour(spark, store, [question], as_of)
    function, tables = QUESTIONS[question]
    hour = open_hour(spark, store, at)
    return function(*(hour.read(table, STORED[table]) for table in tables))


def run_kpis(
    spark: SparkSession, store: str, results: str, at: datetime, questions: Iterable[str] = tuple(QUESTIONS)
) -> dict[str, str]:
    """Answers questions for the hour ``at`` and stores each result as one file.

    All are answered from one version of the hour, and their results appear together.
    """
    hour = open_hour(spark, store, at)
    with staging(spark, results) as folder:
        staged = {}
        for question in questions:
            function, tables = QUESTIONS[question]
            result = function(*(hour.read(table, STORED[table]) for table in tables))
            staged[RESULT_NAMES[question]] = stage(result, f"{folder}/{question}", files=1)
        paths = publish(spark, results, at, staged)
    for path in paths.values():
        log.info("result stored in %s", path)
    return {question: paths[RESULT_NAMES[question]] for question in questions}


def run_kpi(spark: SparkSession, question: str, store: str, results: str, at: datetime) -> str:
    """Answers one question for the hour ``at`` and stores the result as one file."""
    return run_kpis(spark, store, results, at, [question])[question]


def read_result(
    spark: SparkSession,
    question: str,
    results: str,
    at: datetime | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """A stored result: of the hour ``at``, else the newest as of a time."""
    name = RESULT_NAMES[question]
    return read_snapshot(spark, results, name, at or latest_hour(spark, results, name, as_of))
