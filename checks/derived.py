"""The star schema and its raw feeds, derived from generic order tables.

Airports come from customers, airlines from suppliers and flights from order lines, so every
table here grows with its source. ``checks/oracle.py`` states the same derivations in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.operators.filters import clean_flights
from skymetrics.schemas import FLIGHTS

# The zones of the check data (zone_seq, continent, subzone, top, left, bottom,
# right). Some share an edge, some overlap, one crosses the date line and matches nothing.
ZONE_ROWS = """
    (0, 'europe', 'north', 72e0, -16e0, 50e0, 40e0),
    (1, 'europe', 'south', 50e0, -10e0, 34e0, 40e0),
    (2, 'northamerica', 'na_n', 72e0, -170e0, 40e0, -50e0),
    (3, 'northamerica', 'na_s', 40e0, -130e0, 12e0, -60e0),
    (4, 'southamerica', NULL, 15e0, -85e0, -57e0, -33e0),
    (5, 'africa', NULL, 38e0, -20e0, -36e0, 53e0),
    (6, 'asia', NULL, 79e0, 40e0, -10e0, 179e0),
    (7, 'oceania', 'dateline', 0e0, 110e0, -50e0, -170e0),
    (8, 'oceania', NULL, 0e0, 110e0, -50e0, 179e0)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT * FROM VALUES {ZONE_ROWS} "
        "AS t(zone_seq, continent, subzone, tl_y, tl_x, br_y, br_x)"
    )


def _multiple(key: str, divisor: int) -> Column:
    return F.col(key) % divisor == 0


def _nation(df: DataFrame, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return df.join(nations, F.col(key) == F.col("n_nationkey"))


def _degrees(factor: int, tenths: int, shift: float) -> Column:
    return ((F.col("c_custkey") * factor) % tenths).cast("double") / F.lit(10.0) - F.lit(shift)


def airports(spark: SparkSession, sf_dir: str, country: bool = False) -> DataFrame:
    """Airports; the join that finds the country's name is made only where it is wanted."""
    customers = table(spark, sf_dir, "customer")
    columns = [
        F.concat(F.lit("A"), "c_custkey").alias("airportID"),
        F.col("c_name").alias("airportName"),
        F.when(~_multiple("c_custkey", 23), _degrees(37, 1600, 80.0)).alias("airportLat"),
        F.when(~_multiple("c_custkey", 29), _degrees(113, 3600, 180.0)).alias("airportLong"),
    ]
    if country:
        customers = _nation(customers, spark, sf_dir, "c_nationkey")
        columns.append(F.col("n_name").alias("airportCountryName"))
    return customers.select(*columns)


def airlines(spark: SparkSession, sf_dir: str, country: bool = False) -> DataFrame:
    """Airlines. One supplier in seven gets a code no flight uses, so some flights' codes are
    unknown here."""
    suppliers = table(spark, sf_dir, "supplier")
    unused = F.col("s_suppkey") % 7 == 6
    columns = [
        F.col("s_suppkey").cast("string").alias("Code"),
        F.concat(F.when(unused, "X").otherwise("S"), "s_suppkey").alias("ICAO"),
        F.col("s_name").alias("Name"),
    ]
    if country:
        suppliers = _nation(suppliers, spark, sf_dir, "s_nationkey")
        columns.append(F.col("n_name").alias("Country"))
    return suppliers.select(*columns)


def raw_flights(spark: SparkSession, sf_dir: str, aircraft: bool = True) -> DataFrame:
    """Flights before cleaning, plus ``l_orderkey``; ``aircraft`` costs the join with parts."""
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    model = F.lit(None).cast("string")
    if aircraft:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        model = F.col("p_brand")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("flightID"),
        model.alias("aircraft"),
        F.when(_multiple("l_orderkey", 97), "N/A")
        .when(_multiple("l_orderkey", 89), "")
        .when(_multiple("l_orderkey", 83), None)
        .otherwise(F.concat(F.lit("S"), "l_suppkey"))
        .alias("airlineCode"),
        F.when(_multiple("l_orderkey", 101), "")
        .otherwise(F.concat(F.lit("A"), "o_custkey"))
        .alias("airportOrigineCode"),
        F.when(_multiple("l_orderkey", 103), "")
        .otherwise(F.concat(F.lit("A"), "l_partkey"))
        .alias("airportDestinationCode"),
        F.when(F.col("l_linestatus") == "O", "0").otherwise("1").alias("flightStatus"),
        "l_orderkey",
    )


def flights(spark: SparkSession, sf_dir: str, aircraft: bool = True) -> DataFrame:
    return clean_flights(raw_flights(spark, sf_dir, aircraft).select(*FLIGHTS.names))


# -- raw feeds, as text lines --------------------------------------------------------------


def flight_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of all flights: some cut short, some with a word for the ground flag."""
    record = F.struct(
        F.col("flightID").alias("id"),
        F.col("aircraft").alias("aircraft_code"),
        F.col("airlineCode").alias("airline_icao"),
        F.col("airportOrigineCode").alias("origin_airport_iata"),
        F.col("airportDestinationCode").alias("destination_airport_iata"),
        F.col("flightStatus").cast("int").alias("on_ground"),
    )
    opening = F.concat(F.lit('{"id":"'), "flightID", F.lit('"'))
    line = (
        F.when(_multiple("l_orderkey", 211), opening)
        .when(_multiple("l_orderkey", 223), F.concat(opening, F.lit(',"on_ground":"unknown"}')))
        .otherwise(F.to_json(record))
    )
    return raw_flights(spark, sf_dir).select(line.alias("value"))


def airport_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of all airports, coordinates as text: '' where missing, some no number."""
    number = F.ltrim("airportID", F.lit("A")).cast("bigint")
    latitude, longitude = (
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("airportLat", "airportLong")
    )
    record = F.struct(
        F.col("airportID").alias("iata"),
        F.col("airportName").alias("name"),
        F.when(number % 31 == 0, "bad").otherwise(latitude).alias("latitude"),
        longitude.alias("longitude"),
        F.col("airportCountryName").alias("country"),
    )
    return airports(spark, sf_dir, country=True).select(F.to_json(record).alias("value"))


def airline_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of all airlines, with a field the table does not have."""
    rows = airlines(spark, sf_dir, country=True)
    record = F.struct("Code", "ICAO", "Name", "Country", F.lit(1).alias("Fleet"))
    return rows.select(F.to_json(record).alias("value"))


def zone_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone document per supplier, around a corner that depends on its key.

    Three continents each: one with two subzones, one without that field, one with none in it.
    Corners come as numbers and as text, and the order of the first two alternates.
    """
    top, left = (F.col("s_suppkey") % 90).cast("string"), (-F.col("s_suppkey") % 180).cast("string")
    text = lambda value: F.concat(F.lit('"'), value, F.lit('"'))

    def box(depth: int, rest: str = "") -> Column:
        return F.concat(
            F.lit('{"tl_y":'), top, F.lit(',"tl_x":'), text(left),
            F.lit(f',"br_y":-{depth},"br_x":"{depth}.5"{rest}}}'),
        )

    nested = F.concat(
        text(F.col("r_name")), F.lit(':{"subzones":{'), text(F.col("n_name")), F.lit(":"), box(1),
        F.lit(","), text(F.col("s_name")), F.lit(":"), box(2), F.lit("}}"),
    )
    plain = F.concat(text(F.concat("r_name", F.lit(" sea"))), F.lit(":"), box(3))
    empty = F.concat(F.lit('"nowhere":'), box(4, ',"subzones":{}'))
    pair = F.when(_multiple("s_suppkey", 2), F.concat_ws(",", nested, plain)).otherwise(
        F.concat_ws(",", plain, nested)
    )
    document = F.concat(F.lit("{"), pair, F.lit(","), empty, F.lit("}"))
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        table(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", document.alias("value"))
    )
