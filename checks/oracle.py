"""The same answers in SQL, over the same Parquet tables; one statement per registered query."""

from checks.registry import READ_HOUR
from checks.derived import ZONE_ROWS

# Derived tables, each stated on its own so that a query names those it needs.
_TABLES = {
    "zones": f"""
        SELECT * FROM (VALUES {ZONE_ROWS})
            AS t(zone_seq, continent, subzone, tl_y, tl_x, br_y, br_x)""",
    "airports": """
        SELECT concat('A', c_custkey) AS airportID, c_name AS airportName,
            CASE WHEN c_custkey % 23 = 0 THEN NULL
                ELSE CAST((c_custkey * 37) % 1600 AS DOUBLE) / 10e0 - 80e0 END AS airportLat,
            CASE WHEN c_custkey % 29 = 0 THEN NULL
                ELSE CAST((c_custkey * 113) % 3600 AS DOUBLE) / 10e0 - 180e0 END AS airportLong,
            n_name AS airportCountryName, c_custkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "airlines": """
        SELECT CAST(s_suppkey AS VARCHAR) AS Code,
            concat(CASE WHEN s_suppkey % 7 = 6 THEN 'X' ELSE 'S' END, s_suppkey) AS ICAO,
            s_name AS Name, n_name AS Country
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "flights_raw": """
        SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey) AS flightID,
            p_brand AS aircraft,
            CASE WHEN l_orderkey % 97 = 0 THEN 'N/A' WHEN l_orderkey % 89 = 0 THEN ''
                WHEN l_orderkey % 83 = 0 THEN NULL ELSE concat('S', l_suppkey) END AS airlineCode,
            CASE WHEN l_orderkey % 101 = 0 THEN ''
                ELSE concat('A', o_custkey) END AS airportOrigineCode,
            CASE WHEN l_orderkey % 103 = 0 THEN ''
                ELSE concat('A', l_partkey) END AS airportDestinationCode,
            CASE WHEN l_linestatus = 'O' THEN '0' ELSE '1' END AS flightStatus,
            l_orderkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "flights": """
        SELECT flightID, aircraft, airlineCode, airportOrigineCode, airportDestinationCode,
            flightStatus
        FROM flights_raw
        WHERE airlineCode <> 'N/A' AND airlineCode <> ''
            AND airportOrigineCode <> '' AND airportDestinationCode <> ''""",
    "zone_of_point": """
        SELECT airportLat, airportLong, arg_min(continent, zone_seq) AS continent
        FROM (SELECT DISTINCT airportLat, airportLong FROM airports) AS p
        JOIN zones ON airportLat BETWEEN br_y AND tl_y AND airportLong BETWEEN tl_x AND br_x
        GROUP BY airportLat, airportLong""",
    "zoned": """
        SELECT airportID, a.airportLat, a.airportLong, continent
        FROM airports AS a LEFT JOIN zone_of_point AS z
            ON a.airportLat = z.airportLat AND a.airportLong = z.airportLong""",
    "joined": """
        SELECT f.*, o.airportID AS airportID_origin, o.airportLat AS airportLat_origin,
            o.airportLong AS airportLong_origin, d.airportID AS airportID_destination,
            d.airportLat AS airportLat_destination, d.airportLong AS airportLong_destination,
            o.continent AS originContinent, d.continent AS destinationContinent
        FROM flights AS f
        LEFT JOIN zoned AS o ON f.airportOrigineCode = o.airportID
        LEFT JOIN zoned AS d ON f.airportDestinationCode = d.airportID""",
    "geo": """
        SELECT *, 6371 * acos(greatest(-1e0, least(1e0,
            sin(radians(airportLat_origin)) * sin(radians(airportLat_destination))
            + cos(radians(airportLat_origin)) * cos(radians(airportLat_destination))
            * cos(radians(airportLong_destination) - radians(airportLong_origin))))) AS km
        FROM joined
        WHERE airportLat_origin IS NOT NULL AND airportLong_origin IS NOT NULL
            AND airportLat_destination IS NOT NULL AND airportLong_destination IS NOT NULL
        UNION ALL
        SELECT *, NULL FROM joined
        WHERE airportLat_origin IS NULL OR airportLong_origin IS NULL
            OR airportLat_destination IS NULL OR airportLong_destination IS NULL""",
    "by_airline": """
        SELECT airlineCode, count(*) AS flight_count
        FROM flights WHERE flightStatus = '0' GROUP BY airlineCode""",
    "busiest": """
        SELECT * FROM by_airline ORDER BY flight_count DESC, airlineCode NULLS FIRST LIMIT 1""",
    "by_aircraft": """
        SELECT aircraft, count(*) AS active_flight_count
        FROM flights WHERE flightStatus = '0' GROUP BY aircraft""",
    "by_country": """
        SELECT Country AS airlineCountry, aircraft, count(*) AS usage_count
        FROM flights LEFT JOIN airlines ON airlineCode = ICAO GROUP BY Country, aircraft""",
    "by_continent": """
        SELECT originContinent, airlineCode, Name AS airline_name,
            count(*) AS regional_flight_count
        FROM joined LEFT JOIN airlines ON airlineCode = ICAO
        WHERE originContinent = destinationContinent
        GROUP BY originContinent, airlineCode, Name""",
    "ranked_countries": """
        SELECT *, CAST(row_number() OVER (PARTITION BY airlineCountry
            ORDER BY usage_count DESC, aircraft NULLS FIRST) AS INTEGER) AS rank
        FROM by_country""",
    "ranked_continents": """
        SELECT *, CAST(row_number() OVER (PARTITION BY originContinent
            ORDER BY regional_flight_count DESC, airlineCode NULLS FIRST,
                airline_name NULLS FIRST) AS INTEGER) AS rank
        FROM by_continent""",
    "zone_rows": """
        SELECT s_suppkey, s_name, n_name, r_name, s_suppkey % 2 AS odd,
            CAST(s_suppkey % 90 AS DOUBLE) AS tl_y, CAST((-s_suppkey) % 180 AS DOUBLE) AS tl_x
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey""",
    "zone_feed": """
        SELECT CAST(first + odd AS INTEGER) AS zone_seq, r_name AS continent, n_name AS subzone,
            tl_y, tl_x, -1e0 AS br_y, 1.5e0 AS br_x FROM zone_files
        UNION ALL
        SELECT CAST(first + odd + 1 AS INTEGER), r_name, s_name, tl_y, tl_x, -2e0, 2.5e0
        FROM zone_files
        UNION ALL
        SELECT CAST(first + 2 - 2 * odd AS INTEGER), concat(r_name, ' sea'), NULL,
            tl_y, tl_x, -3e0, 3.5e0 FROM zone_files""",
    # Files are in the order of their names.
    "zone_files": """
        SELECT *, 3 * (row_number() OVER (ORDER BY concat(s_suppkey, '/')) - 1) AS first
        FROM zone_rows""",
    "unread": """
        SELECT flightID FROM flights_raw
        WHERE l_orderkey % 211 = 0 OR l_orderkey % 223 = 0""",
}

_NEEDS = {
    "zone_files": ("zone_rows",),
    "zone_feed": ("zone_files",),
    "unread": ("flights_raw",),
    "flights": ("flights_raw",),
    "zone_of_point": ("airports", "zones"),
    "zoned": ("airports", "zone_of_point"),
    "joined": ("flights", "zoned"),
    "geo": ("joined",),
    "by_airline": ("flights",),
    "busiest": ("by_airline",),
    "by_aircraft": ("flights",),
    "by_country": ("flights", "airlines"),
    "by_continent": ("joined", "airlines"),
    "ranked_countries": ("by_country",),
    "ranked_continents": ("by_continent",),
}


def _with(select: str, *tables: str) -> str:
    """``select`` after a WITH clause of ``tables`` and all that they need."""
    needed: dict[str, None] = {}

    def add(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            add(other)
        needed[name] = None

    for name in tables:
        add(name)
    clauses = ",\n    ".join(f"{name} AS ({_TABLES[name]})" for name in needed)
    return f"WITH {clauses}\n{select}"


_FLIGHT = (
    "flightID, aircraft, airlineCode, airportOrigineCode, airportDestinationCode, flightStatus"
)
_ORIGIN = "airportID_origin, airportLat_origin, airportLong_origin"
_DESTINATION = "airportID_destination, airportLat_destination, airportLong_destination"
_KM = "round(km, 6) AS flightDistance"
_LONGEST = f"""
    FROM geo WHERE flightStatus = '0' AND km IS NOT NULL
    ORDER BY km DESC, {", ".join(f"{c} NULLS FIRST" for c in _FLIGHT.split(", "))} LIMIT 1"""
_MEANS = """
    SELECT originContinent, round(avg(km), 3) AS average_flight_distance
    FROM geo WHERE originContinent IS NOT NULL AND km IS NOT NULL GROUP BY originContinent"""
_TOP_AIRLINE = """
    SELECT airlineCode, Name AS airline_name, flight_count
    FROM busiest JOIN airlines ON airlineCode = ICAO"""
_TOP_REGIONAL = """
    SELECT originContinent, airlineCode, airline_name, regional_flight_count
    FROM ranked_continents WHERE rank = 1"""
_TOP_COUNTRIES = "SELECT * FROM ranked_countries WHERE rank <= 3"
_TOP_AIRCRAFT = "ORDER BY active_flight_count DESC, aircraft NULLS FIRST LIMIT 1"

_REJECTS = """
        SELECT 'flights' AS feed, 'malformed' AS reason,
            CASE WHEN l_orderkey % 211 = 0 THEN concat('{"id":"', flightID, '"')
                ELSE concat('{"id":"', flightID, '","on_ground":"unknown"}') END AS record
        FROM flights_raw WHERE l_orderkey % 211 = 0 OR l_orderkey % 223 = 0
        UNION ALL
        SELECT 'airports', 'latitude', concat('{"iata":"', airportID, '","name":"', airportName,
            '","latitude":"bad","longitude":"', coalesce(CAST(airportLong AS VARCHAR), ''),
            '","country":"', airportCountryName, '"}')
        FROM airports WHERE c_custkey % 31 = 0"""

ORACLE: dict[str, str] = {
    "src_flights_typed": _with(
        f"SELECT {_FLIGHT} FROM flights_raw WHERE l_orderkey % 211 <> 0 AND l_orderkey % 223 <> 0",
        "flights_raw",
    ),
    "src_airports_typed": _with(
        """SELECT airportID, airportName, airportLat, airportLong, airportCountryName
        FROM airports WHERE c_custkey % 31 <> 0""",
        "airports",
    ),
    "src_airlines_typed": _with("SELECT Code, ICAO, Name, Country FROM airlines", "airlines"),
    "src_zones_flattened": _with(
        """
        SELECT s_suppkey, CAST(odd AS INTEGER) AS zone_seq, r_name AS continent,
            n_name AS subzone, tl_y, tl_x, -1e0 AS br_y, 1.5e0 AS br_x FROM zone_rows
        UNION ALL
        SELECT s_suppkey, CAST(odd + 1 AS INTEGER), r_name, s_name, tl_y, tl_x, -2e0, 2.5e0
        FROM zone_rows
        UNION ALL
        SELECT s_suppkey, CAST(2 - 2 * odd AS INTEGER), concat(r_name, ' sea'), NULL,
            tl_y, tl_x, -3e0, 3.5e0 FROM zone_rows""",
        "zone_rows",
    ),
    "src_zones_feed": _with("SELECT * FROM zone_feed", "zone_feed"),
    "src_quarantine": _with(_REJECTS, "flights_raw", "airports"),
    "ingest_flights": _with(
        "SELECT * FROM flights WHERE flightID NOT IN (SELECT flightID FROM unread)",
        "flights",
        "unread",
    ),
    "ingest_rejects": _with(_REJECTS, "flights_raw", "airports"),
    "ingest_zoned_airports": _with(
        """SELECT airportID, airportLat, airportLong,
            (SELECT arg_min(z.continent, z.zone_seq) FROM zone_feed AS z
                WHERE airportLat BETWEEN br_y AND tl_y AND airportLong BETWEEN tl_x AND br_x)
                AS continent
        FROM airports WHERE c_custkey % 31 <> 0""",
        "airports",
        "zone_feed",
    ),
    "snapshot_write": _with("SELECT * FROM flights", "flights"),
    "snapshot_read_hour": (
        f"SELECT * FROM events WHERE date_trunc('hour', ts) = TIMESTAMP '{READ_HOUR}'"
    ),
    "snapshot_read_latest": """
        SELECT * FROM events
        WHERE date_trunc('hour', ts) = (SELECT max(date_trunc('hour', ts)) FROM events)""",
    "results_read": _with(_TOP_COUNTRIES, "ranked_countries"),
    "results_read_kpi1": _with(_TOP_AIRLINE, "busiest", "airlines"),
    "results_read_kpi2": _with(_TOP_REGIONAL, "ranked_continents"),
    "results_read_kpi3": _with(
        f"SELECT {_FLIGHT}, {_ORIGIN}, {_DESTINATION}, {_KM} {_LONGEST}", "geo"
    ),
    "results_read_kpi4": _with(_MEANS, "geo"),
    "results_read_kpi5": _with(f"SELECT * FROM by_aircraft {_TOP_AIRCRAFT}", "by_aircraft"),
    "clean_flights": _with("SELECT * FROM flights", "flights"),
    "filter_ongoing": _with("SELECT * FROM flights WHERE flightStatus = '0'", "flights"),
    "filter_known_continent": _with(
        "SELECT flightID, originContinent FROM joined WHERE originContinent IS NOT NULL", "joined"
    ),
    "filter_valid_distance": _with(
        f"SELECT flightID, {_KM} FROM geo WHERE km IS NOT NULL AND NOT isnan(km)", "geo"
    ),
    "filter_regional": _with(
        """SELECT flightID, airlineCode, originContinent, destinationContinent FROM joined
        WHERE originContinent = destinationContinent""",
        "joined",
    ),
    "project_role_airport": _with(
        """SELECT airportID AS airportID_origin, airportLat AS airportLat_origin,
            airportLong AS airportLong_origin FROM airports""",
        "airports",
    ),
    "project_flight_geo": _with(
        f"SELECT {_FLIGHT}, {_KM}, originContinent, destinationContinent FROM geo", "geo"
    ),
    "join_origin_airport": _with(
        """SELECT f.*, airportID AS airportID_origin, airportLat AS airportLat_origin,
            airportLong AS airportLong_origin
        FROM flights AS f LEFT JOIN airports ON airportOrigineCode = airportID""",
        "flights",
        "airports",
    ),
    "join_destination_airport": _with(
        """SELECT f.*, airportID AS airportID_destination, airportLat AS airportLat_destination,
            airportLong AS airportLong_destination
        FROM flights AS f LEFT JOIN airports ON airportDestinationCode = airportID""",
        "flights",
        "airports",
    ),
    "join_flights_airports": _with(
        f"SELECT {_FLIGHT}, {_ORIGIN}, {_DESTINATION} FROM joined", "joined"
    ),
    "join_airline_name": _with(
        """SELECT f.*, Name AS airline_name
        FROM flights AS f LEFT JOIN airlines ON airlineCode = ICAO""",
        "flights",
        "airlines",
    ),
    "join_airline_country": _with(
        """SELECT f.*, Country AS airlineCountry
        FROM flights AS f LEFT JOIN airlines ON airlineCode = ICAO""",
        "flights",
        "airlines",
    ),
    "join_top_airline_inner": _with(_TOP_AIRLINE, "busiest", "airlines"),
    "zone_of_airport": _with("SELECT * FROM zoned", "zoned"),
    "zone_of_flight": _with(
        f"SELECT {_FLIGHT}, originContinent, destinationContinent FROM joined", "joined"
    ),
    "agg_count_by_airline": _with("SELECT * FROM by_airline", "by_airline"),
    "agg_count_by_aircraft": _with("SELECT * FROM by_aircraft", "by_aircraft"),
    "agg_count_by_country_aircraft": _with("SELECT * FROM by_country", "by_country"),
    "agg_count_regional": _with("SELECT * FROM by_continent", "by_continent"),
    "agg_avg_distance": _with(_MEANS, "geo"),
    "win_row_number_global": _with(
        f"""SELECT *, CAST(1 AS INTEGER) AS rank
        FROM (SELECT * FROM by_aircraft {_TOP_AIRCRAFT}) AS t""",
        "by_aircraft",
    ),
    "win_top1_per_continent": _with(
        "SELECT * FROM ranked_continents WHERE rank = 1", "ranked_continents"
    ),
    "win_top3_per_country": _with(_TOP_COUNTRIES, "ranked_countries"),
    "topk_airline": _with("SELECT * FROM busiest", "busiest"),
    "topk_longest_flight": _with(f"SELECT flightID, {_KM} {_LONGEST}", "geo"),
    "fn_great_circle_km": _with(
        f"""SELECT flightID, airportLat_origin, airportLong_origin, airportLat_destination,
            airportLong_destination, {_KM} FROM geo""",
        "geo",
    ),
    "fn_snapshot_keys": """
        SELECT event_id, strftime(ts, '%Y') AS tech_year, strftime(ts, '%m') AS tech_month,
            strftime(ts, '%d') AS tech_day, strftime(ts, '%H') AS tech_hour FROM events""",
    "kpi1_airline_most_flights": _with(_TOP_AIRLINE, "busiest", "airlines"),
    "kpi2_regional_airline_by_continent": _with(_TOP_REGIONAL, "ranked_continents"),
    "kpi3_longest_ongoing_flight": _with(
        f"SELECT {_FLIGHT}, {_ORIGIN}, {_DESTINATION}, {_KM} {_LONGEST}", "geo"
    ),
    "kpi4_avg_distance_by_continent": _with(_MEANS, "geo"),
    "kpi5_aircraft_most_active": _with(f"SELECT * FROM by_aircraft {_TOP_AIRCRAFT}", "by_aircraft"),
    "kpi6_top3_aircraft_by_country": _with(_TOP_COUNTRIES, "ranked_countries"),
}
