"""Table schemas, raw feed schemas and result names shared by every module."""

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _struct(**types: DataType) -> StructType:
    return StructType([StructField(name, type_) for name, type_ in types.items()])


_text, _real, _int = StringType(), DoubleType(), IntegerType()

# Column names and types of the star schema.
AIRPORTS = _struct(
    airportID=_text,
    airportName=_text,
    airportLat=_real,
    airportLong=_real,
    airportCountryName=_text,
)
FLIGHTS = _struct(
    flightID=_text,
    aircraft=_text,
    airlineCode=_text,
    airportOrigineCode=_text,
    airportDestinationCode=_text,
    flightStatus=_text,
)
AIRLINES = _struct(Code=_text, ICAO=_text, Name=_text, Country=_text)
ZONES = _struct(
    zone_seq=_int,
    continent=_text,
    subzone=_text,
    tl_y=_real,
    tl_x=_real,
    br_y=_real,
    br_x=_real,
)

# The tables that land as feeds, and all that an hour of the store has.
TABLES = {"flights": FLIGHTS, "airports": AIRPORTS, "airlines": AIRLINES, "zones": ZONES}
ZONED_AIRPORTS = StructType([*AIRPORTS.fields, StructField("continent", _text)])
ZONE_TILES = _struct(
    level=_int,
    tile_y=_int,
    tile_x=_int,
    zone_seq=_int,
    continent=_text,
    tl_y=_real,
    tl_x=_real,
    br_y=_real,
    br_x=_real,
)
STORED = {**TABLES, "zone_tiles": ZONE_TILES, "zoned_airports": ZONED_AIRPORTS}

# Field names of the raw feeds. Coordinates arrive as text.
RAW_FLIGHT = _struct(
    id=_text,
    aircraft_code=_text,
    airline_icao=_text,
    origin_airport_iata=_text,
    destination_airport_iata=_text,
    on_ground=_int,
)
RAW_AIRPORT = _struct(iata=_text, name=_text, latitude=_text, longitude=_text, country=_text)
RAW_AIRLINE = AIRLINES
RAW_BOX = _struct(tl_y=_text, tl_x=_text, br_y=_text, br_x=_text)

# Records that could not be typed, kept beside the tables.
REJECTED = _struct(feed=_text, reason=_text, record=_text)

# The folder each result is stored under.
RESULT_NAMES = {
    "kpi1": "airline_with_most_flights",
    "kpi2": "airline_with_most_regional_flights",
    "kpi3": "longest_ongoing_flight",
    "kpi4": "average_flight_distance_by_continent",
    "kpi5": "aircraft_manufacturer_with_most_active_flights",
    "kpi6": "top_3_aircraft_models_by_country",
}
