"""Raw feeds to typed tables.

Flights, airports and airlines land as JSON lines, zones as one nested JSON document per file.
Each ``*_from_*`` function returns the typed columns plus ``reject_reason`` and ``record``;
``accepted`` and ``rejected`` split that. One bad record never fails a run, nor does it vanish:
every line that is not blank is in exactly one of the two.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from skymetrics.functions import parse_double
from skymetrics.schemas import RAW_AIRLINE, RAW_AIRPORT, RAW_BOX, RAW_FLIGHT

_BROKEN, _END = "_broken", "_end_of_record"
_REJECT_COLUMNS = ("reject_reason", "record")
MALFORMED = "malformed"
_BLANK = r"^\s*$"

# JSON as its standard has it. Spark by default takes texts in single quotes and NaN for a number too.
_STRICT = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BROKEN,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

# A JSON string; possessive, so that a long one does not exhaust the matcher's stack.
_STRING = r'"(?:[^"\\]++|\\.)*+"'


def _ends_early(text: Column) -> Column:
    """Whether a JSON text's first value ends before its last bracket.

    Strings are taken out, as what looks like a bracket there is none, and depth is counted over the
    brackets that are left.
    """
    brackets = F.regexp_replace(F.regexp_replace(text, _STRING, ""), r"[^\[\]{}]++", "")
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(False).alias("early"))

    def step(so_far: Column, bracket: Column) -> Column:
        opens = F.when(bracket.isin("{", "["), 1).otherwise(-1)
        return F.struct(
            (so_far["depth"] + opens).alias("depth"),
            F.lit(1).alias("seen"),
            (so_far["early"] | ((so_far["depth"] <= 0) & (so_far["seen"] == 1))).alias("early"),
        )

    return F.aggregate(F.regexp_extract_all(brackets, F.lit("(.)")), start, step)["early"]


def _read(text: Column, schema: DataType) -> Column:
    """Struct (_record, _END, _BROKEN): a JSON text read as the only element of an array.

    ``from_json`` ignores what follows the first value. So the text is parsed as the only element
    of an array in an object with a last key: text behind the value then breaks the array, adds
    elements to it, or hides the last key. Only a text that closes the array itself would pass. It has
    a bracket for that behind its record, and where there is one, the record's end is looked for.
    """
    wrapped = F.concat(F.lit('{"_record":['), text, F.lit(f'],"{_END}":"0"}}'))
    fields = [
        StructField("_record", ArrayType(schema)),
        StructField(_END, StringType()),
        StructField(_BROKEN, StringType()),
    ]
    return F.from_json(wrapped, StructType(fields), _STRICT)


def _judged(read: Column | dict[str, Column], text: Column) -> tuple[Column, Column]:
    """The record of what ``_read`` made of a text, and whether all of the text is one such value."""
    record = F.get(read["_record"], F.lit(0))
    # Most texts have no such bracket, and to look for one byte is far cheaper than the pattern.
    closes = text.contains("]") & text.rlike(r"\}\s*\]")
    one_value = ~F.when(closes, _ends_early(text)).otherwise(False)
    single = (F.size(read["_record"]) == 1) & record.isNotNull() & read[_END].isNotNull()
    whole = F.coalesce(read[_BROKEN].isNull() & single & one_value, F.lit(False))
    return record.alias("_record"), whole.alias("_fine")


def _parsed(text: Column, schema: DataType) -> Column:
    """Struct (_record, _fine): a JSON text as ``schema``, and whether all of it is one such value."""
    read = F.array(_read(text, schema))
    return F.get(F.transform(read, lambda r: F.struct(*_judged(r, text))), F.lit(0))


def parse_lines(lines: DataFrame, schema: StructType, line: str = "value") -> DataFrame:
    """JSON fields of each line, the line itself as ``record``, and why it could not be read.

    The whole record decides whether a line is good, whichever columns are used later, which a
    JSON file scan would not guarantee as it parses the selected columns only. Generated rows,
    unlike a projected struct, are not parsed again by a filter on them. They are judged as columns of
    their own, which Spark compiles, and a lambda it does not.
    """
    text = F.col(line)
    read = F.inline(F.array(_read(text, schema)))
    rows = lines.filter(text.startswith("{") | ~text.rlike(_BLANK)).select(text.alias("record"), read)
    found = {name: F.col(name) for name in ("_record", _END, _BROKEN)}
    return rows.select("record", *_judged(found, F.col("record"))).select(
        *[F.when(F.col("_fine"), F.col("_record")[f]).alias(f) for f in schema.names],
        "record",
        F.when(~F.col("_fine"), MALFORMED).alias("reject_reason"),
    )


def accepted(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("reject_reason").isNull()).drop(*_REJECT_COLUMNS)


def rejected(typed: DataFrame, feed: str) -> DataFrame:
    """The records left out of ``accepted``, as (feed, reason, record)."""
    return typed.filter(F.col("reject_reason").isNotNull()).select(
        F.lit(feed).alias("feed"), F.col("reject_reason").alias("reason"), "record"
    )


def flights_from_lines(lines: DataFrame) -> DataFrame:
    """Flights. The ground flag is an integer, so that its text is '0' or '1'."""
    return parse_lines(lines, RAW_FLIGHT).select(
        F.col("id").alias("flightID"),
        F.col("aircraft_code").alias("aircraft"),
        F.col("airline_icao").alias("airlineCode"),
        F.col("origin_airport_iata").alias("airportOrigineCode"),
        F.col("destination_airport_iata").alias("airportDestinationCode"),
        F.col("on_ground").cast("string").alias("flightStatus"),
        *_REJECT_COLUMNS,
    )


def _not_a_number(text: Column) -> Column:
    return text.isNotNull() & (text != "") & parse_double(text).isNull()


def airports_from_lines(lines: DataFrame) -> DataFrame:
    """Airports. A missing or empty coordinate is null; any other text must be a number."""
    raw = parse_lines(lines, RAW_AIRPORT)
    reason = F.col("reject_reason")
    for coordinate in ("latitude", "longitude"):
        reason = F.coalesce(reason, F.when(_not_a_number(F.col(coordinate)), coordinate))
    return raw.select(
        F.col("iata").alias("airportID"),
        F.col("name").alias("airportName"),
        parse_double(F.col("latitude")).alias("airportLat"),
        parse_double(F.col("longitude")).alias("airportLong"),
        F.col("country").alias("airportCountryName"),
        reason.alias("reject_reason"),
        "record",
    )


def airlines_from_lines(lines: DataFrame) -> DataFrame:
    """Airlines, by field name; other fields are dropped, missing ones are null."""
    return parse_lines(lines, RAW_AIRLINE).select(*RAW_AIRLINE.names, *_REJECT_COLUMNS)


def _zones_of(continent: Column, text: Column) -> Column:
    """Rows (continent, subzone, box, record) of one entry of a zone document; no box: unreadable."""
    no_name, no_box = F.lit(None).cast("string"), F.lit(None).cast(RAW_BOX)
    details = StructType([*RAW_BOX.fields, StructField("subzones", MapType(StringType(), StringType()))])

    def row(subzone: Column, box: Column, record: Column) -> Column:
        return F.struct(
            continent.alias("continent"),
            subzone.alias("subzone"),
            box.cast(RAW_BOX).alias("box"),
            record.alias("record"),
        )

    def of_subzone(name: Column, box_text: Column) -> Column:
        box = _parsed(box_text, RAW_BOX)
        return row(name, F.when(box["_fine"], box["_record"]).otherwise(no_box), box_text)

    def of_entry(entry: Column) -> Column:
        whole = entry["_record"]
        box = F.struct(*[whole[corner].alias(corner) for corner in RAW_BOX.names])
        subzones = F.transform(
            F.map_entries(whole["subzones"]), lambda sub: of_subzone(sub["key"], sub["value"])
        )
        return F.when(entry["_fine"], F.coalesce(subzones, F.array(row(no_name, box, text)))).otherwise(
            F.array(row(no_name, no_box, text))
        )

    return F.get(F.transform(F.array(_parsed(text, details)), of_entry), F.lit(0))


def zones_from_documents(
    documents: DataFrame, document: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Zones of nested documents {continent: {corners, subzones?: {name: {corners}}}}.

    A continent with subzones gives one row for each and none for its own box; without the
    field it gives its own box. ``zone_seq`` counts the rows of a document in its key order. An
    entry that cannot be read is rejected on its own, a document only if it is no object.
    ``keep`` passes columns of ``documents`` through, to tell several documents apart.
    """
    text = F.col(document)
    entries = _parsed(text, MapType(StringType(), StringType()))
    none = F.lit(None).cast("string")
    unreadable = F.array(
        F.struct(
            none.alias("continent"),
            none.alias("subzone"),
            F.lit(None).cast(RAW_BOX).alias("box"),
            text.alias("record"),
        )
    )

    def rows_of(parsed: Column) -> Column:
        found = F.transform(
            F.map_entries(parsed["_record"]), lambda e: _zones_of(e["key"], e["value"])
        )
        return F.when(parsed["_fine"], F.flatten(found)).otherwise(unreadable)

    zones = F.get(F.transform(F.array(entries), rows_of), F.lit(0))
    rows = (
        documents.filter(~text.rlike(_BLANK))
        .select(*keep, F.posexplode(zones).alias("zone_seq", "zone"))
        .select(*keep, "zone_seq", "zone.*")
    )
    reason = F.when(F.col("box").isNull(), MALFORMED)
    typed = []
    for corner in RAW_BOX.names:
        number = parse_double(F.col("box")[corner])
        reason = F.coalesce(reason, F.when(number.isNull(), corner))
        typed.append(number.alias(corner))
    named = F.to_json(F.struct("continent", "subzone", "record"))
    return rows.select(
        *keep,
        "zone_seq",
        "continent",
        "subzone",
        *typed,
        reason.alias("reject_reason"),
        F.when(F.col("continent").isNull(), F.col("record")).otherwise(named).alias("record"),
    )


def zones_by_file(spark: SparkSession, path: str) -> DataFrame:
    """Zones of all documents of a feed, each with its ``file`` and its place in it."""
    texts = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return zones_from_documents(texts, keep=("file",))


def in_sequence(zones: DataFrame) -> DataFrame:
    """``zones_by_file`` in one sequence: by file name, then by place in it. Reads ``zones`` twice."""
    # One row for each file.
    sizes = zones.groupBy("file").agg(F.count("*").alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    placed = zones.join(first, "file")
    seq = (F.col("zone_seq") + F.col("first")).cast("int")
    return placed.withColumn("zone_seq", seq).drop("file", "first")


_LINE_FEEDS = {
    "flights": flights_from_lines,
    "airports": airports_from_lines,
    "airlines": airlines_from_lines,
}


def landed_files(spark: SparkSession, path: str) -> int:
    """How many files a feed landed, blank ones too."""
    return len(spark.read.format("binaryFile").load(path).inputFiles())


def read_feed(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """One landed feed, typed, with its rejects still in it."""
    if feed == "zones":
        return in_sequence(zones_by_file(spark, path))
    return _LINE_FEEDS[feed](spark.read.text(path))
