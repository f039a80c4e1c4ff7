"""Which zone a point lies in: the first zone, in ``zone_seq`` order, whose box holds it.

Zones and points meet by tile. ``zone_tiles`` cuts zones into tiles, which ``extract`` stores beside the zones,
so that the size of their files is a true estimate; ``assign_by_tiles`` looks points up in them. No join
is prescribed: few tiles are broadcast, many are merged. Where very many zones overlap, ``settle_tiles`` first
drops what cannot be the first zone of any point, and cuts crowded tiles.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymetrics.functions import in_box

_CORNERS = ("tl_y", "tl_x", "br_y", "br_x")
_TILE = ("level", "tile_y", "tile_x")
_SIDES = (("br_y", "tl_y", "tile_y"), ("tl_x", "br_x", "tile_x"))

# Tiles of level k are squares of 2**k degrees. A box is cut into tiles of the first level at which
# it is at most _SPAN tiles high and wide, so it has few rows, and a tile holds boxes of its size
# only. Coordinates past _EDGE fall in the outer tiles, so endless boxes have an end too.
_LEVELS = 10
_SPAN = 4
_EDGE = 1024.0

# A tile with more zones than _CROWD is cut in four, down to the level FINEST.
_CROWD = 64
FINEST = -6


def zone_tiles(zones: DataFrame) -> DataFrame:
    """(level, tile_y, tile_x, zone_seq, continent, corners): each zone in every tile that it touches.

    Zones need a ``zone_seq``; those without one are left out.
    """
    return (
        _usable(zones)
        .withColumn("level", _level())
        .withColumn("tile_y", _tile_range("br_y", "tl_y"))
        .withColumn("tile_x", _tile_range("tl_x", "br_x"))
        .select(*_TILE, "zone_seq", "continent", *_CORNERS)
    )


def assign_zone(
    points: DataFrame, zones: DataFrame, lat: str, lon: str, name: str
) -> DataFrame:
    """``assign_by_tiles`` for zones whose tiles aren't stored.

    Estimates do not see what cutting zones up adds. So tiles are dealt by place first: adaptive
    execution then knows how many bytes they are before it picks the join.
    """
    return assign_by_tiles(points, zone_tiles(zones).repartition(*_TILE), lat, lon, name)


def settle_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles that give every point the same zone as ``tiles`` do, with fewer zones each, plus ``crowded``.

    Corners are drawn in to their tile. Of zones with the same corners there the first is left, and none
    that comes after one that holds the whole tile. Zones that reach into a crowded tile only in part are put
    into the quarters that they touch; those rows are ``crowded`` and may be settled once more. Their level
    falls each time and ends at ``FINEST``.
    """
    drawn_in = tiles
    for low, high, tile in _SIDES:
        start, end = _reach(tile)
        drawn_in = drawn_in.withColumn(low, F.greatest(low, start)).withColumn(high, F.least(high, end))
    zone = F.min(F.struct("zone_seq", "continent")).alias("_zone")
    firsts = drawn_in.groupBy(*_TILE, *_CORNERS).agg(zone).select("*", "_zone.*").drop("_zone")
    whole = F.lit(True)
    for low, high, tile in _SIDES:
        start, end = _reach(tile)
        whole = whole & (F.col(low) == start) & (F.col(high) == end)
    marked = firsts.withColumn("_whole", whole)
    first = F.min(F.when(F.col("_whole"), F.col("zone_seq")))
    of_tile = marked.groupBy(*_TILE).agg(first.alias("_first"), F.count("*").alias("_size"))
    left = marked.join(of_tile, list(_TILE)).where(F.col("_first").isNull() | (F.col("zone_seq") <= F.col("_first")))
    crowded = ~F.col("_whole") & (F.col("_size") > _CROWD) & (F.col("level") > FINEST)
    cut = left.withColumn("crowded", crowded).withColumn("level", F.col("level") - F.col("crowded").cast("int"))
    for side in _SIDES:
        cut = cut.withColumn(side[2], _quarters(*side))
    return cut.select(*tiles.columns, "crowded")


def assign_by_tiles(
    points: DataFrame, tiles: DataFrame, lat: str, lon: str, name: str, finest: int = 0
) -> DataFrame:
    """Adds column ``name``: the continent of each row's point, null outside every zone.

    Distinct points meet the zones of their tiles, so many rows in one place cost one lookup.
    Of zones with the same ``zone_seq``, the first by continent counts. ``finest`` is the lowest
    level of the tiles: 0, or ``FINEST`` if they were settled.
    """
    spots = (
        points.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
        .dropna()  # null and NaN alike
        .distinct()
        .withColumn("_level", F.explode(F.sequence(F.lit(finest), F.lit(_LEVELS - 1))))
        .withColumn("_tile_y", _tile("_lat", "_level"))
        .withColumn("_tile_x", _tile("_lon", "_level"))
    )
    meets = in_box(F.col("_lat"), F.col("_lon"), {corner: F.col(corner) for corner in _CORNERS})
    for column in _TILE:
        meets = (F.col(f"_{column}") == F.col(column)) & meets
    zone = F.when(F.col("zone_seq").isNotNull(), F.struct("zone_seq", "continent"))
    # A left join, as it can broadcast the tiles only: spots are ten times what estimates take them for.
    found = spots.join(tiles, meets, "left").groupBy("_lat", "_lon").agg(F.min(zone)["continent"].alias(name))
    same_spot = (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon"))
    return points.join(found, same_spot, "left").drop("_lat", "_lon")


def _usable(zones: DataFrame) -> DataFrame:
    """Zones that can hold a point. An inverted box holds none, and sequence() would count down
    over it."""
    for corner in _CORNERS:
        # Spark orders NaN above every number; as a corner it must match nothing.
        zones = zones.filter(~F.isnan(corner))
    upright = (F.col("br_y") <= F.col("tl_y")) & (F.col("tl_x") <= F.col("br_x"))
    return zones.filter(F.col("zone_seq").isNotNull() & upright)


def _within_edges(value: Column) -> Column:
    """Clamped; clamping keeps the order, so a box still covers its points."""
    return F.least(F.lit(_EDGE), F.greatest(F.lit(-_EDGE), value))


def _level() -> Column:
    height = _within_edges(F.col("tl_y")) - _within_edges(F.col("br_y"))
    width = _within_edges(F.col("br_x")) - _within_edges(F.col("tl_x"))
    tiles = F.greatest(F.lit(1.0), height / _SPAN, width / _SPAN)
    return F.least(F.lit(_LEVELS - 1), F.ceil(F.log2(tiles)).cast("int"))


def _tile(column: str, level: str = "level") -> Column:
    return F.floor(_within_edges(F.col(column)) / F.pow(F.lit(2.0), F.col(level))).cast("int")


def _tile_range(low: str, high: str) -> Column:
    return F.explode(F.sequence(_tile(low), _tile(high)))


def _reach(tile: str) -> tuple[Column, Column]:
    """From where to where a tile goes in one direction. Those at the edge have no end."""
    size, infinity = F.pow(F.lit(2.0), F.col("level")), F.lit(float("inf"))
    start, end = F.col(tile) * size, (F.col(tile) + 1) * size
    return F.when(start > -_EDGE, start).otherwise(-infinity), F.when(start < _EDGE, end).otherwise(infinity)


def _quarters(low: str, high: str, tile: str) -> Column:
    """The halves of a crowded tile that a zone touches in one direction; else the tile itself."""
    halves = F.sequence(
        F.greatest(_tile(low), F.col(tile) * 2), F.least(_tile(high), F.col(tile) * 2 + 1)
    )
    return F.explode(F.when(F.col("crowded"), halves).otherwise(F.array(tile)))
