"""Geographic column expressions; all of them compile to JVM code."""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius.
EARTH_RADIUS_KM = 6371.0


def is_finite(value: Column) -> Column:
    """True for a real number, null for null, false for NaN and infinities (NaN sorts last)."""
    return F.abs(value) < F.lit(float("inf"))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines; null unless all four are finite.

    Rounding can push the cosine of two equal points past 1, where acos is NaN, so it is
    clamped. The clamp skips nulls, which is why the presence guard has to wrap it.
    """
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(phi1) * F.sin(phi2) + F.cos(phi1) * F.cos(phi2) * F.cos(
        F.radians(lon2) - F.radians(lon1)
    )
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    known = reduce(and_, map(is_finite, (lat1, lon1, lat2, lon2)))
    return F.when(known, F.acos(clamped) * F.lit(EARTH_RADIUS_KM))


def in_box(lat: Column, lon: Column, box) -> Column:
    """Closed box test, all edges included. ``box`` is a struct, or a mapping, of corners.

    A box whose left edge lies east of its right edge (across the date line) holds no point.
    """
    return lat.between(box["br_y"], box["tl_y"]) & lon.between(box["tl_x"], box["br_x"])
