from skymetrics.functions.geo import great_circle_km, in_box, is_finite
from skymetrics.functions.hours import HOUR_KEYS, hour_columns, hour_values
from skymetrics.functions.numbers import parse_double

__all__ = [
    "HOUR_KEYS",
    "great_circle_km",
    "hour_columns",
    "hour_values",
    "in_box",
    "is_finite",
    "parse_double",
]
