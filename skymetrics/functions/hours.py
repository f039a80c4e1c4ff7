"""The four partition keys that name an hour."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Partition keys, outermost first, and how each is printed.
HOUR_KEYS = ("tech_year", "tech_month", "tech_day", "tech_hour")
_HOUR_FORMATS = ("%Y", "%m", "%d", "%H")


def hour_values(at: datetime) -> dict[str, str]:
    """Zero-padded keys of one run time."""
    return {key: at.strftime(fmt) for key, fmt in zip(HOUR_KEYS, _HOUR_FORMATS)}


def hour_columns(ts: Column) -> list[Column]:
    """The same keys per row.

    Field extraction reads a zone-less timestamp as it stands; formatting it as text would
    first cast it to an instant and shift the hours a session time zone skips.
    """
    fields = (F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts))
    return [
        F.lpad(field.cast("string"), 4 if key == "tech_year" else 2, "0").alias(key)
        for key, field in zip(HOUR_KEYS, fields)
    ]
