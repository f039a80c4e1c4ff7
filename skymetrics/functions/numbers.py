"""Text to number."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number. The JVM also takes suffixed (1.5d) and hex forms.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def parse_double(text: Column) -> Column:
    """The number a text holds, null where it holds none; never fails the job."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
