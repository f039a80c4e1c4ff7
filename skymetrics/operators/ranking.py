"""Top-n, globally or per group, with an order that leaves no ties open."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def largest_first(measure: str, *tie_breaks: str) -> list[Column]:
    """Descending ``measure``; equal values in ascending order of the other columns."""
    return [F.desc_nulls_last(measure), *(F.asc_nulls_first(c) for c in tie_breaks)]


def top_n(
    df: DataFrame,
    order: Sequence[Column],
    n: int = 1,
    per: Sequence[str] = (),
    rank: str | None = None,
) -> DataFrame:
    """First ``n`` rows in ``order``, for each group of ``per``; ``rank`` names a 1-based column.

    Spark keeps n rows per task (and group) before it exchanges anything, in both forms.
    """
    if not per:
        top = df.orderBy(*order).limit(n)
        return top if rank is None else top.withColumn(rank, _row_number(Window.orderBy(*order)))
    position = rank or "_rank"
    ranked = df.withColumn(position, _row_number(Window.partitionBy(*per).orderBy(*order)))
    top = ranked.filter(F.col(position) <= n)
    return top if rank else top.drop(position)


def _row_number(window) -> Column:
    return F.row_number().over(window)
