"""Connected components of a graph too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymetrics.llm.common import stored


def _largest_first(edges: DataFrame) -> DataFrame:
    """Large star: every neighbour above a node is tied to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _smallest_first(edges: DataFrame) -> DataFrame:
    """Small star: a node and its neighbours below it are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = (
        edges.join(least, "a")
        .where(F.col("b") != F.col("least"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    return moved.union(least).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): the smallest node ``b`` that each node ``a`` reaches, for nodes that aren't it.

    ``edges`` has two columns of one ordered type, ``a`` above ``b``. Rounds of large and small
    star (Kiveris et al., 2014) end when a round changes nothing. Each round is stored, so a lost
    executor costs no earlier round. Minima are taken before the join, so a node with very many
    neighbours is a large join key only, which adaptive execution splits.
    """
    state = stored(edges.where(F.col("a") > F.col("b")).distinct(), "edges")
    mark = _mark(state)
    while mark[0]:
        state = stored(_smallest_first(_largest_first(state)), "edges")
        mark, before = _mark(state), mark
        if mark == before:
            break
    return state


def _mark(edges: DataFrame) -> tuple:
    """Number and digest of the edges, to tell whether a round changed them."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())
