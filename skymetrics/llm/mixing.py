"""Mixing sources to target weights by weighted sampling without replacement.

Each source has a target of words. What a source needs beyond whole passes over itself is filled by
documents in the order of exponential keys: -ln(u) / w, u uniform by hash of the id, w the
document's quality weight, so that a document of twice the weight is twice as likely to be next
(Efraimidis and Spirakis). A running sum in that order is cut at the budget.

Running sums are taken over stretches of keys of about the same number of documents, whatever their
weights: stretches are cut by how many documents of each class of weights are expected up to a key. So
no task holds a source.

Sources rank by code point, null last, and are a source like any other. Null texts have no words. A null
id draws by its text, so rows without ids are spread as well. Very long texts count whole. Repeated
rows have equal keys and are taken one after the other. No rows give no rows. Only ``doc_id``, ``text`` and
``source`` are read, so further columns may have any name.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skymetrics.llm.common import WORD, documents, free_name, stored

# Weights of the sources, repeating in their order, and the share of all words.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2

LETTERS = r"[\p{L}\x09-\x0D\x20]+"

# Documents of one stretch of the running sums.
STRETCH = 5000


def quality_weight(text: Column) -> Column:
    """From 0.1 to 1.1: the share of letters and white space in a text."""
    odd = F.length(F.regexp_replace(text, LETTERS, ""))
    return F.coalesce(1.1 - odd / F.greatest(F.length(text), F.lit(1)), F.lit(0.1))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row each.

    Sources share the budget by weight. In the order of cap to weight, a source is capped if its
    cap is no more than its share of what those before it have left.
    """
    # One row for each source: small, however many documents there are.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = sizes.withColumn("weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS)))
    cap = MOST_PASSES * F.col("source_size")
    by_cap = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    left = F.lit(SHARE) * total - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = left / F.sum("weight").over(after)
    steps = ranked.select(
        "source", "source_size", "weight", cap.alias("cap"), level.alias("level")
    ).withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    # All sources behind the first that isn't capped take their share at its level.
    first = F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.col("cap") / F.col("weight")))
    return steps.withColumn("level", first.over(Window.partitionBy())).select(
        "source",
        "source_size",
        F.least(
            F.col("cap").cast("double"),
            F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")),
        ).alias("target"),
    )


def drawn(seed: Column) -> Column:
    """A number from 0 to 1 by hash of a text."""
    digits = F.substring(F.md5(F.concat(F.lit("mix:"), seed)), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + 1) / F.lit(float(2**52 + 1))


def _expected(keyed: DataFrame) -> DataFrame:
    """(name, classes): how many documents of each class of weights a source has, and their mean weight.

    A class is a quarter of a doubling, so a source has a few dozen.
    """
    counted = keyed.groupBy("source", F.round(4 * F.log2("weight")).alias("class")).agg(
        F.count("*").alias("n"), F.avg("weight").alias("weight")
    )
    classes = F.collect_list(F.struct("n", "weight")).alias("classes")
    return counted.groupBy(F.col("source").alias("name")).agg(classes)


def _stretch(key: Column) -> Column:
    """Number of the stretch of a key: of all documents of its source, how many are expected before it."""
    before = F.aggregate(
        "classes", F.lit(0.0), lambda sum_, c: sum_ + c["n"] * (1 - F.exp(-key * c["weight"]))
    )
    return F.floor(before / STRETCH)


def mix(sized: DataFrame, whole: bool = False) -> DataFrame:
    """(doc_id, mark, size, source_size, target, taken, ...) from (doc_id, mark, source, size, weight,
    draw).

    ``whole`` takes the document at the edge of a budget once more or not at all, whichever is
    nearer to the target; otherwise as many of its words as are missing.
    """
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    plan = sources.select(
        F.col("source").alias("name"),
        "source_size",
        "target",
        F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).alias("passes"),
    ).withColumn("budget", F.round(F.col("target")).cast("long") - F.col("passes") * F.col("source_size"))
    keyed = sized.withColumn("key", -F.ln("draw") / F.col("weight"))
    known = F.col("source").eqNullSafe(F.col("name"))
    keyed = keyed.join(_expected(sized), known).withColumn("stretch", _stretch(F.col("key"))).drop("name", "classes")
    at = [F.col("source"), F.col("stretch")]
    within = Window.partitionBy(*at).orderBy("key", F.col("doc_id").asc_nulls_last(), "size", "mark")
    rows = within.rowsBetween(Window.unboundedPreceding, -1)
    inside = keyed.withColumn("inside", F.coalesce(F.sum("size").over(rows), F.lit(0)))
    order = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("source", "stretch")
        .agg(F.sum("size").alias("held"))
        .withColumn("offset", F.coalesce(F.sum("held").over(order), F.lit(0)))
        .join(plan, F.col("source").eqNullSafe(F.col("name")))
        .select(F.col("source").alias("name"), F.col("stretch").alias("part"), "offset", "source_size", "target", "passes", "budget")
    )
    same = F.col("source").eqNullSafe(F.col("name")) & (F.col("stretch") == F.col("part"))
    room = F.col("budget") - F.col("offset") - F.col("inside")
    if whole:
        extra = F.when(2 * room >= F.col("size"), F.col("size")).otherwise(F.lit(0))
        extra = F.when((room > 0) & (F.col("passes") < MOST_PASSES), extra).otherwise(F.lit(0))
    else:
        extra = F.greatest(F.lit(0), F.least(F.col("size"), room))
    return inside.join(offsets, same).select(
        "doc_id",
        "mark",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + extra).cast("long").alias("taken"),
        "passes",
        F.col("key").alias("sample_key"),
    )


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, source, size, weight, draw) of documents, stored; texts of one id differ in mark."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return stored(
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("mark"),
            "source",
            size.alias("size"),
            quality_weight(F.col("text")).alias("weight"),
            drawn(F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))).alias("draw"),
        ),
        "sized",
    )


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(sized(documents(spark, sf_dir))).drop("mark", "passes", "sample_key")
