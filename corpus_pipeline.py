"""The corpus pipeline: five stages, each over all that the one before it kept.

``run`` writes what a stage returns as Parquet in the shared folder and gives it to the next.

All stages take null and empty texts, null ids, sources and languages, very long texts, repeated rows and
columns beyond those of documents, whatever their names, and return all columns, but for the last. An empty
table gives an empty one of the same columns.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.llm import language_id, mixing, packing, quality_classifier, simhash_dedup
from skymetrics.llm.common import documents, free_name, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier takes for good; null and empty texts by the score of an empty line.

    Repeated rows share a score. Without labels of both kinds all stay.
    """
    return quality_classifier.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: not null or empty texts, nor any without a letter.

    Of languages that tie, the one with more labelled documents counts.
    """
    return language_id.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of fingerprints that hang together.

    Null and empty texts are one group. Of rows that repeat the id, the one with the smallest fingerprint stays.
    A null id stays only if its group has no other.
    """
    return simhash_dedup.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of a document for each time the mix takes it: none, one or two.

    Documents are taken whole, so texts stay as they are. Rows that repeat an id and a text are each
    taken as often as the one of them that is taken most.
    """
    times = free_name(docs, "times")
    key, mark = free_name(docs, f"{times}_id"), free_name(docs, f"{times}_mark")
    often = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1).cast("int")
    taken = (
        mixing.mix(mixing.sized(docs), whole=True)
        .groupBy(F.col("doc_id").alias(key), F.col("mark").alias(mark))
        .agg(F.max(often).alias(times))
    )
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(mark))
    copies = docs.join(taken.where(F.col(times) > 0), same)
    return copies.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies: windows that hold no text twice.

    Null and empty texts have one piece without words, very long ones several.
    """
    return packing.pack(packing.sized(docs))


STAGES = [
    ("quality_classifier", quality),
    ("language_id", language),
    ("simhash_dedup", near_duplicates),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

# The stages' models and fingerprints are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
