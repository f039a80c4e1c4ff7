"""What the text operators share: tables, folds, scratch tables, text buffers."""

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skymetrics.plans.session import scratch_folder

# Fixed value: a word of the contracts, a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS = 1000

# Text handled at once inside a task, in bytes; bounds the memory of the vectorised code.
CHUNK_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lets batches that go to Python hold few rows, as texts are long.

    A batch is in memory several times, in the executor's buffers and in Python. A session that
    has a setting of its own keeps it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, str(BATCH_ROWS))


def fold_is(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """Whether crc32 of the key's text leaves ``remainder``; false for a null key."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends in files."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with numbers ``id`` from 1 without gaps, in no special order, stored."""
    placed = stored(rows.withColumn("row", F.monotonically_increasing_id()), f"{name}-rows")
    part, place = F.shiftrightunsigned("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    # A row for each partition, so the running sum is one of few rows.
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    joined = placed.withColumn("part", part).join(firsts, "part")
    return stored(joined.withColumn("id", F.col("first") + place + 1).drop("part", "first", "row"), name)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def kept(name: str, make: Callable[[], object]):
    """What ``make`` gives, made once in a Python worker and kept while it lives.

    A task unpickles its functions anew, so a cache within them would start empty each time.
    """
    held = sys.modules.setdefault("_skymetrics_kept", ModuleType("_skymetrics_kept"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each text begins and ends (null: empty)."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``limit`` bytes; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(texts.cast(pa.large_binary())), 0).to_numpy()
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > limit:
            yield texts.slice(first, i - first)
            first, held = i, 0
        held += size
    if len(texts) > first:
        yield texts.slice(first)
