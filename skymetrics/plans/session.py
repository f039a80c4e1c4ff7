"""Session settings the plans count on, and where they may put intermediate tables."""

import atexit
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Adaptive execution picks broadcasts by measured size, merges small shuffle partitions and
# splits the partitions of hot keys. Broadcasting a dimension of 32 MB, as counted in compressed
# files, is far cheaper than shuffling the fact table for it. Large scan splits keep ingested
# files from being small, as a landed text split shrinks several times on its way to Parquet.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    # A task may write to a few folders at once instead of sorting its rows by folder first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def build_session(
    app_name: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with ``SETTINGS``, overridden by ``settings``; no master means spark-submit's."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, in the shared folder the cluster names.

    It is removed when the program ends, if the session still runs then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = f"{base.rstrip('/')}/skymetrics/{name}-{uuid4().hex}"
    atexit.register(_remove_at_exit, spark, folder)
    return folder


def file_system(spark: SparkSession, folder: str):
    """The file system of a folder, and its path there.

    Spark has no call to list, move or remove a folder, so this and the functions below reach into
    the JVM; nothing else does.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def read_text(spark: SparkSession, file: str) -> str | None:
    """A small file's text; None if it is not there."""
    fs, path = file_system(spark, file)
    if not fs.exists(path):
        return None
    try:
        stream = fs.open(path)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return None  # gone in between
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, file: str, text: str) -> bool:
    """Makes a small file at once, by moving it into place; False if there is one already."""
    fs, path = file_system(spark, file)
    passing = path.getParent().suffix(f"/.{uuid4().hex}")
    stream = fs.create(passing, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    if not fs.exists(path) and fs.rename(passing, path):
        return True
    fs.delete(passing, False)
    return False


def remove_folder(spark: SparkSession, folder: str) -> None:
    fs, path = file_system(spark, folder)
    fs.delete(path, True)


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        remove_folder(spark, folder)
