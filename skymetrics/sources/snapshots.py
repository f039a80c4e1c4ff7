"""Hourly snapshots: ``<root>/<table>/tech_year=YYYY/tech_month=MM/tech_day=DD/tech_hour=HH``."""

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from skymetrics.functions import HOUR_KEYS, hour_columns, hour_values
from skymetrics.plans.session import file_system
from skymetrics.sources.manifests import (
    SPARK_MARK,
    Entry,
    Staged,
    data_files,
    move_files,
    publish,
    read_manifest,
    remove_others,
    snapshot_path,
    staging,
)


def stage(df: DataFrame, folder: str, files: int | None = None) -> Staged:
    """Writes a table into a folder of ``staging``.

    Every task writes its own file; ``files`` is for small results, which then shuffle, so that only
    the finished rows and not the work behind them pass through that many tasks.
    """
    (df if files is None else df.repartition(files)).write.parquet(folder)
    return Staged(folder, df.schema)


def write_snapshot(
    df: DataFrame, root: str, table: str, at: datetime, files: int | None = None
) -> str:
    """Replaces one hour of a table and returns its path.

    The new hour is written beside the old one, which stays as it is until the new one is whole. An
    empty result replaces what was there too.
    """
    spark = df.sparkSession
    with staging(spark, root) as folder:
        return publish(spark, root, at, {table: stage(df, f"{folder}/{table}", files)})[table]


def write_snapshots(df: DataFrame, root: str, table: str, ts: Column) -> str:
    """Writes each row to the hour of ``ts``, replacing exactly the hours that occur, each at once.

    Rows without a time are kept too, in the folder Spark gives to null keys.

    Rows are brought together by hour, or each task would write a file per hour. The rebalance
    hint lets adaptive execution split an hour that is too large for one task.
    """
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{table}"
    hours = df.select("*", *hour_columns(ts))
    with staging(spark, root) as folder:
        hours.hint("rebalance", *HOUR_KEYS).write.partitionBy(*HOUR_KEYS).parquet(folder)
        for keys in _hours_of(*file_system(spark, folder)):
            hour = "/".join(keys)
            values = [key.partition("=")[2] for key in keys]
            if all(map(str.isdigit, values)):
                publish(spark, root, datetime(*map(int, values)), {table: Staged(f"{folder}/{hour}", df.schema)})
            else:
                remove_others(spark, f"{path}/{hour}", move_files(spark, f"{folder}/{hour}", f"{path}/{hour}"))
    return path


def _hours_of(fs, folder, keys: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """The partition folders that a write made, as their four keys."""
    if len(keys) == len(HOUR_KEYS):
        yield keys
        return
    for name in data_files(fs, folder):
        yield from _hours_of(fs, folder.suffix(f"/{name}"), (*keys, name))


@dataclass(frozen=True)
class Hour:
    """The tables of one version of an hour, whatever is written after it was opened."""

    spark: SparkSession
    root: str
    at: datetime
    tables: dict[str, Entry]

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """A table; an error if the hour does not have it, or not all of its files.

        An hour that only Spark has written, without a manifest, has to bear Spark's mark. No file is
        opened to plan the read, but for such an hour and without ``schema``.
        """
        path = snapshot_path(self.root, table, self.at)
        fs, folder = file_system(self.spark, path)
        entry = self.tables.get(table)
        if entry is None and not fs.exists(folder.suffix(f"/{SPARK_MARK}")):
            raise FileNotFoundError(f"no finished snapshot of {table} for this hour: {path}")
        if entry is None:
            return (self.spark.read if schema is None else self.spark.read.schema(schema)).parquet(path)
        if not fs.exists(folder):
            raise FileNotFoundError(f"the folder of this hour is gone: {path}")
        reader = self.spark.read.schema(schema or entry.schema)
        whole = reader.parquet(path)
        found = {file.rpartition("/")[2] for file in whole.inputFiles()}
        if missing := set(entry.files) - found:
            raise FileNotFoundError(f"{len(missing)} of {len(entry.files)} files are gone: {path}")
        if len(found) == len(entry.files):
            return whole
        # Another version's files are here too, of a run that is on its way or has died.
        return reader.parquet(*[f"{path}/{file}" for file in entry.files]) if entry.files else whole.limit(0)


def open_hour(spark: SparkSession, root: str, at: datetime) -> Hour:
    """One version of an hour, to read several tables that belong together."""
    return Hour(spark, root, at, read_manifest(spark, root, at).tables)


def read_snapshot(
    spark: SparkSession, root: str, table: str, at: datetime, schema: StructType | None = None
) -> DataFrame:
    """One hour of a table. An hour that was not written is an error, none stands in for it.

    Nor is an hour that a write has not finished. Only the hour's folder is listed, however many
    hours the table has.
    """
    return open_hour(spark, root, at).read(table, schema)


def _finished(spark: SparkSession, root: str, table: str, at: datetime) -> bool:
    if table in read_manifest(spark, root, at).tables:
        return True
    fs, folder = file_system(spark, snapshot_path(root, table, at))
    return fs.exists(folder.suffix(f"/{SPARK_MARK}"))


def latest_hour(
    spark: SparkSession, root: str, table: str, as_of: datetime | None = None
) -> datetime:
    """Newest finished hour of a table, not later than ``as_of``.

    Walks down the newest year, month, day and hour, stepping back where nothing is found, so
    it lists a few folders and opens no data file. A query for the largest key would open them all.
    """
    fs, path = file_system(spark, f"{root.rstrip('/')}/{table}")
    bound = None if as_of is None else tuple(hour_values(as_of).values())

    def newest(folder, found: tuple[str, ...]) -> datetime | None:
        if len(found) == len(HOUR_KEYS):
            at = datetime(*map(int, found))
            return at if _finished(spark, root, table, at) else None
        prefix = HOUR_KEYS[len(found)] + "="
        values = [name.removeprefix(prefix) for name in data_files(fs, folder) if name.startswith(prefix)]
        # Rows without a time have a folder of their own, which is no hour.
        for value in sorted(filter(str.isdigit, values), reverse=True):
            hour = (*found, value)
            if bound is not None and hour > bound[: len(hour)]:
                continue
            hit = newest(folder.suffix(f"/{prefix}{value}"), hour)
            if hit is not None:
                return hit
        return None

    hit = newest(path, ()) if fs.exists(path) else None
    if hit is None:
        raise FileNotFoundError(f"no snapshot of {table} under {root} as of {as_of or 'now'}")
    return hit


def read_latest(
    spark: SparkSession,
    root: str,
    table: str,
    as_of: datetime | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The newest hour of a table, as of a time."""
    return read_snapshot(spark, root, table, latest_hour(spark, root, table, as_of), schema)
