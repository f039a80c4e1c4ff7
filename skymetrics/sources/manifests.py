"""Which files make up an hour: one manifest for all tables of a store.

``<root>/_hours/tech_year=.../tech_hour=HH/<number>.json`` names the schema and the data files of each table
of that hour; the highest number counts. Files are written beside the hour, moved into it under names
that no other write uses, and only then named by a new manifest. So an hour goes from one version of all
tables of a run to the next at once, and what a run has not finished is in no manifest. Files that the new
manifest does not name are removed last. Wherever a run dies, readers have the old version whole or
the new one.
"""

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from skymetrics.functions import hour_values
from skymetrics.plans.session import file_system, read_text, remove_folder, write_text

# The mark that Spark itself leaves in a folder when a write is done.
SPARK_MARK = "_SUCCESS"


@dataclass(frozen=True)
class Entry:
    """A table of an hour: how its rows look, and which files of its folder hold them."""

    schema: StructType
    files: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    number: int
    tables: dict[str, Entry]


@dataclass(frozen=True)
class Staged:
    """A table written beside its hour. A folder that isn't there holds no rows."""

    folder: str
    schema: StructType


def hour_folder(at: datetime) -> str:
    return "/".join(f"{key}={value}" for key, value in hour_values(at).items())


def snapshot_path(root: str, table: str, at: datetime) -> str:
    return f"{root.rstrip('/')}/{table}/{hour_folder(at)}"


def data_files(fs, folder) -> list[str]:
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(name for name in names if name[0] not in "_.")


def _manifests(root: str, at: datetime) -> str:
    return f"{root.rstrip('/')}/_hours/{hour_folder(at)}"


def _numbers(fs, folder) -> list[int]:
    if not fs.exists(folder):
        return []
    return sorted(int(n.removesuffix(".json")) for n in data_files(fs, folder) if n.endswith(".json"))


def read_manifest(spark: SparkSession, root: str, at: datetime) -> Manifest:
    """The newest manifest of an hour; number 0, without tables, if there is none."""
    fs, folder = file_system(spark, _manifests(root, at))
    while numbers := _numbers(fs, folder):
        text = read_text(spark, f"{_manifests(root, at)}/{numbers[-1]:010d}.json")
        if text is None:  # replaced since it was listed
            continue
        tables = {
            name: Entry(StructType.fromJson(table["schema"]), tuple(table["files"]))
            for name, table in json.loads(text).items()
        }
        return Manifest(numbers[-1], tables)
    return Manifest(0, {})


def _write_manifest(spark: SparkSession, root: str, at: datetime, manifest: Manifest) -> None:
    tables = {
        name: {"schema": entry.schema.jsonValue(), "files": list(entry.files)}
        for name, entry in manifest.tables.items()
    }
    path = f"{_manifests(root, at)}/{manifest.number:010d}.json"
    if not write_text(spark, path, json.dumps(tables)):
        raise FileExistsError(f"another run has stored this hour meanwhile: {path}")


@contextmanager
def staging(spark: SparkSession, root: str) -> Iterator[str]:
    """A folder of the store itself for tables in the making, so that they need only be moved."""
    folder = f"{root.rstrip('/')}/_staged/{uuid4().hex}"
    try:
        yield folder
    finally:
        remove_folder(spark, folder)


def move_files(spark: SparkSession, staged: str, hour: str) -> tuple[str, ...]:
    """Moves the data files of one folder into another; returns their names."""
    fs, source = file_system(spark, staged)
    _, target = file_system(spark, hour)
    if not fs.exists(source):
        fs.mkdirs(target)
        return ()
    names = data_files(fs, source)
    if not fs.exists(target):
        # One move for all files. Spark's mark must not come along, as the hour is not finished yet.
        fs.delete(source.suffix(f"/{SPARK_MARK}"), False)
        fs.mkdirs(target.getParent())
        moved = fs.rename(source, target)
    else:
        moved = all([fs.rename(source.suffix(f"/{name}"), target.suffix(f"/{name}")) for name in names])
    if not moved:
        raise OSError(f"could not move {staged} to {hour}")
    return tuple(names)


def remove_others(spark: SparkSession, hour: str, files: tuple[str, ...]) -> None:
    """Removes data files of a folder that are not among ``files``, and Spark's mark."""
    fs, folder = file_system(spark, hour)
    for name in {*data_files(fs, folder), SPARK_MARK}.difference(files):
        fs.delete(folder.suffix(f"/{name}"), False)


def publish(spark: SparkSession, root: str, at: datetime, staged: dict[str, Staged]) -> dict[str, str]:
    """Makes staged tables those of an hour, all at once; returns their paths."""
    paths = {table: snapshot_path(root, table, at) for table in staged}
    entries = {
        table: Entry(new.schema, move_files(spark, new.folder, paths[table])) for table, new in staged.items()
    }
    before = read_manifest(spark, root, at)
    _write_manifest(spark, root, at, Manifest(before.number + 1, {**before.tables, **entries}))
    for table, entry in entries.items():
        remove_others(spark, paths[table], entry.files)
    fs, folder = file_system(spark, _manifests(root, at))
    for number in _numbers(fs, folder):
        if number <= before.number:
            fs.delete(folder.suffix(f"/{number:010d}.json"), False)
    return paths
