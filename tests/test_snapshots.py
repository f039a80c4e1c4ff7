import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skymetrics.schemas import FLIGHTS
from skymetrics.sources import manifests
from skymetrics.sources.snapshots import (
    latest_hour,
    open_hour,
    read_latest,
    read_snapshot,
    snapshot_path,
    write_snapshot,
    write_snapshots,
)
from tests.helpers import flights, tuples

AT = datetime(2024, 3, 5, 7, 42)
ROW = ("1", "a", "AFR", "A", "B", "0")


def test_path_layout():
    assert snapshot_path("/data/", "flights", AT) == (
        "/data/flights/tech_year=2024/tech_month=03/tech_day=05/tech_hour=07"
    )


def test_write_and_read_back(spark, tmp_path):
    df = flights(spark, ROW, ("2", None, "", None, "B", None))
    path = write_snapshot(df, str(tmp_path), "flights", AT)
    assert path == snapshot_path(str(tmp_path), "flights", AT)
    for schema in (None, FLIGHTS):
        back = read_snapshot(spark, str(tmp_path), "flights", AT, schema)
        assert back.columns == df.columns and tuples(back) == tuples(df)


def test_a_rerun_replaces_its_hour_only(spark, tmp_path):
    root, next_hour = str(tmp_path), AT + timedelta(hours=1)
    write_snapshot(flights(spark, ROW), root, "flights", AT)
    write_snapshot(flights(spark, ROW, ROW), root, "flights", next_hour)
    write_snapshot(flights(spark, ROW, ROW, ROW), root, "flights", AT)
    write_snapshot(flights(spark, ROW, ROW, ROW), root, "flights", AT)
    assert read_snapshot(spark, root, "flights", AT).count() == 3
    assert read_snapshot(spark, root, "flights", next_hour).count() == 2


def test_an_empty_result_replaces_what_was_there(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(flights(spark, ROW), root, "flights", AT)
    write_snapshot(flights(spark, ROW).filter("false"), root, "flights", AT, files=1)
    back = read_snapshot(spark, root, "flights", AT)
    assert back.columns == FLIGHTS.names and back.count() == 0
    assert latest_hour(spark, root, "flights") == AT.replace(minute=0)


def test_one_file_for_a_small_result(spark, tmp_path):
    many = flights(spark, *[ROW] * 50).repartition(6)
    path = write_snapshot(many, str(tmp_path), "r", AT, files=1)
    assert len(read_snapshot(spark, str(tmp_path), "r", AT).inputFiles()) == 1
    path = write_snapshot(many, str(tmp_path), "t", AT)
    assert len(spark.read.parquet(path).inputFiles()) == 6


def test_a_missing_hour_is_an_error(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError, match="flights"):
        read_latest(spark, root, "flights")
    write_snapshot(flights(spark, ROW), root, "flights", AT)
    for schema in (None, FLIGHTS):
        with pytest.raises(FileNotFoundError, match="tech_hour=08"):
            read_snapshot(spark, root, "flights", AT + timedelta(hours=1), schema)


def test_latest_hour_as_of(spark, tmp_path):
    root = str(tmp_path)
    hours = [datetime(2023, 12, 31, 23), datetime(2024, 1, 1, 0), datetime(2024, 3, 5, 9),
             datetime(2024, 3, 5, 10)]
    for i, hour in enumerate(hours):
        write_snapshot(flights(spark, *[ROW] * (i + 1)), root, "flights", hour)
    # A newer hour in the making, and things that are no hour.
    (tmp_path / "flights/tech_year=2024/tech_month=04/tech_day=01/tech_hour=00/_temporary").mkdir(
        parents=True
    )
    (tmp_path / "flights/_SUCCESS").touch()
    as_of = {
        None: hours[3],
        datetime(2030, 1, 1): hours[3],
        datetime(2024, 4, 1, 5): hours[3],
        datetime(2024, 3, 5, 10, 59): hours[3],
        datetime(2024, 3, 5, 9, 59): hours[2],
        datetime(2024, 3, 5, 8): hours[1],
        datetime(2024, 1, 1, 0): hours[1],
        datetime(2023, 12, 31, 23): hours[0],
    }
    for moment, hour in as_of.items():
        assert latest_hour(spark, root, "flights", moment) == hour
    assert read_latest(spark, root, "flights", datetime(2024, 3, 5, 8)).count() == 2
    with pytest.raises(FileNotFoundError):
        latest_hour(spark, root, "flights", datetime(2023, 12, 31, 22))


def events(spark, rows):
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz")


def test_rows_go_to_the_hour_of_their_time(spark, tmp_path):
    root, start = str(tmp_path), datetime(2024, 1, 31, 22, 30)
    rows = [(i, start + timedelta(minutes=20 * i)) for i in range(12)]
    write_snapshots(events(spark, rows), root, "events", F.col("ts"))
    for hour in sorted({t.replace(minute=0) for _, t in rows}):
        got = read_snapshot(spark, root, "events", hour)
        assert got.columns == ["id", "ts"]
        mine = [r for r in rows if r[1].replace(minute=0) == hour]
        assert tuples(got) == sorted(mine, key=repr)


def test_hourly_write_replaces_only_the_hours_it_has(spark, tmp_path):
    root, one, two = str(tmp_path), datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2)
    write_snapshots(events(spark, [(1, one), (2, two)]), root, "events", F.col("ts"))
    write_snapshots(events(spark, [(3, two)]), root, "events", F.col("ts"))
    assert tuples(read_snapshot(spark, root, "events", one)) == [(1, one)]
    assert tuples(read_snapshot(spark, root, "events", two)) == [(3, two)]


def test_rows_without_a_time_are_kept_and_are_no_hour(spark, tmp_path):
    root, hour = str(tmp_path), datetime(2024, 1, 1, 1)
    write_snapshots(events(spark, [(1, hour), (2, None)]), root, "events", F.col("ts"))
    assert latest_hour(spark, root, "events") == hour
    assert tuples(read_latest(spark, root, "events")) == [(1, hour)]
    assert spark.read.parquet(f"{root}/events").count() == 2


def test_a_hot_hour_is_written_by_several_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    start = datetime(2024, 1, 1)
    rows = spark.range(0, 200_000, numPartitions=8).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(start + timedelta(hours=1)))
        .otherwise(F.lit(start))
        .cast("timestamp_ntz")
        .alias("ts"),
    )
    write_snapshots(rows, str(tmp_path), "events", F.col("ts"))
    back = read_snapshot(spark, str(tmp_path), "events", start)
    assert back.count() == 133_333 and len(back.inputFiles()) > 1


@pytest.mark.parametrize("schema", [None, FLIGHTS], ids=["inferred", "given"])
def test_a_half_written_hour_is_an_error(spark, tmp_path, schema):
    root = str(tmp_path)
    hour = tmp_path / "flights" / "tech_year=2024" / "tech_month=03" / "tech_day=05" / "tech_hour=07"
    (hour / "_temporary" / "0").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root, "flights", datetime(2024, 3, 5, 7), schema)
    write_snapshot(spark.createDataFrame([], FLIGHTS), root, "flights", datetime(2024, 3, 5, 8))
    assert read_snapshot(spark, root, "flights", datetime(2024, 3, 5, 8), schema).isEmpty()


@pytest.mark.parametrize("schema", [None, FLIGHTS], ids=["inferred", "given"])
def test_an_hour_with_some_of_its_files_is_an_error(spark, tmp_path, schema):
    root, many = str(tmp_path), flights(spark, *[ROW] * 40).repartition(4)
    path = write_snapshot(many, root, "flights", AT)
    assert read_snapshot(spark, root, "flights", AT, schema).count() == 40
    lost = sorted(Path(path).glob("part-*"))[1]
    lost.unlink()
    with pytest.raises(FileNotFoundError, match="1 of 4 files"):
        read_snapshot(spark, root, "flights", AT, schema)
    shutil.rmtree(path)
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root, "flights", AT, schema)


@pytest.mark.parametrize("schema", [None, FLIGHTS], ids=["inferred", "given"])
def test_an_hour_that_only_spark_wrote_needs_its_mark(spark, tmp_path, schema):
    root, path = str(tmp_path), snapshot_path(str(tmp_path), "flights", AT)
    flights(spark, *[ROW] * 40).repartition(4).write.parquet(path)
    assert read_snapshot(spark, root, "flights", AT, schema).count() == 40
    assert latest_hour(spark, root, "flights") == AT.replace(minute=0)
    (Path(path) / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError, match="finished"):
        read_snapshot(spark, root, "flights", AT, schema)
    with pytest.raises(FileNotFoundError):
        latest_hour(spark, root, "flights")
    # A write makes it an hour again.
    write_snapshot(flights(spark, ROW), root, "flights", AT)
    assert read_snapshot(spark, root, "flights", AT, schema).count() == spark.read.parquet(path).count() == 1


def test_hours_of_a_dynamic_write_need_their_files_too(spark, tmp_path):
    root, hour = str(tmp_path), datetime(2024, 1, 1, 1)
    write_snapshots(events(spark, [(1, hour), (2, hour.replace(hour=2))]), root, "events", F.col("ts"))
    for file in Path(snapshot_path(root, "events", hour)).glob("part-*"):
        file.unlink()
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root, "events", hour)
    assert read_snapshot(spark, root, "events", hour.replace(hour=2)).count() == 1


def test_a_write_that_fails_leaves_the_old_hour(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(flights(spark, ROW, ROW), root, "flights", AT)
    fails = flights(spark, *[ROW] * 8).repartition(4).withColumn(
        "flightStatus", F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("lost"))).otherwise("0")
    )
    with pytest.raises(Exception, match="lost"):
        write_snapshot(fails, root, "flights", AT)
    assert read_snapshot(spark, root, "flights", AT).count() == 2
    assert not list((tmp_path / "_staged").iterdir())


def test_files_of_a_dead_run_are_not_read_and_go_with_the_next(spark, tmp_path):
    root = str(tmp_path)
    path = write_snapshot(flights(spark, ROW, ROW), root, "flights", AT)
    flights(spark, *[ROW] * 5).write.mode("append").parquet(path)
    assert read_snapshot(spark, root, "flights", AT).count() == 2
    assert read_snapshot(spark, root, "flights", AT, FLIGHTS).count() == 2
    write_snapshot(flights(spark, ROW), root, "flights", AT)
    assert spark.read.parquet(path).count() == read_snapshot(spark, root, "flights", AT).count() == 1


def test_of_two_runs_one_says_that_the_other_was_first(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    whole = manifests._write_manifest

    def overtaken(*args):
        monkeypatch.setattr(manifests, "_write_manifest", whole)
        write_snapshot(flights(spark, ROW, ROW), root, "flights", AT)
        return whole(*args)

    monkeypatch.setattr(manifests, "_write_manifest", overtaken)
    with pytest.raises(FileExistsError, match="another run"):
        write_snapshot(flights(spark, ROW), root, "flights", AT)


def test_an_hour_keeps_its_other_tables(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(flights(spark, ROW), root, "flights", AT)
    write_snapshot(flights(spark, ROW, ROW), root, "other", AT)
    hour = open_hour(spark, root, AT)
    assert [hour.read(t).count() for t in ("flights", "other")] == [1, 2]
    assert len(list((tmp_path / "_hours").rglob("*.json"))) == 1
