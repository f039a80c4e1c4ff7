"""Every registered query beside its SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from checks import registry
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.registry import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    # The leaders of the smallest tables, found with another engine.
    assert {(r.originContinent, r.airlineCode, r.regional_flight_count) for r in rows} == {
        ("africa", "S9", 10),
        ("asia", "S0", 18),
        ("europe", "S5", 1),
        ("northamerica", "S3", 6),
        ("oceania", "S5", 2),
        ("southamerica", "S9", 8),
    }


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark, con, SF_SMALL, name) is None


def test_the_text_queries_may_be_left_out():
    code = (
        "import sys; sys.modules['skymetrics.llm'] = None; import __spark_entry__ as d; "
        "from checks.registry import QUERIES; assert set(d.queries()) == set(QUERIES), 'left over'"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(driver.__file__).parent)


def test_zone_documents_land_as_files_of_one_folder_from_many_tasks(spark, tmp_path):
    documents = spark.range(300).selectExpr("id AS key", "concat('{\"é\":', id, '}') AS value").coalesce(1)
    registry._land_documents(documents, "key", f"file://{tmp_path}/zones")
    # A folder for each file, made by one task, took most of the time at 60,000 files.
    files = {p.name: p.read_text() for p in (tmp_path / "zones").iterdir() if p.suffix == ".json"}
    assert files == {f"{i}.json": f'{{"é":{i}}}\n' for i in range(300)}
    assert spark.read.text(f"{tmp_path}/zones", wholetext=True).count() == 300


def test_ingested_zones_land_in_one_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "scratch_folder", lambda _, name: f"file://{tmp_path}/{name}")
    rejects = driver.queries()["ingest_rejects"](spark, SF_SMALL)
    landed = [p for p in (tmp_path / "landing" / "zones").iterdir() if p.suffix != ".crc"]
    assert all(p.is_file() for p in landed)
    assert len(landed) == spark.read.parquet(f"{SF_SMALL}/supplier.parquet").count()
    assert rejects.where("feed = 'zones'").isEmpty() and not rejects.isEmpty()
