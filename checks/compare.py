"""Runs registered queries beside their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.registry import QUERIES


def connect(sf_dir: str):
    """DuckDB with each Parquet file of the folder as a view."""
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows in one order, columns by name, nulls alike."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(frame.itertuples(index=False, name=None), key=repr)


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL, None if nothing does."""
    got, want = QUERIES[name](spark, sf_dir).toPandas(), con.execute(ORACLE[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"{len(a)} rows and {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows, such as {wrong[0]}" if wrong else None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from skymetrics.plans.session import build_session

    spark = build_session(
        "compare",
        "local[8]",
        {
            "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='compare-')}",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.session.timeZone": "UTC",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in names or QUERIES:
        start = time.time()
        found = difference(spark, con, sf_dir, name) if name in ORACLE else "no SQL"
        failures += found is not None
        took = time.time() - start
        print("ok  " if found is None else "FAIL", f"{took:6.2f}s", name, found or "", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
