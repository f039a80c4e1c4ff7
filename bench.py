"""Wall time of the six questions, as one JSON line.

``stored_*`` time the real flow: tables and results stored as hourly snapshots, each question
reading its hour; ``value`` sums the ``stored_kpi*`` questions. ``kpi*`` derive the star schema from
the generic tables within the timed query. ``ingest_flights`` types, cleans and stores landed
JSON lines, and stores the rejects. Every figure is the median of three runs after one warm-up.
"""

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from checks import derived
from checks.registry import QUERIES, RUN_HOUR
from skymetrics.operators.enrich import zoned_airports
from skymetrics.plans.jobs import QUESTIONS, answer, ingest, run_kpi
from skymetrics.plans.session import build_session, scratch_folder
from skymetrics.sources.snapshots import write_snapshot

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def drain(df) -> None:
    """Runs the plan to the last row without handing rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def seconds(run: Callable[[], object]) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS if CPUS.isdigit() else "8",
            "spark.sql.session.timeZone": "UTC",
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": f"file://{shared}",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {
        name: seconds(lambda q=q: drain(q(spark, SF_DIR)))
        for name, q in QUERIES.items()
        if name.startswith("kpi")
    }

    store, results = scratch_folder(spark, "store"), scratch_folder(spark, "results")
    tables = {
        "flights": derived.flights(spark, SF_DIR),
        "airports": derived.airports(spark, SF_DIR, country=True),
        "airlines": derived.airlines(spark, SF_DIR, country=True),
        "zones": derived.zones(spark),
        "zoned_airports": zoned_airports(
            derived.airports(spark, SF_DIR, country=True), derived.zones(spark)
        ),
    }
    for name, table in tables.items():
        timed[f"store_{name}"] = seconds(
            lambda n=name, t=table: write_snapshot(t, store, n, RUN_HOUR)
        )
    landing = scratch_folder(spark, "landing")
    derived.flight_lines(spark, SF_DIR).write.text(f"{landing}/flights")
    landed = scratch_folder(spark, "landed")
    timed["ingest_flights"] = seconds(lambda: ingest(spark, landing, landed, "flights", RUN_HOUR))
    for name in QUESTIONS:
        timed[f"stored_{name}"] = seconds(
            lambda n=name: drain(answer(spark, n, store, RUN_HOUR))
        )
    timed["stored_kpi2_and_save"] = seconds(
        lambda: run_kpi(spark, "kpi2", store, results, RUN_HOUR)
    )
    value = round(sum(timed[f"stored_{name}"] for name in QUESTIONS), 3)
    sf = os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "six flight questions over stored hours, total wall time",
                "value": value,
                "unit": "sec",
                "queries": timed,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
