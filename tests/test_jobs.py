import json
from datetime import datetime

import pytest

from skymetrics.__main__ import main
from skymetrics.operators import zones as zones_module
from skymetrics.plans import jobs
from skymetrics.plans.session import scratch_folder
from skymetrics.schemas import RESULT_NAMES, STORED, TABLES
from skymetrics.sources import manifests
from skymetrics.sources.snapshots import open_hour, read_snapshot, snapshot_path
from tests.helpers import first_zone, tuples

AT = datetime(2024, 3, 5, 7)


def flight(i, airline, origin, destination, on_ground):
    return json.dumps(
        {"id": f"F{i}", "aircraft_code": f"B{i % 2}", "airline_icao": airline,
         "origin_airport_iata": origin, "destination_airport_iata": destination,
         "on_ground": on_ground}
    )


@pytest.fixture
def landing(tmp_path):
    """The four feeds, each with something wrong in it."""
    feeds = {
        "flights": [
            flight(1, "AFR", "CDG", "ORY", 0),
            flight(2, "AFR", "CDG", "JFK", 0),
            flight(3, "DLH", "ORY", "CDG", 1),
            flight(4, "DLH", "JFK", "XXX", 0),
            flight(5, "", "CDG", "ORY", 0),
            flight(6, "AFR", "CDG", "", 0),
            '{"id": "F7"',
            flight(8, "AFR", "CDG", "ORY", "down"),
        ],
        "airports": [
            '{"iata":"CDG","name":"c","latitude":"49.0","longitude":"2.5","country":"France"}',
            '{"iata":"ORY","name":"o","latitude":"48.7","longitude":"2.4","country":"France"}',
            '{"iata":"JFK","name":"j","latitude":"40.6","longitude":"-73.8","country":"USA"}',
            '{"iata":"BAD","name":"b","latitude":"north","longitude":"1","country":"?"}',
        ],
        "airlines": [
            '{"Code":"AF","ICAO":"AFR","Name":"Air France","Country":"France"}',
            '{"Code":"LH","ICAO":"DLH","Name":"Lufthansa"}',
        ],
        "zones": [
            '{"europe":{"tl_y":72,"tl_x":-16,"br_y":34,"br_x":40,"subzones":',
            '{"north":{"tl_y":72,"tl_x":-16,"br_y":48.8,"br_x":40},',
            '"south":{"tl_y":48.8,"tl_x":-16,"br_y":34,"br_x":40}}},',
            '"america":{"tl_y":72,"tl_x":-170,"br_y":12,"br_x":-50}}',
        ],
    }
    for feed, lines in feeds.items():
        (tmp_path / "landing" / feed).mkdir(parents=True)
        (tmp_path / "landing" / feed / "part.json").write_text("\n".join(lines))
    return tmp_path


def test_extract_then_answer(spark, landing):
    root, store, results = (str(landing / d) for d in ("landing", "store", "results"))
    rejects = jobs.extract(spark, root, store, AT)
    assert rejects == {"flights": 2, "airports": 1, "airlines": 0, "zones": 0}
    sizes = {t: read_snapshot(spark, store, t, AT, STORED[t]).count() for t in STORED}
    assert sizes == {"flights": 4, "airports": 3, "airlines": 2, "zones": 3, "zone_tiles": 31, "zoned_airports": 3}
    bad = read_snapshot(spark, store, "rejected_flights", AT)
    assert [r[:2] for r in tuples(bad)] == [("flights", "malformed")] * 2
    assert read_snapshot(spark, store, "rejected_airlines", AT).isEmpty()

    paths = jobs.run_kpis(spark, store, results, AT)
    assert set(paths) == set(RESULT_NAMES)
    got = {q: jobs.read_result(spark, q, results, AT) for q in paths}
    assert all(len(df.inputFiles()) == 1 for df in got.values())
    assert tuples(got["kpi1"]) == [("AFR", "Air France", 2)]
    assert tuples(got["kpi2"]) == [("europe", "AFR", "Air France", 1)]
    assert got["kpi3"].first().flightID == "F2"
    means = {row[0]: row[1] for row in got["kpi4"].collect()}
    assert set(means) == {"europe"} and 1900 < means["europe"] < 2000
    assert tuples(got["kpi5"]) == [("B0", 2)]
    assert tuples(got["kpi6"]) == [
        ("France", "B0", 1, 1),
        ("France", "B1", 1, 2),
        (None, "B0", 1, 1),
        (None, "B1", 1, 2),
    ]

    # The same hour again gives the same store.
    assert jobs.extract(spark, root, store, AT) == rejects
    assert read_snapshot(spark, store, "flights", AT).count() == 4


def test_an_hour_that_was_not_extracted_is_an_error(spark, landing):
    with pytest.raises(FileNotFoundError):
        jobs.run_kpi(spark, "kpi1", str(landing / "store"), str(landing / "results"), AT)


def test_command_line(spark, landing):
    store, results = str(landing / "store"), str(landing / "results")
    when = ["--store", store, "--at", AT.isoformat(), "--master", "local[8]"]
    main(["extract", "--landing", str(landing / "landing"), *when])
    main(["kpi", "--results", results, "--question", "kpi1", "--question", "kpi5", *when])
    assert tuples(jobs.read_result(spark, "kpi1", results, AT)) == [("AFR", "Air France", 2)]
    with pytest.raises(FileNotFoundError):
        jobs.read_result(spark, "kpi2", results, AT)
    main(["kpi", "--results", results, *when])
    assert jobs.read_result(spark, "kpi2", results, AT).count() == 1


def test_scratch_folders_are_new_and_shared(spark):
    a, b = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert a != b
    assert a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_scratch_folder_needs_a_shared_one():
    class Bare:
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Bare, "x")


def test_a_repaired_feed_leaves_no_rejects(spark, landing):
    root, store = str(landing / "landing"), str(landing / "store")
    feed = landing / "landing" / "flights" / "part.json"
    assert jobs.ingest(spark, root, store, "flights", AT) == 2
    assert read_snapshot(spark, store, "rejected_flights", AT).count() == 2
    feed.write_text(flight(1, "AFR", "CDG", "ORY", 0))
    assert jobs.ingest(spark, root, store, "flights", AT) == 0
    assert read_snapshot(spark, store, "rejected_flights", AT).isEmpty()
    assert read_snapshot(spark, store, "flights", AT).count() == 1


@pytest.mark.parametrize(
    "text",
    ['{"version": 4}', "{}", "", " \n", '{"europe":{"tl_y":1,"tl_x":0,"br_y":0,"br_x":1,"subzones":{}}}'],
    ids=["unreadable", "empty object", "empty file", "blank file", "empty subzones"],
)
def test_a_zone_feed_without_a_zone_fails_the_extract(spark, landing, text):
    """And leaves the hour as it was, with all its tables."""
    root, store = str(landing / "landing"), str(landing / "store")
    jobs.extract(spark, root, store, AT)
    (landing / "landing" / "zones" / "part.json").write_text(text)
    (landing / "landing" / "flights" / "part.json").write_text(flight(1, "AFR", "CDG", "ORY", 0))
    with pytest.raises(ValueError, match="no zone in 1 files"):
        jobs.extract(spark, root, store, AT)
    assert tuples(jobs.answer(spark, "kpi2", store, AT)) == [("europe", "AFR", "Air France", 1)]
    assert read_snapshot(spark, store, "flights", AT).count() == 4
    assert not list((landing / "store" / "_staged").iterdir())


def test_a_rerun_changes_all_tables_of_an_hour_at_once(spark, landing, monkeypatch):
    """A reader between any two steps of a rerun sees the old tables, all of them or none of the new."""
    root, store = str(landing / "landing"), str(landing / "store")
    jobs.extract(spark, root, store, AT)
    opened = open_hour(spark, store, AT)
    (landing / "landing" / "flights" / "part.json").write_text(flight(1, "AFR", "CDG", "JFK", 0))
    airport = '{"iata":"CDG","name":"moved","latitude":"40.0","longitude":"-73.0","country":"USA"}'
    (landing / "landing" / "airports" / "part.json").write_text(airport)

    def seen():
        hour = open_hour(spark, store, AT)
        return [hour.read(t, STORED[t]).count() for t in ("flights", "airports", "zoned_airports")]

    between = []
    for step in ("move_files", "_write_manifest"):
        whole = getattr(manifests, step)

        def watched(*args, whole=whole):
            between.append(seen())
            return whole(*args)

        monkeypatch.setattr(manifests, step, watched)
    jobs.extract(spark, root, store, AT)
    assert len(between) == len(TABLES) * 2 + 3 and set(map(tuple, between)) == {(4, 3, 3)}
    assert seen() == [1, 1, 1]
    assert jobs.answer(spark, "kpi2", store, AT).isEmpty()
    # An hour that was opened before is gone, which is an error and no mixture.
    with pytest.raises(FileNotFoundError):
        opened.read("flights")


def test_a_run_that_dies_leaves_the_old_hour(spark, landing, monkeypatch):
    root, store = str(landing / "landing"), str(landing / "store")
    jobs.extract(spark, root, store, AT)
    before = {t: tuples(read_snapshot(spark, store, t, AT)) for t in STORED}
    (landing / "landing" / "flights" / "part.json").write_text(flight(9, "DLH", "CDG", "ORY", 0))

    def dies(*_):
        raise RuntimeError("lost")

    for step in ("move_files", "_write_manifest"):
        with monkeypatch.context() as patch:
            patch.setattr(manifests, step, dies)
            with pytest.raises(RuntimeError, match="lost"):
                jobs.extract(spark, root, store, AT)
        assert {t: tuples(read_snapshot(spark, store, t, AT)) for t in STORED} == before
    # What the dead run left behind goes with the next one.
    jobs.extract(spark, root, store, AT)
    path = snapshot_path(store, "flights", AT)
    assert tuples(read_snapshot(spark, store, "flights", AT)) == [("F9", "B1", "DLH", "CDG", "ORY", "0")]
    assert spark.read.parquet(path).count() == 1


def test_the_newest_result(spark, landing):
    root, store, results = (str(landing / d) for d in ("landing", "store", "results"))
    early = AT.replace(hour=5)
    jobs.extract(spark, root, store, early)
    jobs.run_kpis(spark, store, results, early)
    (landing / "landing" / "flights" / "part.json").write_text(flight(1, "DLH", "CDG", "ORY", 0))
    jobs.extract(spark, root, store, AT)
    jobs.run_kpis(spark, store, results, AT)
    assert tuples(jobs.read_result(spark, "kpi1", results)) == [("DLH", "Lufthansa", 1)]
    for moment in ({"at": early}, {"as_of": AT.replace(hour=6)}):
        assert tuples(jobs.read_result(spark, "kpi1", results, **moment)) == [("AFR", "Air France", 2)]
    with pytest.raises(FileNotFoundError):
        jobs.read_result(spark, "kpi1", results, as_of=AT.replace(hour=4))


def test_the_command_line_shows_the_newest_results(spark, landing, capsys):
    root, store, results = (str(landing / d) for d in ("landing", "store", "results"))
    jobs.extract(spark, root, store, AT)
    jobs.run_kpis(spark, store, results, AT)
    main(["result", "--results", results, "--question", "kpi1", "--master", "local[8]"])
    assert "Air France" in capsys.readouterr().out


def test_good_records_are_written_once(spark, landing):
    """What a feed's ingest writes is what the store holds of it."""
    root, store = str(landing / "landing"), str(landing / "store")
    lines = [flight(i, "AFR", "CDG", "ORY", i % 2) for i in range(20_000)] + ["{"]
    (landing / "landing" / "flights" / "part.json").write_text("\n".join(lines))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("once", "once")
    jobs.ingest(spark, root, store, "flights", AT)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One job writes, one counts the rejects from what it wrote.
    assert len(tracker.getJobIdsForGroup("once")) <= 3
    assert read_snapshot(spark, store, "flights", AT).count() == 20_000
    assert read_snapshot(spark, store, "rejected_flights", AT).collect() == [("flights", "malformed", "{")]


def test_the_newest_hour_that_has_all_tables(spark, landing):
    root, store, results = (str(landing / d) for d in ("landing", "store", "results"))
    early = AT.replace(hour=5)
    jobs.extract(spark, root, store, early)
    jobs.extract(spark, root, store, AT)
    later = AT.replace(hour=9)
    jobs.ingest(spark, root, store, "flights", later)
    assert jobs.newest_hour(spark, store, ["kpi5"]) == later
    assert jobs.newest_hour(spark, store, jobs.QUESTIONS) == AT
    assert jobs.newest_hour(spark, store, jobs.QUESTIONS, AT.replace(hour=6)) == early
    assert tuples(jobs.answer(spark, "kpi1", store)) == [("AFR", "Air France", 2)]
    with pytest.raises(FileNotFoundError):
        jobs.answer(spark, "kpi1", store, as_of=AT.replace(hour=4))
    argv = ["kpi", "--store", store, "--results", results, "--question", "kpi1", "--latest"]
    main([*argv, "--as-of", AT.isoformat(), "--master", "local[8]"])
    assert jobs.read_result(spark, "kpi1", results, AT).count() == 1


@pytest.mark.parametrize("text", [None, "", "\n \n"], ids=["no file", "empty file", "blank lines"])
def test_an_empty_feed_gives_an_empty_table(spark, tmp_path, text):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    for feed in TABLES:
        (landing / feed).mkdir(parents=True)
        if text is not None and feed != "zones":  # which must not be blank
            (landing / feed / "part.json").write_text(text)
    rejects = jobs.extract(spark, str(landing), store, AT)
    assert rejects == dict.fromkeys(TABLES, 0)
    for table, schema in TABLES.items():
        back = read_snapshot(spark, store, table, AT)
        assert back.columns == schema.names and back.count() == 0


def test_extract_settles_crowded_tiles_and_keeps_every_answer(spark, landing, monkeypatch):
    monkeypatch.setattr(zones_module, "_CROWD", 3)
    boxes = [(i, f"z{i}", None, 50.0 - i, -60.0 + i, 20.0 + i % 7, 30.0 - i % 11) for i in range(15)]
    for i, name, _, top, left, bottom, right in boxes:
        text = f'{{"{name}":{{"tl_y":{top},"tl_x":{left},"br_y":{bottom},"br_x":{right}}}}}'
        (landing / "landing" / "zones" / f"a{i:02d}.json").write_text(text)
    (landing / "landing" / "zones" / "part.json").unlink()
    spots = [(15.0 + 0.7 * y, -65.0 + 1.9 * x) for y in range(55) for x in range(52)]
    lines = [f'{{"iata":"P{i}","latitude":"{y}","longitude":"{x}"}}' for i, (y, x) in enumerate(spots)]
    (landing / "landing" / "airports" / "part.json").write_text("\n".join(lines))
    rounds, settle = [], jobs.settle_tiles
    monkeypatch.setattr(jobs, "settle_tiles", lambda tiles: rounds.append(tiles) or settle(tiles))
    jobs.extract(spark, str(landing / "landing"), str(landing / "store"), AT)
    assert 1 < len(rounds) <= 17  # the levels from 9 to -6, and one
    zoned = read_snapshot(spark, str(landing / "store"), "zoned_airports", AT)
    got = {r.airportID: r.continent for r in zoned.collect()}
    assert got == {f"P{i}": first_zone(*p, boxes) for i, p in enumerate(spots)}


def test_extract_opens_the_zone_files_once(spark, landing, monkeypatch):
    folder, store, stage = landing / "landing" / "zones", str(landing / "store"), jobs.stage
    (folder / "a.json").write_text('{"first":{"tl_y":1,"tl_x":0,"br_y":0,"br_x":1}}')

    def once(df, target, *more):
        staged = stage(df, target, *more)
        if target.endswith("/zones_by_file"):
            for file in folder.iterdir():
                file.unlink()
        return staged

    monkeypatch.setattr(jobs, "stage", once)
    monkeypatch.setattr(jobs, "landed_files", lambda *_: pytest.fail("lists the files of a feed with zones"))
    jobs.extract(spark, str(landing / "landing"), store, AT)
    assert not list(folder.iterdir())
    zones = read_snapshot(spark, store, "zones", AT).orderBy("zone_seq").collect()
    assert zones[0].continent == "first" and [z.zone_seq for z in zones] == list(range(len(zones))) and len(zones) > 1
