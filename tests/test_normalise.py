"""Landed files to bronze, on a small season with a rookie, a stub driver and an unlisted status."""

import csv
import glob
import json

import pytest

from lapstack.plans.models import MODELS, build_models
from lapstack.plans.normalise import normalise, write_all
from lapstack.plans.quality import check_warehouse, report_passed
from lapstack.schemas import BRONZE_COLUMNS, ROUND_ENDPOINTS
from lapstack.sources.sinks import create_layers, load_warehouse, validate_load

from conftest import rows

HISTORY = {
    "seasons": [{"year": "2030", "url": "s30"}],
    "status": [{"statusId": "4", "status": "Finished"}],
    "circuits": [
        {"circuitId": "9", "circuitRef": "oval", "name": "Oval", "country": "Nowhere", "lat": "1.5", "lng": "2", "alt": ""}
    ],
    "drivers": [{"driverId": "7", "driverRef": "ada", "forename": "Ada", "surname": "Able", "dob": "2001-02-03"}],
    "constructors": [{"constructorId": "3", "constructorRef": "alpha", "name": "Alpha, Inc", "nationality": "X"}],
    "races": [
        {"raceId": "20", "year": "2030", "round": "1", "circuitId": "9", "name": "Opener", "date": "2030-03-01"}
    ],
    "results": [
        {
            "resultId": "100",
            "raceId": "20",
            "driverId": "7",
            "constructorId": "3",
            "number": "",
            "grid": "1",
            "position": "1",
            "positionOrder": "1",
            "points": "25",
            "laps": "50",
            "statusId": "4",
        }
    ],
}


def entry(**more):
    return {"season": "2031", "round": "1", **more}


def races(*entries):
    return {"MRData": {"RaceTable": {"Races": list(entries)}}}


ADA = {"Driver": {"driverId": "ada"}, "Constructor": {"constructorId": "alpha"}}
BEN = {"Driver": {"driverId": "ben"}, "Constructor": {"constructorId": "beta"}}
CAT = {"Driver": {"driverId": "cat"}, "Constructor": {"constructorId": "beta"}}

YEAR_FILES = {
    "drivers": {
        "MRData": {
            "DriverTable": {
                "Drivers": [
                    {"driverId": "ben", "permanentNumber": "8", "givenName": "Ben", "familyName": "Bold"},
                    {"driverId": "ada", "givenName": "Changed", "familyName": "Name"},
                ]
            }
        }
    },
    "circuits": {
        "MRData": {
            "CircuitTable": {
                "Circuits": [
                    {"circuitId": "bay", "circuitName": "Bay", "Location": {"lat": "4", "long": "5", "country": "Sea"}}
                ]
            }
        }
    },
    "constructors": {"MRData": {"ConstructorTable": {"Constructors": [{"constructorId": "beta", "name": "Beta"}]}}},
    "races": races(
        entry(
            raceName="Bay Race",
            date="2031-04-01",
            time="13:00:00Z",
            Circuit={"circuitId": "bay"},
            Qualifying={"date": "2031-03-31", "time": "15:00:00Z"},
        ),
        entry(round="2", raceName="Hill Race", date="2031-05-01", Circuit={"circuitId": "hill"}),
        entry(raceName="Late copy", Circuit={"circuitId": "other"}),
    ),
    "results": races(
        entry(
            Results=[
                {
                    "number": "8",
                    "position": "1",
                    "points": "25",
                    "grid": "2",
                    "laps": "40",
                    "status": "Finished",
                    "Time": {"millis": "5000000", "time": "1:23:20.000"},
                    "FastestLap": {"rank": "1", "lap": "30", "Time": {"time": "1:20.5"}},
                    **BEN,
                },
                {"number": "1", "position": "2", "points": "18", "grid": "1", "laps": "40", "status": "Gearbox", **ADA},
                {"number": "5", "points": "0", "grid": "3", "laps": "2", **CAT},
            ]
        ),
        entry(round="2", Results=[]),
    ),
    "qualifying": races(entry(QualifyingResults=[{"number": "1", "position": "1", "Q1": "1:19.9", **ADA}])),
    "sprint": races(entry(SprintResults=[{"number": "8", "position": "1", "points": "8", "grid": "1", "laps": "10", "status": "Finished", **BEN}])),
    "pitstops": races(
        entry(PitStops=[{"driverId": "ada", "lap": "12", "stop": "1", "time": "14:20:00", "duration": "1:02.500"}])
    ),
    "laps": races(
        entry(
            Laps=[
                {"number": "1", "Timings": [{"driverId": "ben", "position": "1", "time": "1:30.250"}]},
                {
                    "number": "2",
                    "Timings": [
                        {"driverId": "ben", "position": "1", "time": "1:29.000"},
                        {"driverId": "ada", "position": "2", "time": "no time"},
                    ],
                },
            ]
        )
    ),
    "driverstandings": {
        "MRData": {
            "StandingsTable": {
                "StandingsLists": [entry(DriverStandings=[{"position": "1", "points": "33", "wins": "1", **BEN}])]
            }
        }
    },
    "constructorstandings": {
        "MRData": {
            "StandingsTable": {
                "StandingsLists": [entry(ConstructorStandings=[{"position": "1", "points": "33", "wins": "1", **BEN}])]
            }
        }
    },
}


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    raw, api = root / "raw", root / "api"
    raw.mkdir()
    for table, columns in BRONZE_COLUMNS.items():
        with open(raw / f"{table}.csv", "w", encoding="utf-8-sig", newline="") as f:
            writer = csv.DictWriter(f, columns, restval="NULL")
            writer.writeheader()
            writer.writerows(HISTORY.get(table, []))
    api.mkdir()
    seasons = [{"season": "2030", "url": "again"}, {"season": "2031", "url": "s31"}]
    (api / "seasons.json").write_text(json.dumps({"MRData": {"SeasonTable": {"Seasons": seasons}}}))
    known = [{"statusId": "1", "status": "Finished"}, {"statusId": "2", "status": "Spun off"}]
    (api / "status.json").write_text(json.dumps({"MRData": {"StatusTable": {"Status": known}}}))
    for year in ("2031", "2029", "notes"):
        (api / year).mkdir()
        for endpoint in ["drivers", "circuits", "constructors", "races", *ROUND_ENDPOINTS]:
            payload = YEAR_FILES[endpoint] if year == "2031" else YEAR_FILES["races"] | {"unused": year}
            (api / year / f"{endpoint}.json").write_text(json.dumps(payload, indent=1))
    return str(raw), str(api)


@pytest.fixture(scope="module")
def bronze(spark, landed):
    return normalise(spark, *landed, start_year=2031)


def test_known_entities_keep_ids_and_attributes(bronze):
    assert rows(bronze["drivers"], "driverId", "driverRef", "forename", "number", "source") == [
        ("7", "ada", "Ada", None, "historical"),
        ("8", "ben", "Ben", "8", "api"),
        ("9", "cat", None, None, "api"),
    ]


def test_statuses_come_from_the_list_then_from_results(bronze):
    assert rows(bronze["status"], "statusId", "status") == [
        ("4", "Finished"),
        ("5", "Spun off"),
        ("6", "Gearbox"),
        ("7", "None"),
    ]


def test_circuits_of_new_races_only(bronze):
    assert rows(bronze["circuits"], "circuitId", "circuitRef", "country") == [
        ("10", "bay", "Sea"),
        ("11", "hill", None),
        ("9", "oval", "Nowhere"),
    ]


def test_races_by_season_and_round(bronze):
    shown = rows(bronze["races"], "raceId", "year", "round", "circuitId", "name", "time", "quali_time", "sprint_date")
    assert shown == [
        ("20", "2030", "1", "9", "Opener", None, None, None),
        ("21", "2031", "1", "10", "Bay Race", "13:00:00", "15:00:00", None),
        ("22", "2031", "2", "11", "Hill Race", None, None, None),
    ]


def test_results_continue_the_ids(bronze):
    shown = rows(
        bronze["results"], "resultId", "raceId", "driverId", "constructorId", "positionOrder", "position", "statusId",
        "milliseconds", "rank", "source",
    )
    assert shown == [
        ("100", "20", "7", "3", "1", "1", "4", None, None, "historical"),
        ("101", "21", "8", "4", "1", "1", "4", "5000000", "1", "api"),
        ("102", "21", "7", "3", "2", "2", "6", None, None, "api"),
        ("103", "21", "9", "4", "3", None, "7", None, None, "api"),
    ]


def test_other_facts(bronze):
    assert rows(bronze["seasons"], "year", "url", "source") == [("2030", "s30", "historical"), ("2031", "s31", "api")]
    assert rows(bronze["lap_times"], "raceId", "driverId", "lap", "milliseconds") == [
        ("21", "7", "2", None),
        ("21", "8", "1", "90250"),
        ("21", "8", "2", "89000"),
    ]
    assert rows(bronze["pit_stops"], "driverId", "stop", "milliseconds") == [("7", "1", "62500")]
    assert rows(bronze["qualifying"], "qualifyId", "driverId", "q1", "q3") == [("1", "7", "1:19.9", None)]
    assert rows(bronze["sprint_results"], "sprintResultId", "driverId", "points") == [("1", "8", "8")]
    assert rows(bronze["driver_standings"], "driverStandingsId", "driverId", "points") == [("1", "8", "33")]
    assert rows(bronze["constructor_standings"], "constructorStandingsId", "constructorId") == [("1", "4")]


def _text(folder):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{folder}/part-*")))


def test_files_are_the_same_on_every_run(spark, bronze, landed, tmp_path):
    write_all(bronze, str(tmp_path / "a"))
    write_all(normalise(spark, *landed, start_year=2031), str(tmp_path / "b"))
    for table, columns in BRONZE_COLUMNS.items():
        first, second = (_text(tmp_path / run / table) for run in ("a", "b"))
        assert first == second
        assert first.splitlines()[0] == ",".join([*columns, "source"])
    assert '"Alpha, Inc"' in _text(tmp_path / "a" / "constructors")
    assert ",NULL," in _text(tmp_path / "a" / "races")


def test_files_to_marts(spark, bronze, tmp_path):
    """Landed files through bronze tables, typed tables and marts, with all checks."""
    write_all(bronze, str(tmp_path / "bronze"))
    create_layers(spark, ["e2e_bronze", "e2e_silver", "e2e_marts"], str(tmp_path / "db"))
    load_warehouse(spark, str(tmp_path / "bronze"), "e2e_bronze")
    counts = {r["table_name"]: r["row_count"] for r in validate_load(spark, "e2e_bronze").collect()}
    assert counts["results"] == 4 and counts["lap_times"] == 3
    assert report_passed(check_warehouse(spark, "e2e_bronze")).first()["passed"]
    built = build_models(spark, MODELS, "e2e_bronze", "e2e_")
    assert len(built) == 23
    hub = spark.table("e2e_marts.race_results_detail")
    assert rows(hub, "race_id", "driver_id", "qualifying_position", "sprint_points", "pit_stop_count", "total_laps") == [
        (20, 7, None, None, None, None),
        (21, 7, 1, None, 1, 1),
        (21, 8, None, 8, None, 2),
        (21, 9, None, None, None, None),
    ]
    standings = spark.table("e2e_marts.championship_standings")
    assert rows(standings.filter("season = 2031"), "driver_id", "championship_position", "cumulative_points") == [
        (7, 2, 18),
        (8, 1, 33),
        (9, 3, 0),
    ]
