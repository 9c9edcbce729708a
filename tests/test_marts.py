"""A hand-worked season: a shared drive, a tie, a retirement, a lapped finish, a sprint, a change of team."""

from decimal import Decimal

import pytest

from lapstack.plans import marts, quality, serve
from lapstack.plans.silver import classify_status

from conftest import rows


@pytest.fixture(scope="module")
def world(spark):
    def made(data, schema):
        return spark.createDataFrame(data, schema).cache()

    drivers = made(
        [(1, "Ada", "Able", "ABL", "X", 11), (2, "Ben", "Bold", "BOL", "Y", None), (3, "Cat", None, "CAT", "Z", 5)],
        "driver_id bigint, forename string, surname string, code string, nationality string, driver_number int",
    ).selectExpr("*", "date '2000-01-01' AS date_of_birth", "'historical' AS source")
    constructors = made([(1, "Alpha", "X"), (2, "Beta", "Y")], "constructor_id bigint, name string, nationality string")
    circuits = made(
        [(1, "Bay", "Sea", "Shore"), (2, "Hill", "Land", "Top")],
        "circuit_id bigint, name string, country string, location string",
    ).selectExpr("*", "1.5D AS latitude", "2.5D AS longitude", "7 AS altitude")
    races = made(
        [(10, 2031, 1, 1, "Bay Race", "2031-03-01"), (11, 2031, 2, 2, "Hill Race", "2031-04-01")],
        "race_id bigint, year int, round int, circuit_id bigint, name string, race_date string",
    ).selectExpr("* EXCEPT (race_date)", "cast(race_date AS date) AS race_date")
    status = classify_status(
        made([(1, "Finished"), (2, "+1 Lap"), (3, "Engine")], "status_id bigint, status string")
    )
    results = made(
        [
            (100, 10, 1, 1, 1, 1, 1, "25", 50, 1, "historical"),
            (101, 10, 2, 2, 1, 2, 2, "18", 50, 2, "historical"),
            (102, 10, 3, 2, 3, 3, None, "0", 12, None, "historical"),
            (103, 10, 2, 1, 2, 9, 3, "2", 20, None, "historical"),  # a second car for Ben: the better result stays
            (110, 11, 1, 1, 2, 2, 2, "18", 49, 2, "api"),
            (111, 11, 2, 1, 1, 1, 1, "25", 50, 1, "api"),  # Ben drives for another team
        ],
        "result_id bigint, race_id bigint, driver_id bigint, constructor_id bigint, status_id bigint, "
        "grid_position smallint, finish_position smallint, p string, laps_completed smallint, "
        "fastest_lap_rank smallint, source string",
    ).selectExpr(
        "* EXCEPT (p)", "cast(p AS decimal(5,2)) AS points", "cast(1 AS smallint) AS fastest_lap_number",
        "'1:20.0' AS fastest_lap_time",
    )
    qualifying = made(
        [(10, 1, 1, 1), (10, 2, 2, 2), (11, 2, 1, 1)],
        "race_id bigint, driver_id bigint, constructor_id bigint, qualifying_position smallint",
    ).selectExpr("*", "'1:19' AS q1_time", "cast(null AS string) AS q2_time", "cast(null AS string) AS q3_time", "'api' AS source")
    sprints = made(
        [(10, 2, 2, 1, "7")],
        "race_id bigint, driver_id bigint, grid_position smallint, finish_position smallint, p string",
    ).selectExpr("* EXCEPT (p)", "cast(p AS decimal(5,2)) AS points")
    laps = made(
        [
            (10, 1, 1, 1, 90000),
            (10, 1, 2, 1, 96000),
            (10, 1, 3, 1, 101000),
            (10, 3, 1, 2, 91000),
            (10, 3, 2, 2, None),
            (11, 1, 1, 1, 80001),
        ],
        "race_id bigint, driver_id bigint, lap_number smallint, lap_position smallint, lap_milliseconds bigint",
    ).selectExpr("*", "'t' AS lap_time", "'api' AS source")
    stops = made(
        [(10, 1, 1, 20, 20000), (10, 1, 2, 40, 23001), (10, 3, 1, 10, None), (11, 1, 1, 9, 21000)],
        "race_id bigint, driver_id bigint, stop_number smallint, lap_number smallint, stop_milliseconds bigint",
    ).selectExpr("*", "'14:00:00' AS stop_time", "'20.0' AS stop_duration", "'api' AS source")
    tables = dict(
        results=results, qualifying=qualifying, sprints=sprints, pit_stops=stops, lap_times=laps, drivers=drivers,
        constructors=constructors, circuits=circuits, races=races, status=status,
    )
    tables["hub"] = marts.race_results_detail(**tables).cache()
    return tables


def test_hub_keeps_the_better_result_of_a_shared_drive(world):
    shown = rows(
        world["hub"], "race_id", "driver_id", "constructor_id", "finish_position", "position_change", "is_dnf",
        "is_podium", "is_win", "qualifying_position", "sprint_points", "pit_stop_count", "total_pit_ms", "total_laps",
    )
    assert shown == sorted(
        [
            (10, 1, 1, 1, 0, False, True, True, 1, None, 2, 43001, 3),
            (10, 2, 2, 2, 0, False, True, False, 2, Decimal("7.00"), None, None, None),
            (10, 3, 2, None, None, True, False, False, None, None, 1, None, 2),
            (11, 1, 1, 2, 0, True, True, False, None, None, 1, 21000, 1),
            (11, 2, 1, 1, 0, False, True, True, 1, None, None, None, None),
        ],
        key=repr,
    )


def test_names_with_a_missing_part_are_null(world):
    assert rows(world["hub"].filter("driver_id = 3"), "driver_name") == [(None,)]


def test_standings_count_sprints_and_break_ties_by_id(world):
    standings = marts.championship_standings(world["hub"])
    shown = rows(standings, "round", "championship_position", "driver_id", "cumulative_points", "points_behind_leader", "wins_so_far")
    assert shown == [
        (1, 1, 1, Decimal("25.00"), Decimal("0.00"), 1),
        (1, 2, 2, Decimal("25.00"), Decimal("0.00"), 0),
        (1, 3, 3, Decimal("0.00"), Decimal("25.00"), 0),
        (2, 1, 2, Decimal("50.00"), Decimal("0.00"), 1),
        (2, 2, 1, Decimal("43.00"), Decimal("7.00"), 1),
    ]
    assert "2_11" in {r["driver_race_key"] for r in standings.collect()}


def test_season_summary(world):
    summary = marts.driver_season_summary(world["hub"])
    shown = rows(summary, "driver_id", "team", "races_entered", "wins", "podiums", "points", "poles", "dnfs", "avg_finish_position", "championship_position")
    assert shown == [
        (1, "Alpha", 2, 1, 2, Decimal("43.00"), 1, 1, Decimal("1.50"), 2),
        (2, "Beta", 2, 1, 2, Decimal("50.00"), 1, 0, Decimal("1.50"), 1),
        (3, "Beta", 1, 0, 0, Decimal("0.00"), 0, 1, None, 3),
    ]


def test_one_two_and_constructor_summary(world):
    shown = rows(
        marts.constructor_season_summary(world["hub"]), "constructor_id", "points", "one_two_finishes", "wins", "championship_position"
    )
    assert shown == [(1, Decimal("68.00"), 1, 2, 1), (2, Decimal("25.00"), 0, 0, 2)]


def test_careers_leave_sprint_points_out(world):
    hub = world["hub"]
    career = marts.driver_career(hub, world["drivers"], marts.driver_season_summary(hub))
    shown = rows(career, "driver_id", "total_points", "teams", "teams_raced_for", "championships_won", "seasons")
    assert shown == [
        (1, Decimal("43.00"), "Alpha", 1, 0, 1),
        (2, Decimal("43.00"), "Alpha, Beta", 2, 1, 1),
        (3, Decimal("0.00"), "Beta", 1, 0, 1),
    ]
    constructors = world["constructors"].selectExpr("*", "'historical' AS source")
    teams = marts.constructor_career(hub, constructors, marts.constructor_season_summary(hub))
    assert rows(teams, "constructor_id", "drivers", "drivers_raced_for", "championships_won") == [
        (1, "Ada Able, Ben Bold", 2, 1),
        (2, "Ben Bold", 2, 0),
    ]


def test_circuit_records(world):
    stats = marts.circuit_stats(world["hub"], world["circuits"], world["qualifying"])
    shown = rows(stats, "circuit_id", "races_hosted", "total_wins", "avg_laps_completed", "avg_total_pit_ms", "most_wins_driver", "most_poles_driver", "latest_race_name", "latest_winner")
    assert shown == [
        (1, 1, 1, Decimal("37.33"), Decimal("43001.00"), "Ada Able", "Ada Able", "Bay Race", "Ada Able"),
        (2, 1, 1, Decimal("49.50"), Decimal("21000.00"), "Ben Bold", "Ben Bold", "Hill Race", "Ben Bold"),
    ]
    assert quality.violating(stats, quality.circuit_invariants()).count() == 0


def test_qualifying_joins_every_result(world):
    table = marts.qualifying_vs_race(*[world[n] for n in ("qualifying", "results", "drivers", "constructors", "races", "status")])
    shown = rows(table, "race_id", "driver_id", "finish_position", "positions_gained_lost", "is_pole", "is_win")
    assert shown == [(10, 1, 1, 0, True, True), (10, 2, 2, 0, False, False), (10, 2, 3, 6, False, False), (11, 2, 1, 0, True, True)]
    violations = quality.unique(table, "qualifying_vs_race", "quali_race_key")
    assert violations.first()["violations"] == 1
    assert rows(serve.pole_conversion(table, 2031)) == [(2, 2, 100.0)]
    assert rows(serve.pole_conversion(table, 1900)) == [(0, 0, 0.0)]


@pytest.mark.parametrize("hot", [False, True])
def test_lap_analysis(world, request, hot):
    if hot:
        request.getfixturevalue("tiny_groups")
    table = marts.lap_time_analysis(*[world[n] for n in ("lap_times", "races", "drivers", "results", "circuits", "constructors")])
    shown = rows(
        table.filter("race_id = 10"), "driver_id", "lap_number", "delta_to_leader_ms", "delta_to_race_best_ms",
        "is_race_fastest_lap", "delta_to_lap_avg_ms", "drivers_on_lap", "lap_seq", "driver_lap_rank", "potential_pit_lap",
    )
    assert shown == [
        (1, 1, 0, 0, True, Decimal("-500.000000"), 2, 1, 1, 0),
        (1, 2, 0, 6000, False, Decimal("0.000000"), 2, 2, 2, 1),
        (1, 3, 0, 11000, False, Decimal("0.000000"), 1, 3, 3, 0),
        (3, 1, 1000, 1000, False, Decimal("500.000000"), 2, 1, 1, 0),
        (3, 2, None, None, False, None, 2, 2, 2, 0),
    ]


def test_stop_analysis(world):
    table = marts.pit_stop_analysis(*[world[n] for n in ("pit_stops", "races", "drivers", "results", "constructors", "circuits")])
    shown = rows(
        table, "race_id", "driver_id", "stop_number", "delta_to_avg_stop_ms", "is_fastest_stop_in_race", "total_pit_ms",
        "total_stops", "stop_delta_from_prev", "is_slow_stop",
    )
    assert shown == [
        (10, 1, 1, Decimal("0.000000"), True, 43001, 2, 20000, False),
        (10, 1, 2, Decimal("0.000000"), True, 43001, 2, 3001, True),
        (10, 3, 1, None, False, None, 1, None, False),
        (11, 1, 1, Decimal("0.000000"), True, 21000, 1, 21000, False),
    ]


def test_head_to_head_of_a_named_pair(world):
    row = serve.head_to_head(world["hub"], 2031, "Alpha", "Ben Bold", "Ada Able").first()
    assert (row["first_driver"], row["first_points"], row["first_avg_finish"]) == ("Ada Able", Decimal("43.00"), Decimal("1.5000"))
    assert (row["second_driver"], row["second_wins"], row["second_poles"]) == ("Ben Bold", 1, 1)


def test_season_overview(world):
    hub = world["hub"]
    overview = serve.season_overview(
        marts.driver_season_summary(hub), marts.constructor_season_summary(hub), serve.season_race_summary(hub, 2031), 2031
    )
    assert tuple(overview.first()) == ("Ben Bold", Decimal("50.00"), "Alpha", 2, "Hill Race", "Ben Bold")


def test_numpy_scalars_are_plain_parameters(world):
    import numpy as np

    assert serve.results_of(world["hub"], np.int64(2031)).count() == 5
    assert serve.plain(np.int64(3)) == 3 and serve.plain("x") == "x"


def test_declared_rules_find_nulls_and_duplicates(spark, world):
    bad = spark.createDataFrame([(1, "a"), (1, None), (None, "c")], "driver_id int, driver_ref string")
    report = quality.declared_rules({"dim_drivers": bad}, {"dim_drivers": ["driver_id"]}, {"dim_drivers": ["driver_id", "driver_ref"]}, [])
    assert rows(report, "check", "column_name", "violations", "passed") == [
        ("not_null", "driver_id", 1, False),
        ("not_null", "driver_ref", 1, False),
        ("unique", "driver_id", 1, False),
    ]
    assert quality.hub_orphans(world["hub"], world["drivers"].filter("driver_id < 3"), world["constructors"], world["circuits"], world["races"]).count() == 1
    assert not quality.report_passed(report).first()["passed"]
