"""Registered serving queries and page roll-ups."""

from __future__ import annotations


from lapstack.functions import scalars as s
from lapstack.operators.groups import FIVE_NUMBERS
from lapstack.plans import serve
from lapstack.registry import marts as m
from lapstack.registry.core import register
from lapstack.registry.relational import _NEIGHBOURS_SQL, _neighbours
from lapstack.registry.sql import half_up_avg

SEASON = 1998
RACE = 199803


def _season(view: str) -> str:
    return f"SELECT * FROM {view} WHERE season = {SEASON}"


register(
    "srv_1_seasons",
    "season",
    lambda t: serve.seasons(t["championship_standings"]),
    "SELECT DISTINCT season FROM standings",
    ["standings"],
)
for _name, _model, _view, _columns, _plan in (
    ("standings", "championship_standings", "standings", m.STANDINGS, serve.standings_of),
    ("drivers", "driver_season_summary", "driver_seasons", m.DRIVER_SEASONS, serve.summary_of),
    ("constructors", "constructor_season_summary", "team_seasons", m.TEAM_SEASONS, serve.summary_of),
    ("results", "race_results_detail", "hub", m.HUB, serve.results_of),
    ("qualifying", "qualifying_vs_race", "quali_race", m.QUALI_RACE, serve.qualifying_of),
):
    register(
        f"srv_2_season_{_name}",
        _columns,
        lambda t, plan=_plan, model=_model: plan(t[model], SEASON),
        _season(_view),
        [_view],
    )
register(
    "srv_3_season_race_summary",
    "race_id round race_name:text race_date:text winner:text winning_team:text classified_drivers dnfs",
    lambda t: serve.season_race_summary(t["race_results_detail"], SEASON),
    "SELECT race_id, round, race_name, race_date, max(driver_name) FILTER (is_win) AS winner, "
    "max(constructor_name) FILTER (is_win) AS winning_team, count(DISTINCT driver_id) AS classified_drivers, "
    f"count(*) FILTER (is_dnf) AS dnfs FROM hub WHERE season = {SEASON} GROUP BY ALL",
    ["hub"],
)
register(
    "srv_4_constructors_of_season",
    "constructor_name:text",
    lambda t: serve.constructors_of(t["race_results_detail"], SEASON),
    f"SELECT DISTINCT constructor_name FROM hub WHERE season = {SEASON}",
    ["hub"],
)
register(
    "srv_4_constructors_all_time",
    "constructor_name:text",
    lambda t: serve.constructors_of(t["race_results_detail"]),
    "SELECT DISTINCT constructor_name FROM hub",
    ["hub"],
)
register(
    "srv_5_driver_careers",
    m.DRIVER_CAREERS,
    lambda t: serve.career_table(t["driver_career"], "driver_id"),
    "SELECT * FROM driver_careers",
    ["driver_careers"],
)
register(
    "srv_5_constructor_careers",
    m.TEAM_CAREERS,
    lambda t: serve.career_table(t["constructor_career"], "constructor_id"),
    "SELECT * FROM team_careers",
    ["team_careers"],
)
register(
    "srv_5_circuits",
    m.CIRCUITS,
    lambda t: serve.circuit_table(t["circuit_stats"]),
    "SELECT * FROM circuit_records",
    ["circuit_records"],
)
_RACES = "race_id round race_name:text circuit_name:text race_date:text"
register(
    "srv_6_races_with_laps",
    _RACES,
    lambda t: serve.races_with_detail(t["lap_time_analysis"], SEASON),
    f"SELECT DISTINCT race_id, round, race_name, circuit_name, race_date FROM lap_analysis WHERE season = {SEASON}",
    ["lap_analysis"],
)
register(
    "srv_6_races_with_stops",
    _RACES,
    lambda t: serve.races_with_detail(t["pit_stop_analysis"], SEASON),
    f"SELECT DISTINCT race_id, round, race_name, circuit_name, race_date FROM pit_analysis WHERE season = {SEASON}",
    ["pit_analysis"],
)
register(
    "srv_7_laps_of_race",
    m.LAP_ANALYSIS,
    lambda t: serve.laps_of(t["lap_time_analysis"], RACE, season=SEASON),
    f"SELECT * FROM lap_analysis WHERE race_id = {RACE}",
    ["lap_analysis"],
)
register(
    "srv_7_stops_of_race",
    m.PIT_ANALYSIS,
    lambda t: serve.stops_of(t["pit_stop_analysis"], RACE, season=SEASON),
    f"SELECT * FROM pit_analysis WHERE race_id = {RACE}",
    ["pit_analysis"],
)
register(
    "srv_8_season_overview",
    "driver_leader:text leader_points:double constructor_leader:text races_completed latest_race:text "
    "latest_winner:text",
    lambda t: serve.season_overview(
        t["driver_season_summary"],
        t["constructor_season_summary"],
        serve.season_race_summary(t["race_results_detail"], SEASON),
        SEASON,
    ),
    f"SELECT (SELECT driver_name FROM driver_seasons WHERE season = {SEASON} AND championship_position = 1) AS "
    f"driver_leader, (SELECT points FROM driver_seasons WHERE season = {SEASON} AND championship_position = 1) AS "
    f"leader_points, (SELECT constructor_name FROM team_seasons WHERE season = {SEASON} AND championship_position = 1) "
    "AS constructor_leader, count(DISTINCT race_id) AS races_completed, arg_max(race_name, round) AS latest_race, "
    f"(SELECT max(driver_name) FROM hub WHERE is_win AND season = {SEASON} AND round = "
    f"(SELECT max(round) FROM hub WHERE season = {SEASON})) AS latest_winner FROM hub WHERE season = {SEASON}",
    ["driver_seasons", "team_seasons", "hub"],
)
register(
    "srv_8_leaders",
    "championship_position driver_name:text team:text points:double wins podiums",
    lambda t: serve.leaders(t["driver_season_summary"], SEASON),
    "SELECT championship_position, driver_name, team, points, wins, podiums FROM driver_seasons "
    f"WHERE season = {SEASON} AND championship_position <= 10",
    ["driver_seasons"],
)
_TEAM_PROGRESS = (
    "SELECT round, team, sum(cumulative_points) AS cumulative_points FROM standings "
    f"WHERE season = {SEASON} GROUP BY round, team"
)
register(
    "srv_9_team_progression",
    "round team:text cumulative_points:double",
    lambda t: serve.team_progression(t["championship_standings"], SEASON),
    _TEAM_PROGRESS,
    ["standings"],
)
register(
    "srv_9_top_teams",
    "team:text best_points:double",
    lambda t: serve.top_teams(serve.team_progression(t["championship_standings"], SEASON)),
    f"SELECT team, max(cumulative_points) AS best_points FROM ({_TEAM_PROGRESS}) GROUP BY team "
    "ORDER BY best_points DESC, team LIMIT 5",
    ["standings"],
)
register(
    "srv_9_top_driver_progression",
    m.STANDINGS,
    lambda t: serve.progression_of_top_drivers(t["championship_standings"], SEASON),
    f"SELECT * FROM standings WHERE season = {SEASON} AND driver_id IN "
    f"(SELECT driver_id FROM standings WHERE season = {SEASON} AND championship_position <= 5)",
    ["standings"],
)
_ROUNDS = list(range(1, 13))
register(
    "srv_10_results_matrix",
    "driver_id driver_name:text points:double " + " ".join(f"r{r}" for r in _ROUNDS),
    lambda t: serve.results_matrix(t["race_results_detail"], SEASON, _ROUNDS),
    "SELECT driver_id, driver_name, sum(points) AS points, "
    + ", ".join(f"max(CASE WHEN round = {r} THEN finish_position END) AS r{r}" for r in _ROUNDS)
    + f" FROM hub WHERE season = {SEASON} GROUP BY driver_id, driver_name",
    ["hub"],
)
register(
    "srv_10_results_cells",
    "driver_id round finish_position label:text band:text",
    lambda t: serve.results_cells(t["race_results_detail"], SEASON),
    "SELECT driver_id, round, finish_position, coalesce(CAST(finish_position AS VARCHAR), 'DNF') AS label, "
    f"CASE WHEN finish_position IS NULL THEN '{s.BAND_NONE}' WHEN finish_position = 1 THEN '{s.BAND_WIN}' WHEN "
    f"finish_position <= 3 THEN '{s.BAND_PODIUM}' WHEN finish_position <= 10 THEN '{s.BAND_POINTS}' ELSE "
    f"'{s.BAND_OUTSIDE}' END AS band FROM hub WHERE season = {SEASON}",
    ["hub"],
)
register(
    "srv_11_pole_conversion",
    "poles pole_wins conversion_rate:double",
    lambda t: serve.pole_conversion(t["qualifying_vs_race"], SEASON),
    "SELECT poles, pole_wins, CASE WHEN poles > 0 THEN pole_wins / poles * 100 ELSE 0 END AS conversion_rate FROM "
    "(SELECT count(*) FILTER (is_pole) AS poles, count(*) FILTER (is_pole AND is_win) AS pole_wins FROM quali_race "
    f"WHERE season = {SEASON})",
    ["quali_race"],
)
register(
    "srv_12_driver_qualifying",
    "driver_name:text constructor_name:text avg_quali:double avg_finish:double poles top3 races "
    "avg_positions_gained:double",
    lambda t: serve.driver_qualifying(t["qualifying_vs_race"], SEASON),
    "SELECT driver_name, constructor_name, round_even(avg(qualifying_position), 1) AS avg_quali, "
    "round_even(avg(finish_position), 1) AS avg_finish, count(*) FILTER (is_pole) AS poles, "
    "count(*) FILTER (qualifying_position <= 3) AS top3, count(*) AS races, "
    f"round_even(avg(positions_gained_lost), 1) AS avg_positions_gained FROM quali_race WHERE season = {SEASON} "
    "GROUP BY driver_name, constructor_name",
    ["quali_race"],
)
register(
    "srv_13_gain_histogram",
    "constructor_name:text positions_gained_lost entries",
    lambda t: serve.gain_histogram(t["qualifying_vs_race"], SEASON),
    f"SELECT constructor_name, positions_gained_lost, count(*) AS entries FROM quali_race WHERE season = {SEASON} "
    "GROUP BY ALL",
    ["quali_race"],
)
_SIDES = " ".join(
    f"{side}_{c}:{'double' if c in ('points', 'avg_finish') else 'long'}"
    for side in ("first", "second")
    for c in serve.HEAD_TO_HEAD
)
_RECORD_SQL = (
    "(SELECT season, constructor_name, driver_name, sum(points) AS points, count(*) FILTER (is_win) AS wins, "
    "count(*) FILTER (is_podium) AS podiums, count(*) FILTER (qualifying_position = 1) AS poles, "
    f"count(*) FILTER (is_dnf) AS dnfs, coalesce({half_up_avg('finish_position', 4)}, 0) AS avg_finish "
    "FROM hub GROUP BY ALL)"
)
_PAIRS_SQL = (
    "SELECT p.season, p.constructor_name, p.first_driver, p.second_driver, "
    + ", ".join(f"{a}.{c} AS {side}_{c}" for side, a in (("first", "a"), ("second", "b")) for c in serve.HEAD_TO_HEAD)
    + f" FROM {_NEIGHBOURS_SQL} p JOIN {_RECORD_SQL} a ON a.season = p.season AND "
    "a.constructor_name = p.constructor_name AND a.driver_name = p.first_driver "
    f"JOIN {_RECORD_SQL} b ON b.season = p.season AND b.constructor_name = p.constructor_name "
    "AND b.driver_name = p.second_driver"
)
register(
    "srv_14_head_to_head",
    f"season constructor_name:text first_driver:text second_driver:text {_SIDES}",
    lambda t: serve.compare_pairs(serve.driver_record(t["race_results_detail"]), _neighbours(t)),
    _PAIRS_SQL,
    ["hub"],
)


def _selected(t):
    """The first pair by name of a season, chosen as a reader of the page would."""
    pair = _neighbours(t).filter(f"season = {SEASON}").orderBy("constructor_name", "first_driver").first()
    return serve.head_to_head(t["race_results_detail"], SEASON, pair["constructor_name"], pair["first_driver"], pair["second_driver"])


register(
    "srv_14_selected_pair",
    f"season constructor_name:text first_driver:text second_driver:text {_SIDES}",
    _selected,
    f"SELECT * FROM ({_PAIRS_SQL}) WHERE season = {SEASON} ORDER BY constructor_name, first_driver LIMIT 1",
    ["hub"],
)
for _metric in serve.CAREER_METRICS:
    register(
        f"srv_15_leaders_by_{_metric}",
        f"driver_id driver_name:text {_metric}:double",
        lambda t, metric=_metric: serve.career_leaders(t["driver_career"], metric, "driver_id"),
        f"SELECT driver_id, driver_name, {_metric} FROM driver_careers ORDER BY {_metric} DESC, driver_id LIMIT 15",
        ["driver_careers"],
    )
register(
    "srv_16_race_pace",
    "driver_name:text constructor_name:text avg_delta_ms:double laps",
    lambda t: serve.race_pace(t["lap_time_analysis"], RACE, season=SEASON),
    f"SELECT driver_name, constructor_name, {half_up_avg('delta_to_race_best_ms', 4)} AS avg_delta_ms, "
    f"count(lap_number) AS laps FROM lap_analysis WHERE race_id = {RACE} GROUP BY ALL",
    ["lap_analysis"],
)
register(
    "srv_16_most_laps",
    "driver_name:text laps",
    lambda t: serve.most_laps(t["lap_time_analysis"], RACE, season=SEASON),
    f"SELECT driver_name, count(lap_number) AS laps FROM lap_analysis WHERE race_id = {RACE} GROUP BY driver_name "
    "ORDER BY laps DESC, driver_name LIMIT 6",
    ["lap_analysis"],
)
register(
    "srv_16_lap_cards",
    "fastest_seconds:double fastest_driver:text average_seconds:double",
    lambda t: serve.lap_cards(t["lap_time_analysis"], RACE, season=SEASON),
    "SELECT min(lap_ms) / 1000 AS fastest_seconds, arg_min(driver_name, (lap_ms, driver_id, lap_number)) AS "
    f"fastest_driver, CAST({half_up_avg('lap_ms', 4)} AS DOUBLE) / 1000 AS average_seconds FROM lap_analysis "
    f"WHERE race_id = {RACE}",
    ["lap_analysis"],
)
register(
    "srv_17_stop_cards",
    "total_stops average_seconds:double fastest_seconds:double slowest_seconds:double",
    lambda t: serve.stop_cards(t["pit_stop_analysis"], RACE, season=SEASON),
    f"SELECT count(*) AS total_stops, CAST({half_up_avg('stop_ms', 4)} AS DOUBLE) / 1000 AS average_seconds, "
    "min(stop_ms) / 1000 AS fastest_seconds, max(stop_ms) / 1000 AS slowest_seconds FROM pit_analysis "
    f"WHERE race_id = {RACE}",
    ["pit_analysis"],
)
register(
    "srv_17_slowest_stops",
    "driver_name:text constructor_name:text stop_number lap_number duration_seconds:double",
    lambda t: serve.slowest_stops(t["pit_stop_analysis"], RACE, season=SEASON),
    "SELECT driver_name, constructor_name, stop_number, lap_number, stop_ms / 1000 AS duration_seconds "
    f"FROM pit_analysis WHERE race_id = {RACE} ORDER BY stop_ms DESC NULLS LAST, driver_id, stop_number LIMIT 20",
    ["pit_analysis"],
)
register(
    "srv_17_stop_distribution",
    "constructor_name:text " + " ".join(f"{n}:double" for n in FIVE_NUMBERS),
    lambda t: serve.stop_distribution(t["pit_stop_analysis"], RACE, season=SEASON),
    "SELECT constructor_name, "
    + ", ".join(f"quantile_cont(stop_ms, {q}) AS {n}" for n, q in FIVE_NUMBERS.items())
    + f" FROM pit_analysis WHERE race_id = {RACE} AND stop_ms IS NOT NULL GROUP BY constructor_name",
    ["pit_analysis"],
)
