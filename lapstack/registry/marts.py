"""Registered marts."""

from __future__ import annotations

from lapstack.plans.marts import championship_standings
from lapstack.registry.core import register

HUB = (
    "race_id driver_id constructor_id status_id circuit_id race_driver_key:text driver_key:text constructor_key:text "
    "circuit_key:text status_key:text season round race_name:text race_date:text driver_name:text "
    "driver_nationality:text driver_code:text driver_number constructor_name:text constructor_nationality:text "
    "circuit_name:text circuit_country:text circuit_location:text grid_position finish_position position_change "
    "points:double laps_completed qualifying_position sprint_grid sprint_finish sprint_points:double pit_stop_count "
    "total_pit_ms best_pit_ms worst_pit_ms best_lap_ms avg_lap_ms:double total_laps status_category:text is_dnf:flag "
    "is_points_finish:flag is_podium:flag is_win:flag fastest_lap_number fastest_lap_rank fastest_lap_time:text "
    "source:text"
)
STANDINGS = (
    "driver_race_key:text driver_id race_id season round driver_name:text team:text cumulative_points:double "
    "championship_position points_behind_leader:double wins_so_far podiums_so_far source:text"
)
DRIVER_SEASONS = (
    "driver_id_season:text driver_id season driver_name:text team:text races_entered wins podiums points:double poles "
    "fastest_laps dnfs avg_finish_position:double championship_position source:text"
)
TEAM_SEASONS = (
    "constructor_id_season:text constructor_id season constructor_name:text races_entered wins podiums points:double "
    "one_two_finishes poles fastest_laps dnfs championship_position source:text"
)
DRIVER_CAREERS = (
    "driver_id driver_name:text driver_code:text nationality:text date_of_birth:text first_season last_season seasons "
    "races_entered wins podiums poles fastest_laps total_points:double dnfs teams_raced_for teams:text "
    "championships_won source:text"
)
TEAM_CAREERS = (
    "constructor_id constructor_name:text nationality:text first_season last_season seasons races_entered wins podiums "
    "poles fastest_laps total_points:double dnfs drivers_raced_for drivers:text championships_won source:text"
)
CIRCUITS = (
    "circuit_id circuit_name:text circuit_country:text circuit_location:text latitude:double longitude:double altitude "
    "seasons_hosted races_hosted first_season last_season unique_drivers unique_constructors total_wins total_podiums "
    "total_dnfs avg_laps_completed:double avg_pit_stops_per_driver:double avg_total_pit_ms:double "
    "most_wins_driver:text most_podiums_driver:text most_poles_driver:text latest_season latest_race_name:text "
    "latest_race_date:text latest_winner:text source:text"
)
QUALI_RACE = (
    "quali_race_key:text race_id driver_id constructor_id qualifying_position grid_position finish_position "
    "positions_gained_lost points:double laps_completed status_category:text is_dnf:flag q1_time:text q2_time:text "
    "q3_time:text fastest_lap_rank is_pole:flag is_win:flag is_podium:flag driver_name:text driver_nationality:text "
    "driver_code:text constructor_name:text constructor_nationality:text season round race_name:text race_date:text "
    "source:text"
)
LAP_ANALYSIS = (
    "lap_analysis_key:text race_id driver_id lap_number lap_position lap_time:text lap_ms delta_to_leader_ms "
    "delta_to_race_best_ms is_race_fastest_lap:flag is_lap_fastest:flag delta_to_lap_avg_ms:double drivers_on_lap "
    "lap_seq driver_lap_rank potential_pit_lap season round race_name:text race_date:text circuit_id "
    "circuit_name:text circuit_country:text driver_name:text driver_code:text constructor_name:text "
    "constructor_nationality:text source:text"
)
PIT_ANALYSIS = (
    "pit_analysis_key:text race_id driver_id stop_number lap_number stop_time:text stop_duration:text stop_ms "
    "delta_to_avg_stop_ms:double is_fastest_stop_in_race:flag is_slowest_stop_in_race:flag total_pit_ms total_stops "
    "stop_seq stop_delta_from_prev is_slow_stop:flag season round race_name:text race_date:text circuit_name:text "
    "circuit_country:text driver_name:text driver_code:text constructor_name:text constructor_nationality:text "
    "grid_position finish_position source:text"
)

# model name, its SQL view, its columns, in inventory order
MARTS = [
    ("race_results_detail", "hub", HUB),
    ("championship_standings", "standings", STANDINGS),
    ("driver_season_summary", "driver_seasons", DRIVER_SEASONS),
    ("constructor_season_summary", "team_seasons", TEAM_SEASONS),
    ("driver_career", "driver_careers", DRIVER_CAREERS),
    ("constructor_career", "team_careers", TEAM_CAREERS),
    ("circuit_stats", "circuit_records", CIRCUITS),
    ("qualifying_vs_race", "quali_race", QUALI_RACE),
    ("lap_time_analysis", "lap_analysis", LAP_ANALYSIS),
    ("pit_stop_analysis", "pit_analysis", PIT_ANALYSIS),
]


def _mart(name: str):
    return lambda t: t.rebuilt(name)


for _number, (_name, _view, _columns) in enumerate(MARTS, 1):
    register(f"mart_{_number}_{_name}", _columns, _mart(_name), f"SELECT * FROM {_view}", [_view])
register(
    "mart_2_hot_groups",
    STANDINGS,
    # groups above a hundred rows count as hot: those of a round do
    lambda t: championship_standings(t["race_results_detail"], limit=100),
    "SELECT * FROM standings",
    ["standings"],
)
