"""Table layouts, payload schemas and rule tables."""

from __future__ import annotations

from dataclasses import dataclass

# Bronze tables with their columns in file order. Writers append ``source``.
BRONZE_COLUMNS: dict[str, list[str]] = {
    "seasons": ["year", "url"],
    "status": ["statusId", "status"],
    "circuits": ["circuitId", "circuitRef", "name", "location", "country", "lat", "lng", "alt", "url"],
    "drivers": ["driverId", "driverRef", "number", "code", "forename", "surname", "dob", "nationality", "url"],
    "constructors": ["constructorId", "constructorRef", "name", "nationality", "url"],
    "races": [
        "raceId", "year", "round", "circuitId", "name", "date", "time", "url", "fp1_date", "fp1_time", "fp2_date",
        "fp2_time", "fp3_date", "fp3_time", "quali_date", "quali_time", "sprint_date", "sprint_time",
    ],
    "results": [
        "resultId", "raceId", "driverId", "constructorId", "number", "grid", "position", "positionText",
        "positionOrder", "points", "laps", "time", "milliseconds", "fastestLap", "rank", "fastestLapTime",
        "fastestLapSpeed", "statusId",
    ],
    "qualifying": ["qualifyId", "raceId", "driverId", "constructorId", "number", "position", "q1", "q2", "q3"],
    "sprint_results": [
        "sprintResultId", "raceId", "driverId", "constructorId", "number", "grid", "position", "positionText",
        "positionOrder", "points", "laps", "time", "milliseconds", "fastestLap", "fastestLapTime", "statusId",
    ],
    "lap_times": ["raceId", "driverId", "lap", "position", "time", "milliseconds"],
    "pit_stops": ["raceId", "driverId", "stop", "lap", "time", "duration", "milliseconds"],
    "driver_standings": ["driverStandingsId", "raceId", "driverId", "points", "position", "positionText", "wins"],
    "constructor_standings": [
        "constructorStandingsId", "raceId", "constructorId", "points", "position", "positionText", "wins",
    ],
}

# Id column and natural key of the tables that have them.
ID_COLUMNS = {
    "seasons": "year",
    "status": "statusId",
    "circuits": "circuitId",
    "drivers": "driverId",
    "constructors": "constructorId",
    "races": "raceId",
    "results": "resultId",
    "qualifying": "qualifyId",
    "sprint_results": "sprintResultId",
    "driver_standings": "driverStandingsId",
    "constructor_standings": "constructorStandingsId",
}
NATURAL_KEYS = {
    "drivers": "driverRef",
    "circuits": "circuitRef",
    "constructors": "constructorRef",
    "status": "status",
}

# Landed files.
HISTORY_TABLES = [*BRONZE_COLUMNS, "constructor_results"]
HISTORY_LAST_YEAR = 2024
FIRST_API_YEAR = 2025
GLOBAL_ENDPOINTS = ["seasons", "status"]
SEASON_ENDPOINTS = ["races", "circuits", "drivers", "constructors"]
ROUND_ENDPOINTS = {
    "results": "Results",
    "qualifying": "QualifyingResults",
    "sprint": "SprintResults",
    "pitstops": "PitStops",
    "laps": "Laps",
    "driverstandings": "DriverStandings",
    "constructorstandings": "ConstructorStandings",
}
SOURCE_VALUES = ("historical", "api")


# Payload schemas, as DDL. Every scalar of the API is text.
_DRIVER_REF = "Driver: struct<driverId: string>"
_TEAM_REF = "Constructor: struct<constructorId: string>"
_SESSION = "struct<date: string, time: string>"
_CIRCUIT = (
    "struct<circuitId: string, circuitName: string, url: string, "
    "Location: struct<lat: string, long: string, locality: string, country: string>>"
)
_RESULT = (
    f"struct<number: string, position: string, positionText: string, points: string, {_DRIVER_REF}, {_TEAM_REF}, "
    "grid: string, laps: string, status: string, Time: struct<millis: string, time: string>, "
    "FastestLap: struct<rank: string, lap: string, Time: struct<time: string>>>"
)
_RACE_HEAD = (
    "season: string, round: string, raceName: string, date: string, time: string, url: string, "
    f"Circuit: {_CIRCUIT}, FirstPractice: {_SESSION}, SecondPractice: {_SESSION}, ThirdPractice: {_SESSION}, "
    f"Qualifying: {_SESSION}, Sprint: {_SESSION}"
)
_STANDING = "position: string, positionText: string, points: string, wins: string"
ROUND_ITEMS = {
    "results": _RESULT,
    "qualifying": (
        f"struct<number: string, position: string, {_DRIVER_REF}, {_TEAM_REF}, Q1: string, Q2: string, Q3: string>"
    ),
    "sprint": _RESULT,
    "pitstops": "struct<driverId: string, lap: string, stop: string, time: string, duration: string>",
    "laps": "struct<number: string, Timings: array<struct<driverId: string, position: string, time: string>>>",
    "driverstandings": f"struct<{_STANDING}, {_DRIVER_REF}>",
    "constructorstandings": f"struct<{_STANDING}, {_TEAM_REF}>",
}
_TABLES: dict[str, tuple[str, str, str]] = {
    "seasons": ("SeasonTable", "Seasons", "struct<season: string, url: string>"),
    "status": ("StatusTable", "Status", "struct<statusId: string, status: string>"),
    "drivers": (
        "DriverTable",
        "Drivers",
        "struct<driverId: string, permanentNumber: string, code: string, givenName: string, familyName: string, "
        "dateOfBirth: string, nationality: string, url: string>",
    ),
    "circuits": ("CircuitTable", "Circuits", _CIRCUIT),
    "constructors": (
        "ConstructorTable",
        "Constructors",
        "struct<constructorId: string, name: string, nationality: string, url: string>",
    ),
    "races": ("RaceTable", "Races", f"struct<{_RACE_HEAD}>"),
    "results": ("RaceTable", "Races", f"struct<{_RACE_HEAD}, Results: array<{ROUND_ITEMS['results']}>>"),
    "qualifying": ("RaceTable", "Races", f"struct<{_RACE_HEAD}, QualifyingResults: array<{ROUND_ITEMS['qualifying']}>>"),
    "sprint": ("RaceTable", "Races", f"struct<{_RACE_HEAD}, SprintResults: array<{ROUND_ITEMS['sprint']}>>"),
    "pitstops": ("RaceTable", "Races", f"struct<{_RACE_HEAD}, PitStops: array<{ROUND_ITEMS['pitstops']}>>"),
    "laps": ("RaceTable", "Races", f"struct<{_RACE_HEAD}, Laps: array<{ROUND_ITEMS['laps']}>>"),
    "driverstandings": (
        "StandingsTable",
        "StandingsLists",
        f"struct<season: string, round: string, DriverStandings: array<{ROUND_ITEMS['driverstandings']}>>",
    ),
    "constructorstandings": (
        "StandingsTable",
        "StandingsLists",
        f"struct<season: string, round: string, ConstructorStandings: array<{ROUND_ITEMS['constructorstandings']}>>",
    ),
}


def payload_path(endpoint: str) -> str:
    """Dotted path to the entry array of an endpoint's payload."""
    table, entries, _ = _TABLES[endpoint]
    return f"MRData.{table}.{entries}"


def payload_schema(endpoint: str) -> str:
    table, entries, entry = _TABLES[endpoint]
    return f"MRData struct<total: string, `limit`: string, `offset`: string, {table}: struct<{entries}: array<{entry}>>>"


def entry_schema(endpoint: str) -> str:
    return _TABLES[endpoint][2]


@dataclass(frozen=True)
class Field:
    """One typed output column: where it comes from and what it becomes."""

    out: str
    source: str
    type: str
    blank_is_null: bool = False


# Typed tables, the bronze tables they come from and their columns. ``clock`` is a validated HH:mm:ss text.
SILVER_FIELDS: dict[str, tuple[str, list[Field]]] = {
    "dim_circuits": (
        "circuits",
        [
            Field("circuit_id", "circuitId", "bigint"),
            Field("circuit_ref", "circuitRef", "string"),
            Field("name", "name", "string"),
            Field("location", "location", "string"),
            Field("country", "country", "string"),
            Field("latitude", "lat", "double"),
            Field("longitude", "lng", "double"),
            Field("altitude", "alt", "int", blank_is_null=True),
            Field("url", "url", "string"),
            Field("source", "source", "string"),
        ],
    ),
    "dim_constructors": (
        "constructors",
        [
            Field("constructor_id", "constructorId", "bigint"),
            Field("constructor_ref", "constructorRef", "string"),
            Field("name", "name", "string"),
            Field("nationality", "nationality", "string"),
            Field("url", "url", "string"),
            Field("source", "source", "string"),
        ],
    ),
    "dim_drivers": (
        "drivers",
        [
            Field("driver_id", "driverId", "bigint"),
            Field("driver_ref", "driverRef", "string"),
            Field("driver_number", "number", "int", blank_is_null=True),
            Field("code", "code", "string"),
            Field("forename", "forename", "string"),
            Field("surname", "surname", "string"),
            Field("date_of_birth", "dob", "date"),
            Field("nationality", "nationality", "string"),
            Field("url", "url", "string"),
            Field("source", "source", "string"),
        ],
    ),
    "dim_races": (
        "races",
        [
            Field("race_id", "raceId", "bigint"),
            Field("year", "year", "int"),
            Field("round", "round", "int"),
            Field("circuit_id", "circuitId", "bigint"),
            Field("name", "name", "string"),
            Field("race_date", "date", "date"),
            Field("race_time", "time", "clock"),
            Field("url", "url", "string"),
            Field("fp1_date", "fp1_date", "date"),
            Field("fp1_time", "fp1_time", "clock"),
            Field("fp2_date", "fp2_date", "date"),
            Field("fp2_time", "fp2_time", "clock"),
            Field("fp3_date", "fp3_date", "date"),
            Field("fp3_time", "fp3_time", "clock"),
            Field("quali_date", "quali_date", "date"),
            Field("quali_time", "quali_time", "clock"),
            Field("sprint_date", "sprint_date", "date"),
            Field("sprint_time", "sprint_time", "clock"),
            Field("source", "source", "string"),
        ],
    ),
    "dim_seasons": (
        "seasons",
        [
            Field("year", "year", "int"),
            Field("url", "url", "string"),
            Field("source", "source", "string"),
        ],
    ),
    "dim_status": (
        "status",
        [
            Field("status_id", "statusId", "bigint"),
            Field("status", "status", "string"),
            Field("source", "source", "string"),
        ],
    ),
    "fact_results": (
        "results",
        [
            Field("result_id", "resultId", "bigint"),
            Field("race_id", "raceId", "bigint"),
            Field("driver_id", "driverId", "bigint"),
            Field("constructor_id", "constructorId", "bigint"),
            Field("driver_number", "number", "int", blank_is_null=True),
            Field("grid_position", "grid", "smallint"),
            Field("finish_position", "position", "smallint", blank_is_null=True),
            Field("position_text", "positionText", "string"),
            Field("position_order", "positionOrder", "bigint"),
            Field("points", "points", "decimal(5,2)"),
            Field("laps_completed", "laps", "smallint"),
            Field("race_time", "time", "string"),
            Field("race_milliseconds", "milliseconds", "bigint"),
            Field("fastest_lap_number", "fastestLap", "smallint", blank_is_null=True),
            Field("fastest_lap_rank", "rank", "smallint", blank_is_null=True),
            Field("fastest_lap_time", "fastestLapTime", "string"),
            Field("fastest_lap_speed", "fastestLapSpeed", "string"),
            Field("status_id", "statusId", "bigint"),
            Field("source", "source", "string"),
        ],
    ),
    "fact_qualifying": (
        "qualifying",
        [
            Field("qualify_id", "qualifyId", "bigint"),
            Field("race_id", "raceId", "bigint"),
            Field("driver_id", "driverId", "bigint"),
            Field("constructor_id", "constructorId", "bigint"),
            Field("driver_number", "number", "int", blank_is_null=True),
            Field("qualifying_position", "position", "smallint"),
            Field("q1_time", "q1", "string"),
            Field("q2_time", "q2", "string"),
            Field("q3_time", "q3", "string"),
            Field("source", "source", "string"),
        ],
    ),
    "fact_sprint_results": (
        "sprint_results",
        [
            Field("sprint_result_id", "sprintResultId", "bigint"),
            Field("race_id", "raceId", "bigint"),
            Field("driver_id", "driverId", "bigint"),
            Field("constructor_id", "constructorId", "bigint"),
            Field("driver_number", "number", "int", blank_is_null=True),
            Field("grid_position", "grid", "smallint"),
            Field("finish_position", "position", "smallint", blank_is_null=True),
            Field("position_text", "positionText", "string"),
            Field("position_order", "positionOrder", "bigint"),
            Field("points", "points", "decimal(5,2)"),
            Field("laps_completed", "laps", "smallint"),
            Field("sprint_time", "time", "string"),
            Field("sprint_milliseconds", "milliseconds", "bigint"),
            Field("fastest_lap_number", "fastestLap", "smallint", blank_is_null=True),
            Field("fastest_lap_time", "fastestLapTime", "string"),
            Field("status_id", "statusId", "bigint"),
            Field("source", "source", "string"),
        ],
    ),
    "fact_lap_times": (
        "lap_times",
        [
            Field("race_id", "raceId", "bigint"),
            Field("driver_id", "driverId", "bigint"),
            Field("lap_number", "lap", "smallint"),
            Field("lap_position", "position", "smallint"),
            Field("lap_time", "time", "string"),
            Field("lap_milliseconds", "milliseconds", "bigint"),
            Field("source", "source", "string"),
        ],
    ),
    "fact_pit_stops": (
        "pit_stops",
        [
            Field("race_id", "raceId", "bigint"),
            Field("driver_id", "driverId", "bigint"),
            Field("stop_number", "stop", "smallint"),
            Field("lap_number", "lap", "smallint"),
            Field("stop_time", "time", "string"),
            Field("stop_duration", "duration", "string"),
            Field("stop_milliseconds", "milliseconds", "bigint"),
            Field("source", "source", "string"),
        ],
    ),
    "fact_driver_standings": (
        "driver_standings",
        [
            Field("driver_standings_id", "driverStandingsId", "bigint"),
            Field("race_id", "raceId", "bigint"),
            Field("driver_id", "driverId", "bigint"),
            Field("points", "points", "decimal(5,2)"),
            Field("championship_position", "position", "smallint"),
            Field("position_text", "positionText", "string"),
            Field("wins", "wins", "smallint"),
            Field("source", "source", "string"),
        ],
    ),
    "fact_constructor_standings": (
        "constructor_standings",
        [
            Field("constructor_standings_id", "constructorStandingsId", "bigint"),
            Field("race_id", "raceId", "bigint"),
            Field("constructor_id", "constructorId", "bigint"),
            Field("points", "points", "decimal(5,2)"),
            Field("championship_position", "position", "smallint"),
            Field("position_text", "positionText", "string"),
            Field("wins", "wins", "smallint"),
            Field("source", "source", "string"),
        ],
    ),
}

# Status categories in matching order, with their patterns.
STATUS_RULES: list[tuple[str, list[str]]] = [
    ("Finished", ["%finished%"]),
    ("Disqualified", ["%disqualified%"]),
    ("Excluded", ["%excluded%"]),
    ("Withdrawn", ["%withdrawn%"]),
    ("Accident", ["%accident%"]),
    ("Collision", ["%collision%"]),
    ("Mechanical", ["%mechanical%"]),
    ("Engine", ["%engine%"]),
    ("Gearbox", ["%gearbox%"]),
    ("Transmission", ["%transmission%"]),
    ("Hydraulics", ["%hydraulics%"]),
    ("Electrical", ["%electrical%"]),
    ("Brakes", ["%brakes%"]),
    ("Suspension", ["%suspension%"]),
    ("Tyre", ["%tyre%", "%tire%"]),
    ("Wheel", ["%wheel%"]),
    ("Fuel", ["%fuel%"]),
    ("Oil", ["%oil%"]),
    ("Overheating", ["%overheating%"]),
    ("Fire", ["%fire%"]),
    ("Not Classified", ["%not classified%"]),
    ("Did Not Start", ["%did not start%", "%dns%"]),
    ("Did Not Qualify", ["%did not qualify%", "%dnq%"]),
    ("Did Not Pre-Qualify", ["%did not pre-qualify%", "%dnpq%"]),
    ("107% Rule", ["%107%"]),
    ("Suspended", ["%suspended%"]),
    ("Red Flag", ["%red flag%"]),
]
STATUS_DEFAULT = "Other"
STATUS_FINISHED = "Finished"


# Declared rules of the typed tables and the marts.
UNIQUE_COLUMNS: dict[str, list[str]] = {
    "dim_drivers": ["driver_id"],
    "dim_constructors": ["constructor_id"],
    "dim_circuits": ["circuit_id"],
    "dim_races": ["race_id"],
    "dim_status": ["status_id"],
    "dim_seasons": ["year"],
    "fact_results": ["result_id"],
    "fact_qualifying": ["qualify_id"],
    "fact_sprint_results": ["sprint_result_id"],
    "fact_driver_standings": ["driver_standings_id"],
    "fact_constructor_standings": ["constructor_standings_id"],
    "race_results_detail": ["race_driver_key"],
    "driver_season_summary": ["driver_id_season"],
    "constructor_season_summary": ["constructor_id_season"],
    "championship_standings": ["driver_race_key"],
    "lap_time_analysis": ["lap_analysis_key"],
    "pit_stop_analysis": ["pit_analysis_key"],
    "qualifying_vs_race": ["quali_race_key"],
    "driver_career": ["driver_id"],
    "constructor_career": ["constructor_id"],
    "circuit_stats": ["circuit_id"],
}
NOT_NULL_COLUMNS: dict[str, list[str]] = {
    "dim_drivers": ["driver_id", "driver_ref"],
    "dim_constructors": ["constructor_id", "constructor_ref", "name"],
    "dim_circuits": ["circuit_id", "circuit_ref", "name", "country"],
    "dim_races": ["race_id", "year", "round", "circuit_id"],
    "dim_status": ["status_id", "status", "status_category"],
    "dim_seasons": ["year"],
    "fact_results": ["result_id", "race_id", "driver_id", "constructor_id", "status_id", "points"],
    "fact_qualifying": ["qualify_id", "race_id", "driver_id", "constructor_id"],
    "fact_sprint_results": ["sprint_result_id", "race_id", "driver_id", "constructor_id", "status_id"],
    "fact_lap_times": ["race_id", "driver_id", "lap_number"],
    "fact_pit_stops": ["race_id", "driver_id", "stop_number"],
    "fact_driver_standings": ["driver_standings_id", "race_id", "driver_id", "points"],
    "fact_constructor_standings": ["constructor_standings_id", "race_id", "constructor_id", "points"],
    "race_results_detail": [
        "race_driver_key", "driver_key", "constructor_key", "circuit_key", "status_key", "season", "round",
        "race_name", "race_date", "driver_name", "driver_nationality", "constructor_name", "constructor_nationality",
        "circuit_name", "circuit_country", "grid_position", "points", "laps_completed", "status_category", "is_dnf",
        "is_points_finish", "is_podium", "is_win", "source",
    ],
    "driver_season_summary": [
        "driver_id_season", "driver_id", "season", "driver_name", "team", "races_entered", "wins", "podiums",
        "points", "poles", "fastest_laps", "dnfs", "source",
    ],
    "constructor_season_summary": [
        "constructor_id_season", "constructor_id", "season", "constructor_name", "races_entered", "wins", "podiums",
        "points", "one_two_finishes", "poles", "fastest_laps", "dnfs", "source",
    ],
    "championship_standings": [
        "driver_race_key", "driver_id", "race_id", "season", "round", "driver_name", "team", "cumulative_points",
        "championship_position", "points_behind_leader", "wins_so_far", "podiums_so_far", "source",
    ],
    "lap_time_analysis": [
        "lap_analysis_key", "race_id", "driver_id", "lap_number", "lap_ms", "is_race_fastest_lap", "is_lap_fastest",
        "drivers_on_lap", "season", "round", "race_name", "circuit_name", "driver_name", "source",
    ],
    "pit_stop_analysis": [
        "pit_analysis_key", "race_id", "driver_id", "stop_number", "total_pit_ms", "total_stops",
        "is_fastest_stop_in_race", "is_slow_stop", "season", "race_name", "driver_name", "source",
    ],
    "qualifying_vs_race": [
        "quali_race_key", "race_id", "driver_id", "qualifying_position", "grid_position", "is_pole", "is_win",
        "is_podium", "is_dnf", "season", "driver_name",
    ],
    "driver_career": [
        "driver_id", "driver_name", "first_season", "last_season", "seasons", "races_entered", "wins", "podiums",
        "poles", "fastest_laps", "total_points", "dnfs", "teams_raced_for", "championships_won",
    ],
    "constructor_career": [
        "constructor_id", "constructor_name", "first_season", "last_season", "seasons", "races_entered", "wins",
        "podiums", "poles", "fastest_laps", "total_points", "championships_won",
    ],
    "circuit_stats": [
        "circuit_id", "circuit_name", "circuit_country", "seasons_hosted", "races_hosted", "first_season",
        "last_season", "unique_drivers", "total_wins", "total_dnfs",
    ],
}
RELATIONSHIPS: list[tuple[str, str, str]] = [
    ("dim_races", "circuit_id", "dim_circuits"),
    ("fact_results", "race_id", "dim_races"),
    ("fact_results", "driver_id", "dim_drivers"),
    ("fact_results", "constructor_id", "dim_constructors"),
    ("fact_results", "status_id", "dim_status"),
    ("fact_qualifying", "race_id", "dim_races"),
    ("fact_qualifying", "driver_id", "dim_drivers"),
    ("fact_qualifying", "constructor_id", "dim_constructors"),
    ("fact_sprint_results", "race_id", "dim_races"),
    ("fact_sprint_results", "driver_id", "dim_drivers"),
    ("fact_sprint_results", "constructor_id", "dim_constructors"),
    ("fact_sprint_results", "status_id", "dim_status"),
    ("fact_lap_times", "race_id", "dim_races"),
    ("fact_lap_times", "driver_id", "dim_drivers"),
    ("fact_pit_stops", "race_id", "dim_races"),
    ("fact_pit_stops", "driver_id", "dim_drivers"),
    ("fact_driver_standings", "race_id", "dim_races"),
    ("fact_driver_standings", "driver_id", "dim_drivers"),
    ("fact_constructor_standings", "race_id", "dim_races"),
    ("fact_constructor_standings", "constructor_id", "dim_constructors"),
]

# Foreign keys of the bronze tables: table, column, parent.
BRONZE_FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("races", "circuitId", "circuits"),
    ("results", "raceId", "races"),
    ("results", "driverId", "drivers"),
    ("results", "constructorId", "constructors"),
    ("results", "statusId", "status"),
    ("qualifying", "raceId", "races"),
    ("qualifying", "driverId", "drivers"),
    ("qualifying", "constructorId", "constructors"),
    ("sprint_results", "raceId", "races"),
    ("sprint_results", "driverId", "drivers"),
    ("sprint_results", "constructorId", "constructors"),
    ("lap_times", "raceId", "races"),
    ("lap_times", "driverId", "drivers"),
    ("pit_stops", "raceId", "races"),
    ("pit_stops", "driverId", "drivers"),
    ("driver_standings", "raceId", "races"),
    ("driver_standings", "driverId", "drivers"),
    ("constructor_standings", "raceId", "races"),
    ("constructor_standings", "constructorId", "constructors"),
]
