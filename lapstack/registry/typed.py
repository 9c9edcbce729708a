"""Registered typed tables and sample queries over the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapstack.plans import samples
from lapstack.plans.silver import classify_status, silver_table
from lapstack.plans.star_bronze import bronze_tables
from lapstack.registry.core import register
from lapstack.registry.sql import half_up
from lapstack.schemas import BRONZE_COLUMNS, SILVER_FIELDS
from lapstack.session import scratch_path
from lapstack.sources.files import read_text_csv
from lapstack.sources.sinks import create_layers, export_bundle, load_warehouse, validate_load, write_bronze

_KINDS = {
    "bigint": "long",
    "int": "long",
    "smallint": "long",
    "double": "double",
    "decimal(5,2)": "double",
    "string": "text",
    "date": "text",
    "clock": "text",
}


def _silver(name: str):
    return lambda t: silver_table(name, bronze_tables(t)[SILVER_FIELDS[name][0]])


def _fold(column: str, size: int) -> str:
    return f"(({column} - 1) % {size} + 1)"


_NUMBER = "CASE WHEN driver_id % 3 <> 0 THEN driver_id % 100 END AS driver_number"
_POSITION = f"CASE WHEN finish_position IS NOT NULL THEN {_fold('finish_position', 20)} END"
_RESULT = (
    f"race_id, driver_id, constructor_id, {_NUMBER}, {_fold('grid_position', 20)} AS grid_position, "
    f"{_POSITION} AS finish_position, coalesce(CAST({_POSITION} AS VARCHAR), 'R') AS position_text, "
    f"{_fold('grid_position', 1000)} AS position_order, driver_id % 500 + 0.50 AS points, status_id, source"
)
_STANDING_POSITION = _fold("grid_position", 20)

# typed tables over the star schema, written directly with their types
TYPED: dict[str, tuple[str, list[str]]] = {
    "dim_circuits": (
        "SELECT circuit_id, circuit_ref, name, location, country, latitude, longitude, "
        "CASE WHEN circuit_id <> 3 THEN altitude END AS altitude, NULL AS url, 'historical' AS source FROM circuits",
        ["circuits"],
    ),
    "dim_constructors": (
        "SELECT constructor_id, constructor_ref, name, nationality, NULL AS url, source FROM teams",
        ["teams"],
    ),
    "dim_drivers": (
        f"SELECT * EXCLUDE (driver_number), {_NUMBER}, NULL AS url FROM drivers",
        ["drivers"],
    ),
    "dim_races": (
        "SELECT race_id, year, round, circuit_id, name, race_date, "
        "CASE WHEN round % 2 = 0 THEN '14:00:00' END AS race_time, NULL AS url, race_date AS fp1_date, "
        "lpad(CAST(round AS VARCHAR), 2, '0') || ':30:00' AS fp1_time, NULL AS fp2_date, NULL AS fp2_time, "
        "NULL AS fp3_date, NULL AS fp3_time, race_date AS quali_date, '13:00:00' AS quali_time, "
        "CASE WHEN round IN (4, 8, 12) THEN race_date END AS sprint_date, "
        "CASE WHEN round IN (4, 8, 12) THEN '10:15:00' END AS sprint_time, source FROM races",
        ["races"],
    ),
    "dim_seasons": (
        "SELECT DISTINCT year(o_orderdate) AS year, 'http://seasons/' || year(o_orderdate) AS url, "
        "'historical' AS source FROM orders",
        [],
    ),
    "dim_status": ("SELECT status_id, status, status_category, 'historical' AS source FROM status", ["status"]),
    "fact_results": (
        f"SELECT result_id, {_RESULT}, laps_completed % 1000 AS laps_completed, NULL AS race_time, "
        "driver_id % 1000 + 5000000 AS race_milliseconds, "
        "CASE WHEN fastest_lap_number % 2 = 0 THEN fastest_lap_number END AS fastest_lap_number, "
        "CASE WHEN fastest_lap_rank <= 15 THEN fastest_lap_rank END AS fastest_lap_rank, fastest_lap_time, "
        "NULL AS fastest_lap_speed FROM results",
        ["results"],
    ),
    "fact_qualifying": (
        f"SELECT qualify_id, race_id, driver_id, constructor_id, {_NUMBER}, "
        f"{_fold('qualifying_position', 20)} AS qualifying_position, q1_time, q2_time, q3_time, source FROM quali",
        ["quali"],
    ),
    "fact_sprint_results": (
        f"SELECT sprint_result_id, {_RESULT}, driver_id % 30 AS laps_completed, NULL AS sprint_time, "
        "driver_id % 1000 + 5000000 AS sprint_milliseconds, NULL AS fastest_lap_number, NULL AS fastest_lap_time "
        "FROM sprints",
        ["sprints"],
    ),
    "fact_lap_times": (
        f"SELECT race_id, driver_id, {_fold('lap_number', 1000)} AS lap_number, lap_position, lap_time, "
        "lap_milliseconds, source FROM laps",
        ["laps"],
    ),
    "fact_pit_stops": (
        f"SELECT race_id, driver_id, {_fold('stop_number', 1000)} AS stop_number, {_fold('lap_number', 1000)} AS "
        "lap_number, stop_time, stop_duration, stop_milliseconds, source FROM pits",
        ["pits"],
    ),
    "fact_driver_standings": (
        "SELECT race_id * 1000000000000 + driver_id AS driver_standings_id, race_id, driver_id, "
        f"driver_id % 500 + 0.25 AS points, {_STANDING_POSITION} AS championship_position, "
        f"CAST({_STANDING_POSITION} AS VARCHAR) AS position_text, driver_id % 5 AS wins, source FROM entries",
        ["entries"],
    ),
    "fact_constructor_standings": (
        "SELECT race_id * 1000000000000 + constructor_id AS constructor_standings_id, race_id, constructor_id, "
        "count(*) % 500 AS points, count(*) % 20 + 1 AS championship_position, "
        "CAST(count(*) % 20 + 1 AS VARCHAR) AS position_text, count(*) % 5 AS wins, source "
        "FROM entries GROUP BY race_id, constructor_id, source",
        ["entries"],
    ),
}

for _number, _name in enumerate(SILVER_FIELDS, 1):
    _columns = " ".join(f"{f.out}:{_KINDS[f.type]}" for f in SILVER_FIELDS[_name][1])
    if _name == "dim_status":
        _columns += " status_category:text"
    register(f"sil_{_number}_{_name}", _columns, _silver(_name), *TYPED[_name])


# status texts built from a table large enough to reach many rules
_PHRASES = (
    "CASE p_partkey % 9 WHEN 0 THEN 'Finished' WHEN 1 THEN '+2 Laps' WHEN 2 THEN 'Engine fire ' WHEN 3 THEN 'TYRE ' "
    "WHEN 4 THEN 'Did not prequalify ' WHEN 5 THEN 'red flag ' WHEN 6 THEN 'DNPQ ' WHEN 7 THEN '107% rule ' "
    "ELSE 'Oil leak ' END || p_name || ' ' || p_type"
)
_CATEGORY_SQL = """CASE
        WHEN status ILIKE '%finished%' THEN 'Finished'
        WHEN status ILIKE '%disqualified%' THEN 'Disqualified'
        WHEN status ILIKE '%excluded%' THEN 'Excluded'
        WHEN status ILIKE '%withdrawn%' THEN 'Withdrawn'
        WHEN status ILIKE '%accident%' THEN 'Accident'
        WHEN status ILIKE '%collision%' THEN 'Collision'
        WHEN status ILIKE '%mechanical%' THEN 'Mechanical'
        WHEN status ILIKE '%engine%' THEN 'Engine'
        WHEN status ILIKE '%gearbox%' THEN 'Gearbox'
        WHEN status ILIKE '%transmission%' THEN 'Transmission'
        WHEN status ILIKE '%hydraulics%' THEN 'Hydraulics'
        WHEN status ILIKE '%electrical%' THEN 'Electrical'
        WHEN status ILIKE '%brakes%' THEN 'Brakes'
        WHEN status ILIKE '%suspension%' THEN 'Suspension'
        WHEN status ILIKE '%tyre%' OR status ILIKE '%tire%' THEN 'Tyre'
        WHEN status ILIKE '%wheel%' THEN 'Wheel'
        WHEN status ILIKE '%fuel%' THEN 'Fuel'
        WHEN status ILIKE '%oil%' THEN 'Oil'
        WHEN status ILIKE '%overheating%' THEN 'Overheating'
        WHEN status ILIKE '%fire%' THEN 'Fire'
        WHEN status ILIKE '%not classified%' THEN 'Not Classified'
        WHEN status ILIKE '%did not start%' OR status ILIKE '%dns%' THEN 'Did Not Start'
        WHEN status ILIKE '%did not qualify%' OR status ILIKE '%dnq%' THEN 'Did Not Qualify'
        WHEN status ILIKE '%did not pre-qualify%' OR status ILIKE '%dnpq%' THEN 'Did Not Pre-Qualify'
        WHEN status ILIKE '%107%' THEN '107% Rule'
        WHEN status ILIKE '%suspended%' THEN 'Suspended'
        WHEN status ILIKE '%red flag%' THEN 'Red Flag'
        ELSE 'Other' END"""
register(
    "sil_6_status_classifier",
    "p_partkey status_category:text",
    lambda t: classify_status(t.raw("part").select("p_partkey", F.expr(_PHRASES).alias("status"))),
    f"SELECT p_partkey, {_CATEGORY_SQL} AS status_category "
    f"FROM (SELECT p_partkey, {_PHRASES} AS status FROM part)",
)

# ---- sample queries ---------------------------------------------------------------------


def _views(*names: str) -> tuple[str, list[str]]:
    """Sub-selects for the named typed tables and the views they need."""
    text = ", ".join(f"{n} AS ({TYPED[n][0]})" for n in names)
    return f"WITH {text} ", [v for n in names for v in TYPED[n][1]]


def _sample(function, *names: str, **params):
    return lambda t: function(*[bronze_tables(t)[n] for n in names], **params)


def _register_sample(key: str, columns: str, plan, tables: list[str], body: str) -> None:
    prefix, views = _views(*tables)
    register(key, columns, plan, prefix + body, views)


def _loaded(tables, *names: str):
    """Tables as loading leaves them: an empty text is NULL."""
    return {n: tables[n].select(*[F.nullif(c, F.lit("")).alias(c) for c in tables[n].columns]) for n in names}


_LATEST = "(SELECT max(year) FROM dim_races)"
_SILVER_OF = {bronze: name for name, (bronze, _) in SILVER_FIELDS.items()}


def _validated(t):
    """All bronze tables loaded from their files into a fresh database and counted there."""
    root = scratch_path(t.spark, "warehouse")
    bronze = "bronze_" + root.rsplit("-", 1)[1][:12]
    create_layers(t.spark, [bronze], root)
    for name, columns in BRONZE_COLUMNS.items():
        write_bronze(bronze_tables(t)[name], f"{root}/files/{name}", columns)
    load_warehouse(t.spark, f"{root}/files", bronze)
    return validate_load(t.spark, bronze)


def _bundled(t):
    """All bronze tables bundled as CSV folders, each read back and counted."""
    root = scratch_path(t.spark, "bundle")
    export_bundle(bronze_tables(t), root)
    return samples.row_counts({n: read_text_csv(t.spark, f"{root}/{n}", [*c, "source"]) for n, c in BRONZE_COLUMNS.items()})


_ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{b}' AS table_name, count(*) AS row_count FROM {_SILVER_OF[b]}" for b in BRONZE_COLUMNS
)
for _name, _plan in (
    ("smp_1_row_counts", lambda t: samples.row_counts(bronze_tables(t))),
    ("snk_3_load_validation", _validated),
    ("snk_5_bundle_counts", _bundled),
):
    _register_sample(_name, "table_name:text row_count", _plan, list(TYPED), _ROW_COUNTS)
_register_sample(
    "smp_2_lineage",
    "source:text row_count",
    _sample(samples.lineage, "drivers"),
    ["dim_drivers"],
    "SELECT source, count(*) AS row_count FROM dim_drivers GROUP BY source",
)
_register_sample(
    "smp_3_latest_races",
    "year round name:text date:text source:text",
    _sample(samples.latest_races, "races"),
    ["dim_races"],
    "SELECT year, round, name, race_date AS date, source FROM dim_races ORDER BY year DESC, round DESC LIMIT 10",
)
_register_sample(
    "smp_4_orphaned_results",
    "orphaned_results",
    lambda t: samples.orphaned_results(bronze_tables(t)["results"], bronze_tables(t)["races"].filter("round <> '7'")),
    ["fact_results", "dim_races"],
    "SELECT count(*) AS orphaned_results FROM fact_results r WHERE r.race_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM dim_races x WHERE x.race_id = r.race_id AND x.round <> 7)",
)
_register_sample(
    "smp_5_driver_statistics",
    "driverId forename:text surname:text nationality:text races wins podiums",
    _sample(samples.driver_statistics, "drivers", "results", source="api"),
    ["dim_drivers", "fact_results"],
    "SELECT d.driver_id AS driverId, forename, surname, nationality, count(result_id) AS races, "
    "count(*) FILTER (finish_position = 1) AS wins, count(*) FILTER (finish_position <= 3) AS podiums "
    "FROM dim_drivers d LEFT JOIN fact_results r ON r.driver_id = d.driver_id WHERE d.source = 'api' "
    "GROUP BY d.driver_id, forename, surname, nationality",
)
_register_sample(
    "smp_6_latest_season_entries",
    "year round race_name:text circuit_name:text finishers",
    _sample(samples.season_entries, "races", "circuits", "results"),
    ["dim_races", "dim_circuits", "fact_results"],
    "SELECT r.year, r.round, r.name AS race_name, c.name AS circuit_name, count(*) AS finishers FROM dim_races r "
    "JOIN dim_circuits c ON c.circuit_id = r.circuit_id LEFT JOIN fact_results e ON e.race_id = r.race_id "
    f"WHERE r.year = {_LATEST} GROUP BY r.year, r.round, r.name, c.name",
)
_register_sample(
    "smp_7_constructor_performance",
    "constructorId name:text races wins avg_points:double",
    _sample(samples.constructor_performance, "constructors", "results", "races"),
    ["dim_constructors", "fact_results", "dim_races"],
    "SELECT k.constructor_id AS constructorId, k.name, count(result_id) AS races, "
    "count(*) FILTER (finish_position = 1) AS wins, "
    f"{half_up('sum(CAST(points * 2 AS BIGINT))', '(2 * count(points))', 2)} AS avg_points "
    "FROM dim_constructors k JOIN fact_results e ON e.constructor_id = k.constructor_id "
    f"JOIN dim_races r ON r.race_id = e.race_id WHERE r.year = {_LATEST} GROUP BY k.constructor_id, k.name",
)
_register_sample(
    "smp_8_stop_comparison",
    "year round name:text driver:text pit_stops fastest_stop_ms slowest_stop_ms",
    _sample(samples.stop_comparison, "pit_stops", "drivers", "races"),
    ["fact_pit_stops", "dim_drivers", "dim_races"],
    "SELECT r.year, r.round, r.name, forename || ' ' || surname AS driver, count(stop_number) AS pit_stops, "
    "min(stop_milliseconds) AS fastest_stop_ms, max(stop_milliseconds) AS slowest_stop_ms FROM fact_pit_stops s "
    "JOIN dim_drivers d ON d.driver_id = s.driver_id JOIN dim_races r ON r.race_id = s.race_id "
    f"WHERE r.year = {_LATEST} GROUP BY r.year, r.round, r.name, forename, surname",
)
_register_sample(
    "smp_9_lap_listing",
    "driver:text lap time:text milliseconds position",
    _sample(samples.lap_listing, "lap_times", "drivers", "races", round=1),
    ["fact_lap_times", "dim_drivers", "dim_races"],
    "SELECT forename || ' ' || surname AS driver, lap_number AS lap, lap_time AS time, "
    "lap_milliseconds AS milliseconds, lap_position AS position FROM fact_lap_times t "
    "JOIN dim_drivers d ON d.driver_id = t.driver_id JOIN dim_races r ON r.race_id = t.race_id "
    f"WHERE r.year = {_LATEST} AND r.round = 1 ORDER BY lap, milliseconds, driver, position LIMIT 50",
)
_register_sample(
    "smp_10_qualifying_listing",
    "year round driver:text quali_pos grid_pos race_pos points:double",
    lambda t: samples.qualifying_listing(*_loaded(bronze_tables(t), "qualifying", "drivers", "races", "results").values()),
    ["fact_qualifying", "dim_drivers", "dim_races", "fact_results"],
    "SELECT r.year, r.round, forename || ' ' || surname AS driver, qualifying_position AS quali_pos, "
    "grid_position AS grid_pos, finish_position AS race_pos, points FROM fact_qualifying q "
    "JOIN dim_drivers d ON d.driver_id = q.driver_id JOIN dim_races r ON r.race_id = q.race_id "
    "LEFT JOIN fact_results e ON e.race_id = r.race_id AND e.driver_id = d.driver_id "
    f"WHERE r.year = {_LATEST}",
)
