"""Registered build from landed files: history as CSV, later seasons as year documents, all the way to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.operators.scans import ordered_scan, row_number
from lapstack.plans.models import build_models
from lapstack.plans.normalise import normalise, write_all
from lapstack.plans.star_bronze import bronze_tables
from lapstack.registry.core import register
from lapstack.registry.sources import _layers
from lapstack.schemas import BRONZE_COLUMNS, ID_COLUMNS
from lapstack.session import scratch_path
from lapstack.sources.documents import write_documents, write_entries
from lapstack.sources.files import BY_ENDPOINT
from lapstack.sources.sinks import create_layers, load_warehouse, write_csv

_FIRST = 1996  # first season that comes as documents
_TWICE = 10**15  # the id under which the history names the first driver once more, further down
_FACTS = ("results", "qualifying", "sprint_results", "lap_times", "pit_stops", "driver_standings", "constructor_standings")


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _land_history(t, root: str) -> None:
    """Tables of the seasons before the first documents; every tenth driver is not known yet, the first one twice."""
    tables = dict(bronze_tables(t))
    season = F.floor(F.col("raceId").cast("bigint") / 100)
    drivers = tables["drivers"].filter(F.col("driverId").cast("bigint") % 10 != 0)
    again = drivers.filter("driverId = '1'").withColumn("driverId", F.lit(str(_TWICE)))
    kept = {
        "seasons": tables["seasons"].filter(F.col("year").cast("int") < _FIRST),
        "drivers": drivers.unionByName(again),
        "races": tables["races"].filter(F.col("year").cast("int") < _FIRST),
        **{f: tables[f].filter(season < _FIRST) for f in _FACTS},
    }
    for name, columns in BRONZE_COLUMNS.items():
        rows = kept.get(name, tables[name]).select(*columns)
        if name in ID_COLUMNS:
            rows = rows.orderBy(F.col(ID_COLUMNS[name]).cast("bigint"))
        write_csv(rows, f"{root}/{name}.csv")


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    return ordered_scan(rows, ["season", "round"], [F.col(c).asc() for c in order], {"place": row_number()})


def _land_documents(t, root: str) -> None:
    """Everything of the later seasons, one document for an endpoint and year."""
    named = {
        "driver_id": t["dim_drivers"].select("driver_id", F.col("driver_ref").alias("driver")),
        "constructor_id": t["dim_constructors"].select("constructor_id", F.col("constructor_ref").alias("team")),
        "status_id": t["dim_status"].select("status_id", F.col("status").alias("status_text")),
    }
    late = t["entries"].filter(F.col("season") >= _FIRST)
    for key, names in named.items():
        late = late.join(names, key)
    races = t["dim_races"].filter(F.col("year") >= _FIRST)
    who = F.struct(F.col("driver").alias("driverId")).alias("Driver")
    team = F.struct(F.col("team").alias("constructorId")).alias("Constructor")
    position = _text((F.col("grid_position") - 1) % 20 + 1)
    points = _text(F.col("driver_id") % 500)
    result = F.struct(
        _text("driver_id").alias("number"), position.alias("position"), position.alias("positionText"), points.alias("points"),
        who, team, position.alias("grid"), _text(F.col("laps_completed") % 1000).alias("laps"), F.col("status_text").alias("status"),
    )
    standing = (points.alias("points"), position.alias("position"), position.alias("positionText"), F.lit("0").alias("wins"))

    def of_races(name: str) -> DataFrame:
        rows = t[name].join(races.select("race_id", F.col("year").alias("season"), "round"), "race_id")
        return rows.join(named["driver_id"], "driver_id")

    timing = F.struct(F.col("driver").alias("driverId"), _text("lap_position").alias("position"), F.lit("1:30.5").alias("time"))
    stop = F.struct(
        F.col("driver").alias("driverId"), _text(F.col("lap_number") % 1000).alias("lap"), _text(F.col("stop_number") % 1000).alias("stop"),
        F.lit("12:00:00").alias("time"), F.lit("20.5").alias("duration"),
    )
    teams = late.groupBy("season", "round", "constructor_id", "team").agg(F.count(F.lit(1)).alias("driver_id"))
    teams = teams.withColumn("grid_position", F.col("driver_id"))
    items = {
        "results": (_placed(late, "driver_id"), result),
        "qualifying": (
            _placed(late.filter(F.col("driver_id") % 5 != 0), "driver_id"),
            F.struct(_text("driver_id").alias("number"), position.alias("position"), who, team, F.lit("1:20.5").alias("Q1")),
        ),
        "sprint": (_placed(late.filter(F.col("round").isin(4, 8, 12)), "driver_id"), result),
        "laps": (
            _placed(of_races("fact_lap_times"), "driver_id", "lap_number"),
            F.struct(_text(F.col("lap_number") % 1000).alias("number"), F.array(timing).alias("Timings")),
        ),
        "pitstops": (_placed(of_races("fact_pit_stops"), "driver_id", "stop_number"), stop),
        "driverstandings": (_placed(late, "driver_id"), F.struct(*standing, who)),
        "constructorstandings": (_placed(teams, "constructor_id"), F.struct(*standing, team)),
    }
    for endpoint, (rows, payload) in items.items():
        write_documents(rows, f"{root}/{endpoint}", endpoint, "season", ["season", "round"], "place", payload)

    circuit = F.struct(F.col("circuit_ref").alias("circuitId"))
    first = F.lit(_FIRST).alias("season")
    calendar = races.join(t["dim_circuits"].select("circuit_id", "circuit_ref"), "circuit_id").withColumn("season", F.col("year"))
    race = F.struct(
        _text("season").alias("season"), _text("round").alias("round"), F.col("name").alias("raceName"),
        _text("race_date").alias("date"), circuit.alias("Circuit"),
    )
    write_entries(calendar, f"{root}/races", "races", "season", ["season", "round"], race)
    rookies = t["dim_drivers"].filter(F.col("driver_id") % 10 == 0).select("*", first)
    driver = F.struct(F.col("driver_ref").alias("driverId"), F.col("forename").alias("givenName"))
    write_entries(rookies, f"{root}/drivers", "drivers", "season", ["driver_id"], driver)
    places = t["dim_circuits"].select("*", first)
    write_entries(places, f"{root}/circuits", "circuits", "season", ["circuit_id"], circuit)
    known = t["dim_constructors"].select("*", first)
    write_entries(known, f"{root}/constructors", "constructors", "season", ["constructor_id"], F.struct(F.col("constructor_ref").alias("constructorId")))
    years = t["dim_seasons"].select("year", first)
    write_entries(years, f"{root}/seasons.json", "seasons", "season", ["year"], F.struct(_text("year").alias("season")))
    states = t["dim_status"].select("status_id", "status", first)
    write_entries(states, f"{root}/status.json", "status", "season", ["status_id"], F.struct("status"))


def _built(t) -> DataFrame:
    """Landed files, bronze files, loaded tables, and the hub over them: rows and sums of ids of every bronze table."""
    raw, api, files = (scratch_path(t.spark, n) for n in ("raw", "api", "files"))
    _land_history(t, raw)
    _land_documents(t, api)
    write_all(normalise(t.spark, raw, api, _FIRST, BY_ENDPOINT), files)
    bronze, prefix = _layers(t, "bronze", "layer")
    load_warehouse(t.spark, files, bronze)
    create_layers(t.spark, [f"{prefix}_silver", f"{prefix}_marts"], scratch_path(t.spark, "warehouse"))
    build_models(t.spark, ["race_results_detail"], bronze, f"{prefix}_")
    parts = []
    for name, columns in BRONZE_COLUMNS.items():
        sums = {
            "id_sum": ID_COLUMNS.get(name),
            "race_sum": "raceId" if "raceId" in columns else None,
            "driver_sum": "driverId" if "driverId" in columns else None,
        }
        total = [
            (F.sum(F.col(c).cast("decimal(38,0)")) if c else F.lit(None)).cast("string").alias(n) for n, c in sums.items()
        ]
        rows = t.spark.table(f"{bronze}.{name}").groupBy("source").agg(F.count(F.lit(1)).alias("row_count"), *total)
        parts.append(rows.select(F.lit(name).alias("table_name"), "source", "row_count", *sums))
    hub = t.spark.table(f"{prefix}_marts.race_results_detail").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.union(hub.select(F.lit("race_results_detail"), none, "n", none, none, none))


# what the build must give: known rows keep their ids, new races and drivers get the next ones
_SQL = f"""
WITH first AS (SELECT {_FIRST} AS y),
new_races AS (SELECT year, round, race_id AS old,
    (SELECT max(race_id) FROM races WHERE year < {_FIRST}) + row_number() OVER (ORDER BY year, round) AS id
  FROM races WHERE year >= {_FIRST}),
rookies AS (SELECT driver_id AS old, {_TWICE} + row_number() OVER (ORDER BY driver_id) AS id FROM drivers WHERE driver_id % 10 = 0),
now AS (SELECT driver_id AS old, CASE WHEN driver_id = 1 THEN {_TWICE} ELSE coalesce(r.id, driver_id) END AS id
  FROM drivers LEFT JOIN rookies r ON r.old = driver_id),
late AS (SELECT e.*, n.id AS race, w.id AS driver FROM entries e JOIN new_races n ON n.old = e.race_id JOIN now w ON w.old = e.driver_id),
teams AS (SELECT race_id, constructor_id, season, any_value(race) AS race FROM late GROUP BY 1, 2, 3),
old_teams AS (SELECT race_id * 1000000000000 + constructor_id AS id, race_id FROM entries
  WHERE season < {_FIRST} GROUP BY race_id, constructor_id),
late_laps AS (SELECT n.id AS race, w.id AS driver FROM laps l JOIN new_races n ON n.old = l.race_id JOIN now w ON w.old = l.driver_id),
late_pits AS (SELECT n.id AS race, w.id AS driver FROM pits l JOIN new_races n ON n.old = l.race_id JOIN now w ON w.old = l.driver_id),
early AS (SELECT race_id FROM races WHERE year < {_FIRST}),
old_results AS (SELECT * FROM results WHERE race_id IN (SELECT race_id FROM early)),
old_quali AS (SELECT * FROM quali WHERE race_id IN (SELECT race_id FROM early)),
old_sprints AS (SELECT * FROM sprints WHERE race_id IN (SELECT race_id FROM early)),
old_laps AS (SELECT * FROM laps WHERE race_id IN (SELECT race_id FROM early)),
old_pits AS (SELECT * FROM pits WHERE race_id IN (SELECT race_id FROM early)),
old_entries AS (SELECT *, race_id * 1000000000000 + driver_id AS id FROM entries WHERE season < {_FIRST}),
told(table_name, source, row_count, id_sum, race_sum, driver_sum) AS (
  SELECT 'seasons', 'historical', count(*), sum(year), NULL, NULL FROM (SELECT DISTINCT year FROM races WHERE year < {_FIRST})
  UNION ALL SELECT 'seasons', 'api', count(*), sum(year), NULL, NULL FROM (SELECT DISTINCT year FROM races WHERE year >= {_FIRST})
  UNION ALL SELECT 'status', 'historical', count(*), sum(status_id), NULL, NULL FROM status
  UNION ALL SELECT 'circuits', 'historical', count(*), sum(circuit_id), NULL, NULL FROM circuits
  UNION ALL SELECT 'constructors', 'historical', count(*), sum(constructor_id), NULL, NULL FROM teams_known
  UNION ALL SELECT 'drivers', 'historical', count(*) + 1, sum(driver_id) + {_TWICE}, NULL, sum(driver_id) + {_TWICE} FROM drivers WHERE driver_id % 10 <> 0
  UNION ALL SELECT 'drivers', 'api', count(*), sum(id), NULL, sum(id) FROM rookies
  UNION ALL SELECT 'races', 'historical', count(*), sum(race_id), sum(race_id), NULL FROM early
  UNION ALL SELECT 'races', 'api', count(*), sum(id), sum(id), NULL FROM new_races
  UNION ALL SELECT 'results', 'historical', count(*), sum(result_id), sum(race_id), sum(driver_id) FROM old_results
  UNION ALL SELECT 'results', 'api', count(*), count(*) * (SELECT max(result_id) FROM old_results)::HUGEINT + count(*) * (count(*) + 1) // 2, sum(race), sum(driver) FROM late
  UNION ALL SELECT 'qualifying', 'historical', count(*), sum(qualify_id), sum(race_id), sum(driver_id) FROM old_quali
  UNION ALL SELECT 'qualifying', 'api', count(*), count(*) * (SELECT max(qualify_id) FROM old_quali)::HUGEINT + count(*) * (count(*) + 1) // 2, sum(race), sum(driver)
    FROM late WHERE driver_id % 5 <> 0
  UNION ALL SELECT 'sprint_results', 'historical', count(*), sum(sprint_result_id), sum(race_id), sum(driver_id) FROM old_sprints
  UNION ALL SELECT 'sprint_results', 'api', count(*), count(*) * (SELECT max(sprint_result_id) FROM old_sprints)::HUGEINT + count(*) * (count(*) + 1) // 2, sum(race), sum(driver)
    FROM late WHERE round IN (4, 8, 12)
  UNION ALL SELECT 'lap_times', 'historical', count(*), NULL, sum(race_id), sum(driver_id) FROM old_laps
  UNION ALL SELECT 'lap_times', 'api', count(*), NULL, sum(race), sum(driver) FROM late_laps
  UNION ALL SELECT 'pit_stops', 'historical', count(*), NULL, sum(race_id), sum(driver_id) FROM old_pits
  UNION ALL SELECT 'pit_stops', 'api', count(*), NULL, sum(race), sum(driver) FROM late_pits
  UNION ALL SELECT 'driver_standings', 'historical', count(*), sum(id), sum(race_id), sum(driver_id) FROM old_entries
  UNION ALL SELECT 'driver_standings', 'api', count(*), count(*) * (SELECT max(id) FROM old_entries)::HUGEINT + count(*) * (count(*) + 1) // 2, sum(race), sum(driver) FROM late
  UNION ALL SELECT 'constructor_standings', 'historical', count(*), sum(id), sum(race_id), NULL FROM old_teams
  UNION ALL SELECT 'constructor_standings', 'api', count(*), count(*) * (SELECT max(id) FROM old_teams)::HUGEINT + count(*) * (count(*) + 1) // 2, sum(race), NULL FROM teams
  UNION ALL SELECT 'race_results_detail', NULL, count(*), NULL, NULL, NULL FROM entries WHERE season >= {_FIRST} OR driver_id % 10 <> 0)
SELECT table_name, source, row_count, CAST(id_sum AS HUGEINT) AS id_sum, CAST(race_sum AS HUGEINT) AS race_sum, CAST(driver_sum AS HUGEINT) AS driver_sum FROM told
"""
register(
    "key_8_bronze_build",
    "table_name:text source:text row_count id_sum:text race_sum:text driver_sum:text",
    _built,
    _SQL.replace("teams_known", "(SELECT DISTINCT constructor_id FROM entries)"),
    ["entries", "results", "quali", "sprints", "laps", "pits", "races", "drivers", "circuits", "status"],
)
