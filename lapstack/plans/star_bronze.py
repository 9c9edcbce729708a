"""All-text bronze tables over the star schema, as the landed files would hold them.

Numbers are folded into the ranges the typed tables allow, so casts stay strict at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(value) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _fold(column: str, size: int) -> Column:
    """1, 2, ... size, 1, 2, ..."""
    return ((F.col(column) - 1) % size + 1).cast("int")


def _blank_where(condition: Column, value: Column) -> Column:
    return F.when(condition, F.lit("")).otherwise(_text(value))


def _null() -> Column:
    return F.lit(None).cast("string")


def _number() -> Column:
    return _blank_where(F.col("driver_id") % 3 == 0, F.col("driver_id") % 100)


def _result_columns() -> dict[str, Column]:
    position = F.when(F.col("finish_position").isNull(), F.lit("")).otherwise(_text(_fold("finish_position", 20)))
    return {
        "raceId": _text("race_id"),
        "driverId": _text("driver_id"),
        "constructorId": _text("constructor_id"),
        "number": _number(),
        "grid": _text(_fold("grid_position", 20)),
        "position": position,
        "positionText": F.when(position == "", F.lit("R")).otherwise(position),
        "positionOrder": _text(_fold("grid_position", 1000)),
        "points": F.concat(_text(F.col("driver_id") % 500), F.lit(".50")),
        "time": _null(),
        "milliseconds": _text(F.col("driver_id") % 1000 + 5_000_000),
        "statusId": _text("status_id"),
    }


def _standing(points: Column, position: Column, wins: Column) -> dict[str, Column]:
    return {"points": points, "position": _text(position), "positionText": _text(position), "wins": _text(wins)}


class BronzeTables(Mapping):
    """The thirteen tables by name, each planned when it is asked for."""

    def __init__(self, plans: dict[str, Callable[[], DataFrame]]):
        self._plans = plans

    def __getitem__(self, name: str) -> DataFrame:
        return self._plans[name]()

    def __iter__(self):
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


def bronze_tables(t: Mapping[str, DataFrame]) -> BronzeTables:
    """``t`` gives the star models by name."""

    def made(model: str, columns: dict[str, Column], source: Column | None = None) -> Callable[[], DataFrame]:
        lineage = F.col("source") if source is None else source
        return lambda: t[model].select(*[c.alias(n) for n, c in columns.items()], lineage.alias("source"))

    def team_standings() -> DataFrame:
        sizes = t["entries"].groupBy("race_id", "constructor_id", "source").agg(F.count(F.lit(1)).alias("_n"))
        points = F.concat(_text(F.col("_n") % 500), F.lit(".00"))
        standing = _standing(points, F.col("_n") % 20 + 1, F.col("_n") % 5)
        key = F.col("race_id") * F.lit(1_000_000_000_000) + F.col("constructor_id")
        return sizes.select(
            _text(key).alias("constructorStandingsId"),
            _text("race_id").alias("raceId"),
            _text("constructor_id").alias("constructorId"),
            *[c.alias(n) for n, c in standing.items()],
            "source",
        )

    history = F.lit("historical")
    even_round = F.col("round") % 2 == 0
    day = _text("race_date")
    sprint = F.col("round").isin(4, 8, 12)
    plans = {
        "seasons": made(
            "dim_seasons", {"year": _text("year"), "url": F.concat(F.lit("http://seasons/"), _text("year"))}
        ),
        "status": made("dim_status", {"statusId": _text("status_id"), "status": F.col("status")}, history),
        "circuits": made(
            "dim_circuits",
            {
                "circuitId": _text("circuit_id"),
                "circuitRef": F.col("circuit_ref"),
                "name": F.col("name"),
                "location": F.col("location"),
                "country": F.col("country"),
                "lat": _text("latitude"),
                "lng": _text("longitude"),
                "alt": _blank_where(F.col("circuit_id") == 3, F.col("altitude")),
                "url": _null(),
            },
            history,
        ),
        "drivers": made(
            "dim_drivers",
            {
                "driverId": _text("driver_id"),
                "driverRef": F.col("driver_ref"),
                "number": _number(),
                "code": F.col("code"),
                "forename": F.col("forename"),
                "surname": F.col("surname"),
                "dob": _text("date_of_birth"),
                "nationality": F.col("nationality"),
                "url": _null(),
            },
        ),
        "constructors": made(
            "dim_constructors",
            {
                "constructorId": _text("constructor_id"),
                "constructorRef": F.col("constructor_ref"),
                "name": F.col("name"),
                "nationality": F.col("nationality"),
                "url": _null(),
            },
        ),
        "races": made(
            "dim_races",
            {
                "raceId": _text("race_id"),
                "year": _text("year"),
                "round": _text("round"),
                "circuitId": _text("circuit_id"),
                "name": F.col("name"),
                "date": day,
                "time": F.when(even_round, F.lit("14:00:00")),
                "url": _null(),
                "fp1_date": day,
                "fp1_time": F.concat(F.lpad(_text("round"), 2, "0"), F.lit(":30:00")),
                **{f"{s}_{part}": _null() for s in ("fp2", "fp3") for part in ("date", "time")},
                "quali_date": day,
                "quali_time": F.lit("13:00:00"),
                "sprint_date": F.when(sprint, day),
                "sprint_time": F.when(sprint, F.lit("10:15:00")),
            },
        ),
        "results": made(
            "fact_results",
            {
                "resultId": _text("result_id"),
                **_result_columns(),
                "laps": _text(F.col("laps_completed") % 1000),
                "fastestLap": _blank_where(F.col("fastest_lap_number") % 2 == 1, F.col("fastest_lap_number")),
                "rank": _blank_where(F.col("fastest_lap_rank") > 15, F.col("fastest_lap_rank")),
                "fastestLapTime": F.col("fastest_lap_time"),
                "fastestLapSpeed": _null(),
            },
        ),
        "qualifying": made(
            "fact_qualifying",
            {
                "qualifyId": _text("qualify_id"),
                "raceId": _text("race_id"),
                "driverId": _text("driver_id"),
                "constructorId": _text("constructor_id"),
                "number": _number(),
                "position": _text(_fold("qualifying_position", 20)),
                "q1": F.col("q1_time"),
                "q2": F.col("q2_time"),
                "q3": F.col("q3_time"),
            },
        ),
        "sprint_results": made(
            "fact_sprint_results",
            {
                "sprintResultId": _text("sprint_result_id"),
                **_result_columns(),
                "laps": _text(F.col("driver_id") % 30),
                "fastestLap": F.lit(""),
                "fastestLapTime": _null(),
            },
        ),
        "lap_times": made(
            "fact_lap_times",
            {
                "raceId": _text("race_id"),
                "driverId": _text("driver_id"),
                "lap": _text(_fold("lap_number", 1000)),
                "position": _text("lap_position"),
                "time": F.col("lap_time"),
                "milliseconds": _text("lap_milliseconds"),
            },
        ),
        "pit_stops": made(
            "fact_pit_stops",
            {
                "raceId": _text("race_id"),
                "driverId": _text("driver_id"),
                "stop": _text(_fold("stop_number", 1000)),
                "lap": _text(_fold("lap_number", 1000)),
                "time": F.col("stop_time"),
                "duration": F.col("stop_duration"),
                "milliseconds": _text("stop_milliseconds"),
            },
        ),
        "driver_standings": made(
            "entries",
            {
                "driverStandingsId": _text(F.col("race_id") * F.lit(1_000_000_000_000) + F.col("driver_id")),
                "raceId": _text("race_id"),
                "driverId": _text("driver_id"),
                **_standing(
                    F.concat(_text(F.col("driver_id") % 500), F.lit(".25")),
                    _fold("grid_position", 20),
                    F.col("driver_id") % 5,
                ),
            },
        ),
        "constructor_standings": team_standings,
    }
    return BronzeTables(plans)
