"""Flattening of nested payloads into all-text bronze rows.

Positions from ``posexplode`` travel along as ``_entry`` / ``_item`` / ``_part``: they are
the encounter order from which ids are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.functions.scalars import duration_ms, strip_zulu
from lapstack.schemas import ROUND_ENDPOINTS, payload_path

ORDINALS = ["year", "_entry", "_item", "_part"]

# Practice, qualifying and sprint sessions of a race and their column prefixes.
SESSIONS = {
    "fp1": "FirstPractice",
    "fp2": "SecondPractice",
    "fp3": "ThirdPractice",
    "quali": "Qualifying",
    "sprint": "Sprint",
}


def explode_entries(payloads: DataFrame, endpoint: str) -> DataFrame:
    """``year``, position and struct of every entry of the payload's top array.

    ``_offset`` is the place of a page's first item in the whole list; only an absent one (merged files) is 0, and
    one that is no number fails the query. Entries of documents that were split are there already.
    """
    if "e" in payloads.columns:
        return payloads
    given = F.col("MRData.offset")
    wrong = F.raise_error(F.concat(F.lit("not a page offset: "), given)).cast("bigint")
    offset = F.when(given.isNull(), F.lit(0)).otherwise(F.coalesce(given.try_cast("bigint"), wrong)).alias("_offset")
    return payloads.select("year", offset, F.posexplode(payload_path(endpoint)).alias("_entry", "e"))


def explode_items(entries: DataFrame, array: str) -> DataFrame:
    """One row per element of a nested array of the entry, with its place in the list."""
    return entries.select(
        "year",
        "_entry",
        "_offset",
        F.col("e.season").cast("int").alias("season"),
        F.col("e.round").cast("int").alias("round"),
        F.posexplode(f"e.{array}").alias("_pos", "i"),
    ).select("year", "_entry", (F.col("_offset") + F.col("_pos")).alias("_item"), "season", "round", "i")


def round_items(payloads: DataFrame, endpoint: str) -> DataFrame:
    """Items of the entries; those of documents that were split are there already."""
    if "i" in payloads.columns:
        return payloads
    return explode_items(explode_entries(payloads, endpoint), ROUND_ENDPOINTS[endpoint])


def _result_columns(id_free_extra: dict[str, Column]) -> list[Column]:
    plain = "number grid position positionText points laps".split()
    return [
        F.col("i.Driver.driverId").alias("driver_slug"),
        F.col("i.Constructor.constructorId").alias("constructor_slug"),
        # a missing status is known by the text "None"
        F.coalesce(F.col("i.status"), F.lit("None")).alias("status_slug"),
        *[F.col(f"i.{c}").alias(c) for c in plain],
        (F.col("_item") + 1).cast("string").alias("positionOrder"),
        F.col("i.Time.time").alias("time"),
        F.col("i.Time.millis").alias("milliseconds"),
        F.col("i.FastestLap.lap").alias("fastestLap"),
        F.col("i.FastestLap.Time.time").alias("fastestLapTime"),
        *[c.alias(n) for n, c in id_free_extra.items()],
    ]


def _fact(items: DataFrame, *columns: Column) -> DataFrame:
    part = F.col("_part") if "_part" in items.columns else F.lit(0).alias("_part")
    return items.select("year", "_entry", "_item", part, "season", "round", *columns)


def results(payloads: DataFrame) -> DataFrame:
    extra = {"rank": F.col("i.FastestLap.rank"), "fastestLapSpeed": F.lit(None).cast("string")}
    return _fact(round_items(payloads, "results"), *_result_columns(extra))


def sprint_results(payloads: DataFrame) -> DataFrame:
    return _fact(round_items(payloads, "sprint"), *_result_columns({}))


def qualifying(payloads: DataFrame) -> DataFrame:
    return _fact(
        round_items(payloads, "qualifying"),
        F.col("i.Driver.driverId").alias("driver_slug"),
        F.col("i.Constructor.constructorId").alias("constructor_slug"),
        *[F.col(f"i.{c}").alias(c.lower()) for c in ("number", "position", "Q1", "Q2", "Q3")],
    )


def lap_times(payloads: DataFrame) -> DataFrame:
    """Two levels down: laps of a race, timings of a lap."""
    laps = round_items(payloads, "laps")
    timings = laps.select(
        "year",
        "_entry",
        "_item",
        "season",
        "round",
        F.col("i.number").alias("lap"),
        F.posexplode("i.Timings").alias("_part", "t"),
    )
    return _fact(
        timings,
        F.col("t.driverId").alias("driver_slug"),
        F.col("lap"),
        F.col("t.position").alias("position"),
        F.col("t.time").alias("time"),
        duration_ms("t.time").cast("string").alias("milliseconds"),
    )


def pit_stops(payloads: DataFrame) -> DataFrame:
    return _fact(
        round_items(payloads, "pitstops"),
        F.col("i.driverId").alias("driver_slug"),
        *[F.col(f"i.{c}").alias(c) for c in ("stop", "lap", "time", "duration")],
        duration_ms("i.duration").cast("string").alias("milliseconds"),
    )


def standings(payloads: DataFrame, endpoint: str) -> DataFrame:
    """Driver or constructor standings: one function, chosen by the endpoint."""
    who, slug = (
        ("i.Driver.driverId", "driver_slug")
        if endpoint == "driverstandings"
        else ("i.Constructor.constructorId", "constructor_slug")
    )
    return _fact(
        round_items(payloads, endpoint),
        F.col(who).alias(slug),
        *[F.col(f"i.{c}").alias(c) for c in ("points", "position", "positionText", "wins")],
    )


def circuit_columns(circuit: str) -> list[Column]:
    """Bronze columns of a circuit struct; location parts are NULL when it has none."""
    return [
        F.col(f"{circuit}.circuitId").alias("circuitRef"),
        F.col(f"{circuit}.circuitName").alias("name"),
        F.col(f"{circuit}.Location.locality").alias("location"),
        F.col(f"{circuit}.Location.country").alias("country"),
        F.col(f"{circuit}.Location.lat").alias("lat"),
        F.col(f"{circuit}.Location.long").alias("lng"),
        F.lit(None).cast("string").alias("alt"),
        F.col(f"{circuit}.url").alias("url"),
    ]


def races(payloads: DataFrame) -> DataFrame:
    sessions = [
        column
        for prefix, name in SESSIONS.items()
        for column in (
            F.col(f"e.{name}.date").alias(f"{prefix}_date"),
            strip_zulu(f"e.{name}.time").alias(f"{prefix}_time"),
        )
    ]
    return explode_entries(payloads, "races").select(
        "year",
        "_entry",
        F.col("e.season").cast("int").alias("season"),
        F.col("e.round").cast("int").alias("round"),
        F.col("e.Circuit").alias("circuit"),
        F.col("e.raceName").alias("name"),
        F.col("e.date").alias("date"),
        strip_zulu("e.time").alias("time"),
        F.col("e.url").alias("url"),
        *sessions,
    )


def drivers(payloads: DataFrame) -> DataFrame:
    return explode_entries(payloads, "drivers").select(
        "year",
        "_entry",
        F.col("e.driverId").alias("driverRef"),
        F.col("e.permanentNumber").alias("number"),
        F.col("e.code").alias("code"),
        F.col("e.givenName").alias("forename"),
        F.col("e.familyName").alias("surname"),
        F.col("e.dateOfBirth").alias("dob"),
        F.col("e.nationality").alias("nationality"),
        F.col("e.url").alias("url"),
    )


def circuits(payloads: DataFrame) -> DataFrame:
    return explode_entries(payloads, "circuits").select("year", "_entry", *circuit_columns("e"))


def constructors(payloads: DataFrame) -> DataFrame:
    return explode_entries(payloads, "constructors").select(
        "year",
        "_entry",
        F.col("e.constructorId").alias("constructorRef"),
        F.col("e.name").alias("name"),
        F.col("e.nationality").alias("nationality"),
        F.col("e.url").alias("url"),
    )
