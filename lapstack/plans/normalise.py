"""Bronze: history and API payloads merged under one set of surrogate keys."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstack.operators.keys import (
    append_ids,
    append_missing,
    last_per_key,
    lookup_or_fail,
    max_id,
    new_keys,
    resolve_keys,
    with_lineage,
)
from lapstack.operators.scans import dense_ids
from lapstack.schemas import BRONZE_COLUMNS, FIRST_API_YEAR, ID_COLUMNS, NATURAL_KEYS, ROUND_ENDPOINTS
from lapstack.session import document_bytes, stage
from lapstack.sources import payloads as p
from lapstack.sources.documents import split_entries, split_items
from lapstack.sources.files import BY_YEAR, in_file_order, largest_file, read_history, read_payload, read_year_payloads
from lapstack.sources.sinks import FILE_ROWS, bronze_layout, write_fixed

SEEN = ["year", "_rank", "_entry", "_item", "_part"]

# Order in which a year's endpoints are worked through; ids follow it.
ENDPOINT_ORDER = (
    "status", "drivers", "circuits", "constructors", "races", "results", "qualifying", "sprint", "laps", "pitstops",
    "driverstandings", "constructorstandings",
)


_SLUGS = {"drivers": "driver_slug", "constructors": "constructor_slug", "status": "status_slug"}


def seen_order() -> list[Column]:
    return [F.col(c).asc() for c in SEEN]


def _mention(df: DataFrame, endpoint: str, columns: list) -> DataFrame:
    """Rows that name an entity, with the place at which they do."""
    rank = F.lit(ENDPOINT_ORDER.index(endpoint)).alias("_rank")
    places = [F.col(c) if c in df.columns else F.lit(0).alias(c) for c in ("_entry", "_item", "_part")]
    return df.select("year", rank, *places, *columns)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _last_ids(spark: SparkSession, raw_dir: str, bronze: dict[str, DataFrame], table: str, keys: list[str]) -> DataFrame:
    """One id for each key: that of its last row in the history's file; keys of later rows are none of the history's."""
    id_column = ID_COLUMNS[table]
    known = last_per_key(in_file_order(spark, f"{raw_dir}/{table}.csv", [*keys, id_column]), keys, id_column, "_place")
    return known.unionByName(bronze[table].filter("source = 'api'").select(*keys, id_column))


def landed_documents(spark: SparkSession, api_dir: str, endpoint: str, start_year: int, layout: str = BY_YEAR) -> DataFrame:
    """An endpoint's year documents: whole while they are small, else their items or entries, read by many tasks."""
    path = layout.format(root=api_dir, endpoint=endpoint)
    if largest_file(spark, path) <= document_bytes(spark):
        return read_year_payloads(spark, api_dir, endpoint, start_year, layout)
    split = split_items if endpoint in ROUND_ENDPOINTS else split_entries
    return split(spark, path, endpoint, start_year)


def _facts(landed: Callable[[str], DataFrame]) -> dict[str, DataFrame]:

    flat = {
        "results": p.results(landed("results")),
        "qualifying": p.qualifying(landed("qualifying")),
        "sprint": p.sprint_results(landed("sprint")),
        "laps": p.lap_times(landed("laps")),
        "pitstops": p.pit_stops(landed("pitstops")),
        "driverstandings": p.standings(landed("driverstandings"), "driverstandings"),
        "constructorstandings": p.standings(landed("constructorstandings"), "constructorstandings"),
    }
    # every entity table looks for its mentions in all facts: parse the documents once
    return {endpoint: stage(df, endpoint) for endpoint, df in flat.items()}


_FACT_TABLES = {
    "results": "results",
    "qualifying": "qualifying",
    "sprint": "sprint_results",
    "laps": "lap_times",
    "pitstops": "pit_stops",
    "driverstandings": "driver_standings",
    "constructorstandings": "constructor_standings",
}


def _entity_mentions(table: str, definitions: list[DataFrame], facts: dict[str, DataFrame]) -> DataFrame:
    """Definitions with attributes, then every fact that names the entity (a stub)."""
    key, slug = NATURAL_KEYS[table], _SLUGS.get(table)
    stubs = [
        _mention(df, endpoint, [F.col(slug).alias(key)])
        for endpoint, df in facts.items()
        if slug and slug in df.columns
    ]
    return _union([*definitions, *stubs])


def _resolve(history: DataFrame, table: str, mentions: DataFrame) -> DataFrame:
    key, id_column = NATURAL_KEYS[table], ID_COLUMNS[table]
    fresh = resolve_keys(history, mentions, [key], id_column, seen_order())
    return with_lineage(history, bronze_layout(fresh, BRONZE_COLUMNS[table]).drop("source"))


def normalise(
    spark: SparkSession, raw_dir: str, api_dir: str, start_year: int = FIRST_API_YEAR, layout: str = BY_YEAR
) -> dict[str, DataFrame]:
    """All bronze tables from landed files; ``layout`` says where the year documents lie."""

    def landed(endpoint: str) -> DataFrame:
        return landed_documents(spark, api_dir, endpoint, start_year, layout)

    history = read_history(spark, raw_dir)
    facts = _facts(landed)
    bronze: dict[str, DataFrame] = {}

    seasons = (
        read_payload(spark, f"{api_dir}/seasons.json", "seasons")
        .select(F.explode("MRData.SeasonTable.Seasons").alias("s"))
        .select(F.col("s.season").alias("year"), F.col("s.url").alias("url"))
    )
    bronze["seasons"] = with_lineage(history["seasons"], append_missing(history["seasons"], seasons, "year"))

    statuses = read_payload(spark, f"{api_dir}/status.json", "status").select(
        F.lit(0).alias("year"), F.posexplode("MRData.StatusTable.Status").alias("_entry", "s")
    )
    status_mentions = _mention(statuses, "status", [F.col("s.status").alias("status")])
    bronze["status"] = _resolve(history["status"], "status", _entity_mentions("status", [status_mentions], facts))

    for table, flatten in (("drivers", p.drivers), ("constructors", p.constructors)):
        flat = flatten(landed(table))
        own = [c for c in flat.columns if c not in ("year", "_entry")]
        bronze[table] = _resolve(
            history[table], table, _entity_mentions(table, [_mention(flat, table, own)], facts)
        )

    # races: a known (year, round) stays as it is and does not mention its circuit
    known_rounds = history["races"].select(
        F.col("year").cast("int").alias("season"), F.col("round").cast("int").alias("round"), "raceId"
    )
    race_order = [F.col("year").asc(), F.col("_entry").asc()]
    fresh_races = new_keys(known_rounds, p.races(landed("races")), ["season", "round"], race_order)
    race_circuits = _mention(fresh_races, "races", p.circuit_columns("circuit"))
    circuits = p.circuits(landed("circuits"))
    own = [c for c in circuits.columns if c not in ("year", "_entry")]
    bronze["circuits"] = _resolve(
        history["circuits"],
        "circuits",
        _entity_mentions("circuits", [_mention(circuits, "circuits", own), race_circuits], facts),
    )
    numbered = dense_ids(fresh_races, race_order, "raceId", start=max_id(history["races"], "raceId"), unique=True)
    circuit_ids = _last_ids(spark, raw_dir, bronze, "circuits", ["circuitRef"])
    api_races = lookup_or_fail(
        numbered.withColumn("circuitRef", F.col("circuit.circuitId")), circuit_ids, ["circuitRef"], "circuitId"
    ).withColumn("year", F.col("season").cast("string"))
    bronze["races"] = with_lineage(
        history["races"], bronze_layout(api_races, BRONZE_COLUMNS["races"]).drop("source")
    )

    race_ids = _last_ids(spark, raw_dir, bronze, "races", ["year", "round"]).select(
        F.col("year").cast("int").alias("season"), F.col("round").cast("int").alias("round"), "raceId"
    )
    links = {
        slug: _last_ids(spark, raw_dir, bronze, table, [NATURAL_KEYS[table]]).withColumnRenamed(NATURAL_KEYS[table], slug)
        for table, slug in _SLUGS.items()
    }
    order = [F.col(c).asc() for c in p.ORDINALS]
    for endpoint, table in _FACT_TABLES.items():
        rows = lookup_or_fail(facts[endpoint], race_ids, ["season", "round"], "raceId")
        for entity, slug in _SLUGS.items():
            if slug in rows.columns:
                rows = lookup_or_fail(rows, links[slug], [slug], ID_COLUMNS[entity])
        if table in ID_COLUMNS:
            rows = append_ids(history[table], rows, ID_COLUMNS[table], order, unique=True)
        bronze[table] = with_lineage(
            history[table], bronze_layout(rows, BRONZE_COLUMNS[table]).drop("source")
        )
    return bronze


def bronze_order(table: str) -> list[Column]:
    """A total row order for files: id order, else every column."""
    if table in ID_COLUMNS:
        return [F.col(ID_COLUMNS[table]).cast("bigint").asc_nulls_last()]
    numbers = [F.col(c).cast("bigint").asc_nulls_last() for c in BRONZE_COLUMNS[table][:3]]
    return [*numbers, *[F.col(c).asc_nulls_last() for c in BRONZE_COLUMNS[table][3:]]]


def write_all(bronze: dict[str, DataFrame], bronze_dir: str, file_rows: int = FILE_ROWS) -> None:
    """The bronze tables as files that are the same byte for byte on every run."""
    for table, columns in BRONZE_COLUMNS.items():
        write_fixed(bronze[table], f"{bronze_dir}/{table}", columns, bronze_order(table), file_rows)
