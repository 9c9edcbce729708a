"""The model graph: which function builds which table, from which tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lapstack.plans import marts
from lapstack.plans.silver import silver_table
from lapstack.schemas import SILVER_FIELDS
from lapstack.sources.sinks import write_table


@dataclass(frozen=True)
class Model:
    layer: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    partition: str | None = None


def _silver(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda bronze: silver_table(name, bronze)


SILVER_MODELS = {name: Model("silver", _silver(name), (bronze,)) for name, (bronze, _) in SILVER_FIELDS.items()}

MART_MODELS = {
    "race_results_detail": Model(
        "marts",
        marts.race_results_detail,
        (
            "fact_results",
            "fact_qualifying",
            "fact_sprint_results",
            "fact_pit_stops",
            "fact_lap_times",
            "dim_drivers",
            "dim_constructors",
            "dim_circuits",
            "dim_races",
            "dim_status",
        ),
        "season",
    ),
    "championship_standings": Model("marts", marts.championship_standings, ("race_results_detail",), "season"),
    "driver_season_summary": Model("marts", marts.driver_season_summary, ("race_results_detail",)),
    "constructor_season_summary": Model("marts", marts.constructor_season_summary, ("race_results_detail",)),
    "driver_career": Model(
        "marts", marts.driver_career, ("race_results_detail", "dim_drivers", "driver_season_summary")
    ),
    "constructor_career": Model(
        "marts", marts.constructor_career, ("race_results_detail", "dim_constructors", "constructor_season_summary")
    ),
    "circuit_stats": Model("marts", marts.circuit_stats, ("race_results_detail", "dim_circuits", "fact_qualifying")),
    "qualifying_vs_race": Model(
        "marts",
        marts.qualifying_vs_race,
        ("fact_qualifying", "fact_results", "dim_drivers", "dim_constructors", "dim_races", "dim_status"),
        "season",
    ),
    "lap_time_analysis": Model(
        "marts",
        marts.lap_time_analysis,
        ("fact_lap_times", "dim_races", "dim_drivers", "fact_results", "dim_circuits", "dim_constructors"),
        "season",
    ),
    "pit_stop_analysis": Model(
        "marts",
        marts.pit_stop_analysis,
        ("fact_pit_stops", "dim_races", "dim_drivers", "fact_results", "dim_constructors", "dim_circuits"),
        "season",
    ),
}

MODELS = {**SILVER_MODELS, **MART_MODELS}


def build_order(names: Iterable[str], models: Mapping[str, Model] = MODELS) -> list[str]:
    """The named models and everything they need, inputs first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in models and name not in order:
            for needed in models[name].inputs:
                visit(needed)
            order.append(name)

    for name in names:
        visit(name)
    return order


def build_models(
    spark: SparkSession,
    names: Iterable[str] = tuple(MODELS),
    bronze: str = "bronze",
    prefix: str = "",
    models: Mapping[str, Model] = MODELS,
) -> list[str]:
    """Write each model as a table of its layer's database; inputs are read back from tables.

    Layers become the databases ``silver`` and ``marts`` (with an optional prefix), and each
    table is written once and read by all its dependants.
    """
    built = []
    for name in build_order(names, models):
        model = models[name]
        frames = [
            spark.table(f"{prefix}{models[i].layer}.{i}" if i in models else f"{bronze}.{i}") for i in model.inputs
        ]
        write_table(model.build(*frames), f"{prefix}{model.layer}.{name}", partition=model.partition)
        built.append(f"{prefix}{model.layer}.{name}")
    return built
