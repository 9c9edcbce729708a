"""Models rebuilt where their inputs changed: season by season, told by checksums that row order does not touch.

Every input of a model leaves one checksum for each of its units in a table beside the models: a unit is a season for
tables that have one (facts take that of their race) and a key for the dimensions. The next build compares them first.
A model whose rows of a season come from that season alone is rewritten for the seasons that differ, and for those in
which a dimension's changed key is used; any other model is rewritten whole, and none whose inputs are as before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lapstack.plans.models import MODELS, Model, build_order
from lapstack.plans.silver import LOADED_AT
from lapstack.session import settle
from lapstack.sources.sinks import write_table

STATE = "model string, input string, unit string, n bigint, digest string"
#: Marts whose rows of a season need that season's rows of their inputs only.
BY_SEASON = frozenset(
    {
        "race_results_detail",
        "championship_standings",
        "driver_season_summary",
        "constructor_season_summary",
        "qualifying_vs_race",
        "lap_time_analysis",
        "pit_stop_analysis",
    }
)
_KEYS = {"dim_drivers": "driver_id", "dim_constructors": "constructor_id", "dim_circuits": "circuit_id", "dim_status": "status_id"}
_WHOLE = ""


def _digest(df: DataFrame) -> list[Column]:
    """Rows, and two sums of row hashes: equal for the same rows in any order, whenever they were loaded."""
    columns = sorted(c for c in df.columns if c != LOADED_AT and not c.startswith("_unit"))
    hashes = [F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)") for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("n"), F.concat_ws(":", *[F.sum(h).cast("string") for h in hashes]).alias("digest")]


def _season(df: DataFrame, races: DataFrame) -> DataFrame | None:
    """The rows with ``_unit``, their season; None for a table that has none."""
    for name in ("season", "year"):
        if name in df.columns:
            return df.withColumn("_unit", F.col(name).cast("int"))
    if "race_id" in df.columns:
        return df.join(races.select("race_id", F.col("year").cast("int").alias("_unit")), "race_id", "left")
    return None


def checksums(df: DataFrame, unit: Column) -> DataFrame:
    """``unit``, ``n`` and ``digest`` of the rows of each unit."""
    marked = df.withColumn("_unit_text", F.coalesce(unit.cast("string"), F.lit(_WHOLE)))
    return marked.groupBy(F.col("_unit_text").alias("unit")).agg(*_digest(df))


class _Inputs:
    """Checksums of the inputs, each worked out once a build and unit, after the input itself was built."""

    def __init__(self, open_table: Callable[[str], DataFrame]) -> None:
        self.open, self.known = open_table, {}

    def checksums(self, name: str, by_season: bool) -> DataFrame:
        at = (name, by_season)
        if at not in self.known:
            df, unit = self.open(name), F.lit(_WHOLE)
            if by_season:
                placed = _season(df, self.open("dim_races"))
                df, unit = (df, F.col(_KEYS[name])) if placed is None else (placed, F.col("_unit"))
            self.known[at] = settle(checksums(df, unit).select(F.lit(name).alias("input"), "unit", "n", "digest"))
        return self.known[at]


def _changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """``input`` and ``unit`` of what came, went or differs."""
    was = old.select("input", "unit", F.struct("n", "digest").alias("_old"))
    now = new.select("input", "unit", F.struct("n", "digest").alias("_new"))
    both = was.join(now, ["input", "unit"], "full_outer")
    return both.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("input", "unit")


def _seasons(changed: DataFrame, model: Model, open_table: Callable[[str], DataFrame]) -> list[int] | None:
    """The seasons that the changed units touch; None if one touches all."""
    races = open_table("dim_races")
    placed = {i: p for i in model.inputs if (p := _season(open_table(i), races)) is not None}
    found = [changed.filter(F.col("input").isin(list(placed))).select(F.col("unit").alias("season"))]
    for name in model.inputs:
        if name in placed:
            continue
        key = _KEYS[name]
        units = changed.filter(F.col("input") == name).select(F.col("unit").alias("_key"))
        if units.isEmpty():
            continue
        for other in placed.values():
            if key in other.columns:
                used = other.select(F.col(key).cast("string").alias("_key"), "_unit").distinct()
                found.append(used.join(units, "_key", "left_semi").select(F.col("_unit").cast("string").alias("season")))
    seasons = {r["season"] for r in reduce(DataFrame.unionByName, found).distinct().collect()}  # as many as seasons
    return None if _WHOLE in seasons or None in seasons else sorted(map(int, seasons))


def _of_seasons(name: str, df: DataFrame, races: DataFrame, seasons: list[int]) -> DataFrame:
    for column in ("season", "year"):
        if column in df.columns:
            return df.filter(F.col(column).cast("int").isin(seasons))
    if "race_id" in df.columns:
        wanted = races.filter(F.col("year").cast("int").isin(seasons)).select("race_id")
        return df.join(wanted, "race_id", "left_semi")
    return df


def _replace_seasons(spark: SparkSession, rows: DataFrame, table: str, seasons: list[int]) -> None:
    """Overwrite the seasons' partitions; those without rows any more are dropped."""
    seen = Observation()
    rows = rows.select(*spark.table(table).columns).observe(seen, F.collect_set("season").alias("seasons"))
    rows.write.mode("overwrite").insertInto(table)
    for season in sorted(set(seasons) - set(seen.get["seasons"])):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (season = {season})")


def build_changed(
    spark: SparkSession,
    names: Iterable[str] = tuple(MODELS),
    bronze: str = "bronze",
    prefix: str = "",
    state: str = "marts.build_inputs",
    models: Mapping[str, Model] = MODELS,
    by_season: Iterable[str] = BY_SEASON,
) -> dict[str, list[int] | str]:
    """Build the named models and what they need; what was written of each: ``all``, its seasons, or an empty list.

    ``state`` is the table of checksums. It is written after a model, so a build that was interrupted does the model
    again. Tables are those of ``build_models``; models by season are partitioned by it.
    """
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")

    def open_table(name: str) -> DataFrame:
        return spark.table(f"{prefix}{models[name].layer}.{name}" if name in models else f"{bronze}.{name}")

    inputs, written = _Inputs(open_table), {}
    for name in build_order(names, models):
        model, table, by = models[name], f"{prefix}{models[name].layer}.{name}", name in by_season
        new = reduce(DataFrame.unionByName, [inputs.checksums(i, by) for i in model.inputs])
        known = spark.catalog.tableExists(state) and spark.catalog.tableExists(table)
        old = spark.table(state).filter(F.col("model") == name) if known else None
        seasons: list[int] | str | None = "all"
        if old is not None and not old.isEmpty():
            changed = settle(_changed(old, new))
            seasons = [] if changed.isEmpty() else _seasons(changed, model, open_table) if by else "all"
            seasons = "all" if seasons is None else seasons
            if not seasons:
                written[name] = []
                if not changed.isEmpty():  # keys that no season uses
                    _keep(spark, new, name, state)
                continue
        frames = [open_table(i) for i in model.inputs]
        if seasons == "all":
            partition = model.partition or ("season" if by else None)
            write_table(model.build(*frames), table, partition=partition)
        else:
            races = open_table("dim_races")
            parts = [_of_seasons(i, df, races, seasons) for i, df in zip(model.inputs, frames)]
            _replace_seasons(spark, model.build(*parts), table, seasons)
        spark.catalog.refreshTable(table)
        _keep(spark, new, name, state)
        written[name] = seasons
    return written


def _keep(spark: SparkSession, new: DataFrame, model: str, state: str) -> None:
    rows = new.select("input", "unit", "n", "digest", F.lit(model).alias("model"))
    if spark.catalog.tableExists(state):
        rows.write.mode("overwrite").insertInto(state)
    else:
        rows.write.format("parquet").partitionBy("model").saveAsTable(state)
