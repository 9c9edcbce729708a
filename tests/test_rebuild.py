"""Rebuilding what changed, on a graph of five models."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lapstack.plans.models import Model, build_models
from lapstack.plans.rebuild import build_changed
from lapstack.sources.sinks import create_layers, write_table

from conftest import rows

RACES = [(s * 100 + r, s, r) for s in (2030, 2031, 2032) for r in (1, 2)]
DRIVERS = [(d, f"name {d}") for d in range(5)]
RESULTS = [(race, d, race % 7 + d) for race, s, _ in RACES for d in range(4) if d != 3 or s == 2031]


def hub(results, drivers, races):
    return results.join(drivers, "driver_id").join(races, "race_id").select(
        "race_id", "driver_id", "name", "points", F.col("year").alias("season")
    )


def career(hub_rows, drivers):
    return drivers.join(hub_rows.groupBy("driver_id").agg(F.sum("points").alias("points")), "driver_id", "left")


MODELS = {
    "dim_races": Model("silver", lambda r: r, ("races",)),
    "dim_drivers": Model("silver", lambda d: d, ("drivers",)),
    "fact_results": Model("silver", lambda r: r, ("results",)),
    "hub": Model("marts", hub, ("fact_results", "dim_drivers", "dim_races"), "season"),
    "career": Model("marts", career, ("hub", "dim_drivers")),
}


class Warehouse:
    def __init__(self, spark, root: Path, tag: str):
        self.spark, self.root, self.tag = spark, root, tag
        create_layers(spark, [f"{tag}_{n}" for n in ("bronze", "silver", "marts")], str(root))
        create_layers(spark, [f"{tag}f_{n}" for n in ("silver", "marts")], str(root))

    def put(self, races=RACES, drivers=DRIVERS, results=RESULTS):
        for name, data, schema in (
            ("races", races, "race_id bigint, year int, round int"),
            ("drivers", drivers, "driver_id bigint, name string"),
            ("results", results, "race_id bigint, driver_id bigint, points bigint"),
        ):
            write_table(self.spark.createDataFrame(data, schema).repartition(3), f"{self.tag}_bronze.{name}")

    def build(self):
        state = f"{self.tag}_marts.build_inputs"
        got = build_changed(self.spark, MODELS, f"{self.tag}_bronze", f"{self.tag}_", state, MODELS, {"hub"})
        build_models(self.spark, MODELS, f"{self.tag}_bronze", f"{self.tag}f_", MODELS)
        for name, m in MODELS.items():
            mine, full = (self.spark.table(f"{self.tag}{x}_{m.layer}.{name}") for x in ("", "f"))
            assert rows(mine, *full.columns) == rows(full), name
        return got

    def files(self):
        return {p: p.stat().st_mtime_ns for layer in ("silver", "marts") for p in (self.root / f"{self.tag}_{layer}").rglob("*.parquet")}


@pytest.fixture
def warehouse(spark, tmp_path, request):
    house = Warehouse(spark, tmp_path, f"reb{abs(hash(request.node.name)) % 10**6}")
    house.put()
    assert house.build() == dict.fromkeys(MODELS, "all")
    return house


def test_an_unchanged_build_writes_nothing(warehouse):
    before = warehouse.files()
    assert warehouse.build() == {n: [] for n in MODELS} and warehouse.files() == before
    warehouse.put(RACES[::-1], DRIVERS[::-1], RESULTS[::-1])  # the same rows in another order
    assert warehouse.build() == {n: [] for n in MODELS} and warehouse.files() == before


def test_one_season_changes(warehouse):
    before = warehouse.files()
    warehouse.put(results=[(r, d, p + (r == 203101 and d == 2)) for r, d, p in RESULTS])
    got = warehouse.build()
    assert got == {"dim_races": [], "dim_drivers": [], "fact_results": "all", "hub": [2031], "career": "all"}
    kept = {p for p in before if "season=2030" in str(p) or "season=2032" in str(p)}
    assert kept and all(warehouse.files()[p] == before[p] for p in kept)


def test_rows_come_and_go(warehouse):
    warehouse.put(races=[*RACES, (203301, 2033, 1)], results=[*[r for r in RESULTS if r[0] // 100 != 2032], (203301, 0, 9)])
    got = warehouse.build()
    assert got["hub"] == [2032, 2033] and got["dim_races"] == "all"
    names = {r[0] for r in warehouse.spark.sql(f"SHOW PARTITIONS {warehouse.tag}_marts.hub").collect()}
    assert names == {"season=2030", "season=2031", "season=2033"}


def test_a_key_touches_the_seasons_that_use_it(warehouse):
    warehouse.put(drivers=[(d, n if d != 3 else "other") for d, n in DRIVERS])
    assert warehouse.build()["hub"] == [2031]
    warehouse.put(drivers=[(d, n if d != 3 else "other") for d, n in DRIVERS if d != 0])
    assert warehouse.build()["hub"] == [2030, 2031, 2032]  # rows of a driver that is gone
    warehouse.put(drivers=[(d, n if d != 3 else "other") for d, n in DRIVERS if d != 0] + [(99, "new")])
    got = warehouse.build()
    assert got["hub"] == [] and got["dim_drivers"] == got["career"] == "all"
    assert warehouse.build() == {n: [] for n in MODELS}


def test_an_interrupted_build_is_done_again(warehouse):
    spark, state = warehouse.spark, f"{warehouse.tag}_marts.build_inputs"
    spark.sql(f"ALTER TABLE {state} DROP PARTITION (model = 'hub')")
    assert warehouse.build() == {"dim_races": [], "dim_drivers": [], "fact_results": [], "hub": "all", "career": []}
