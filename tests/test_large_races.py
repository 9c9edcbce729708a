"""Races with far more entries than any real one: places in a list are not bound by the widths of racing data."""

import json

import pytest
from pyspark.sql import functions as F

from lapstack import session
from lapstack.plans import star
from lapstack.plans.silver import silver_table
from lapstack.registry import landing
from lapstack.schemas import BRONZE_COLUMNS
from lapstack.session import stage
from lapstack.sources import documents
from lapstack.sources.sinks import write_table
from tests.conftest import rows
from tests.test_moved_rows import _lines, _orders


@pytest.mark.parametrize(("table", "bronze"), [("fact_results", "results"), ("fact_sprint_results", "sprint_results")])
def test_places_of_a_large_race_are_typed(spark, table, bronze):
    columns = {c: F.lit("1") for c in [*BRONZE_COLUMNS[bronze], "source"]}
    # as ``payloads`` tells them from the place of an item in its list
    columns["positionOrder"] = F.element_at(F.array(F.lit("32768"), F.lit("110000"), F.lit("3000000001")), F.col("id").cast("int"))
    typed = silver_table(table, spark.range(1, 4).select("id", *[v.alias(c) for c, v in columns.items()]))
    assert rows(typed, "position_order") == [(110000,), (3000000001,), (32768,)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_pack_well_are_not_broadcast(spark):
    """Half a million names take under a megabyte in files, and many times that in the driver."""
    names = stage(spark.range(500_000).select("id", F.concat(F.lit("customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("name")), "names")
    assert "Broadcast" not in _plan(names.join(names.withColumnRenamed("name", "other"), "id"))


def test_stored_frames_are_broadcast_when_counted_few(spark, monkeypatch):
    stats = stage(spark.range(20), "stats")
    rows_of = spark.range(1000).withColumn("id", F.col("id") % 40)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        joined = rows_of.join(session.few(stats), "id")
        assert "BroadcastHashJoin" in _plan(joined) and joined.count() == 500
        monkeypatch.setattr(session, "_FEW_ROWS", 19)
        assert "Broadcast" not in _plan(rows_of.join(session.few(stats), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pieces_of_documents_move_once(spark, tmp_path, monkeypatch):
    """A long item, a long array and short ones: what lies in one block is put together there."""
    laps = lambda n, size=1: [{"number": str(i), "Timings": [{"driverId": "d" * size, "position": str(i)}]} for i in range(n)]
    races = [{"season": "2031", "round": str(r), "Laps": laps(n, size)} for r, (n, size) in enumerate([(3, 1), (60, 1), (0, 1), (2, 900), (4, 2)], 1)]
    (tmp_path / "2031").mkdir()
    (tmp_path / "2031" / "laps.json").write_text(json.dumps({"MRData": {"RaceTable": {"Races": races}}}))
    stored, plain = [], documents.stage
    monkeypatch.setattr(documents, "stage", lambda df, label: stored.append((label, _plan(df))) or plain(df, label))
    items = documents.split_items(spark, f"{tmp_path}/*/laps.json", "laps", 2031, 400)
    found = rows(items, "round", "_entry", "_item", "i.number", F.length(F.col("i.Timings")[0]["driverId"]))
    assert found == sorted(((r["round"] and int(r["round"]), e, n, i["number"], len(i["Timings"][0]["driverId"])) for e, r in enumerate(races) for n, i in enumerate(r["Laps"])), key=repr)
    # texts are stored as pieces and as what a block holds of an item, and shuffled once between
    assert [label for label, _ in stored] == ["pieces", "parts"]
    assert stored[1][1].count("Exchange hashpartitioning") == 1


def test_laps_of_documents_move_without_what_does_not_tell_them(spark, tmp_path, monkeypatch):
    _orders(spark).write.parquet(f"{tmp_path}/orders.parquet")
    _lines(spark).write.parquet(f"{tmp_path}/lineitem.parquet")
    plans, plain = [], landing.write_documents
    monkeypatch.setattr(landing, "write_documents", lambda lines, *more: plans.append(_plan(lines.select("ordinal", "l_suppkey"))) or plain(lines, *more))
    path = landing.lap_documents(star.StarTables(spark, str(tmp_path)))
    assert plans and not any(c in plans[0] for c in ("l_discount", "l_tax", "l_returnflag", "l_shipdate"))
    laps = documents.split_items(spark, f"{path}/*", "laps", 0, 100)
    plainly = landing.race_lines(star.StarTables(spark, str(tmp_path))).filter("season IS NOT NULL")
    assert laps.count() == plainly.count() > 10


def test_tables_by_season_are_written_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS large_races")
    races = spark.range(400, numPartitions=4).select("id", (F.col("id") % 3 + 2030).cast("int").alias("season"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("written", "a table by season")
    try:
        write_table(races, "large_races.races", partition="season")
        stages = [s for j in tracker.getJobIdsForGroup("written") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) == 1
    files = spark.table("large_races.races").inputFiles()
    # each season from every task, compressed as all stores are
    assert len(files) == 12 and all(f.endswith(".zstd.parquet") for f in files)
    assert rows(spark.table("large_races.races").groupBy("season").count()) == [(2030, 134), (2031, 133), (2032, 133)]
    spark.sql("DROP DATABASE large_races CASCADE")
