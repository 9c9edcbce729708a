import pytest
from pyspark.errors import AnalysisException

from lapstack.schemas import HISTORY_TABLES
from lapstack.sources.files import completeness_report, read_text_csv
from lapstack.sources.sinks import bronze_layout, create_layers, load_table, validate_load, write_bronze, write_table

from conftest import rows


def test_csv_with_mark_and_bad_bytes(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("﻿id,name,note\n1,Zoë,NA\n2,NULL,\"a, \"\"b\"\"\"\n".encode() + b"3,bad\xffbyte,\n")
    assert rows(read_text_csv(spark, str(path), ["name", "id", "absent", "note"])) == sorted(
        [("Zoë", "1", None, "NA"), (None, "2", None, 'a, "b"'), ("bad�byte", "3", None, None)], key=repr
    )
    assert rows(read_text_csv(spark, str(path), ["id", "note"], wide_nulls=True)) == sorted(
        [("1", None), ("2", 'a, "b"'), ("3", None)], key=repr
    )


def test_completeness(spark):
    expected = spark.createDataFrame([(n,) for n in HISTORY_TABLES[:3]], "name string")
    full, empty = spark.range(3), spark.range(0)
    years = spark.createDataFrame([("2022",), ("2024",)], "year string")
    present = {HISTORY_TABLES[0]: full, HISTORY_TABLES[1]: empty}
    report = completeness_report(expected, present, years, 2024)
    assert rows(report, "name", "passed") == sorted(
        [(HISTORY_TABLES[0], True), (HISTORY_TABLES[1], False), (HISTORY_TABLES[2], False), ("year", True)]
    )
    stale = completeness_report(expected, present, years, 2025)
    assert rows(stale.filter("check = 'last_year'"), "found", "passed") == [(2024, False)]
    nothing = completeness_report(expected, {}, years.limit(0), 2024)
    assert rows(nothing, "passed") == [(False,)] * 4


def test_load_modes(spark, tmp_path):
    create_layers(spark, ["modes"], str(tmp_path / "db"))
    frame = spark.createDataFrame([("1", "x", "api"), ("2", None, "api")], "statusId string, status string, source string")
    path = str(tmp_path / "status")
    write_bronze(frame, path, ["statusId", "status"])
    load_table(spark, path, "modes.status", ["statusId", "status"])
    load_table(spark, path, "modes.status", ["statusId", "status"], "replace")
    assert spark.table("modes.status").count() == 2
    load_table(spark, path, "modes.status", ["statusId", "status"], "append")
    assert spark.table("modes.status").filter("status IS NULL").count() == 2
    with pytest.raises(AnalysisException):
        load_table(spark, path, "modes.status", ["statusId", "status"], "fail")
    assert rows(validate_load(spark, "modes", ["status"])) == [("status", 4)]
    with pytest.raises(ValueError, match="results"):
        validate_load(spark, "modes", ["status", "results"])


def test_layout_and_partitions(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2030, "x"), (2, 2031, "y")], "id int, season int, extra string")
    assert bronze_layout(frame, ["missing", "id"]).columns == ["missing", "id", "source"]
    create_layers(spark, ["parted"], str(tmp_path / "db"))
    write_table(frame, "parted.t", partition="season")
    plan = spark.table("parted.t").filter("season = 2031")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
