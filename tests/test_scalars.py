from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lapstack.functions import scalars as s
from lapstack.plans.silver import classify_status

from conftest import rows


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, ms",
    [
        ("1:38.109", 98109),
        ("1:42:06.304", 6126304),
        ("13.341", 13341),
        ("16:44.718", 1004718),
        ("1:00.000", 60000),
        ("1:00:00.000", 3600000),
        ("0.001", 1),
        (None, None),
        ("garbage", None),
        ("1:xx.5", None),
        ("", None),
    ],
)
def test_duration(spark, text, ms):
    assert one(spark, text, s.duration_ms("v")) == ms


@pytest.mark.parametrize("text, want", [("14:00:00Z", "14:00:00"), ("14:00:00", "14:00:00"), (None, None), ("Z", "")])
def test_strip_zulu(spark, text, want):
    assert one(spark, text, s.strip_zulu("v")) == want


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "1")], "a int, b string")
    keys = [r["k"] for r in df.select(s.surrogate_key(["a", "b"]).alias("k")).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)


def test_average_rounds_half_up_once(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (2,), (None,)], "v smallint")
    assert df.agg(s.exact_avg("v", 4, 2).alias("x")).first()["x"] == Decimal("1.75")
    eight = spark.createDataFrame([(i,) for i in (0, 0, 0, 0, 0, 0, 0, 1)], "v int")
    assert eight.agg(s.exact_avg("v", 4, 2).alias("x")).first()["x"] == Decimal("0.13")


def test_clock_accepts_times_and_rejects_others(spark):
    assert one(spark, "09:30:00", s.clock_text("v")) == "09:30:00"
    assert one(spark, None, s.clock_text("v")) is None
    with pytest.raises(PySparkException):
        one(spark, "25:00:00", s.clock_text("v"))


@pytest.mark.parametrize(
    "text, label",
    [
        ("Finished", "Finished"),
        ("+1 Lap", "Other"),
        ("Engine fire", "Engine"),
        ("Did not prequalify", "Other"),
        ("Did not pre-qualify", "Did Not Pre-Qualify"),
        ("TIRE failure", "Tyre"),
        ("Not classified", "Not Classified"),
        (None, "Other"),
    ],
)
def test_status_first_match_wins(spark, text, label):
    df = spark.createDataFrame([(text,)], "status string")
    assert classify_status(df).first()["status_category"] == label


def test_bands_and_display(spark):
    df = spark.createDataFrame([(1,), (3,), (10,), (11,), (None,)], "p int")
    got = rows(df.select("p", s.finish_band("p").alias("b"), s.display_text("p", "DNF").alias("t")))
    assert got == sorted(
        [
            (1, s.BAND_WIN, "1"),
            (3, s.BAND_PODIUM, "3"),
            (10, s.BAND_POINTS, "10"),
            (11, s.BAND_OUTSIDE, "11"),
            (None, s.BAND_NONE, "DNF"),
        ],
        key=repr,
    )


def test_flags_are_never_null(spark):
    assert one(spark, None, s.flag(F.col("v") == 1), "int") is False


def test_names_with_a_missing_part_are_null(spark):
    df = spark.createDataFrame([("A", None), ("A", "B")], "f string, l string")
    assert rows(df.select(s.full_name("f", "l").alias("n"))) == [("A B",), (None,)]
