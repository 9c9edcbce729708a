"""Documents read by ranges against the same documents read whole."""

import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapstack.plans.normalise import normalise
from lapstack.schemas import BRONZE_COLUMNS, ROUND_ENDPOINTS, payload_path
from lapstack.session import DOCUMENT_BYTES
from lapstack.sources import payloads as p
from lapstack.sources.documents import read_pieces, split_entries, split_items, write_documents
from lapstack.sources.files import read_year_payloads

from conftest import rows
from test_normalise import landed  # noqa: F401

HOSTILE = ['}', '{', '"', '\\', '\\"', '"Laps":[{', '"Races": [{"a":1}]', "],", "},{", "\n", "é}", '","x":{', "\\\\", "}}]", "plain"]


def note(rng):
    return "".join(rng.choice(HOSTILE) for _ in range(rng.randint(0, 6)))


def timing(rng):
    return {"driverId": note(rng), "position": str(rng.randrange(20)), "time": f"1:{rng.randrange(60):02}.{rng.randrange(1000):03}"}


def lap(rng, n):
    item = {"number": str(n), "Timings": [timing(rng) for _ in range(rng.randint(0, 4))]}
    if rng.random() < 0.3:
        item["other"] = {"Laps": [{"x": note(rng)}], "deep": [[{"y": {}}], {}]}
    return shuffled(rng, item)


def shuffled(rng, fields):
    return dict(sorted(fields.items(), key=lambda _: rng.random()))


def race(rng, n):
    entry = {
        "season": "2031",
        "round": str(n),
        "raceName": note(rng),
        "Circuit": {"circuitId": note(rng), "Location": {"lat": "1", "country": note(rng)}, "tags": [{"a": 1}, {"b": note(rng)}]},
        "Laps": [lap(rng, i) for i in range(rng.choice([0, 1, 2, 30]))],
        "Other": [{"Laps": note(rng)}, {"z": [{"w": 1}]}],
        "numbers": [1, 2, 3],
        "date": "2031-01-01",
    }
    return shuffled(rng, entry)


def document(rng, n):
    table = shuffled(rng, {"season": "2031", "Races": [race(rng, i + 1) for i in range(n)], "meta": {"q": note(rng)}})
    return {"MRData": shuffled(rng, {"total": "5", "limit": "30", "RaceTable": table, "url": note(rng)})}


def written(folder, endpoint, texts):
    for year, text in texts.items():
        (folder / year).mkdir(parents=True)
        (folder / year / f"{endpoint}.json").write_text(text)
    return str(folder)


def items_of(df):
    return rows(df.select("year", "_entry", "_item", "season", "round", F.to_json("i").alias("i")))


@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":")}])
def test_items_equal_those_of_a_whole_read(spark, tmp_path, layout):
    rng = random.Random(str(layout))
    texts = {y: json.dumps(document(rng, n), ensure_ascii=rng.random() < 0.5, **layout) for y, n in (("2031", 9), ("2032", 4), ("2033", 0), ("old", 2))}
    root = written(tmp_path / "api", "laps", texts)
    whole = items_of(p.round_items(read_year_payloads(spark, root, "laps", 2031), "laps"))
    assert len(whole) > 20
    for size in (200, 5_000, None):
        assert items_of(split_items(spark, f"{root}/*/laps.json", "laps", 2031, size)) == whole
    blocks = read_pieces(spark, f"{root}/*/laps.json", 2031, 200).select("file", "block").distinct().count()
    assert blocks > len(texts["2031"]) / 300


@pytest.mark.parametrize("layout", [{}, {"indent": 2}])
def test_entries_equal_those_of_a_whole_read(spark, tmp_path, layout):
    rng = random.Random(7)
    texts = {"2031": json.dumps(document(rng, 12), **layout), "2030": json.dumps(document(rng, 3), **layout)}
    root = written(tmp_path / "api", "races", texts)
    whole = rows(p.races(read_year_payloads(spark, root, "races", 2031)).withColumn("circuit", F.to_json("circuit")))
    split = p.races(split_entries(spark, f"{root}/*/races.json", "races", 2031, 300))
    assert rows(split.withColumn("circuit", F.to_json("circuit"))) == whole and len(whole) == 12


def test_no_documents_or_entries(spark, tmp_path):
    root = written(tmp_path / "api", "laps", {"2031": "{}", "2032": '{"MRData": {"RaceTable": {"Races": []}}}\n'})
    assert split_items(spark, f"{root}/*/laps.json", "laps", 0).count() == 0
    assert split_entries(spark, f"{root}/*/laps.json", "races", 0).count() == 0


def test_written_documents_read_back(spark, tmp_path):
    rng = random.Random(3)
    made = [(y, r, f"name {note(rng)}", i + 1, note(rng) or None) for y in (2031, 2032) for r in (1, 2, 11) for i in range(rng.randint(1, 40))]
    frame = spark.createDataFrame(made, "season int, round int, raceName string, place int, driver string")
    item = F.struct(F.col("place").cast("string").alias("number"), F.array(F.struct(F.col("driver").alias("driverId"))).alias("Timings"))
    names = {(y, r): n for y, r, n, *_ in made}
    one_name = frame.withColumn("raceName", F.first("raceName").over(Window.partitionBy("season", "round").orderBy("place")))
    write_documents(one_name, str(tmp_path / "docs"), "laps", "season", ["season", "round", "raceName"], "place", item)
    files = {path.parent.name: json.loads(path.read_text()) for path in (tmp_path / "docs").glob("year=*/*.txt")}
    assert {y: d["MRData"]["total"] for y, d in files.items()} == {f"year={y}": str(sum(m[0] == y for m in made)) for y in (2031, 2032)}
    for y, d in files.items():
        entries = d["MRData"]["RaceTable"]["Races"]
        assert [e["round"] for e in entries] == ["1", "2", "11"] and all(len(names) and e["Laps"][0]["number"] == "1" for e in entries)
    laps = p.lap_times(split_items(spark, f"{tmp_path}/docs/*", "laps", 0, 400))
    assert rows(laps.select("season", "round", F.col("_item") + 1, "driver_slug")) == sorted(((y, r, i, d) for y, r, _, i, d in made), key=repr)


def test_bronze_is_the_same_from_split_documents(spark, landed):  # noqa: F811
    whole = {t: rows(df) for t, df in normalise(spark, *landed, start_year=2031).items()}
    spark.conf.set(DOCUMENT_BYTES, "1")
    try:
        split = {t: rows(df) for t, df in normalise(spark, *landed, start_year=2031).items()}
    finally:
        spark.conf.unset(DOCUMENT_BYTES)
    assert split == whole and set(split) == set(BRONZE_COLUMNS)


def test_every_endpoint_is_known():
    assert all(payload_path(e).count(".") == 2 for e in ROUND_ENDPOINTS)
