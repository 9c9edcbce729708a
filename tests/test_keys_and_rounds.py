import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lapstack.operators import keys, rounds
from lapstack.streaming.complete import complete_items, given_out, run_complete
from lapstack.streaming.rounds import apply_batch, current_items, drop_superseded, fold_season, run_available

from conftest import rows


def test_new_keys_take_the_first_mention(spark):
    known = spark.createDataFrame([("a", "4")], "ref string, id string")
    mentions = spark.createDataFrame(
        [(3, "c", "late"), (1, "b", None), (2, "b", "second"), (0, "a", "known"), (5, "c", "later")],
        "at int, ref string, note string",
    )
    fresh = keys.resolve_keys(known, mentions, ["ref"], "id", [F.col("at").asc()])
    assert rows(fresh, "ref", "id", "note") == [("b", 5, None), ("c", 6, "late")]


def test_ids_start_at_one_without_history(spark):
    known = spark.createDataFrame([], "ref string, id string")
    mentions = spark.createDataFrame([(1, "x"), (2, "y")], "at int, ref string")
    assert rows(keys.resolve_keys(known, mentions, ["ref"], "id", [F.col("at").desc()]), "ref", "id") == [
        ("x", 2),
        ("y", 1),
    ]


def test_a_reference_must_exist(spark):
    races = spark.createDataFrame([(2031, 1, "20")], "season int, round int, raceId string")
    good = spark.createDataFrame([(2031, 1, "a")], "season int, round int, who string")
    assert rows(keys.lookup_or_fail(good, races, ["season", "round"], "raceId"), "who", "raceId") == [("a", "20")]
    bad = good.unionByName(spark.createDataFrame([(2031, 9, "b")], good.schema))
    with pytest.raises(PySparkException, match=r"no row registered for \(2031, 9\)"):
        keys.lookup_or_fail(bad, races, ["season", "round"], "raceId").collect()


def test_a_repeated_key_gives_its_last_id_once(spark):
    races = spark.createDataFrame([(1, "20", 0), (1, "9", 1), (2, "7", 2)], "round int, raceId string, at int")
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "round int, who string")
    assert rows(keys.lookup_or_fail(facts, races, ["round"], "raceId", "at"), "who", "raceId") == [
        ("a", "9"),
        ("b", "9"),
        ("c", "7"),
    ]
    assert rows(keys.lookup_or_fail(facts, races, ["round"], "raceId"), "who", "raceId")[0] == ("a", "20")


@pytest.mark.parametrize("hot", [False, True])
def test_laps_split_over_pages_are_joined_in_page_order(spark, request, hot):
    if hot:
        request.getfixturevalue("tiny_groups")
    schema = "race string, page int, laps array<struct<number: string, parts: array<string>>>"
    pages = spark.createDataFrame(
        [
            ("r", 2, [("10", ["e"]), ("2", ["c", "d"])]),
            ("r", 1, [("2", ["a", "b"])]),
            ("r", 3, [("2", ["f"]), ("11", [])]),
            ("empty", 1, []),
        ],
        schema,
    )
    merged = rounds.merge_pages(pages, ["race"], "page", "laps", "number", "parts")
    assert [tuple(r) for r in merged.orderBy("number", "ordinal").collect()] == [
        ("r", 2, 1, "a"),
        ("r", 2, 2, "b"),
        ("r", 2, 3, "c"),
        ("r", 2, 4, "d"),
        ("r", 2, 5, "f"),
        ("r", 10, 1, "e"),
    ]


def test_flat_pages(spark):
    pages = spark.createDataFrame([("d", 2, ["c", "d"], 5), ("d", 0, ["a", "b"], 5)], "k string, o int, i array<string>, t int")
    assert rows(rounds.flat_pages(pages, ["k"], "o", "i")) == [("d", 1, "a"), ("d", 2, "b"), ("d", 3, "c"), ("d", 4, "d")]
    assert rows(rounds.pages_complete(pages, ["k"], "i", "t")) == [("d", 4, 5, False)]


def test_due_rounds(spark):
    races = spark.createDataFrame(
        [("1", "2031-03-01", True), ("2", "2031-04-01", False), ("3", "2031-04-02", True), ("4", None, True)],
        "round string, date string, sprint boolean",
    )
    assert rows(rounds.due_rounds(races, "2031-04-01"), "round") == [("1",), ("2",), ("4",)]
    assert rows(rounds.due_rounds(races, "2031-04-01", sprint=F.col("sprint")), "round") == [("1",), ("4",)]


def test_an_empty_fetch_never_wipes_a_round(spark):
    schema = "season int, round int, n_items int, tag string"
    stored = spark.createDataFrame([(31, 1, 1, "old"), (31, 2, 0, "old"), (31, 3, 4, "old"), (31, 5, 0, "old")], schema)
    fetched = spark.createDataFrame([(31, 1, 2, "new"), (31, 3, 0, "new"), (31, 4, 0, "new"), (31, 5, 0, "new")], schema)
    assert rows(rounds.upsert_rounds(stored, fetched, ["season", "round"])) == [
        (31, 1, 2, "new"),
        (31, 2, 0, "old"),
        (31, 3, 4, "old"),
        (31, 4, 0, "new"),
        (31, 5, 0, "new"),
    ]


def test_items_of_a_fetched_round_replace_the_stored(spark):
    stored = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "round int, item string")
    fetched = spark.createDataFrame([(1, "z"), (3, "n")], stored.schema)
    assert rows(rounds.upsert_items(stored, fetched, ["round"])) == [(1, "z"), (2, "c"), (3, "n")]


def test_nested_pages_hold_at_most_a_page(spark):
    items = spark.range(250).select(F.lit(1).alias("round"), F.col("id").alias("at"))
    pages = rounds.nest_rounds(items, ["round"], [F.col("at").asc()], ["at"])
    got = {r["page"]: [i["at"] for i in r["items"]] for r in pages.collect()}
    assert got == {0: list(range(100)), 1: list(range(100, 200)), 2: list(range(200, 250))}
    assert rows(rounds.payload_totals(pages, ["round"])) == [(1, 250)]


def _land(folder, name, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(p) for p in pages))


def page(round_, fetch, items, offset=0):
    return {"season": 2031, "round": round_, "endpoint": "results", "fetch": fetch, "offset": offset, "items": items}


def test_stream_keeps_the_newest_non_empty_fetch(spark, tmp_path):
    landing, store, progress = tmp_path / "landing", str(tmp_path / "store"), str(tmp_path / "progress")
    _land(landing, "a", page(1, 1, ["a1", "a2"]), page(2, 1, ["b1"]), page(3, 1, []))
    run_available(spark, str(landing), store, progress)
    _land(landing, "b", page(1, 2, ["a3"]), page(2, 2, []))
    run_available(spark, str(landing), store, progress)
    _land(landing, "c", page(1, 2, ["a4"], offset=1))
    run_available(spark, str(landing), store, progress)
    assert rows(current_items(spark, store), "round", "ordinal", "item") == [(1, 1, "a3"), (1, 2, "a4"), (2, 1, "b1")]


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "season int, round int, endpoint string, fetch bigint, `offset` bigint, items array<string>"
    first = spark.createDataFrame([(31, 1, "laps", 1, 0, ["x"]), (32, 1, "laps", 1, 0, ["q"])], schema)
    second = spark.createDataFrame([(31, 1, "laps", 2, 0, ["y", "z"])], schema)
    apply_batch(spark, store, first, 0)
    apply_batch(spark, store, second, 1)
    once = rows(current_items(spark, store))
    apply_batch(spark, store, second, 1)
    assert rows(current_items(spark, store)) == once
    assert [r[-1] for r in once] == ["y", "z", "q"]


def test_batches_stay_apart_in_static_overwrite_mode(spark, tmp_path):
    store, setting = str(tmp_path / "store"), "spark.sql.sources.partitionOverwriteMode"
    schema = "season int, round int, endpoint string, fetch bigint, `offset` bigint, items array<string>"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "static")
    try:
        apply_batch(spark, store, spark.createDataFrame([(31, 1, "laps", 1, 0, ["x"])], schema), 0)
        apply_batch(spark, store, spark.createDataFrame([(32, 1, "laps", 1, 0, ["y"])], schema), 1)
    finally:
        spark.conf.set(setting, before)
    assert rows(current_items(spark, store), "season", "item") == [(31, "x"), (32, "y")]
    assert rows(current_items(spark, store, [32]), "season", "item") == [(32, "y")]


def test_a_new_checkpoint_adds_to_the_store_and_copies_count_once(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    _land(landing, "a", page(1, 1, ["a1", "a2"]), page(2, 2, ["b1"]))
    run_available(spark, str(landing), store, str(tmp_path / "one"))
    _land(landing, "b", page(1, 3, ["a3"]), page(2, 2, ["b1"]))
    run_available(spark, str(landing), store, str(tmp_path / "two"))
    want = [(1, 1, "a3"), (2, 1, "b1")]
    assert rows(current_items(spark, store), "round", "ordinal", "item") == want
    assert drop_superseded(spark, store) == 0


def test_superseded_folders_go(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "season int, round int, endpoint string, fetch bigint, `offset` bigint, items array<string>"
    for fetch in (1, 2, 3):
        rounds_ = [1] if fetch < 3 else [1, 2]
        landed = spark.createDataFrame([(31, r, "laps", fetch, 0, [f"x{fetch}"]) for r in rounds_], schema)
        apply_batch(spark, store, landed, fetch)
    once = rows(current_items(spark, store))
    assert drop_superseded(spark, store) == 2
    assert rows(current_items(spark, store)) == once and len(once) == 2


def test_a_folded_season_is_one_folder(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "season int, round int, endpoint string, fetch bigint, `offset` bigint, items array<string>"
    for fetch in (1, 2, 3):
        landed = spark.createDataFrame([(s, r, "laps", fetch, 0, [f"x{fetch}", "y"]) for s in (31, 32) for r in range(fetch, 4)], schema)
        apply_batch(spark, store, landed, fetch)
    once = rows(current_items(spark, store))
    assert fold_season(spark, store, 31) == 3 and fold_season(spark, store, 31) == 0 and fold_season(spark, store, 99) == 0
    assert rows(current_items(spark, store)) == once
    assert len(list((tmp_path / "store" / "season=31").iterdir())) == 1 and len(list((tmp_path / "store" / "season=32").iterdir())) == 3
    apply_batch(spark, store, spark.createDataFrame([(31, 1, "laps", 1, 0, ["x1", "y"])], schema), 1)  # an old batch once more
    assert rows(current_items(spark, store)) == once


STAMP = "2031-05-01T%02d:00:00Z"


def total_page(round_, items, total, hour, offset=0, fetch=1):
    return page(round_, fetch, items, offset) | {"total": total, "landed_at": STAMP % hour}


def test_rounds_are_given_out_once_when_complete(spark, tmp_path):
    landing, given, progress, store = tmp_path / "landing", str(tmp_path / "given"), str(tmp_path / "progress"), str(tmp_path / "store")
    seen = []

    def step(name, *pages):
        _land(landing, name, *pages)
        run_complete(spark, str(landing), given, progress, delay_seconds=2 * 3600)
        run_available(spark, str(landing), store, str(tmp_path / "stored"))
        got = rows(given_out(spark, given), "round", "fetch", "collected", "reported", "complete")
        new = [r for r in got if r not in seen]
        assert len(got) == len(seen) + len(new)  # nothing is given out twice
        seen.extend(new)
        return new

    first = [
        total_page(1, ["a", "b"], 2, 1),
        total_page(2, ["c"], 3, 1),
        total_page(3, ["e"], 4, 1),
        total_page(4, [], 0, 1),
        total_page(5, ["x"], None, 1),
    ]
    assert step("a", *first, total_page(1, ["a", "b"], 2, 1)) == [(1, 1, 2, 2, True), (4, 1, 0, 0, True)]
    # a late page, a page twice, a page of a round that was given out, a second fetch
    assert step("b", total_page(2, ["d", "e"], 3, 2, 1), total_page(2, ["c"], 3, 2), total_page(1, ["a", "b"], 2, 2)) == [(2, 1, 3, 3, True)]
    assert step("c", total_page(1, ["z"], 1, 2, fetch=2), total_page(3, ["e"], 4, 2)) == [(1, 2, 1, 1, True)]
    assert rows(complete_items(spark, store, given), "round", "ordinal", "item") == [(1, 1, "z"), (2, 1, "c"), (2, 2, "d"), (2, 3, "e")]
    # time passes: what is short is given out as that, and pages after it come too late
    short = step("d", total_page(9, ["n"], 1, 20))
    short += step("e", total_page(10, ["n"], 1, 21))
    assert sorted(short, key=repr) == sorted([(3, 1, 1, 4, False), (5, 1, 1, None, False), (9, 1, 1, 1, True), (10, 1, 1, 1, True)], key=repr)
    assert step("f", total_page(3, ["f", "g", "h"], 4, 3, 1)) == []


def test_a_batch_of_given_rounds_run_again_replaces_itself(spark, tmp_path):
    assert given_out(spark, str(tmp_path / "none")).count() == 0
