"""What large tables may not do: move wide rows twice, cut few rows into many chunks, store a file for each small block."""

from __future__ import annotations

import datetime as dt
import glob

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapstack.operators import scans
from lapstack.operators.scans import GroupProfile, _chunks
from lapstack.plans import marts, quality, star
from lapstack.registry import landing
from lapstack.session import scratch_path
from lapstack.sources.documents import read_pieces
from lapstack.sources.sinks import write_fixed
from tests.conftest import rows

_ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
_LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


def _orders(spark):
    """Two customers; order 2 comes twice, order 5 has no day, order 6 no customer, orders 1 to 3 are of one month."""
    day = dt.datetime(1998, 3, 4)
    of = {1: (7, day), 2: (7, day), 3: (7, day), 4: (8, day), 5: (8, None), 6: (None, day), 7: (7, dt.datetime(2000, 1, 1))}
    listed = [(k, c, "O", 1.0, d, "1") for k, (c, d) in of.items()]
    return spark.createDataFrame([*listed, listed[1]], _ORDERS)


def _lines(spark):
    day = dt.datetime(1998, 5, 1)
    made = [(k, p, 1, n, 1.0, 10.0 * p, 0.1, 0.0, "R" if n % 2 else "N", "O", day) for k in range(1, 9) for n, p in enumerate((30, 10, 20), 1)]
    return spark.createDataFrame([*made, made[0]], _LINES)


def test_low_limits_do_not_make_many_chunks():
    assert _chunks(GroupProfile(100, 80, 8_400_000)) == 42
    assert _chunks(GroupProfile(2_000_000, 7, 50_000_000)) == 50
    assert _chunks(GroupProfile(3, 1, 10)) == 7


def test_large_files_are_read_in_pieces_a_task_can_sort(spark, tmp_path):
    with open(tmp_path / "lines.txt", "wb") as f:
        f.truncate(96 << 20)
    # as where there are far more bytes than cores
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert spark.read.text(f"{tmp_path}/lines.txt").rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def _numbered_plainly(orders, lines):
    owner = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("driver_id"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("race_id"),
    )
    order = [F.col(c).asc_nulls_last() for c in star.LINE_COLUMNS]
    place = F.row_number().over(Window.partitionBy("race_id", "driver_id").orderBy(*order))
    return lines.join(owner, "l_orderkey").withColumn("lap_number", place)


def test_lines_are_numbered_within_the_month_as_by_one_window(spark):
    orders, lines = _orders(spark), _lines(spark)
    made = star.lap_lines(orders, lines).withColumn("price", F.col("lap_milliseconds") / 100)
    plain = _numbered_plainly(orders, lines).withColumn("price", F.col("l_extendedprice"))
    assert rows(made, "race_id", "driver_id", "lap_number", "price") == rows(plain, "race_id", "driver_id", "lap_number", "price")


def test_hot_orders_are_numbered_alike(spark, tiny_groups):
    orders, lines = _orders(spark), _lines(spark)
    columns = ("race_id", "driver_id", "lap_number", "l_linenumber")
    assert rows(star.lap_lines(orders, lines), *columns) == rows(_numbered_plainly(orders, lines), *columns)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_numbered_within_their_order(spark):
    plan = _plan(star.lap_lines(_orders(spark), _lines(spark)))
    # what is laid out by month are orders, read from their own small rows
    numbered = [x for x in plan.splitlines() if "Window [row_number()" in x]
    assert numbered and all("windowspecdefinition(l_orderkey" in x for x in numbered)


def _stops_plainly(lines):
    place = F.row_number().over(Window.partitionBy("race_id", "driver_id").orderBy("lap_number")).cast("int")
    return lines.filter("l_returnflag = 'R'").withColumn("stop_number", place)


def test_returned_lines_know_their_number(spark):
    lines = _lines(spark).withColumn("l_returnflag", F.when(~((F.col("l_orderkey") == 4) & (F.col("l_linenumber") == 1)), F.col("l_returnflag")))
    made = spark.createDataFrame(star.lap_lines(_orders(spark), lines).collect(), star.lap_lines(_orders(spark), lines).schema)
    columns = ("race_id", "driver_id", "lap_number", "stop_number")
    stops = star.fact_pit_stops(made)
    assert stops.count() > 10 and rows(stops, *columns) == rows(_stops_plainly(made), *columns)
    # they are told without moving a row
    assert "Exchange" not in _plan(stops) and "Window" not in _plan(stops)


def test_hot_orders_know_their_stops(spark, tiny_groups):
    made = star.lap_lines(_orders(spark), _lines(spark)).cache()
    columns = ("race_id", "driver_id", "lap_number", "stop_number")
    assert rows(star.fact_pit_stops(made), *columns) == rows(_stops_plainly(made), *columns)


def test_models_told_row_by_row_are_not_stored(spark, tmp_path):
    _orders(spark).write.parquet(f"{tmp_path}/orders.parquet")
    _lines(spark).write.parquet(f"{tmp_path}/lineitem.parquet")
    t = star.StarTables(spark, str(tmp_path))
    stops, laps = t["fact_pit_stops"], t["fact_lap_times"]
    assert set(t._store) == {"lap_lines"}
    assert set(laps.inputFiles()) == set(stops.inputFiles()) == set(t["lap_lines"].inputFiles())
    assert t["fact_lap_times"] is laps and laps.count() > stops.count() > 0


def test_months_are_sized_by_their_orders(spark, monkeypatch):
    asked = []
    plain = star.profile_groups
    monkeypatch.setattr(star, "profile_groups", lambda df, keys, within=None: asked.append((df, keys, within)) or plain(df, keys, within=within))
    customer = spark.createDataFrame([(7,), (7,), (8,)], "c_custkey long")
    assert star.entries(_orders(spark), customer).count() == 4
    ((base, keys, within),) = asked
    most = [df.groupBy(*keys).count().agg(F.max("count")).first()[0] for df in (base, within)]
    assert most[0] <= most[1]


def test_races_of_a_season_are_counted_where_it_lies(spark):
    schema = (
        "driver_id long, season int, race_id long, is_win boolean, is_podium boolean, points decimal(18,2), sprint_points decimal(18,2), "
        "qualifying_position int, fastest_lap_rank int, is_dnf boolean, source string"
    )
    races = [(1, 2030, 5), (1, 2030, 5), (1, 2030, 6), (1, 2031, 7), (2, 2030, None), (2, None, 8), (None, 2030, 9), (None, 2030, 9)]
    hub = spark.createDataFrame([(*r, True, False, None, None, 1, 1, False, "api") for r in races], schema)
    rollup = marts.season_rollup(hub, "driver_id")
    distinct = hub.groupBy("driver_id", "season").agg(F.count_distinct("race_id").alias("races_entered"))
    columns = ("driver_id", "season", "races_entered")
    assert rows(rollup, *columns) == rows(distinct, *columns)
    assert rollup.schema["races_entered"].dataType == distinct.schema["races_entered"].dataType
    assert _plan(rollup).count("Exchange hashpartitioning") == 1


def test_numbers_of_hot_groups_need_no_window_over_their_rows(spark):
    table = spark.range(600).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("n"), (F.col("id") % 40).alias("v"), F.col("id").alias("x"))
    table = table.unionByName(table.limit(50)).withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col("v").desc(), F.col("x").asc_nulls_last()]
    hot = scans._chunked_scan(table, ["k", "n"], order, {"at": scans.row_number()}, GroupProfile(30, 8, 650))
    plain = table.drop("_tie").withColumn("at", F.row_number().over(Window.partitionBy("k", "n").orderBy(*order)).cast("bigint"))
    assert rows(hot) == rows(plain) and hot.columns == plain.columns
    assert "Window" not in _plan(hot) and "Exchange hashpartitioning" not in _plan(hot)


def test_numbered_rows_of_files_are_not_stored_once_more(spark, tmp_path):
    table = spark.range(25).select((25 - F.col("id")).cast("string").alias("id"), F.lit("api").alias("source")).repartition(4)
    stored = f"{scratch_path(spark, 'x').rsplit('/', 1)[0]}/*"
    before = set(glob.glob(stored))
    write_fixed(table, f"{tmp_path}/table", ["id"], [F.col("id").cast("bigint")], 10)
    made = {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in set(glob.glob(stored)) - before}
    assert "places" in made and "numbered" not in made
    files = sorted(glob.glob(f"{tmp_path}/table/part-*.csv"))
    found = [[line.split(",")[0] for line in open(file).read().split()[1:]] for file in files]
    assert found == [[str(i) for i in range(low, min(low + 10, 26))] for low in (1, 11, 21)]


def test_pages_of_results_are_compressed_and_whole(spark, tmp_path):
    _orders(spark).write.parquet(f"{tmp_path}/orders.parquet")
    _lines(spark).write.parquet(f"{tmp_path}/lineitem.parquet")
    t = star.StarTables(spark, str(tmp_path))
    path = t.landed("results_payloads", landing._write_payloads("results"))
    found = glob.glob(f"{path}/year=*/part-*")
    assert found and all(f.endswith(".json.gz") for f in found)
    results = landing.payloads(t, "results").select(F.explode("MRData.RaceTable.Races").alias("e")).select("e.raceName", F.explode("e.Results").alias("r"))
    # every line of a dated order, those of the order that comes twice twice
    counts = {r["raceName"]: r["n"] for r in results.groupBy("raceName").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"1": 4, "2": 6, "3": 3, "4": 3, "6": 3, "7": 3}


def test_dimensions_join_where_the_entry_lies(spark):
    laps = spark.createDataFrame([(1, 1, 10, 5), (1, 1, 11, 5), (1, 2, 12, 6), (1, 3, None, 7)], "race_id long, driver_id long, result_id long, lap_ms long")
    entry = spark.createDataFrame([(1, 1, 10, "a"), (1, 1, 11, "b"), (1, 2, 13, "c"), (1, 3, None, "d")], "race_id long, driver_id long, result_id long, name string")
    kept = [(1, 1, 10, 5, "a"), (1, 1, 11, 5, "b")]
    for hot in (0, 1):
        joined = marts._with_entry(laps, entry, GroupProfile(10, hot, hot))
        assert rows(joined, "race_id", "driver_id", "result_id", "lap_ms", "name") == kept
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(marts._with_entry(laps, entry, GroupProfile(10, 0, 0)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(race_id" in plan
    assert not any("result" in line for line in plan.splitlines() if "hashpartitioning" in line)


def test_long_keys_stay_where_they_are(spark):
    table = spark.createDataFrame([("a",), ("b",), ("b",), ("b",), (None,), (None,), ("c",), ("c",)], "key string")
    assert quality.unique(table, "t", "key").first()["violations"] == 2
    alone = quality.unique(table.filter("key = 'a'"), "t", "key")
    assert alone.first()["violations"] == 0 and "xxhash64" in _plan(alone)
    numbers = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "key double")
    assert quality.unique(numbers, "t", "key").first()["violations"] == 1


def test_written_tables_tell_repeats_and_lost_keys(spark, tmp_path):
    tables = {
        "child": spark.createDataFrame([(1, 1), (1, 2), (2, 3), (3, None)], "id long, parent_id long"),
        "parent": spark.createDataFrame([(1,), (2,)], "parent_id long"),
    }

    def write(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    report = quality.written_and_checked(tables, write, {"child": ["id"]}, {"child": ["parent_id"]}, [("child", "parent_id", "parent")])
    told = {(r["check"], r["table_name"]): r["violations"] for r in report.collect()}
    assert told == {("row_count", "child"): 0, ("row_count", "parent"): 0, ("not_null", "child"): 1, ("unique", "child"): 1, ("relationship", "child"): 1}


def test_small_blocks_share_files(spark, tmp_path):
    folder = tmp_path / "2031"
    folder.mkdir()
    (folder / "laps.json").write_text('{"a":"}\\"}x","b":[{"c":1}]}' * 400)
    pieces = read_pieces(spark, str(folder), 2031, 50)
    most = 4 * spark.sparkContext.defaultParallelism
    assert pieces.select("file", "block").distinct().count() > most >= len(pieces.inputFiles())
    # a brace that ends in a quoted text is none
    first = pieces.orderBy("seq").select("quotes", "outer", "inner").first()
    assert tuple(first) == (3, 1, -1)
    assert pieces.select("year").distinct().collect() == [(2031,)]
