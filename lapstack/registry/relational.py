"""Registered filters, joins, aggregations, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapstack.functions.scalars import exact_avg
from lapstack.operators.bitmaps import distinct_bitmaps, distinct_counts, merged_bitmaps
from lapstack.operators.groups import (
    best_per_key,
    distinct_list,
    five_numbers,
    pivot_matrix,
    rank_with_gap,
    record_holder,
    with_group_stats,
)
from lapstack.operators.scans import ordered_scan, previous, row_number, running_sum
from lapstack.plans import marts, serve
from lapstack.plans.quality import foreign_key
from lapstack.plans.star import RAW
from lapstack.registry.core import register
from lapstack.registry.sql import LINE_ORDER, half_up_avg
from lapstack.session import stage
from lapstack.sources.files import missing_names
from lapstack.sources.sinks import table_counts

ENTRY = "race_id driver_id season round points:double finish_position"
_ENTRY_SQL = "race_id, driver_id, season, round, points, finish_position"

# ---- filters ----------------------------------------------------------------------------

register(
    "fil_1_parameter_equality",
    ENTRY,
    lambda t: serve.where_equal(t["entries"], season=1997, round=3),
    f"SELECT {_ENTRY_SQL} FROM entries WHERE season = 1997 AND round = 3",
    ["entries"],
)
register(
    "fil_2_thresholds",
    ENTRY,
    lambda t: t["entries"].filter((F.col("finish_position") <= 2) | (F.col("points") > 900000)),
    f"SELECT {_ENTRY_SQL} FROM entries WHERE finish_position <= 2 OR points > 900000",
    ["entries"],
)
register(
    "fil_3_in_list",
    ENTRY,
    lambda t: t["entries"].filter(F.col("finish_position").isin(1, 2, 3) & ~F.col("source").isin("historical")),
    f"SELECT {_ENTRY_SQL} FROM entries WHERE finish_position IN (1, 2, 3) AND source NOT IN ('historical')",
    ["entries"],
)
register(
    "fil_4_null_tests",
    "race_id driver_id grid_position",
    lambda t: t["entries"].filter(F.col("finish_position").isNull() & F.col("grid_position").isNotNull()),
    "SELECT race_id, driver_id, grid_position FROM entries WHERE finish_position IS NULL AND grid_position IS NOT NULL",
    ["entries"],
)
register(
    "fil_5_pattern_any_case",
    "p_partkey p_name:text p_type:text",
    lambda t: t.raw("part").filter(F.col("p_name").ilike("%RED%") | F.col("p_type").ilike("prom_")),
    "SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%RED%' OR p_type ILIKE 'prom_'",
)
register(
    "fil_6_scalar_subquery",
    "o_orderkey o_custkey o_totalprice:double",
    lambda t: t.spark.sql(
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} "
        "WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM {orders})",
        orders=t.raw("orders"),
    ),
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
    "WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
)
register(
    "fil_7_not_exists",
    "c_custkey c_name:text",
    lambda t: t.raw("customer")
    .join(t.raw("orders").filter("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti"),
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS "
    "(SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')",
)
register(
    "fil_8_having",
    "l_orderkey l_linenumber copies",
    lambda t: t.raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"),
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)

# ---- joins ------------------------------------------------------------------------------

register(
    "join_1_star",
    "l_orderkey l_linenumber p_name:text s_name:text c_name:text n_name:text r_name:text l_extendedprice:double",
    lambda t: t.raw("lineitem")
    .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    .join(t.raw("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    .join(t.raw("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    .join(t.raw("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    .join(t.raw("customer").select("c_custkey", "c_name", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    .join(t.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    .join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")),
    "SELECT l_orderkey, l_linenumber, p_name, s_name, c_name, n_name, r_name, l_extendedprice FROM lineitem "
    "JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey "
    "JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey "
    "JOIN region ON r_regionkey = n_regionkey",
)
register(
    "join_2_left_enrichment",
    "race_id driver_id qualifying_position sprint_points:double pit_stop_count best_lap_ms",
    lambda t: t["entries"]
    .select("race_id", "driver_id")
    .join(t["fact_qualifying"].select("race_id", "driver_id", "qualifying_position"), ["race_id", "driver_id"], "left")
    .join(
        t["fact_sprint_results"].select("race_id", "driver_id", F.col("points").alias("sprint_points")),
        ["race_id", "driver_id"],
        "left",
    )
    .join(marts.stop_totals(t["fact_pit_stops"]), ["race_id", "driver_id"], "left")
    .join(marts.lap_totals(t["fact_lap_times"]), ["race_id", "driver_id"], "left"),
    "SELECT e.race_id, e.driver_id, q.qualifying_position, s.points AS sprint_points, p.pit_stop_count, l.best_lap_ms "
    "FROM entries e LEFT JOIN quali q ON q.race_id = e.race_id AND q.driver_id = e.driver_id "
    "LEFT JOIN sprints s ON s.race_id = e.race_id AND s.driver_id = e.driver_id "
    "LEFT JOIN stop_sums p ON p.race_id = e.race_id AND p.driver_id = e.driver_id "
    "LEFT JOIN lap_sums l ON l.race_id = e.race_id AND l.driver_id = e.driver_id",
    ["entries", "quali", "sprints", "stop_sums", "lap_sums"],
)
register(
    "join_3_fact_to_fact",
    "race_id driver_id lap_number lap_milliseconds result_id race_name:text",
    lambda t: t["fact_lap_times"]
    .select("race_id", "driver_id", "lap_number", "lap_milliseconds")
    .join(t["fact_results"].select("race_id", "driver_id", "result_id"), ["race_id", "driver_id"])
    .join(t["dim_races"].select("race_id", F.col("name").alias("race_name")), "race_id"),
    "SELECT l.race_id, l.driver_id, l.lap_number, l.lap_milliseconds, r.result_id, x.name AS race_name FROM laps l "
    "JOIN results r ON r.race_id = l.race_id AND r.driver_id = l.driver_id JOIN races x ON x.race_id = l.race_id",
    ["laps", "results", "races"],
)


def _records_per_circuit(t):
    entry = t["entries"]
    by_count = [F.col("_rows").desc(), F.col("driver_id").asc()]
    named = entry.withColumn("_label", F.col("driver_id"))
    holders = {
        "top_finisher": named.filter("finish_position = 1"),
        "top_podiums": named.filter("finish_position <= 3"),
        "top_starter": named.filter("grid_position = 1"),
        "top_points": named.filter("points > 400000"),
        "top_sprinter": named.filter("round IN (4, 8, 12)"),
    }
    joined = entry.groupBy("circuit_id").agg(F.count(F.lit(1)).alias("entries"))
    for name, rows in holders.items():
        best = record_holder(rows, ["circuit_id"], ["driver_id"], by_count, "_label", name)
        joined = joined.join(best, "circuit_id", "left")
    return joined


def _record_sql(name: str, condition: str) -> str:
    return (
        f"LEFT JOIN (SELECT circuit_id, driver_id AS {name} FROM entries WHERE {condition} GROUP BY circuit_id, "
        f"driver_id QUALIFY row_number() OVER (PARTITION BY circuit_id ORDER BY count(*) DESC, driver_id) = 1) USING (circuit_id)"
    )


register(
    "join_4_group_records",
    "circuit_id entries top_finisher top_podiums top_starter top_points top_sprinter",
    _records_per_circuit,
    "SELECT * FROM (SELECT circuit_id, count(*) AS entries FROM entries GROUP BY circuit_id) g "
    + " ".join(
        _record_sql(n, c)
        for n, c in (
            ("top_finisher", "finish_position = 1"),
            ("top_podiums", "finish_position <= 3"),
            ("top_starter", "grid_position = 1"),
            ("top_points", "points > 400000"),
            ("top_sprinter", "round IN (4, 8, 12)"),
        )
    ),
    ["entries"],
)
register(
    "join_5_default_for_missing",
    "c_custkey urgent_orders",
    lambda t: t.raw("customer")
    .join(
        t.raw("orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).count(),
        "c_custkey",
        "left",
    )
    .select("c_custkey", F.coalesce("count", F.lit(0)).alias("urgent_orders")),
    "SELECT c_custkey, coalesce(n, 0) AS urgent_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n "
    "FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON o_custkey = c_custkey",
)
register(
    "join_6_orphans",
    "table_name:text column_name:text violations passed:flag",
    lambda t: foreign_key(
        t.raw("lineitem"), "lineitem", "l_partkey", t.raw("part").filter("p_type <> 'PROMO'"), "p_partkey"
    ),
    "SELECT 'lineitem' AS table_name, 'l_partkey' AS column_name, count(*) AS violations, count(*) = 0 AS passed "
    "FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') ON p_partkey = l_partkey "
    "WHERE l_partkey IS NOT NULL AND p_partkey IS NULL",
)


def _neighbours(t):
    """Every driver with the next team-mate by name: as many pairs as drivers, never all pairs."""
    group = ["season", "constructor_name"]
    names = t["race_results_detail"].select(*group, "driver_name").distinct()
    paired = ordered_scan(names, group, [F.col("driver_name").asc()], {"first_driver": previous("driver_name")})
    return paired.filter("first_driver IS NOT NULL").withColumnRenamed("driver_name", "second_driver")


_NEIGHBOURS_SQL = (
    "(SELECT season, constructor_name, lag(driver_name) OVER (PARTITION BY season, constructor_name "
    "ORDER BY driver_name) AS first_driver, driver_name AS second_driver FROM "
    "(SELECT DISTINCT season, constructor_name, driver_name FROM hub))"
)
register(
    "join_7_team_mates",
    "season constructor_name:text first_driver:text second_driver:text",
    _neighbours,
    f"SELECT * FROM {_NEIGHBOURS_SQL} WHERE first_driver IS NOT NULL",
    ["hub"],
)
register(
    "join_8_rank_of_aggregate",
    "driver_id season points:double place",
    lambda t: ordered_scan(
        t["entries"].groupBy("driver_id", "season").agg(F.sum("points").alias("points")),
        ["season"],
        [F.col("points").desc(), F.col("driver_id").asc()],
        {"place": row_number()},
    ),
    "WITH a AS (SELECT driver_id, season, sum(points) AS points FROM entries GROUP BY ALL), "
    "b AS (SELECT driver_id, season, row_number() OVER (PARTITION BY season ORDER BY points DESC, driver_id) AS place "
    "FROM a) SELECT a.driver_id, a.season, a.points, b.place FROM a LEFT JOIN b "
    "ON a.driver_id = b.driver_id AND a.season = b.season",
    ["entries"],
)

# ---- aggregations -----------------------------------------------------------------------

register(
    "agg_1_group_totals",
    "race_id driver_id laps total_ms best_ms worst_ms avg_ms:double",
    lambda t: t["fact_lap_times"]
    .groupBy("race_id", "driver_id")
    .agg(
        F.count(F.lit(1)).alias("laps"),
        F.sum("lap_milliseconds").alias("total_ms"),
        F.min("lap_milliseconds").alias("best_ms"),
        F.max("lap_milliseconds").alias("worst_ms"),
        exact_avg("lap_milliseconds", 20, 2).alias("avg_ms"),
    ),
    f"SELECT race_id, driver_id, count(*) AS laps, sum(lap_milliseconds) AS total_ms, min(lap_milliseconds) AS best_ms, "
    f"max(lap_milliseconds) AS worst_ms, {half_up_avg('lap_milliseconds', 2)} AS avg_ms FROM laps GROUP BY ALL",
    ["laps"],
)
register(
    "agg_2_conditional_counts",
    "driver_id wins podiums unplaced",
    lambda t: t["entries"]
    .groupBy("driver_id")
    .agg(
        F.count_if(F.col("finish_position") == 1).alias("wins"),
        F.sum(F.when(F.col("finish_position") <= 3, 1).otherwise(0)).alias("podiums"),
        F.count(F.when(F.col("finish_position").isNull(), 1)).alias("unplaced"),
    ),
    "SELECT driver_id, sum(CASE WHEN finish_position = 1 THEN 1 ELSE 0 END) AS wins, "
    "sum(CASE WHEN finish_position <= 3 THEN 1 ELSE 0 END) AS podiums, "
    "count(CASE WHEN finish_position IS NULL THEN 1 END) AS unplaced FROM entries GROUP BY driver_id",
    ["entries"],
)
register(
    "agg_3_filter_clause",
    "race_id winner unplaced",
    lambda t: t.spark.sql(
        "SELECT race_id, max(driver_id) FILTER (WHERE finish_position = 1) AS winner, "
        "count(*) FILTER (WHERE finish_position IS NULL) AS unplaced FROM {e} GROUP BY race_id",
        e=t["entries"],
    ),
    "SELECT race_id, max(CASE WHEN finish_position = 1 THEN driver_id END) AS winner, "
    "count(*) - count(finish_position) AS unplaced FROM entries GROUP BY race_id",
    ["entries"],
)
register(
    "agg_4_distinct_counts",
    "l_suppkey orders parts ship_days",
    lambda t: t.raw("lineitem")
    .groupBy("l_suppkey")
    .agg(
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_shipdate").alias("ship_days"),
    ),
    "SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, "
    "count(DISTINCT l_shipdate) AS ship_days FROM lineitem GROUP BY l_suppkey",
)
register(
    "agg_5_ordered_distinct_list",
    "driver_id teams:text",
    lambda t: distinct_list(t["race_results_detail"], ["driver_id"], "constructor_name", "teams"),
    "SELECT driver_id, string_agg(DISTINCT constructor_name, ', ' ORDER BY constructor_name) AS teams "
    "FROM hub GROUP BY driver_id",
    ["hub"],
)


def _rolled_distinct(t):
    """Drivers, teams and races of a season and circuit, once as bitmaps; merged to circuits, to seasons and to all."""
    ids = ["driver_id", "constructor_id", "race_id"]
    fine = stage(distinct_bitmaps(t["race_results_detail"], ["season", "circuit_id"], ids), "bitmaps")
    parts = [distinct_counts(fine, ["season", "circuit_id"], ids).withColumn("grain", F.lit("both"))]
    for grain, keys in (("season", ["season"]), ("circuit", ["circuit_id"])):
        parts.append(distinct_counts(merged_bitmaps(fine, keys), keys, ids).withColumn("grain", F.lit(grain)))
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


register(
    "agg_4_rolled_distinct",
    "grain:text season circuit_id driver_id constructor_id race_id",
    _rolled_distinct,
    "SELECT CASE grouping(season, circuit_id) WHEN 0 THEN 'both' WHEN 1 THEN 'season' ELSE 'circuit' END AS grain, season, "
    "circuit_id, count(DISTINCT driver_id) AS driver_id, count(DISTINCT constructor_id) AS constructor_id, "
    "count(DISTINCT race_id) AS race_id FROM hub GROUP BY GROUPING SETS ((season, circuit_id), (season), (circuit_id))",
    ["hub"],
)
for _entity, _name in (("driver_id", "constructor_name"), ("constructor_id", "driver_name")):
    register(
        f"agg_5_{_name}_rows",
        f"{_entity} place {_name}:text",
        lambda t, entity=_entity, name=_name: marts.career_partners(t["race_results_detail"], entity, name),
        f"SELECT {_entity}, row_number() OVER (PARTITION BY {_entity} ORDER BY {_name}) AS place, {_name} "
        f"FROM (SELECT DISTINCT {_entity}, {_name} FROM hub WHERE {_name} IS NOT NULL)",
        ["hub"],
    )
register(
    "agg_6_exact_averages",
    "driver_id avg_place:double avg_grid:double",
    lambda t: t["entries"]
    .groupBy("driver_id")
    .agg(exact_avg("finish_position", 20, 2).alias("avg_place"), exact_avg("grid_position", 20, 2).alias("avg_grid")),
    f"SELECT driver_id, {half_up_avg('finish_position', 2)} AS avg_place, {half_up_avg('grid_position', 2)} AS avg_grid "
    "FROM entries GROUP BY driver_id",
    ["entries"],
)


def _doubles(t):
    """One-two finishes with the nation of the customer as the team, so that some exist."""
    teams = t["entries"].withColumn("constructor_id", F.col("driver_id") % 3)
    return marts.one_two_finishes(teams)


register(
    "agg_7_two_levels",
    "constructor_id season one_two_finishes",
    _doubles,
    "SELECT constructor_id, season, count(DISTINCT race_id) AS one_two_finishes FROM (SELECT driver_id % 3 AS "
    "constructor_id, season, race_id FROM entries WHERE finish_position <= 2 GROUP BY ALL HAVING count(*) = 2) "
    "GROUP BY ALL",
    ["entries"],
)
register(
    "agg_8_titles",
    "driver_id championships_won",
    lambda t: marts.titles(t["driver_season_summary"], "driver_id"),
    "SELECT driver_id, count(DISTINCT season) AS championships_won FROM driver_seasons "
    "WHERE championship_position = 1 GROUP BY driver_id",
    ["driver_seasons"],
)
register(
    "agg_9_group_by_ordinal",
    "l_returnflag:text l_linestatus:text n",
    lambda t: t.spark.sql(
        "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {l} GROUP BY 1, 2", l=t.raw("lineitem")
    ),
    "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
register(
    "agg_10_global_metrics",
    "stops fastest slowest avg_ms:double clean",
    lambda t: t["fact_pit_stops"].agg(
        F.count(F.lit(1)).alias("stops"),
        F.min("stop_milliseconds").alias("fastest"),
        F.max("stop_milliseconds").alias("slowest"),
        exact_avg("stop_milliseconds", 20, 2).alias("avg_ms"),
        F.count_if(F.col("stop_milliseconds") < 10000).alias("clean"),
    ),
    f"SELECT count(*) AS stops, min(stop_milliseconds) AS fastest, max(stop_milliseconds) AS slowest, "
    f"{half_up_avg('stop_milliseconds', 2)} AS avg_ms, count(*) FILTER (stop_milliseconds < 10000) AS clean FROM pits",
    ["pits"],
)
register(
    "agg_11_arg_min",
    "race_id best_ms driver_id",
    lambda t: t["fact_lap_times"]
    .groupBy("race_id")
    .agg(
        F.min("lap_milliseconds").alias("best_ms"),
        F.min_by("driver_id", F.struct("lap_milliseconds", "driver_id", "lap_number")).alias("driver_id"),
    ),
    "SELECT race_id, lap_milliseconds AS best_ms, driver_id FROM laps QUALIFY row_number() OVER "
    "(PARTITION BY race_id ORDER BY lap_milliseconds, driver_id, lap_number) = 1",
    ["laps"],
)
register(
    "agg_12_first_in_order",
    "race_name:text round winner:text total_finishers total_dnfs",
    lambda t: serve.race_by_race(t["race_results_detail"], 1998),
    "SELECT race_name, round, arg_min(driver_name, (coalesce(finish_position, 1e18), driver_id)) AS winner, "
    "count(finish_position) AS total_finishers, count(*) FILTER (is_dnf) AS total_dnfs FROM hub WHERE season = 1998 "
    "GROUP BY race_name, round",
    ["hub"],
)
_ROUNDS = list(range(1, 13))
register(
    "agg_13_pivot_matrix",
    "driver_id season " + " ".join(f"r{r}" for r in _ROUNDS),
    lambda t: pivot_matrix(t["entries"], ["driver_id", "season"], "round", _ROUNDS, "finish_position", "r"),
    "SELECT driver_id, season, "
    + ", ".join(f"min(finish_position) FILTER (round = {r}) AS r{r}" for r in _ROUNDS)
    + " FROM entries GROUP BY driver_id, season",
    ["entries"],
)
register(
    "agg_14_five_numbers",
    "constructor_id lowest:double quartile_1:double median:double quartile_3:double highest:double",
    lambda t: five_numbers(t["entries"], ["constructor_id"], "grid_position", nulls=False),
    "SELECT constructor_id, "
    + ", ".join(
        f"quantile_cont(grid_position, {q}) AS {n}"
        for q, n in zip((0, 0.25, 0.5, 0.75, 1), "lowest quartile_1 median quartile_3 highest".split())
    )
    + " FROM entries GROUP BY constructor_id",
    ["entries"],
)

# ---- windows ----------------------------------------------------------------------------

register(
    "win_1_running_totals",
    "driver_id season round total:double wins",
    lambda t: ordered_scan(
        t["entries"].withColumn("_win", F.when(F.col("finish_position") == 1, 1).otherwise(0)),
        ["driver_id", "season"],
        [F.col("round").asc()],
        {"total": running_sum("points"), "wins": running_sum("_win")},
    ),
    "SELECT driver_id, season, round, sum(points) OVER w AS total, "
    "sum(CASE WHEN finish_position = 1 THEN 1 ELSE 0 END) OVER w AS wins FROM entries "
    "WINDOW w AS (PARTITION BY driver_id, season ORDER BY round ROWS UNBOUNDED PRECEDING)",
    ["entries"],
)
register(
    "win_1_hot_groups",
    "season round driver_id total:double place",
    lambda t: ordered_scan(
        t["entries"],
        ["season"],
        [F.col("round").asc(), F.col("driver_id").asc()],
        {"total": running_sum("points"), "place": row_number()},
        limit=1000,
    ),
    "SELECT season, round, driver_id, sum(points) OVER w AS total, row_number() OVER w AS place FROM entries "
    "WINDOW w AS (PARTITION BY season ORDER BY round, driver_id ROWS UNBOUNDED PRECEDING)",
    ["entries"],
)
register(
    "win_2_ranking",
    "race_id driver_id place",
    lambda t: ordered_scan(
        t["entries"],
        ["race_id"],
        [F.col("points").desc(), F.col("laps_completed").desc(), F.col("driver_id").asc()],
        {"place": row_number()},
    ),
    "SELECT race_id, driver_id, row_number() OVER (PARTITION BY race_id ORDER BY points DESC, laps_completed DESC, "
    "driver_id) AS place FROM entries",
    ["entries"],
)
register(
    "win_3_gap_to_leader",
    "race_id driver_id place leader:double gap:double",
    lambda t: rank_with_gap(
        t["entries"],
        ["race_id"],
        [F.col("points").desc(), F.col("driver_id").asc()],
        "points",
        "place",
        "leader",
        "gap",
    ),
    "SELECT race_id, driver_id, row_number() OVER w AS place, first_value(points) OVER w AS leader, "
    "first_value(points) OVER w - points AS gap FROM entries "
    "WINDOW w AS (PARTITION BY race_id ORDER BY points DESC, driver_id)",
    ["entries"],
)


def _lap_deltas(t):
    laps = t["fact_lap_times"].select("race_id", "driver_id", "lap_number", F.col("lap_milliseconds").alias("lap_ms"))
    by_lap = with_group_stats(
        laps,
        ["race_id", "lap_number"],
        {
            "lap_best": F.min("lap_ms"),
            "lap_worst": F.max("lap_ms"),
            "lap_avg": exact_avg("lap_ms", 20, 2),
            "on_lap": F.count(F.lit(1)),
        },
        nulls=False,
    )
    return with_group_stats(by_lap, ["race_id"], {"race_best": F.min("lap_ms")}, nulls=False).withColumn(
        "to_race_best", F.col("lap_ms") - F.col("race_best")
    )


register(
    "win_4_group_statistics",
    "race_id driver_id lap_number lap_best lap_worst lap_avg:double on_lap race_best to_race_best",
    _lap_deltas,
    "SELECT race_id, driver_id, lap_number, min(lap_milliseconds) OVER w AS lap_best, max(lap_milliseconds) OVER w AS "
    "lap_worst, "
    + half_up_avg("lap_milliseconds", 2).replace("count(lap_milliseconds)", "count(lap_milliseconds) OVER w").replace(
        "sum(lap_milliseconds)", "sum(lap_milliseconds) OVER w"
    )
    + " AS lap_avg, count(*) OVER w AS on_lap, min(lap_milliseconds) OVER (PARTITION BY race_id) AS race_best, "
    "lap_milliseconds - min(lap_milliseconds) OVER (PARTITION BY race_id) AS to_race_best FROM laps "
    "WINDOW w AS (PARTITION BY race_id, lap_number)",
    ["laps"],
)


def _event_laps(t):
    """Events as laps: a day is a race, a user a driver."""
    events = t.raw("events").select(
        "event_id",
        F.to_date("ts").alias("day"),
        "user_id",
        "ts",
        F.round(F.col("value") * 1000, 0).cast("bigint").alias("ms"),
    )
    in_time = [F.col("ts").asc(), F.col("event_id").asc()]
    numbered = ordered_scan(events, ["day", "user_id"], in_time, {"seq": row_number(), "before_ms": previous("ms")})
    by_ms = [F.col("ms").asc_nulls_last(), F.col("event_id").asc()]
    return ordered_scan(numbered, ["day", "user_id"], by_ms, {"value_rank": row_number()})


_EVENT_SQL = (
    "SELECT event_id, user_id, row_number() OVER w AS seq, lag(ms) OVER w AS before_ms, row_number() OVER "
    "(PARTITION BY CAST(ts AS DATE), user_id ORDER BY ms NULLS LAST, event_id) AS value_rank, "
    "coalesce(ms - lag(ms) OVER w > 5000, false) AS slower FROM "
    "(SELECT *, CAST(round(value * 1000) AS BIGINT) AS ms FROM events) "
    "WINDOW w AS (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts, event_id)"
)
register(
    "win_5_sequence_and_rank",
    "event_id user_id seq value_rank",
    _event_laps,
    f"SELECT event_id, user_id, seq, value_rank FROM ({_EVENT_SQL})",
)
register(
    "win_6_lag_threshold",
    "event_id before_ms slower:flag",
    lambda t: _event_laps(t).withColumn(
        "slower", F.coalesce(F.col("ms") - F.col("before_ms") > marts.PIT_LAP_GAP_MS, F.lit(False))
    ),
    f"SELECT event_id, before_ms, slower FROM ({_EVENT_SQL})",
)
register(
    "win_7_two_grains",
    "race_id driver_id stop_number stop_best stop_worst total_ms total_stops",
    lambda t: with_group_stats(
        with_group_stats(
            t["fact_pit_stops"],
            ["race_id", "stop_number"],
            {"stop_best": F.min("stop_milliseconds"), "stop_worst": F.max("stop_milliseconds")},
            nulls=False,
        ),
        ["race_id", "driver_id"],
        {"total_ms": F.sum("stop_milliseconds"), "total_stops": F.count(F.lit(1))},
        nulls=False,
    ),
    "SELECT race_id, driver_id, stop_number, min(stop_milliseconds) OVER (PARTITION BY race_id, stop_number) AS "
    "stop_best, max(stop_milliseconds) OVER (PARTITION BY race_id, stop_number) AS stop_worst, "
    "sum(stop_milliseconds) OVER (PARTITION BY race_id, driver_id) AS total_ms, "
    "count(*) OVER (PARTITION BY race_id, driver_id) AS total_stops FROM pits",
    ["pits"],
)
register(
    "win_8_record_holder",
    "l_suppkey most_frequent_part:text",
    lambda t: record_holder(
        t.raw("lineitem").join(t.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey"),
        ["l_suppkey"],
        ["l_partkey"],
        [F.col("_rows").desc(), F.col("l_partkey").asc()],
        "p_name",
        "most_frequent_part",
    ),
    "SELECT l_suppkey, p_name AS most_frequent_part FROM lineitem JOIN part ON p_partkey = l_partkey "
    "GROUP BY l_suppkey, l_partkey, p_name "
    "QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_partkey) = 1",
)
register(
    "win_9_best_row_per_key",
    "l_orderkey l_linenumber l_partkey l_suppkey l_quantity:double l_extendedprice:double",
    lambda t: best_per_key(
        t.raw("lineitem"),
        ["l_orderkey", "l_linenumber"],
        [F.col("l_quantity").desc_nulls_first(), *[F.col(c.strip()).asc_nulls_last() for c in LINE_ORDER.split(",")]],
    ),
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem "
    "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY l_quantity DESC NULLS FIRST, {LINE_ORDER}) = 1",
)

# ---- sorting, top-k, distinct -----------------------------------------------------------

register(
    "sort_1_multi_key",
    "round finish_position driver_id points:double",
    lambda t: t["entries"].orderBy(
        F.col("round").asc(), F.col("finish_position").asc_nulls_last(), F.col("points").desc(), F.col("driver_id")
    ),
    "SELECT round, finish_position, driver_id, points FROM entries "
    "ORDER BY round, finish_position NULLS LAST, points DESC, driver_id",
    ["entries"],
)
register(
    "sort_2_top_k",
    "o_orderkey o_totalprice:double",
    lambda t: t.raw("orders").orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(20),
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
register(
    "sort_3_latest_per_group",
    "o_custkey o_orderkey o_totalprice:double o_orderdate:text",
    lambda t: best_per_key(t.raw("orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    .withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")),
    "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS "
    "o_orderdate FROM orders ORDER BY o_custkey, orders.o_orderdate DESC, o_orderkey DESC",
)
register(
    "sort_4_distinct",
    "l_returnflag:text l_linestatus:text l_linenumber",
    lambda t: t.raw("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct(),
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
)

# ---- set operations ---------------------------------------------------------------------

_COUNTED = list(RAW)
register(
    "set_1_union_of_counts",
    "table_name:text row_count",
    lambda t: table_counts({n: t.raw(n) for n in _COUNTED}).orderBy(F.col("row_count").desc(), "table_name"),
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _COUNTED),
)
register(
    "set_2_append_by_name",
    "driver_id:long name:text source:text",
    lambda t: t.raw("customer")
    .select(F.col("c_custkey").alias("driver_id"), F.col("c_name").alias("name"), F.lit("historical").alias("source"))
    .unionByName(
        t.raw("supplier").select(
            F.lit("api").alias("source"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("driver_id")
        )
    ),
    "SELECT c_custkey AS driver_id, c_name AS name, 'historical' AS source FROM customer UNION ALL "
    "SELECT s_suppkey, s_name, 'api' FROM supplier",
)
register(
    "set_3_difference",
    "name:text",
    lambda t: missing_names(
        t.raw("customer").select(F.col("c_name").alias("name")),
        t.raw("orders")
        .filter("o_totalprice > 450000")
        .join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_name").alias("name"))
        .distinct(),
    ),
    "SELECT c_name AS name FROM customer EXCEPT SELECT c_name FROM customer JOIN orders ON o_custkey = c_custkey "
    "WHERE o_totalprice > 450000",
)
