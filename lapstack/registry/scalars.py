"""Registered scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapstack.functions import scalars as s
from lapstack.plans.silver import LOADED_AT, silver_table
from lapstack.plans.star_bronze import bronze_tables
from lapstack.registry.core import register
from lapstack.registry.sql import key_of

register(
    "scl_1_casts",
    "o_orderkey whole short amount:double day:text",
    lambda t: t.raw("orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").cast("int").alias("whole"),
        (F.col("o_orderkey") % 30000).cast("string").cast("smallint").alias("short"),
        F.col("o_totalprice").cast("string").cast("decimal(18,2)").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").cast("date").alias("day"),
    ),
    "SELECT o_orderkey, o_orderkey AS whole, o_orderkey % 30000 AS short, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, "
    "CAST(o_orderdate AS DATE) AS day FROM orders",
)
register(
    "scl_2_nullif",
    "o_orderkey status:text priority:text",
    lambda t: t.raw("orders").select(
        "o_orderkey",
        s.blank_to_null(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("")).alias("status"),
        s.sentinel_to_null(
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("NULL")
        ).alias("priority"),
    ),
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, "
    "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders",
)
register(
    "scl_3_coalesce",
    "race_id driver_id points:double",
    lambda t: t["entries"]
    .select("race_id", "driver_id", "points")
    .join(
        t["fact_sprint_results"].select("race_id", "driver_id", F.col("points").alias("extra")),
        ["race_id", "driver_id"],
        "left",
    )
    .withColumn("points", F.col("points") + F.coalesce("extra", F.lit(0))),
    "SELECT e.race_id, e.driver_id, e.points + coalesce(s.points, 0) AS points FROM entries e "
    "LEFT JOIN sprints s ON s.race_id = e.race_id AND s.driver_id = e.driver_id",
    ["entries", "sprints"],
)
register(
    "scl_4_concatenation",
    "c_custkey full_name:text label:text missing:text",
    lambda t: t.raw("customer").select(
        "c_custkey",
        s.full_name("c_mktsegment", "c_name").alias("full_name"),
        s.composite_text_key("c_custkey", "c_nationkey").alias("label"),
        s.full_name(F.nullif("c_mktsegment", F.lit("HOUSEHOLD")), "c_name").alias("missing"),
    ),
    "SELECT c_custkey, c_mktsegment || ' ' || c_name AS full_name, c_custkey || '_' || c_nationkey AS label, "
    "nullif(c_mktsegment, 'HOUSEHOLD') || ' ' || c_name AS missing FROM customer",
)
register(
    "scl_5_surrogate_key",
    "race_id driver_id one:text two:text three:text",
    lambda t: t["entries"].select(
        "race_id",
        "driver_id",
        s.surrogate_key(["driver_id"]).alias("one"),
        s.surrogate_key(["race_id", "driver_id"]).alias("two"),
        s.surrogate_key(["race_id", "driver_id", "finish_position"]).alias("three"),
    ),
    f"SELECT race_id, driver_id, {key_of('driver_id')} AS one, {key_of('race_id', 'driver_id')} AS two, "
    f"{key_of('race_id', 'driver_id', 'finish_position')} AS three FROM entries",
    ["entries"],
)
register(
    "scl_6_flags",
    "race_id driver_id is_win:flag is_podium:flag",
    lambda t: t["entries"].select(
        "race_id",
        "driver_id",
        s.flag(F.col("finish_position") == 1).alias("is_win"),
        s.flag(F.col("finish_position") <= 3).alias("is_podium"),
    ),
    "SELECT race_id, driver_id, CASE WHEN finish_position = 1 THEN true ELSE false END AS is_win, "
    "CASE WHEN finish_position <= 3 THEN true ELSE false END AS is_podium FROM entries",
    ["entries"],
)
register(
    "scl_7_arithmetic",
    "race_id driver_id change seconds:double share:double",
    lambda t: t["entries"].select(
        "race_id",
        "driver_id",
        (F.col("grid_position") - F.col("finish_position")).alias("change"),
        (F.col("first_order") / 1000).alias("seconds"),
        (F.col("laps_completed") / F.col("grid_position") * 100).alias("share"),
    ),
    "SELECT race_id, driver_id, grid_position - finish_position AS change, first_order / 1000 AS seconds, "
    "laps_completed / grid_position * 100 AS share FROM entries",
    ["entries"],
)
# event values as durations: minutes and seconds, hours for some, garbage for others
_CLOCK = (
    "CASE event_id % 4 WHEN 0 THEN {h} || ':' || {m} || ':' || {sec} WHEN 1 THEN {m} || ':' || {sec} "
    "WHEN 2 THEN {sec} ELSE event_type || ':' || {sec} END"
).format(
    h="CAST(user_id % 3 AS VARCHAR(9))",
    m="lpad(CAST(user_id % 60 AS VARCHAR(9)), 2, '0')",
    sec="lpad(CAST(event_id % 60 AS VARCHAR(9)), 2, '0') || '.' || lpad(CAST(event_id % 1000 AS VARCHAR(9)), 3, '0')",
)
register(
    "scl_8_duration_ms",
    "event_id duration:text ms",
    lambda t: t.raw("events")
    .select("event_id", F.expr(_CLOCK.replace("VARCHAR(9)", "STRING")).alias("duration"))
    .withColumn("ms", s.duration_ms("duration")),
    f"SELECT event_id, {_CLOCK} AS duration, CASE event_id % 4 "
    "WHEN 0 THEN (user_id % 3) * 3600000 + (user_id % 60) * 60000 + (event_id % 60) * 1000 + event_id % 1000 "
    "WHEN 1 THEN (user_id % 60) * 60000 + (event_id % 60) * 1000 + event_id % 1000 "
    "WHEN 2 THEN (event_id % 60) * 1000 + event_id % 1000 END AS ms FROM events",
)
register(
    "scl_9_strip_zulu",
    "event_id clock:text",
    lambda t: t.raw("events").select(
        "event_id",
        s.strip_zulu(
            F.concat(F.date_format("ts", "HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, F.lit("Z")).otherwise(""))
        ).alias("clock"),
    ),
    "SELECT event_id, strftime(ts, '%H:%M:%S') AS clock FROM events",
)


def _stamped(t, loaded_at):
    return silver_table("dim_races", bronze_tables(t)["races"], loaded_at).select("race_id", LOADED_AT)


register(
    "scl_10_load_stamp",
    "race_id stamp:text stamped:flag",
    lambda t: _stamped(t, F.lit("2031-02-03 04:05:06").cast("timestamp")).join(
        _stamped(t, None).select("race_id", (F.col(LOADED_AT) <= F.current_timestamp()).alias("stamped")), "race_id"
    ).select("race_id", F.date_format(LOADED_AT, "yyyy-MM-dd HH:mm:ss").alias("stamp"), "stamped"),
    "SELECT race_id, '2031-02-03 04:05:06' AS stamp, true AS stamped FROM races",
    ["races"],
)
register(
    "scl_11_round",
    "o_orderkey tenth:double whole:double",
    lambda t: t.raw("orders").select(
        "o_orderkey",
        F.round(F.col("o_totalprice").cast("decimal(18,2)"), 1).alias("tenth"),
        F.round(F.col("o_totalprice").cast("decimal(18,2)"), 0).alias("whole"),
    ),
    "SELECT o_orderkey, round(CAST(o_totalprice AS DECIMAL(18,2)), 1) AS tenth, "
    "round(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS whole FROM orders",
)
register(
    "scl_12_result_band",
    "race_id driver_id band:text",
    lambda t: t["entries"].select("race_id", "driver_id", s.finish_band("finish_position").alias("band")),
    f"SELECT race_id, driver_id, CASE WHEN finish_position IS NULL THEN '{s.BAND_NONE}' WHEN finish_position = 1 THEN "
    f"'{s.BAND_WIN}' WHEN finish_position <= 3 THEN '{s.BAND_PODIUM}' WHEN finish_position <= 10 THEN '{s.BAND_POINTS}' "
    f"ELSE '{s.BAND_OUTSIDE}' END AS band FROM entries",
    ["entries"],
)
register(
    "scl_13_tolerant_number",
    "s_suppkey balance:double",
    lambda t: t.raw("supplier")
    .select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("unknown")).otherwise(F.col("s_acctbal").cast("string")).alias("text"),
    )
    .select("s_suppkey", s.tolerant_number("text").alias("balance"))
    .dropna(subset=["balance"]),
    "SELECT s_suppkey, s_acctbal AS balance FROM supplier WHERE s_suppkey % 3 <> 0 AND s_acctbal IS NOT NULL",
)
register(
    "scl_14_display_text",
    "race_id driver_id finish:text",
    lambda t: t["entries"].select("race_id", "driver_id", s.display_text("finish_position", "DNF").alias("finish")),
    "SELECT race_id, driver_id, coalesce(CAST(finish_position AS VARCHAR), 'DNF') AS finish FROM entries",
    ["entries"],
)
