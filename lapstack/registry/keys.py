"""Registered key resolution: customers are known entities, orders mention them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapstack.operators import keys
from lapstack.plans.star import LINE_COLUMNS
from lapstack.registry.core import register
from lapstack.registry.sql import LINE_ORDER
from lapstack.session import scratch_path


def _known(t):
    """Even customers are known, with their key as id."""
    return t.raw("customer").filter("c_custkey % 2 = 0").select(
        F.col("c_name").alias("driverRef"), F.col("c_custkey").cast("string").alias("driverId"), "c_mktsegment"
    )


def _mentions(t):
    """Every order names its customer, with attributes of that order."""
    names = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("driverRef"))
    return t.raw("orders").join(names, "o_custkey").select("driverRef", "o_orderkey", "o_orderpriority")


_MAX_KNOWN = "(SELECT max(c_custkey) FROM customer WHERE c_custkey % 2 = 0)"


def _seen():
    return [F.col("o_orderkey").asc()]


register(
    "key_1_resolve_natural_key",
    "driverRef:text driverId first_priority:text source:text",
    lambda t: keys.with_lineage(
        _known(t).select("driverRef", F.col("driverId").cast("bigint").alias("driverId"), F.lit("historical").alias("source")),
        keys.resolve_keys(_known(t), _mentions(t), ["driverRef"], "driverId", _seen()).select(
            "driverRef", "driverId", F.col("o_orderpriority").alias("first_priority")
        ),
    ),
    "SELECT c_name AS driverRef, c_custkey AS driverId, NULL AS first_priority, 'historical' AS source FROM customer "
    "WHERE c_custkey % 2 = 0 UNION ALL "
    f"SELECT c_name, {_MAX_KNOWN} + row_number() OVER (ORDER BY first_seen), priority, 'api' FROM "
    "(SELECT c_name, min(o_orderkey) AS first_seen, arg_min(o_orderpriority, o_orderkey) AS priority FROM orders "
    "JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 2 <> 0 GROUP BY c_name)",
)


def _months(t):
    return t.raw("orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"), "o_orderkey"
    )


def _known_months(t):
    odd = _months(t).filter("round % 2 = 1").select("year", "round").distinct()
    return odd.withColumn("raceId", (F.col("year") * 100 + F.col("round")).cast("bigint"))


register(
    "key_2_composite_key",
    "year round raceId first_order",
    lambda t: keys.resolve_keys(_known_months(t), _months(t), ["year", "round"], "raceId", _seen()).withColumnRenamed(
        "o_orderkey", "first_order"
    ),
    "SELECT year, round, (SELECT max(year(o_orderdate) * 100 + month(o_orderdate)) FROM orders "
    "WHERE month(o_orderdate) % 2 = 1) + row_number() OVER (ORDER BY first_order) AS raceId, first_order FROM "
    "(SELECT year(o_orderdate) AS year, month(o_orderdate) AS round, min(o_orderkey) AS first_order FROM orders "
    "WHERE month(o_orderdate) % 2 = 0 GROUP BY ALL)",
)
register(
    "key_3_lookup_or_fail",
    "o_orderkey driverRef:text c_custkey",
    lambda t: keys.lookup_or_fail(
        _mentions(t), t.raw("customer").select(F.col("c_name").alias("driverRef"), "c_custkey"), ["driverRef"], "c_custkey"
    ),
    "SELECT o_orderkey, c_name AS driverRef, c_custkey FROM orders JOIN customer ON c_custkey = o_custkey",
)


def _late_entities(t):
    """Definitions for a third of the customers come first; others appear only in orders, as stubs."""
    defined = t.raw("customer").filter("c_custkey % 3 = 1").select(
        F.lit(0).alias("rank"), F.col("c_custkey").alias("place"), F.col("c_name").alias("driverRef"), "c_mktsegment"
    )
    stubs = _mentions(t).select(F.lit(1).alias("rank"), F.col("o_orderkey").alias("place"), "driverRef")
    mentions = defined.unionByName(stubs, allowMissingColumns=True)
    return keys.resolve_keys(
        _known(t), mentions, ["driverRef"], "driverId", [F.col("rank").asc(), F.col("place").asc()]
    )


register(
    "key_4_late_entities",
    "driverRef:text driverId c_mktsegment:text",
    _late_entities,
    f"SELECT c_name AS driverRef, {_MAX_KNOWN} + row_number() OVER (ORDER BY rank, place) AS driverId, "
    "CASE WHEN rank = 0 THEN c_mktsegment END AS c_mktsegment FROM ("
    "SELECT c_name, c_mktsegment, CASE WHEN c_custkey % 3 = 1 THEN 0 ELSE 1 END AS rank, "
    "CASE WHEN c_custkey % 3 = 1 THEN c_custkey ELSE (SELECT min(o_orderkey) FROM orders WHERE o_custkey = c_custkey) END "
    "AS place FROM customer WHERE c_custkey % 2 <> 0) WHERE place IS NOT NULL",
)
def _line_ids(t):
    known = t.raw("orders").select(F.col("o_orderkey").alias("row_id"))
    return keys.append_ids(known, t.raw("lineitem"), "row_id", [F.col(c).asc_nulls_last() for c in LINE_COLUMNS])


register(
    "key_5_sequential_ids",
    "row_id l_orderkey l_partkey l_suppkey l_linenumber l_extendedprice:double",
    _line_ids,
    f"SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY {LINE_ORDER}) AS row_id, l_orderkey, "
    "l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem",
)
register(
    "key_6_append_missing",
    "year source:text",
    lambda t: keys.with_lineage(
        _months(t).filter("year < 1999").select("year").distinct().withColumn("source", F.lit("historical")),
        keys.append_missing(
            _months(t).filter("year < 1999").select("year").distinct(), _months(t).select("year").distinct(), "year"
        ),
    ),
    "SELECT DISTINCT year(o_orderdate) AS year, CASE WHEN year(o_orderdate) < 1999 THEN 'historical' ELSE 'api' END AS "
    "source FROM orders",
)
register(
    "key_7_lineage_union",
    "key name:text segment:text source:text",
    lambda t: keys.with_lineage(
        t.raw("customer").select(
            F.col("c_custkey").alias("key"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.lit("historical").alias("source"),
        ),
        t.raw("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")),
    ).orderBy(F.col("source").desc(), F.col("key").asc()),
    "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, 'historical' AS source FROM customer UNION ALL "
    "SELECT s_suppkey, s_name, NULL, 'api' FROM supplier",
)


def _lasting(t):
    """Customers numbered by the orders up to 1995, then up to 1998; the first run once more in between changes nothing."""
    store = scratch_path(t.spark, "ids")
    orders = _mentions(t).join(t.raw("orders").select("o_orderkey", F.year("o_orderdate").alias("year")), "o_orderkey")

    def run(name, upto):
        return keys.lasting_ids(t.spark, store, name, orders.filter(F.col("year") <= upto), ["driverRef"], "driverId", _seen())

    run("first", 1995)
    run("first", 1995)
    return run("second", 1998)


register(
    "key_9_lasting_ids",
    "driverRef:text driverId run:text",
    _lasting,
    """WITH seen AS (SELECT c_name, min(o_orderkey) AS first_seen, min(o_orderkey) FILTER (year(o_orderdate) <= 1995) AS early
      FROM orders JOIN customer ON c_custkey = o_custkey WHERE year(o_orderdate) <= 1998 GROUP BY c_name),
    old AS (SELECT c_name, row_number() OVER (ORDER BY early) AS id FROM seen WHERE early IS NOT NULL)
    SELECT c_name AS "driverRef", id AS "driverId", 'first' AS run FROM old
    UNION ALL SELECT c_name, (SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY first_seen), 'second'
    FROM seen WHERE early IS NULL""",
)
