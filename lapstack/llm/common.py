"""Helpers shared by the text operators: staged frames, bounded Arrow batches, hot-key joins, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstack.session import stage

_BATCH_ROWS, _SPARK_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
_BATCH_BYTES, _SPARK_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
_CACHE = "lapstack_worker_cache"

# The six ASCII white space characters as a Java character class.
ASCII_SPACE = r"[ \t\n\u000B\f\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 500, megabytes: int = 32) -> None:
    """Arrow batches of fewer rows and bytes than Spark's defaults, so that long texts fit a worker.

    A value other than the default is the caller's own and stays.
    """
    for key, default, own in ((_BATCH_ROWS, _SPARK_ROWS, str(rows)), (_BATCH_BYTES, _SPARK_BYTES, f"{megabytes}m")):
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, own)


def free_name(taken: Iterable[str], name: str) -> str:
    """A column name that none of ``taken`` clashes with (names are compared without case)."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def worker_cache() -> dict:
    """A dictionary that lives as long as a worker process, so that tasks after the first find what it has loaded.

    Functions are sent by value and bring their own module globals with each task; this is kept apart from them.
    """
    return sys.modules.setdefault(_CACHE, types.ModuleType(_CACHE)).__dict__


def text_of(column: str = "text") -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once: an expression named inside a lambda is computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bits_of(parts: Sequence[tuple[Column, int]]) -> Column:
    """One long from (value, width) pieces, the first piece highest."""
    out = F.lit(0).cast("bigint")
    for value, width in parts:
        out = F.shiftleft(out, width).bitwiseOR(value)
    return out


def with_value_by_key(rows: DataFrame, lookup: DataFrame, key: str, count: str, total: int, hot_share: int = 1000) -> DataFrame:
    """Left join of many rows to one lookup row per key, where a key may hold most of the rows.

    ``count`` names the lookup column with the number of ``rows`` of that key, ``total`` all rows. A key with over
    1/``hot_share`` of the rows is hot; there are at most ``hot_share`` of those, so they are broadcast, and the
    rows of hot keys never meet in one task. The other keys join by shuffle. ``rows`` should be stored.
    """
    hot = F.broadcast(lookup.filter(F.col(count) > total / hot_share))
    cold = lookup.filter(F.col(count) <= total / hot_share)
    near = rows.join(hot, key, "inner")
    far = rows.join(hot.select(key), key, "left_anti").join(cold, key, "left")
    return near.unionByName(far)


def connected_components(links: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node of the undirected links ``a``, ``b``.

    Alternating large and small stars: every round points each node at the smallest node it knows of, which halves
    the paths, so a chain of n nodes takes about log(n) rounds. Each round is written to the shared folder. Self
    links give one-node components; NULL ends are dropped; an empty input gives no rows.
    """
    edges = stage(
        links.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL")
        .distinct(),
        label,
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    edges = edges.filter("a <> b")
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(small.filter("a <> b").union(lowest.select("a", F.col("m").alias("b"))).distinct(), label)
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")
        ).first()
        if state == before and state[0] == state[2]:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )
