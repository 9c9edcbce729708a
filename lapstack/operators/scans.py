"""Ordered window scans that stay parallel when one group holds most of the rows.

Small groups go through ordinary window functions. A group above the row limit of a
task is cut into ordered chunks by a range partitioning; each chunk is scanned on its
own and then corrected by what the chunks before it carry over.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstack.session import few, group_rows, settle, stage

_BROADCAST_KEYS = 100_000
_POSITION_BITS = 33
_CHUNK_ROWS = 200_000  # chunks below this many rows only cost time ...
_FEW_CHUNKS = 32  # ... beyond as many


@dataclass(frozen=True)
class Scan:
    kind: str
    column: str | None = None


def row_number() -> Scan:
    return Scan("row_number")


def running_sum(column: str) -> Scan:
    return Scan("sum", column)


def previous(column: str) -> Scan:
    return Scan("lag", column)


def leading(column: str) -> Scan:
    """The value of the first row of the group."""
    return Scan("first", column)


@dataclass(frozen=True)
class GroupProfile:
    limit: int
    hot_groups: int
    hot_rows: int


def profile_groups(
    df: DataFrame, keys: Sequence[str], within: DataFrame | None = None, limit: int | None = None
) -> GroupProfile:
    """How many groups exceed the row limit of a task: one aggregation, one row back.

    ``within`` may name a cheaper frame whose groups are at least as large; when none of
    those is too large, ``df`` itself is not counted. ``limit`` stands in for the session's row limit.
    """
    if within is not None:
        outer = profile_groups(within, keys, limit=limit)
        if outer.hot_groups == 0:
            return outer
    return profile_sizes(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), limit)


def profile_sizes(sizes: DataFrame, limit: int | None = None) -> GroupProfile:
    """The same from one row per group, with its rows as ``_n``."""
    limit = limit or group_rows(sizes.sparkSession)
    hot = F.col("_n") > limit
    found = sizes.agg(
        F.count_if(hot).alias("groups"),
        F.coalesce(F.sum(F.when(hot, F.col("_n"))), F.lit(0)).alias("rows"),
    ).first()
    return GroupProfile(limit, int(found["groups"]), int(found["rows"]))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "") -> Column:
    """Equality on every key, where NULL equals NULL."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k + suffix]) for k in keys))


def bounded_scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column], scans: Mapping[str, Scan]) -> DataFrame:
    """Window scans for groups whose size is bounded by the data model."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({name: _local(scan, window) for name, scan in scans.items()})


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    scans: Mapping[str, Scan],
    profile: GroupProfile | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add one column per scan, each over the rows of a group in a total order.

    ``profile`` may come from a narrower frame with the same (or larger) groups; ``limit`` stands in for the session's
    row limit of a group. With a hot group the input is written to the shared folder first, so that it is evaluated once however many branches read it.
    """
    profile = profile or profile_groups(df, keys, limit=limit)
    if profile.hot_groups == 0:
        return bounded_scan(df, keys, order, scans)

    columns = df.columns
    df = stage(df.withColumn("_tie", F.monotonically_increasing_id()), "scan")
    hot_keys = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > profile.limit).select(*keys)
    hot_keys = hot_keys.toDF(*[f"{k}_hot" for k in keys])
    if profile.hot_groups <= _BROADCAST_KEYS:
        hot_keys = F.broadcast(hot_keys)
    match = same_keys(df, hot_keys, keys, "_hot")
    cool = bounded_scan(df.join(hot_keys, match, "left_anti").select(*columns), keys, order, scans)
    hot = _chunked_scan(df.join(hot_keys, match, "left_semi"), keys, order, scans, profile)
    return cool.unionByName(hot.select(*cool.columns))


def spread_ties(df: DataFrame) -> DataFrame:
    """Give every row its own ``_tie``, so that copies of a row can be split by range.

    The frame is stored: a task run again must send its rows to the same ranges.
    """
    return stage(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")


def dense_ids(
    df: DataFrame, order: Sequence[Column], name: str, start: int = 0, unique: bool = False
) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in order, without a global window.

    Rows are range-partitioned and sorted; each keeps its partition and its place in it.
    The frame is stored so both passes see the same layout, and the per-partition
    offsets (one row per partition) are added back. ``unique`` states that no two rows
    share a place in the order; otherwise copies are told apart first.
    """
    if not unique:
        df, order = spread_ties(df), [*order, F.col("_tie").asc()]
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, "places")
    chunk = F.shiftright("_place", _POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    ahead = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(chunk.alias("_chunk"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_chunk", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    )
    return (
        placed.withColumn("_chunk", chunk)
        .join(F.broadcast(offsets), "_chunk")
        .withColumn(name, (F.lit(start) + F.col("_before") + position + 1).cast("bigint"))
        .drop("_chunk", "_before", "_place", "_tie")
    )


def _local(scan: Scan, window) -> Column:
    if scan.kind == "row_number":
        return F.row_number().over(window).cast("bigint")
    if scan.kind == "sum":
        return F.sum(scan.column).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if scan.kind == "lag":
        return F.lag(scan.column).over(window)
    if scan.kind == "first":
        return F.first(scan.column).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    raise ValueError(f"unknown scan {scan.kind}")


def _chunks(profile: GroupProfile) -> int:
    """Chunks of half the row limit; a low limit does not cut many rows into ever smaller ones."""
    useful = max(_FEW_CHUNKS, math.ceil(profile.hot_rows / _CHUNK_ROWS))
    return max(2, min(math.ceil(2 * profile.hot_rows / profile.limit), useful))


def _chunked_numbers(rows, columns, keys, order, names, parts):
    """Row numbers of hot groups: a row's place in its sorted chunk tells them, so rows move to their chunk only."""
    sorted_by = [*[F.col(k).asc() for k in keys], *order]
    placed = rows.repartitionByRange(parts, *sorted_by).sortWithinPartitions(*sorted_by)
    placed = stage(placed.withColumn("_place", F.monotonically_increasing_id()).drop("_tie"), "chunks")
    placed = placed.withColumn("_chunk", F.shiftright("_place", _POSITION_BITS))
    # one row per (group, chunk)
    ends = placed.groupBy("_chunk", *keys).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("_ahead", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    join_keys = ["_chunk", *keys]
    carry = few(settle(carry.select(*[F.col(k).alias(f"{k}_c") for k in join_keys], "_first", "_ahead")))
    joined = placed.join(carry, same_keys(placed, carry, join_keys, "_c"), "inner")
    number = (F.col("_ahead") + F.col("_place") - F.col("_first") + 1).cast("bigint")
    return joined.withColumns(dict.fromkeys(names, number)).select(*columns, *names)


def _chunked_scan(rows, keys, order, scans, profile):
    """The scans of hot groups; ``rows`` have their own ``_tie`` and are stored, so a task run again sees the same."""
    columns, order = [c for c in rows.columns if c != "_tie"], [*order, F.col("_tie").asc()]
    parts = _chunks(profile)
    if all(scan.kind == "row_number" for scan in scans.values()):
        return _chunked_numbers(rows, columns, keys, order, list(scans), parts)
    chunks = (
        rows.repartitionByRange(parts, *[F.col(k) for k in keys], *order).withColumn("_chunk", F.spark_partition_id())
    )
    chunks = stage(chunks, "chunks")
    within = Window.partitionBy("_chunk", *keys).orderBy(*order)
    work = chunks.withColumns(
        {"_at": F.row_number().over(within)} | {f"_in_{name}": _local(scan, within) for name, scan in scans.items()}
    )

    # one row per (group, chunk): what this chunk hands to the next ones
    ends = work.groupBy("_chunk", *keys).agg(
        F.max("_at").cast("bigint").alias("_rows"),
        *[
            (
                F.sum(scan.column)
                if scan.kind == "sum"
                else F.max_by(scan.column, "_at")
                if scan.kind == "lag"
                else F.min_by(scan.column, "_at")
            ).alias(f"_end_{name}")
            for name, scan in scans.items()
            if scan.kind != "row_number"
        ],
    )
    across = Window.partitionBy(*keys).orderBy("_chunk")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = {"_carry_rows": F.coalesce(F.sum("_rows").over(before), F.lit(0))}
    for name, scan in scans.items():
        if scan.kind == "sum":
            carried[f"_carry_{name}"] = F.sum(f"_end_{name}").over(before)
        elif scan.kind == "lag":
            carried[f"_carry_{name}"] = F.lag(f"_end_{name}").over(across)
        elif scan.kind == "first":
            carried[f"_carry_{name}"] = F.first(f"_end_{name}").over(
                across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
    join_keys = ["_chunk", *keys]
    carry = ends.withColumns(carried).select(*[F.col(k).alias(f"{k}_c") for k in join_keys], *carried)
    joined = work.join(carry, same_keys(work, carry, join_keys, "_c"), "inner")

    types = dict(work.dtypes)
    out = {}
    for name, scan in scans.items():
        inside, carry_in = F.col(f"_in_{name}"), F.col(f"_carry_{name}")
        if scan.kind == "row_number":
            out[name] = F.col("_at") + F.col("_carry_rows")
        elif scan.kind == "sum":
            both = F.coalesce(inside, F.lit(0)) + F.coalesce(carry_in, F.lit(0))
            out[name] = F.when(inside.isNotNull() | carry_in.isNotNull(), both).cast(types[f"_in_{name}"])
        elif scan.kind == "lag":
            out[name] = F.when(F.col("_at") == 1, carry_in).otherwise(inside)
        else:
            out[name] = carry_in
    return joined.withColumns(out).select(*columns, *scans)
