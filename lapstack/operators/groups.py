"""Group operators: best row, statistics joined back, record holders, lists, matrices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstack.operators.scans import GroupProfile, leading, ordered_scan, row_number, running_sum, same_keys


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union, joined pairwise: a chain would have Spark check a growing plan each time."""
    frames = list(frames)
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionAll(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in the given total order.

    The ``row_number() = 1`` filter makes Spark keep one row per group in every map task
    (WindowGroupLimit), so a hot group never reaches one task whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_best", F.row_number().over(window)).filter(F.col("_best") == 1).drop("_best")


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column], nulls: bool = True) -> DataFrame:
    """Whole-group statistics on every row: partial aggregation first, then a join back.

    ``nulls=False`` states that no key is NULL; plain equality then reuses the aggregation's partitioning.
    """
    found = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    if not nulls:
        return df.join(found, list(keys), "inner")
    found = found.select(*[F.col(k).alias(f"{k}_g") for k in keys], *stats)
    return df.join(found, same_keys(df, found, keys, "_g"), "inner").drop(*[f"{k}_g" for k in keys])


def rank_with_gap(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    rank: str = "championship_position",
    lead: str = "leader_points",
    gap: str = "points_behind_leader",
    limit: int | None = None,
    profile: GroupProfile | None = None,
) -> DataFrame:
    """Position in the group, the leader's value, and the distance to it."""
    ranked = ordered_scan(df, keys, order, {rank: row_number(), lead: leading(value)}, profile, limit)
    return ranked.withColumn(gap, F.col(lead) - F.col(value))


def record_holder(
    df: DataFrame, group: Sequence[str], entity: Sequence[str], order: Sequence[Column], label: str, name: str
) -> DataFrame:
    """Per group, the label of the entity with most rows; ``_rows`` is the count to order by."""
    counts = df.groupBy(*group, *entity, label).agg(F.count(F.lit(1)).alias("_rows"))
    return best_per_key(counts, group, order).select(*group, F.col(label).alias(name))


def distinct_list(df: DataFrame, keys: Sequence[str], value: str, name: str, separator: str = ", ") -> DataFrame:
    """Sorted distinct values of a group as one text; duplicates go before the list is built."""
    pairs = df.select(*keys, value).distinct()
    listed = F.expr(f"listagg(`{value}`, '{separator}') within group (order by `{value}`)")
    return pairs.groupBy(*keys).agg(listed.alias(name))


def distinct_rows(df: DataFrame, keys: Sequence[str], value: str, place: str = "place") -> DataFrame:
    """The sorted distinct values of a group, a row each with its place: the list of any length, never one value."""
    pairs = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    return ordered_scan(pairs, keys, [F.col(value).asc()], {place: row_number()})


def pivot_matrix(
    df: DataFrame, row_keys: Sequence[str], column: str, columns: Sequence, value: str, prefix: str = ""
) -> DataFrame:
    """One row per key, one column per listed value; the lowest value fills a cell."""
    wide = df.groupBy(*row_keys).pivot(column, list(columns)).agg(F.min(value))
    return wide.select(*row_keys, *[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in columns])


# The five numbers of a distribution and their quantiles.
FIVE_NUMBERS = {"lowest": 0.0, "quartile_1": 0.25, "median": 0.5, "quartile_3": 0.75, "highest": 1.0}


def five_numbers(df: DataFrame, keys: Sequence[str], value: str, nulls: bool = True) -> DataFrame:
    """Minimum, quartiles and maximum per group, exact and interpolated; ``nulls=False``: no key is NULL.

    Equal values are counted first; the running count over the distinct values tells which
    of them hold the wanted places, so no group's values meet in one buffer.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    upto = ordered_scan(counts, keys, [F.col(value).asc()], {"_upto": running_sum("_c")})
    placed = with_group_stats(upto, keys, {"_n": F.sum("_c")}, nulls)
    at = {name: F.lit(q) * (F.col("_n") - 1) for name, q in FIVE_NUMBERS.items()}

    def holds(place: Column) -> Column:
        return (F.col("_upto") > place) & (F.col("_upto") - F.col("_c") <= place)

    ends = []
    for name, place in at.items():
        ends.append(F.max(F.when(holds(F.floor(place)), F.col(value))).cast("double").alias(f"_{name}_low"))
        ends.append(F.max(F.when(holds(F.ceil(place)), F.col(value))).cast("double").alias(f"_{name}_high"))
    found = placed.groupBy(*keys, "_n").agg(*ends)
    return found.select(
        *keys,
        *[
            (F.col(f"_{n}_low") + (F.col(f"_{n}_high") - F.col(f"_{n}_low")) * (p - F.floor(p))).alias(n)
            for n, p in at.items()
        ],
    )
