"""Keys without a parent, told by exact bitmaps of ids.

One pass over the children counts the rows and sets the bits of all their foreign keys, a bitmap for each key column and
range of ids; those of the parents are laid beside them, and only ranges in which a child has bits that its parent lacks
are looked into. Ids are whole numbers, also as texts; a text that is no such number is compared as it is. A range of
ids takes the same few kilobytes however many rows use it, so bitmaps pay for ids that lie close together: where a
parent's ids are too far apart, ids are compared themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.session import settle

_BITMAP_BYTES = 4096
_ID_BYTES = 64  # that a parent's id may take in bitmaps, on average
_AS_IT_IS, _OUTSIDE = -1, -2  # in place of a range: compared themselves; not among the parent's ids
_LOST = "child string, column string, key string, n bigint"


@dataclass(frozen=True)
class Link:
    """A foreign key: a column of a child, and the parent's rows with its key."""

    child: str
    column: str
    parent: DataFrame
    key: str


def _numbered(rows: DataFrame) -> DataFrame:
    """With ``id``, the key as a number if it is one; rows without a key are left out."""
    number = F.col("key").try_cast("bigint")
    return rows.filter("key IS NOT NULL").withColumn("id", F.when(number.cast("string") == F.col("key"), number))


def _spans(parents: DataFrame) -> DataFrame:
    """For each parent, one row: its ids' bounds, and whether they lie close enough together for bitmaps."""
    sizes = parents.groupBy("parent").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
    span = F.col("high").cast("decimal(38,0)") - F.col("low").cast("decimal(38,0)")
    dense = span / (8 * _BITMAP_BYTES) * _BITMAP_BYTES <= F.col("n") * _ID_BYTES + 64 * _BITMAP_BYTES
    return sizes.select("parent", "low", "high", F.coalesce(dense, F.lit(False)).alias("dense"))


def _placed(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """With ``range``, that of the id among its parent's."""
    place = (
        F.when(F.col("id").isNull(), F.lit(_AS_IT_IS))
        .when(~F.coalesce(F.col("id").between(F.col("low"), F.col("high")), F.lit(False)), F.lit(_OUTSIDE))
        # ranges of negative ids come before 1
        .when(F.col("dense"), F.bitmap_bucket_number("id") - F.bitmap_bucket_number("low"))
        .otherwise(F.lit(_AS_IT_IS))
    )
    known = rows.join(F.broadcast(spans), "parent", "left")  # a row for each parent
    return known.withColumn("range", place.cast("bigint")).drop("low", "high", "dense")


def _bits(rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"), *more)


def lost_keys(children: Mapping[str, DataFrame], links: Sequence[Link]) -> DataFrame:
    """``child``, ``column``, ``key`` (text) and ``n``, its rows, for every non-NULL key that its parent lacks.

    The children are read once, and once more only where keys are lost. The result is stored.
    """
    labels = {}
    for x in links:
        labels.setdefault((id(x.parent), x.key), (f"{len(labels)}", x))
    parents = reduce(
        DataFrame.unionByName,
        [x.parent.select(F.lit(label).alias("parent"), F.col(f"`{x.key}`").cast("string").alias("key")) for label, x in labels.values()],
    )
    stacked = []
    for name, child in children.items():
        own = [x for x in links if x.child == name]
        values = [
            F.struct(
                F.lit(name).alias("child"),
                F.lit(x.column).alias("column"),
                F.lit(labels[id(x.parent), x.key][0]).alias("parent"),
                F.col(f"`{x.column}`").cast("string").alias("key"),
            )
            for x in own
        ]
        if own:
            stacked.append(child.select(F.explode(F.array(*values)).alias("x")).select("x.*"))
    parents = _numbered(parents)
    spans = _spans(parents)
    parents = _placed(parents, spans)
    rows = _placed(_numbered(reduce(DataFrame.unionByName, stacked)), spans)
    used = _bits(rows, ["child", "column", "parent", "range"]).select("parent", "range", "bits", F.lit(False).alias("own"))
    both = used.unionByName(_bits(parents, ["parent", "range"]).withColumn("own", F.lit(True)))
    compared = both.groupBy("parent", "range").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"),
        F.coalesce(F.max(F.when(F.col("own"), F.bitmap_count("bits"))), F.lit(0)).alias("there"),
        F.min("own").alias("only_parents"),
    )
    # the ids of these ranges, and keys that have no range, are compared themselves
    lossy = F.when(F.col("range") < 0, ~F.col("only_parents")).otherwise(F.col("all") > F.col("there"))
    wanted = settle(compared.filter(lossy).select("parent", "range"))
    if wanted.isEmpty():
        return rows.sparkSession.createDataFrame([], _LOST)
    suspects = rows.join(wanted, ["parent", "range"], "left_semi").groupBy("child", "column", "parent", "key")
    known = parents.join(wanted, ["parent", "range"], "left_semi").select("parent", "key").distinct()
    lost = suspects.agg(F.count(F.lit(1)).alias("n")).join(known, ["parent", "key"], "left_anti")
    return settle(lost.select("child", "column", "key", "n"))


def rows_with_lost_keys(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]], null_is_lost: bool = False) -> DataFrame:
    """The child's rows of which a key has no parent (or, if asked for, is NULL); ``parents`` by key column.

    The child meets the lost keys alone, a join for each key column that has any.
    """
    lost = lost_keys({"": child}, [Link("", column, parent, key) for column, (parent, key) in parents.items()])
    columns = {r["column"] for r in lost.select("column").distinct().collect()}  # key columns
    marked, bad, taken = child, F.lit(False), []
    for column in parents:
        key = F.col(f"`{column}`")
        if null_is_lost:
            bad = bad | key.isNull()
        if column in columns:
            mark = f"_lost_{len(taken)}"
            own = lost.filter(F.col("column") == column).select(F.col("key").alias(f"{mark}_key"), F.lit(True).alias(mark))
            marked = marked.join(own, key.cast("string") == F.col(f"{mark}_key"), "left")
            bad = bad | F.col(mark).isNotNull()
            taken += [mark, f"{mark}_key"]
    return marked.filter(bad).drop(*taken)


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """The distinct ids of every group as bitmaps: ``keys``, ``name`` (the id column), ``range`` and ``bits``.

    All id columns come from one pass, without a row for each distinct combination. Bitmaps of groups can be merged to
    any coarser grain (``merged_bitmaps``); they pay for whole numbers that lie close together, as ids of dimensions do.
    """
    pairs = [F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("bigint").alias("id")) for c in ids]
    rows = df.select(*keys, F.explode(F.array(*pairs)).alias("x")).select(*keys, "x.name", "x.id").filter("id IS NOT NULL")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
    return rows.groupBy(*keys, "name", F.bitmap_bucket_number("id").alias("range")).agg(bits)


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of a coarser grain: what any of the merged groups has counts once."""
    return bitmaps.groupBy(*keys, "name", "range").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """``keys`` and, under the name of each id column, how many distinct ids a group has."""
    counts = bitmaps.groupBy(*keys).pivot("name", list(ids)).agg(F.sum(F.bitmap_count("bits")))
    return counts.select(*keys, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in ids])
