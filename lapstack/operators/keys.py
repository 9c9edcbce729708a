"""Surrogate keys: new natural keys get ids after the known ones, in first-seen order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstack.operators.groups import best_per_key
from lapstack.operators.scans import dense_ids
from lapstack.session import stage


def max_id(known: DataFrame, id_column: str) -> int:
    """Highest id in use, 0 for an empty table: one number comes back."""
    found = known.agg(F.max(F.col(f"`{id_column}`").cast("bigint")).alias("m")).first()["m"]
    return int(found or 0)


def new_keys(known: DataFrame, mentions: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First mention of each key the known table lacks.

    Mentions shrink to one row per key in every map task before anything is shuffled.
    """
    first = best_per_key(mentions, keys, order)
    return first.join(known.select(*keys).distinct(), list(keys), "left_anti")


def resolve_keys(
    known: DataFrame, mentions: DataFrame, keys: Sequence[str], id_column: str, order: Sequence[Column]
) -> DataFrame:
    """Rows to append for unknown keys, with ids continuing after the known ones.

    Known rows keep their attributes, and of several mentions of a new key the first
    wins, whatever it carries.
    """
    fresh = new_keys(known, mentions, keys, order)
    total = [*order, *[F.col(k).asc() for k in keys]]
    return dense_ids(fresh, total, id_column, start=max_id(known, id_column), unique=True)


def append_ids(
    known: DataFrame, rows: DataFrame, id_column: str, order: Sequence[Column], unique: bool = False
) -> DataFrame:
    """Sequential ids for new fact rows, after those in use."""
    return dense_ids(rows, order, id_column, start=max_id(known, id_column), unique=unique)


def append_missing(known: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key the known table lacks."""
    return rows.join(known.select(key).distinct(), key, "left_anti")


def last_per_key(table: DataFrame, keys: Sequence[str], id_column: str, place: str | None = None) -> DataFrame:
    """One id for each key: that of its last row by ``place``, else the highest; a partial aggregation."""
    by = F.col(place) if place else F.col(id_column).cast("bigint")
    return table.groupBy(*keys).agg(F.max_by(id_column, by).alias(id_column))


def lookup_or_fail(
    rows: DataFrame, keys_table: DataFrame, keys: Sequence[str], id_column: str, place: str | None = None
) -> DataFrame:
    """Attach an id that must exist; a row without one fails the query.

    A key that the table has more than once gives its last id, and rows are never multiplied.
    """
    pairs = last_per_key(keys_table, keys, id_column, place)
    message = F.concat(F.lit("no row registered for ("), F.concat_ws(", ", *keys), F.lit(")"))
    found = F.coalesce(F.col(id_column), F.raise_error(message).cast(dict(pairs.dtypes)[id_column]))
    return rows.join(pairs, list(keys), "left").withColumn(id_column, found)


def with_lineage(history: DataFrame, api: DataFrame) -> DataFrame:
    """Bag union by column name; columns one side lacks are NULL."""
    tagged = api.withColumn("source", F.lit("api"))
    return history.unionByName(tagged, allowMissingColumns=True)


def lasting_ids(
    spark: SparkSession, store: str, run: str, mentions: DataFrame, keys: Sequence[str], id_column: str, order: Sequence[Column]
) -> DataFrame:
    """Ids that outlive a run: ``keys``, ``id_column`` and ``run`` of every key known after this run.

    ``store`` is a folder to which every run adds the keys that no run before it had, numbered on from the highest id in
    the order of their first mention; nothing stored is rewritten. Mentions of known keys go before anything is
    numbered. A run that is done again replaces what it added, and gives the same ids for the same mentions.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in mentions.schema if f.name in keys)
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    layout = f"{schema}, `{id_column}` bigint, run string"
    known = spark.read.schema(layout).parquet(store) if there else spark.createDataFrame([], layout)
    earlier = known.filter(F.col("run") != run)
    fresh = resolve_keys(earlier, mentions, keys, id_column, order).select(*keys, id_column, F.lit(run).alias("run"))
    fresh = stage(fresh, "fresh-ids")
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/run={run}")
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)
    fresh.write.mode("append").partitionBy("run").parquet(store)
    return earlier.unionByName(fresh)
