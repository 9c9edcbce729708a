"""Rounds re-fetched by file arrival: landed pages are kept as they come, the newest fetch of a round counts.

The store holds landed items under ``season=/batch=``; a batch is named by its query and number, so a replayed batch
rewrites its own folders and another query, also one with a new checkpoint folder, never touches them. Nothing stored
is read to take a batch in. The current state is worked out on reading: per round the newest fetch that brought any
items, one item per ordinal. ``drop_superseded`` removes folders that hold nothing current any more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstack.session import tune

ROUND_KEYS = ["season", "round", "endpoint"]
# one landed line is a page of a round: its fetch number, the place of its first item, its items
LANDED = "season int, round int, endpoint string, fetch bigint, `offset` bigint, items array<string>"
STORED = "round int, endpoint string, fetch bigint, ordinal bigint, item string, season int, batch string"
_QUERY_ID = "sql.streaming.queryId"


def explode_landed(landed: DataFrame) -> DataFrame:
    """One row per landed item with its place in the round; empty pages give none."""
    return landed.select(*ROUND_KEYS, "fetch", "offset", F.posexplode("items").alias("_pos", "item")).select(
        *ROUND_KEYS, "fetch", (F.col("offset") + F.col("_pos") + 1).cast("bigint").alias("ordinal"), "item"
    )


def newest_fetch(items: DataFrame) -> DataFrame:
    """Items of the latest fetch that brought a round any; pages of one fetch may arrive apart."""
    newest = items.groupBy(*ROUND_KEYS).agg(F.max("fetch").alias("fetch"))
    return items.join(newest, [*ROUND_KEYS, "fetch"], "left_semi")


def _hadoop_path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = _hadoop_path(spark, path)
    return files.exists(at)


def batch_name(spark: SparkSession, batch_id: int) -> str:
    """A micro-batch by its query and number; to be asked for while the batch is taken in."""
    return f"{spark.sparkContext.getLocalProperty(_QUERY_ID)}-{batch_id}"


def stored_items(spark: SparkSession, store: str, seasons: list[int] | None = None) -> DataFrame:
    """All landed items, of the given seasons (only their folders are read)."""
    if not path_exists(spark, store):
        return spark.createDataFrame([], STORED)
    rows = spark.read.schema(STORED).parquet(store)
    return rows if seasons is None else rows.filter(F.col("season").isin(seasons))


def current_items(spark: SparkSession, store: str, seasons: list[int] | None = None) -> DataFrame:
    """One item per round and ordinal, from the newest fetch; of a page landed twice with other items, the largest."""
    kept = newest_fetch(stored_items(spark, store, seasons))
    return kept.groupBy(*ROUND_KEYS, "fetch", "ordinal").agg(F.max("item").alias("item"))


def apply_batch(spark: SparkSession, store: str, landed: DataFrame, batch_id: int, query: str = "batch") -> None:
    """Store the items of one micro-batch; running it again replaces what it stored."""
    (
        explode_landed(landed)
        .withColumn("batch", F.lit(f"{query}-{batch_id}"))
        .hint("rebalance", "season")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("season", "batch")
        .parquet(store)
    )


def drop_superseded(spark: SparkSession, store: str) -> int:
    """Delete the season and batch folders without a current item; how many. For times when no batch is written.

    Only the names of folders come to the driver. A batch that is replayed later stores its items again, and they are
    superseded again.
    """
    rows = stored_items(spark, store)
    newest = rows.groupBy(*ROUND_KEYS).agg(F.max("fetch").alias("fetch"))
    live = rows.join(newest, [*ROUND_KEYS, "fetch"], "left_semi").select("season", "batch")
    old = rows.select("season", "batch").distinct().join(live.distinct(), ["season", "batch"], "left_anti").collect()
    for r in old:
        files, path = _hadoop_path(spark, f"{store}/season={r['season']}/batch={r['batch']}")
        files.delete(path, True)
    return len(old)


def fold_season(spark: SparkSession, store: str, season: int) -> int:
    """Put a season's current items into one folder and delete the folders it had; how many. For seasons that are over.

    Reading the season then meets its current items alone, however many batches brought them. The old folders go after
    the new one is there, and items that are in both count once, so a run that was interrupted can be run again.
    """
    files, path = _hadoop_path(spark, f"{store}/season={season}")
    old = [f.getPath() for f in files.listStatus(path)] if files.exists(path) else []
    if len(old) < 2:
        return 0
    kept = current_items(spark, store, [season]).withColumn("batch", F.lit(f"folded-{uuid.uuid4().hex}"))
    columns = [c.split()[0] for c in STORED.split(", ")]
    (
        kept.select(*columns)
        .hint("rebalance", "season")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("season", "batch")
        .parquet(store)
    )
    for folder in old:
        files.delete(folder, True)
    return len(old)


def run_available(spark: SparkSession, landing: str, store: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Take in all files landed so far, then stop."""
    tune(spark)

    def take(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        apply_batch(own, store, batch, batch_id, own.sparkContext.getLocalProperty(_QUERY_ID))

    query = (
        spark.readStream.schema(LANDED)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
