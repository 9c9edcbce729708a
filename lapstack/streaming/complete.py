"""Rounds given out when their pages are complete, whatever order the pages arrive in.

Landed pages report the total of their fetch. A state for each round and fetch keeps the places of the pages it has seen
and their items counted; a page that lands twice counts once. The fetch is given out once, as soon as the count reaches
the total; one that stays short is given out as incomplete when the watermark has passed its last page by the delay, and
its state goes. Only page headers pass through the states; items stay in the store of ``streaming.rounds``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lapstack.session import tune
from lapstack.streaming.rounds import LANDED, ROUND_KEYS, batch_name, path_exists, stored_items

LANDED_WITH_TOTAL = f"{LANDED}, total bigint, landed_at timestamp"
FETCH_KEYS = [*ROUND_KEYS, "fetch"]
GIVEN_OUT = "season int, round int, endpoint string, fetch bigint, collected bigint, reported bigint, complete boolean"
GIVEN_COLUMNS = ["season", "round", "endpoint", "fetch", "collected", "reported", "complete"]
_STATE = "places array<bigint>, collected bigint, reported bigint, last bigint, given boolean"


def page_headers(landed: DataFrame) -> DataFrame:
    return landed.select(
        *FETCH_KEYS, "offset", F.size("items").cast("bigint").alias("n"), "total", "landed_at"
    )


def _counted(delay_ms: int):
    def run(key: tuple, pages: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        def given(collected, reported, complete):
            return pd.DataFrame([(*key, collected, reported, complete)], columns=GIVEN_COLUMNS)

        if state.hasTimedOut:
            _, collected, reported, _, done = state.get
            state.remove()
            if not done:
                yield given(collected, reported, False)
            return
        places, collected, reported, last, done = state.get if state.exists else ([], 0, None, 0, False)
        seen = set(places)
        for page in pages:
            for place, n, total, at in zip(page["offset"], page["n"], page["total"], page["landed_at"]):
                last = max(last, int(at.timestamp() * 1000))
                if total is not None and not pd.isna(total):
                    reported = max(reported or 0, int(total))
                if place not in seen:
                    seen.add(place)
                    collected += max(int(n), 0)
        complete = reported is not None and collected >= reported
        if complete and not done:
            yield given(collected, reported, True)
        done = done or complete
        # of a fetch that was given out the places are not needed any more, but that it was
        state.update(([] if done else sorted(int(x) for x in seen), collected, reported, last, done))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + delay_ms)

    return run


def rounds_given_out(pages: DataFrame, delay: str, delay_ms: int) -> DataFrame:
    """A stream of fetches, each once: complete, or incomplete after the delay; ``pages`` are streamed headers."""
    return (
        pages.withWatermark("landed_at", delay)
        .groupBy(*FETCH_KEYS)
        .applyInPandasWithState(_counted(delay_ms), GIVEN_OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


def run_complete(
    spark: SparkSession, landing: str, given: str, checkpoint: str, delay_seconds: int = 3600, files_per_batch: int = 1000
) -> None:
    """Take in the page headers of all files landed so far and add what is given out to the folder ``given``.

    A batch writes a folder of its own, so a batch that is run again replaces what it wrote.
    """
    tune(spark)

    def take(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{given}/batch={batch_name(batch.sparkSession, batch_id)}")

    landed = spark.readStream.schema(LANDED_WITH_TOTAL).option("maxFilesPerTrigger", files_per_batch).json(landing)
    query = (
        rounds_given_out(page_headers(landed), f"{delay_seconds} seconds", 1000 * delay_seconds)
        .writeStream.foreachBatch(take)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def given_out(spark: SparkSession, given: str) -> DataFrame:
    """The fetches given out so far."""
    if not path_exists(spark, given):
        return spark.createDataFrame([], GIVEN_OUT)
    return spark.read.schema(GIVEN_OUT).parquet(f"{given}/batch=*")


def complete_items(spark: SparkSession, store: str, given: str, seasons: list[int] | None = None) -> DataFrame:
    """Items of each round's newest complete fetch that brought any, one for an ordinal."""
    complete = given_out(spark, given).filter("complete AND collected > 0")
    newest = complete.groupBy(*ROUND_KEYS).agg(F.max("fetch").alias("fetch"))
    kept = stored_items(spark, store, seasons).join(newest, FETCH_KEYS, "left_semi")
    return kept.groupBy(*FETCH_KEYS, "ordinal").agg(F.max("item").alias("item"))
