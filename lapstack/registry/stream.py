"""Registered streaming ingestion: rounds landed by three fetches, taken in as they arrive."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapstack.operators.rounds import PAGE_ITEMS, nest_rounds
from lapstack.registry.core import register
from lapstack.session import scratch_path
from lapstack.streaming.complete import given_out, run_complete
from lapstack.streaming.rounds import current_items, run_available

_ROUND = ["season", "round"]


def _land(t, path: str, fetch: int, copy: str = "") -> None:
    """Entries of a month as a round: the second fetch has even rounds, every other one empty, the third every third."""
    item = F.concat_ws(":", F.col("driver_id").cast("string"), F.lit(str(fetch)))
    rows = t["entries"].select(*_ROUND, "grid_position", item.alias("item"))
    if fetch > 1:
        rows = rows.filter(F.col("round") % fetch == 0)
    pages = nest_rounds(rows, _ROUND, [F.col("grid_position").asc()], ["item"])
    items = F.transform("items", lambda i: i["item"])
    if fetch == 2:
        items = F.when(F.col("round") % 4 != 0, items).otherwise(F.array().cast("array<string>"))
    pages.select(
        *_ROUND,
        F.lit("results").alias("endpoint"),
        F.lit(fetch).alias("fetch"),
        (F.col("page") * PAGE_ITEMS).alias("offset"),
        items.alias("items"),
    ).write.json(f"{path}/fetch_{fetch}{copy}")


def _streamed(t):
    """Two fetches by one query; a third and the first one's pages once more by a query with its own checkpoint."""
    landing, store, progress, other = (scratch_path(t.spark, n) for n in ("landing", "rounds", "progress", "progress"))
    for fetch in (1, 2):
        _land(t, landing, fetch)
        run_available(t.spark, f"{landing}/*", store, progress)
    _land(t, landing, 3)
    _land(t, landing, 1, "_again")
    run_available(t.spark, f"{landing}/*", store, other)
    return current_items(t.spark, store)


register(
    "str_1_rounds_by_arrival",
    "season round endpoint:text ordinal item:text",
    _streamed,
    "SELECT season, round, 'results' AS endpoint, grid_position AS ordinal, driver_id || CASE WHEN round % 3 = 0 THEN ':3' "
    "WHEN round % 2 = 0 AND round % 4 <> 0 THEN ':2' ELSE ':1' END AS item FROM entries",
    ["entries"],
)


def _land_totals(t, path: str, hour: int, which, name: str) -> None:
    """Pages of the entries of a month with the month's total, landed at an hour; ``which`` picks the pages."""
    rows = t["entries"].select(*_ROUND, "grid_position", F.col("driver_id").cast("string").alias("item"))
    totals = rows.groupBy(*_ROUND).agg(F.count(F.lit(1)).alias("total"))
    pages = nest_rounds(rows, _ROUND, [F.col("grid_position").asc()], ["item"]).join(totals, _ROUND)
    last = F.floor((F.col("total") - 1) / PAGE_ITEMS)
    pages.withColumn("last", F.col("page") == last).filter(which).select(
        *_ROUND,
        F.lit("results").alias("endpoint"),
        F.lit(1).alias("fetch"),
        (F.col("page") * PAGE_ITEMS).alias("offset"),
        F.transform("items", lambda i: i["item"]).alias("items"),
        "total",
        F.lit(f"2030-01-01T{hour:02}:00:00Z").alias("landed_at"),
    ).write.json(f"{path}/{name}")


def _given_out(t):
    """The last page of every second round comes late, all pages of every third come twice, the last of every fifth never.

    Pages that land long after let the watermark pass the rounds that are still short.
    """
    landing, given, progress = (scratch_path(t.spark, n) for n in ("landing", "given", "progress"))
    take = lambda: run_complete(t.spark, f"{landing}/*", given, progress, 3 * 3600)
    number = F.col("round")
    _land_totals(t, landing, 1, (number % 5 != 0) & ~((number % 2 == 0) & F.col("last")) | (number % 5 == 0) & ~F.col("last"), "first")
    take()
    _land_totals(t, landing, 2, (number % 5 != 0) & ((number % 2 == 0) & F.col("last") | (number % 3 == 0)), "late")
    take()
    _land_totals(t, landing, 20, number == 1, "again")
    take()
    return given_out(t.spark, given)


register(
    "str_2_complete_rounds",
    "season round endpoint:text fetch collected reported complete:flag",
    _given_out,
    f"""SELECT season, round, 'results' AS endpoint, 1 AS fetch,
        CASE WHEN round % 5 <> 0 THEN n ELSE (n - 1) // {PAGE_ITEMS} * {PAGE_ITEMS} END AS collected, n AS reported,
        round % 5 <> 0 AS complete
    FROM (SELECT season, round, count(*) AS n FROM entries GROUP BY season, round)
    WHERE round % 5 <> 0 OR n > {PAGE_ITEMS}""",
    ["entries"],
)
