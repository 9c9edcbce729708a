"""Landed pages and rounds: merging pages, choosing due rounds, replacing re-fetched ones.

Items stay in long form, one row each with its place in the round. A nested array per
round would gather a whole round into one value; pages of a fixed size do not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.operators.scans import GroupProfile, ordered_scan, row_number

# Fixed value: items per landed page.
PAGE_ITEMS = 100


def merge_pages(pages: DataFrame, keys: Sequence[str], page: str, items: str, group: str, parts: str) -> DataFrame:
    """Concatenate the groups of all pages: one row per part, numbered within key and group.

    ``items`` is an array of structs holding the group number (``group``, text) and its
    array of parts. Parts of a group split over pages follow one another in page order;
    groups sort as numbers.
    """
    rows = pages.select(*keys, page, F.posexplode(items).alias("_item", "i")).select(
        *keys, page, "_item", F.col(f"i.{group}").cast("int").alias(group), F.posexplode(f"i.{parts}").alias("_part", "part")
    )
    order = [F.col(page).asc(), F.col("_item").asc(), F.col("_part").asc()]
    return ordered_scan(rows, [*keys, group], order, {"ordinal": row_number()}).select(
        *keys, group, "ordinal", "part"
    )


def flat_pages(pages: DataFrame, keys: Sequence[str], offset: str, items: str) -> DataFrame:
    """Items of a paginated flat list with their place in the whole list."""
    return pages.select(*keys, F.col(offset).alias("_offset"), F.posexplode(items).alias("_pos", "item")).select(
        *keys, (F.col("_offset") + F.col("_pos") + 1).cast("bigint").alias("ordinal"), "item"
    )


def pages_complete(pages: DataFrame, keys: Sequence[str], items: str, total: str) -> DataFrame:
    """Per list, collected and reported counts; complete when they agree."""
    return pages.groupBy(*keys).agg(
        F.sum(F.size(items)).cast("bigint").alias("collected"), F.max(total).cast("bigint").alias("reported")
    ).withColumn("complete", F.col("collected") >= F.col("reported"))


def due_rounds(races: DataFrame, as_of: str, date: str = "date", sprint: Column | None = None) -> DataFrame:
    """Rounds dated up to ``as_of`` (ISO text); a missing date counts as due.

    ``sprint`` is the condition a round must also meet for the sprint endpoint.
    """
    due = races.filter(F.coalesce(F.col(date).cast("string"), F.lit("")) <= as_of)
    return due if sprint is None else due.filter(sprint)


def upsert_items(stored: DataFrame, fetched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items after a fetch: a re-fetched round replaces the stored one.

    A round fetched empty has no rows in ``fetched``, so its stored items remain.
    """
    replaced = fetched.select(*keys).distinct()
    return stored.join(replaced, list(keys), "left_anti").unionByName(fetched)


def upsert_rounds(stored: DataFrame, fetched: DataFrame, keys: Sequence[str], items: str = "n_items") -> DataFrame:
    """Round headers after a fetch, by the same rule: empty never replaces non-empty."""
    others = [c for c in stored.columns if c not in keys]
    old = stored.select(*keys, F.struct(*others).alias("_old"))
    new = fetched.select(*keys, F.struct(*others).alias("_new"))
    keep = F.col("_new").isNull() | ((F.col(f"_new.{items}") == 0) & (F.coalesce(F.col(f"_old.{items}"), F.lit(0)) > 0))
    return (
        old.join(new, list(keys), "full_outer")
        .select(*keys, F.when(keep, F.col("_old")).otherwise(F.col("_new")).alias("r"))
        .select(*keys, *[F.col(f"r.{c}").alias(c) for c in others])
    )


def nest_rounds(
    items: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    payload: Sequence[str | Column],
    page_items: int = PAGE_ITEMS,
    profile: GroupProfile | None = None,
) -> DataFrame:
    """Pages of at most ``page_items`` items per round, in item order.

    ``payload`` columns are made after the rows are numbered, so that what is sorted has no texts made from it.
    """
    placed = ordered_scan(items, keys, order, {"_at": row_number()}, profile)
    page = F.expr(f"(_at - 1) div {page_items}")
    return (
        placed.groupBy(*keys, page.alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("_at", F.struct(*payload).alias("item")))).alias("_sorted"))
        .select(*keys, "page", F.transform("_sorted", lambda s: s["item"]).alias("items"))
    )


def payload_totals(pages: DataFrame, keys: Sequence[str], items: str = "items") -> DataFrame:
    """Grand total of items per payload."""
    return pages.groupBy(*keys).agg(F.sum(F.size(items)).cast("bigint").alias("total"))
