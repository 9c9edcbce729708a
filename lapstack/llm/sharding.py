"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards under quotas.

The nodes that move are atoms: the copies of a text that fall into one of a fixed number of buckets, so a text with a
third of all rows is many atoms and no group meets in one task. Atoms of one text are linked. Labels start
balanced; in each round every linked atom asks for the shard, with room left, in which its neighbours have most rows,
provided that is more than where it is. Requests are added up by (from, to, strength, slice), a table whose size does
not depend on the data, and the driver grants slices, strongest first, while the target shard stays within its quota.
Unlinked documents come last and fill the shards up: by slices of a hash, and one by one where a document is large
against a shard, of which there can only be a bounded number.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapstack.llm.common import text_of
from lapstack.session import stage

ROW_BYTES = 8


@dataclass(frozen=True)
class Settings:
    shards: int = 24
    rounds: int = 10
    slack: float = 0.02  # over the fullest shard of linked documents
    buckets: int = 256  # atoms that a text's copies may make at most
    slices: int = 16  # of requests of one strength between two shards
    strengths: int = 12  # classes of gain, by powers of two
    fill_slices: int = 8192  # of the unlinked documents
    large: int = 1024  # a document above 1 / (shards * large) of all bytes is placed by itself
    slot_buckets: int = 512  # of a shard, counted apart so that slots need no shard-wide order


def documents_of(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, the text's hash and one of the row; a NULL text has no bytes.

    The place of a row is part of its hash, so that rows of one ``doc_id``, or without any, are dealt out as well; the
    rows are to be stored.
    """
    text = text_of()
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.xxhash64("doc_id", F.monotonically_increasing_id(), F.lit(17)).alias("row_hash"),
    )


def _slice(column: str, parts: int, seed: int):
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(parts)).cast("int")


def _packed(pieces: list[tuple], loads: list[float]) -> dict:
    """Largest first, each piece (key, bytes) to the shard with the least: key -> shard; ``loads`` is updated."""
    heap = [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(heap)
    placed = {}
    for key, size in sorted(pieces, key=lambda p: (-p[1], p[0])):
        load, s = heapq.heappop(heap)
        placed[key] = s
        heapq.heappush(heap, (load + size, s))
    for load, s in heap:
        loads[s] = load
    return placed


def _granted(requests: list, loads: dict[int, int], quota: float) -> set:
    """The (from, to, strength, slice) requests that keep every target within its quota; strongest first."""
    waiting = sorted(requests, key=lambda r: (-r["strength"], r["src"], r["dst"], r["slice"]))
    out, moved = set(), True
    while moved and waiting:
        moved, left = False, []
        for r in waiting:
            if loads[r["dst"]] + r["bytes"] <= quota:
                loads[r["dst"]] += r["bytes"]
                loads[r["src"]] -= r["bytes"]
                out.add((r["src"], r["dst"], r["strength"], r["slice"]))
                moved = True
            else:
                left.append(r)
        waiting = left  # what has moved away may have made room
    return out


def _small_frame(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A table whose rows are bounded by the settings, for a broadcast join."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def propagate(atoms: DataFrame, quota: float, settings: Settings = Settings()) -> DataFrame:
    """Labels (``shard``) of linked atoms (``group``, ``bucket``, ``rows``, ``bytes``), within ``quota`` bytes a shard."""
    spark, shards = atoms.sparkSession, settings.shards
    atoms = atoms.withColumn("fine", F.xxhash64("group", "bucket"))
    start = atoms.groupBy(_slice("fine", settings.fill_slices, 3).alias("s")).agg(F.sum("bytes").alias("bytes")).collect()
    loads = [0] * shards
    first = _packed([(r["s"], r["bytes"]) for r in start], loads)
    if not first:
        return atoms.select("group", "bucket", F.lit(0).alias("shard"))
    table = _small_frame(spark, list(first.items()), "s int, shard int")
    labels = stage(atoms.withColumn("s", _slice("fine", settings.fill_slices, 3)).join(table, "s").drop("s"), "labels")
    # where linked documents fill every shard, some slack lets them change places
    quota = max(quota, max(loads) * (1 + settings.slack))
    load, closed = dict(enumerate(loads)), set()
    for turn in range(settings.rounds):
        room = F.array(*[F.lit(s not in closed) for s in range(shards)])
        votes = labels.groupBy("group", "shard").agg(F.sum("rows").alias("votes"), F.sum("bytes").alias("together"))
        open_votes = votes.filter(F.get(room, F.col("shard")))
        # most neighbours first; of equals, one that the group's hash picks
        pick = F.struct(F.col("votes"), F.xxhash64("group", "shard", F.lit(turn)).alias("by"), F.col("shard"))
        best = open_votes.groupBy("group").agg(F.max(pick).alias("best"))
        asked = (
            labels.join(votes, ["group", "shard"])
            .join(best, "group")
            .select(
                *labels.columns,
                F.col("best.shard").alias("dst"),
                F.when(F.col("best.votes") > F.col("votes"), F.col("best.votes") - F.col("votes"))
                # a tie moves the same way for the whole group
                .when((F.col("best.votes") == F.col("votes")) & (F.col("best.shard") != F.col("shard")), F.lit(0))
                .alias("gain"),
                # what is large against the quota may move in parts, else a group's atoms keep together
                F.when(F.col("together") * settings.slices > quota, F.col("fine")).otherwise(F.col("group")).alias("unit"),
            )
            .withColumn("strength", F.least(F.floor(F.log2(F.col("gain") + 1)), F.lit(settings.strengths - 1)).cast("int"))
            .withColumn("slice", _slice("unit", settings.slices, 5))
            .drop("unit")
        )
        asked = stage(asked, "asked")
        requests = (
            asked.filter("gain IS NOT NULL AND dst <> shard")
            .groupBy(F.col("shard").alias("src"), "dst", "strength", "slice")
            .agg(F.sum("bytes").alias("bytes"))
            .collect()  # at most shards * shards * strengths * slices rows
        )
        if not requests:
            break
        before = dict(load)
        granted = _granted(requests, load, quota)
        # a shard that had to turn all away is full, until something leaves it
        turned_away = {r["dst"] for r in requests} - {dst for _, dst, _, _ in granted}
        closed = {s for s in closed | turned_away if load[s] >= before[s]}
        if not granted:
            if len(closed) == shards:
                break
            continue
        moves = _small_frame(spark, sorted(granted), "shard int, dst int, strength int, slice int").withColumn("go", F.lit(True))
        labels = stage(
            asked.join(moves, ["shard", "dst", "strength", "slice"], "left").select(
                *[F.when(F.col("go"), F.col("dst")).otherwise(F.col("shard")).alias("shard") if c == "shard" else F.col(c) for c in labels.columns]
            ),
            "labels",
        )
    return labels.select("group", "bucket", "shard")


def shard(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row; sizes of shards are nearly equal.

    Equal texts are linked and share a shard as far as the quota of total / shards bytes lets them. A shard exceeds the
    mean by less than one large document or slice. NULL texts have no bytes, a NULL ``doc_id`` is a value like others,
    repeated rows each get a slot; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = stage(documents_of(docs).withColumn("bucket", F.pmod("row_hash", F.lit(settings.buckets)).cast("int")), "sizes")
    total = rows.agg(F.sum("size").alias("t")).first()["t"] or 0
    atoms = rows.groupBy(F.col("text_hash").alias("group"), "bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.max("size").alias("one")
    )
    # at most `buckets` rows of a group are added up here
    whole = atoms.groupBy("group").agg(F.sum("rows").alias("copies"))
    atoms = stage(atoms.join(whole, "group"), "atoms")
    linked = propagate(atoms.filter("copies > 1").select("group", "bucket", "rows", "bytes"), total / settings.shards, settings)
    linked = stage(linked, "linked")
    alone = atoms.filter("copies = 1")

    loads = [0.0] * settings.shards
    taken = atoms.filter("copies > 1").join(linked, ["group", "bucket"]).groupBy("shard").agg(F.sum("bytes").alias("b"))
    for r in taken.collect():
        loads[r["shard"]] = r["b"]
    limit = max(total // (settings.shards * settings.large), 1)
    # fewer than shards * large documents can be above the limit
    large = alone.filter(F.col("bytes") > limit).select("group", "bytes").collect()
    big = _packed([(r["group"], r["bytes"]) for r in large], loads)
    slices = alone.filter(F.col("bytes") <= limit).groupBy(_slice("group", settings.fill_slices, 7).alias("s"))
    rest = _packed([(r["s"], r["b"]) for r in slices.agg(F.sum("bytes").alias("b")).collect()], loads)
    by_group = _small_frame(spark, list(big.items()), "group bigint, big int")
    by_slice = _small_frame(spark, list(rest.items()), "s int, rest int")
    singles = (
        alone.withColumn("s", _slice("group", settings.fill_slices, 7))
        .join(by_group, "group", "left")
        .join(by_slice, "s", "left")
        .select("group", "bucket", F.coalesce("big", "rest").alias("shard"))
    )
    placed = linked.unionByName(singles).withColumnRenamed("group", "text_hash")
    labelled = rows.join(placed, ["text_hash", "bucket"]).withColumn("part", F.pmod(F.xxhash64("row_hash"), F.lit(settings.slot_buckets)))
    return with_slots(stage(labelled.select("doc_id", "size", "text_crc32", "shard", "part"), "shards"))


def with_slots(labelled: DataFrame) -> DataFrame:
    """Gapless ``slot`` numbers from 0 within every ``shard``: by ``part``, then ``doc_id``; ``part`` is dropped.

    Rows of a shard are only ordered within a part; the rows before a part are counted (a table as small as shards
    times parts).
    """
    counts = labelled.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(counts.select("shard", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = labelled.withColumn("at", F.row_number().over(within)).join(starts, ["shard", "part"])
    return numbered.withColumn("slot", F.col("before") + F.col("at") - 1).drop("part", "at", "before")
