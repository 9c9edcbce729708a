"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, whatever the length of the text, so the
sketch of a union is the union of the sketches, and shares of sketches estimate containment and resemblance however
unequal two documents are. Everything is DataFrame expressions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstack.llm.common import ASCII_SPACE, free_name, let, text_of

_LOWEST = -(1 << 63)
_SHARES = 10_000  # id quantiles at most


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    fraction: float = 1 / 16  # of the hash range that is kept
    bucket_bytes: int = 64 << 20  # of texts that one task orders by id


def hashes_of(text: Column, width: int = 5) -> Column:
    """The distinct shingle hashes of a text, in order; fewer words than ``width`` are one shingle, none are none."""
    none = F.array().cast("array<bigint>")

    def made(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
        each = F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return F.when(F.size(w) > 0, F.sort_array(F.array_distinct(each))).otherwise(none)

    return let(F.array_remove(F.split(F.lower(text), ASCII_SPACE + "+"), ""), made)


def sketch_of(hashes: Column, settings: Settings = Settings()) -> Column:
    """The hashes below the fixed fraction of the range (hashes are signed), in order."""
    low = _LOWEST + int(settings.fraction * (1 << 64))
    return F.filter(hashes, lambda h: h < F.lit(low)) if low < 1 << 63 else hashes


def resemblance(a: Column, b: Column) -> Column:
    """The share of common hashes among all of two sketches, 0 to 1; 1 for equal sketches, also empty ones."""
    common = F.size(F.array_intersect(a, b))
    return F.when(a == b, 1.0).otherwise(common / (F.size(a) + F.size(b) - common))


def containment(a: Column, b: Column) -> Column:
    """The estimated share of the first text's shingles that the second has, 0 to 1.

    An empty sketch says nothing of its text: its share is 1 of an equal sketch, else 0.
    """
    return F.when(a == b, 1.0).when(F.size(a) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(sketch: Column) -> Column:
    """Aggregate: the sketch of all shingles of a group of documents; the hashes kept grow with the distinct text."""
    return F.sort_array(F.array_distinct(F.flatten(F.collect_list(sketch))))


def printed(sketch: Column) -> Column:
    """The sketch as text: its hashes in hex, comma-joined."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def with_fingerprint(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents with ``sketch`` (a column of that name is replaced); NULL texts count as empty."""
    return docs.withColumn("sketch", sketch_of(hashes_of(text_of(), settings.shingle), settings))


def _known(cuts: list[tuple[int, int]]) -> Column:
    """Cuts as one constant, however many they are."""
    return F.from_json(F.lit(json.dumps([{"k": k, "h": h} for k, h in cuts])), "array<struct<k:bigint,h:bigint>>")


def _bucket_of(place: Column, cuts: list[tuple[int, int]]) -> Column:
    """How many cuts are at most the place, in two steps of about the root of their number."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    block = F.size(F.filter(_known(cuts[step - 1 :: step]), lambda c: c <= place))
    rest = F.filter(F.slice(_known(cuts), block * step + 1, F.lit(step)), lambda c: c <= place)
    return block * step + F.size(rest)


def _firsts(rows: DataFrame, settings: Settings) -> list[tuple[int, int]]:
    """The places (id, hash) at which ranges of at most about ``bucket_bytes`` begin, each that of a row.

    ``rows`` has ``k``, ``h`` and ``bytes``. Quantiles of the ids are weighed by the bytes between them; a range that
    is still too large is cut evenly by id, or by hash where it has one id.
    """
    spark = rows.sparkSession
    total = rows.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return []
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = max(1, min(settings.bucket_bytes, -(-total["bytes"] // least)))
    shares = min(4 * -(-total["bytes"] // target), _SHARES)
    ids = rows.agg(F.percentile_approx("k", [i / shares for i in range(shares)], max(10_000, 10 * shares))).first()[0]

    def measured(rows: DataFrame, cuts: list[tuple[int, int]]) -> list:
        ranges = rows.groupBy(_bucket_of(F.struct("k", "h"), cuts[1:]).alias("b"))
        sizes = ranges.agg(F.sum("bytes").alias("bytes"), F.min("k").alias("k"), F.max("k").alias("top"), F.min("h").alias("h"))
        return sizes.orderBy("b").collect()  # a row for each range

    # an id that is several quantiles is a range of its own
    often = {a for a, b in zip(ids, ids[1:]) if a == b}
    cuts = [(k, _LOWEST) for k in sorted({*ids, *(k + 1 for k in often)}) if k < 1 << 63]
    found = measured(rows.withColumn("h", F.lit(_LOWEST)), cuts)
    if any(r["bytes"] > 2 * target for r in found):
        cuts = []
        for r in found:
            pieces = -(-r["bytes"] // target)
            if r["k"] == r["top"]:
                cuts += [(r["k"], _LOWEST + (i << 64) // pieces) for i in range(pieces)]
            else:
                cuts += [(r["k"] + (r["top"] - r["k"]) * i // pieces, _LOWEST) for i in range(pieces)]
        found = measured(rows, sorted(set(cuts)))
    firsts, held, last = [], 0, None
    for r in found:
        # ranges are taken together up to the target; one that begins inside an id begins at its first hash
        inside = last == r["k"]
        if not firsts or inside or held + r["bytes"] > target:
            firsts.append((r["k"], r["h"] if inside else _LOWEST))
            held = 0
        held += r["bytes"]
        last = r["top"]
    return firsts


def _keys(spark, parts: int) -> list[int]:
    """Numbers that a shuffle over ``parts`` partitions deals to a partition each, in the order of the partitions."""
    tried = spark.range(40 * parts + 100)
    dealt = tried.groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("p")).agg(F.min("id").alias("id")).collect()
    known = {r["p"]: r["id"] for r in dealt}
    return [known.get(p, p) for p in range(parts)]


def with_next(docs: DataFrame, value: Column, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """Every row with ``own``, ``value`` of it, and ``next``, that of the row after it by ``doc_id`` (after the last, the first).

    Rows without an id come with the smallest one; rows of one id by a hash of ``text``, then the text. Rows are dealt
    to ranges of about ``bucket_bytes`` bytes of text, one to a partition; rows of one id are several ranges if need
    be. The first rows of a range are dealt to the range before as well, where they only serve as the end, so one
    shuffle is enough and no task sees all rows.
    """
    spark = docs.sparkSession
    key, hashed, number, to, end = (free_name([*docs.columns, "own", "next"], n) for n in ("key", "hash", "range", "to", "end"))
    least = docs.agg(F.min("doc_id")).first()[0] or 0
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(least)), hashed: F.xxhash64(text)})
    firsts = _firsts(keyed.select(F.col(key).alias("k"), F.col(hashed).alias("h"), (F.octet_length(text) + 64).alias("bytes")), settings)
    cuts = firsts[1:]
    place = F.struct(F.col(key).alias("k"), F.col(hashed).alias("h"))
    # a range that begins inside an id begins at its hash, any other at all rows of its id
    first = F.get(_known(firsts), F.col(number))
    begins = (first["k"] == F.col(key)) & ((first["h"] == F.col(hashed)) | (first["h"] == _LOWEST))
    slot = F.from_json(F.lit(json.dumps(_keys(spark, len(cuts) + 1))), "array<bigint>")
    # the range before; before the first comes the last
    before = F.pmod(F.col(number) - 1, F.lit(len(cuts) + 1))
    here = F.struct(F.col(number).alias("b"), F.lit(False).alias("end"))
    there = F.struct(before.alias("b"), F.lit(True).alias("end"))
    dealt = (
        keyed.withColumn(number, _bucket_of(place, cuts))
        .withColumn(to, F.explode(F.when(begins, F.array(here, there)).otherwise(F.array(here))))
        .withColumns({number: F.get(slot, F.col(f"{to}.b")), end: F.col(f"{to}.end")})
        .drop(to)
        .repartition(len(cuts) + 1, number)
    )
    order = Window.partitionBy(number).orderBy(end, key, hashed, text)
    led = dealt.withColumn("own", value).withColumn("next", F.lead("own").over(order)).filter(~F.col(end))
    return led.drop(key, hashed, number, end)


def edited(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down, code points) replaced by as many first ones of the next text, or all."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def edit_fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, the fingerprints of a text and of its edited form, and their likeness.

    ``near_edited`` and ``near_next`` compare the text's fingerprint with those of the edited and the next text;
    ``part_of_edited`` is the estimated share of its shingles that the edited text still has. NULL texts are empty; the
    next row is that of ``with_next``; a table of one row is its own next. Equal texts have equal fingerprints. Other
    columns are left out. An empty table gives no rows.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    # only texts are shuffled: a sketch is made from them faster than it is stored, once for a text and the one before
    own = F.struct(F.col("text"), sketch_of(hashes_of(F.col("text"), settings.shingle), settings).alias("sketch"))
    made = with_next(rows, own, settings).withColumn("edit", edited(F.col("text"), F.col("next.text")))
    made = made.withColumn("changed", sketch_of(hashes_of(F.col("edit"), settings.shingle), settings))
    sketch, changed, following = F.col("own.sketch"), F.col("changed"), F.col("next.sketch")
    return made.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edit").cast("binary"), 256).alias("edited_sha256"),
        printed(sketch).alias("fingerprint"),
        printed(changed).alias("edited_fingerprint"),
        resemblance(sketch, changed).cast("double").alias("near_edited"),
        resemblance(sketch, following).cast("double").alias("near_next"),
        containment(sketch, changed).cast("double").alias("part_of_edited"),
    )
