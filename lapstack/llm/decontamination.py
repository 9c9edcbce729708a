"""Benchmark decontamination: short test items searched in long documents by containment MinHash.

Test items are partitioned by size (the next power of two). An item keeps the smallest hashes of its five-word
shingles: all of them in small partitions, else as many as a document that holds the asked-for share may lack in that
partition, and some more. The documents' shingle hashes are probed with those sketches, whatever the documents' own
size; one with fewer sketch hits than it must have is ruled out for certain. What is left is verified on the shingles
themselves. An item shorter than a shingle is one shingle of its own length, and documents are probed at that length
too. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import ASCII_SPACE, let, text_of
from lapstack.session import stage

# a side of at most so many narrow rows may be broadcast; beyond that the join is a shuffle
_BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    containment: float = 0.8
    sketch: int = 48  # smallest hashes kept of an item, at least
    spare: int = 16  # hashes kept beyond those that a document may lack, at least


def words_of(column: str = "text") -> Column:
    """Lower-case words between ASCII white space."""
    return F.array_remove(F.split(F.lower(text_of(column)), ASCII_SPACE + "+"), "")


def _places(words: Column, width: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0)))


def shingles_of(words: Column, width: Column | int) -> Column:
    """The distinct shingles of a word array; fewer words than ``width`` make one shingle, none make none."""
    none = F.array().cast("array<string>")

    def made(w: Column) -> Column:
        each = F.transform(_places(w, width), lambda i: F.array_join(F.slice(w, i + 1, width), " "))
        return F.when(F.size(w) > 0, F.array_distinct(each)).otherwise(none)

    return let(words, made)


def hashes_of(words: Column, width: int, shorter: tuple[int, ...] = ()) -> Column:
    """xxhash64 over the words of every distinct shingle; words that a short text lacks leave the hash as it is.

    ``shorter`` names smaller widths whose shingles are hashed besides.
    """
    none = F.array().cast("array<bigint>")

    def made(w: Column) -> Column:
        def grams(n: int) -> Column:
            return F.transform(_places(w, n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))

        each = F.concat(*map(grams, (width, *shorter))) if shorter else grams(width)
        return F.when(F.size(w) > 0, F.array_distinct(each)).otherwise(none)

    return let(words, made)


def _part(size: Column) -> Column:
    """The size partition of an item: the exponent of the next power of two."""
    return F.ceil(F.log2(size)).cast("int")


def _lacking(size: Column, settings: Settings) -> Column:
    """How many of an item's shingles a document with the asked-for share may lack."""
    return F.floor(size * (1 - settings.containment) + 1e-9).cast("int")


def _kept(size: Column, settings: Settings) -> Column:
    """How many hashes an item keeps, by its size partition: at least ``spare`` more than a document may lack."""
    largest = F.pow(F.lit(2), _part(size)).cast("int")
    return F.least(size, F.greatest(F.lit(settings.sketch), _lacking(largest, settings) + settings.spare))


def item_sketches(items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``item``, ``size``, ``part`` (size partition), ``required`` (sketch hits that a document must have) and one sketch
    ``hash`` a row; equal items once."""
    sized = (
        items.select("item", "words")
        .select("item", hashes_of(F.col("words"), settings.shingle).alias("hashes"))
        .withColumn("size", F.size("hashes"))
        .withColumn("kept", _kept(F.col("size"), settings))
    )
    return sized.select(
        "item",
        "size",
        _part(F.col("size")).alias("part"),
        (F.col("kept") - _lacking(F.col("size"), settings)).alias("required"),
        F.explode(F.slice(F.sort_array("hashes"), F.lit(1), F.col("kept"))).alias("hash"),
    )


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= _BROADCAST_ROWS else df


def matches(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``item_id``, ``item_shingles``, ``shared_shingles``, ``containment`` of every test item of which a
    document holds the asked-for share of shingles.

    Words are lower-cased and parted by ASCII white space; whole texts are searched. An item of fewer words than a
    shingle is one shingle, found wherever a document has these words in a row. NULL and empty items or texts hold
    nothing; equal items are searched once and all reported; rows that share a ``doc_id`` count as one document, and
    rows without one are not searched; copies of a benchmark row are reported once. Other columns are not read.
    """
    width = settings.shingle
    named = benchmark.filter("item_id IS NOT NULL").select("item_id", words_of().alias("words")).distinct()
    named = named.filter(F.size("words") > 0).withColumn("item", F.xxhash64("words"))
    named = stage(named, "items")
    items = named.groupBy("item").agg(F.any_value("words").alias("words"))
    counted = items.agg(F.sum(F.size("words")).alias("n"), F.collect_set(F.when(F.size("words") < width, F.size("words"))).alias("short"))
    counted = counted.first()
    n_shingles, short = counted["n"] or 0, tuple(sorted(counted["short"]))
    sketches = stage(item_sketches(items, settings), "sketches")

    searched = docs.filter("doc_id IS NOT NULL")
    probes = searched.select("doc_id", F.explode(hashes_of(words_of(), width, short)).alias("hash"))
    hits = probes.join(_bounded(sketches.select("hash", "item", "required"), sketches.count()), "hash")
    found = (
        hits.groupBy("doc_id", "item", "hash")
        .agg(F.any_value("required").alias("required"))
        .groupBy("doc_id", "item")
        .agg(F.count(F.lit(1)).alias("hits"), F.any_value("required").alias("required"))
        .filter("hits >= required")
        .select("doc_id", "item")
    )
    pairs = stage(found, "candidates")

    own_width = F.least(F.size("words"), F.lit(width)).alias("width")
    exact_items = items.select("item", own_width, shingles_of(F.col("words"), width).alias("item_set"))
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", text_of().alias("text"))
    # the pairs are two numbers a row, the items' shingles are counted as rows
    near = texts.join(_bounded(pairs, pairs.count()), "doc_id").join(_bounded(exact_items, n_shingles), "item")
    shared = (
        near.select(
            "doc_id",
            "item",
            F.size("item_set").alias("item_shingles"),
            F.array_intersect("item_set", shingles_of(words_of(), F.col("width"))).alias("common"),
        )
        # rows of one document are taken together
        .withColumn("s", F.explode("common"))
        .groupBy("doc_id", "item")
        .agg(F.any_value("item_shingles").cast("bigint").alias("item_shingles"), F.count_distinct("s").alias("shared_shingles"))
        .withColumn("containment", F.col("shared_shingles") / F.col("item_shingles"))
        .filter(F.col("containment") >= settings.containment)
    )
    names = named.select("item", "item_id").distinct()
    return shared.join(names, "item").select("doc_id", "item_id", "item_shingles", "shared_shingles", "containment")


def decontaminate(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that hold no test item, with all their columns; rows without a ``doc_id`` stay."""
    named = matches(docs, benchmark, settings).select("doc_id").distinct()
    named = stage(named, "contaminated")
    return docs.join(_bounded(named, named.count()), "doc_id", "left_anti").select(*docs.columns)


MATCHES_SQL = r"""
WITH item_words AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
items AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS n, array_to_string(w[i:i+4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL),
docs AS (
  SELECT DISTINCT doc_id, n, array_to_string(w[i:i+n-1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM items))),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM items GROUP BY item_id)
SELECT doc_id, item_id, any_value(item_shingles) AS item_shingles, count(*) AS shared_shingles,
       count(*) / any_value(item_shingles) AS containment
FROM docs JOIN items USING (s, n) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id
HAVING count(*) / any_value(item_shingles) >= 0.8
"""
