"""Year documents: one large nested JSON file written as a stream of lines, and read by many tasks.

A document is read in pieces that end at a closing brace, as Spark splits a text file over tasks at any separator. A
piece alone does not say whether it starts inside a quoted text or how deep it lies; both follow from sums over the
pieces before it: the parity of the unescaped quotes, and the opened less the closed brackets. The sums are made inside
the blocks of a file, one block to a task, and over the blocks from one row each. Pieces that close an element of the
wanted array end it, and only the pieces of one element (or of one entry without its elements) ever meet: where their
block lies, or, if they are of several blocks, by the number of the element.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapstack.schemas import ROUND_ENDPOINTS, ROUND_ITEMS, entry_schema, payload_path
from lapstack.session import few, settle, stage
from lapstack.sources.files import year_of

_PIECES_END = "}"
_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
# brackets opened around an element: of the top array (object, its table, the table's object, the array), and of an
# array of its entries
_ENTRY_DEPTH, _ITEM_DEPTH = 4, 6
_NEXT_ELEMENT = r"\A\s*,\s*(?=\{)"
_QUOTED = r'"[^"]*(?:"|\z)'
_ARRAY_END = r"\A\s*\]"
_BLOCK = ["file", "block"]
_TASKS = 4  # for each core, that read blocks


def _plain(text: Column) -> Column:
    """Without escaped characters."""
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)


def _unquoted(text: Column, inside: Column | bool = False) -> Column:
    """Without quoted texts; ``inside``: whether the text starts in one."""
    plain = _plain(text)
    tail = F.regexp_replace(plain, r'\A[^"]*(?:"|\z)', "")
    start = tail if inside is True else plain if inside is False else F.when(inside, tail).otherwise(plain)
    return F.regexp_replace(start, _QUOTED, "")


def _count(text: Column, character: str) -> Column:
    """How often the character is there: a search for one character costs far less than an expression."""
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _deeper(unquoted: Column) -> Column:
    """Opened less closed brackets."""
    return _count(unquoted, "[") + _count(unquoted, "{") - _count(unquoted, "]") - _count(unquoted, "}")


def _array_start(key: str) -> str:
    """The name of an array of objects and its bracket; inside a quoted text its quotes would be escaped."""
    return rf'(?<!\\)"{key}"\s*:\s*\[\s*(?=\{{)'


def read_pieces(spark: SparkSession, path: str, start_year: int | None = None, split_bytes: int | None = None) -> DataFrame:
    """``year``, ``file``, ``block``, ``seq`` and ``text``: the documents' pieces in order, without their closing brace; stored.

    ``year`` is that of the folder and ``file`` a number told from the whole path, as rows are sorted by it many times.

    ``quotes`` counts a piece's quotes, ``outer`` and ``inner`` what it adds to the depth if it starts outside or inside
    a quoted text (its brace counts where it ends outside); they are told here once, for all that reads the pieces. A
    task reads many blocks, so that small ones do not make as many files.

    With ``start_year`` only those in number-named folders from that one on; ``split_bytes`` stands in for the session's
    size of a block.
    """
    pieces = spark.read.option("lineSep", _PIECES_END).text(path).select(
        year_of(F.col("_metadata.file_path")).alias("year"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("text"),
    )
    pieces = pieces.withColumn("_plain", _plain(F.col("text"))).withColumn("quotes", _count(F.col("_plain"), '"'))
    odd = F.col("quotes") % 2
    pieces = pieces.withColumn("_out", F.regexp_replace("_plain", _QUOTED, ""))
    pieces = pieces.withColumns({"_all": _deeper(F.col("_plain")), "_outside": _deeper(F.col("_out"))}).drop("_plain", "_out")
    # a bracket that is not outside lies in a quoted text, or outside if the piece starts in one
    pieces = pieces.withColumns({"outer": F.col("_outside") - (1 - odd), "inner": F.col("_all") - F.col("_outside") - odd})
    pieces = pieces.drop("_all", "_outside")
    if start_year is not None:
        pieces = pieces.filter(F.col("year") >= start_year)
    before = spark.conf.get(_SPLIT_BYTES)
    if split_bytes:
        spark.conf.set(_SPLIT_BYTES, str(split_bytes))
    try:
        return stage(pieces.coalesce(_TASKS * spark.sparkContext.defaultParallelism), "pieces")
    finally:
        spark.conf.set(_SPLIT_BYTES, before)


def _in_block() -> tuple:
    order = Window.partitionBy(*_BLOCK).orderBy("seq")
    return order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(column: str | Column) -> Column:
    return F.coalesce(F.sum(column).over(_in_block()[0]), F.lit(0))


def _ahead(blocks: DataFrame, sums: Sequence[str]) -> DataFrame:
    """For each block of a file, one row, the sums over the blocks before it; stored."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return settle(blocks.select(*_BLOCK, *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(s) for s in sums]))


def _with_place(pieces: DataFrame) -> DataFrame:
    """The pieces with ``quoted`` (whether they start in a quoted text), ``depth`` at their start and ``after`` their brace."""
    marked = pieces.withColumn("q", _before("quotes") % 2)
    even = F.col("q") == 0
    step0, step1 = F.when(even, F.col("outer")).otherwise(F.col("inner")), F.when(even, F.col("inner")).otherwise(F.col("outer"))
    # of a block: its quotes, and the depth it adds if it starts outside or inside a quoted text
    sizes = marked.withColumns({"d0": step0, "d1": step1}).groupBy(*_BLOCK)
    sizes = sizes.agg(F.sum("quotes").alias("quotes"), F.sum("d0").alias("d0"), F.sum("d1").alias("d1"))
    starts = _ahead(sizes, ["quotes"]).withColumnRenamed("quotes", "start")
    known = sizes.join(starts, _BLOCK).withColumn("d", F.when(F.col("start") % 2 == 0, F.col("d0")).otherwise(F.col("d1")))
    depths = _ahead(known, ["d"]).join(starts, _BLOCK).select(*_BLOCK, F.col("d").alias("_depth"), (F.col("start") % 2).alias("_start"))
    placed = marked.join(few(depths), _BLOCK).withColumn("quoted", (F.col("q") + F.col("_start")) % 2 == 1)
    placed = placed.withColumn("d", F.when(F.col("quoted"), F.col("inner")).otherwise(F.col("outer")))
    placed = placed.withColumn("depth", F.col("_depth") + _before("d"))
    outside = (F.col("quoted").cast("int") + F.col("quotes")) % 2 == 0
    return placed.withColumn("after", F.when(outside, F.col("depth") + F.col("d"))).select("year", *_BLOCK, "seq", "text", "quoted", "depth", "after")


def _with_start(pieces: DataFrame, key: str, depth: int, name: str) -> DataFrame:
    """With ``name``: the place (from 1) after the bracket that starts the array at this depth, NULL where a piece has none."""
    found = F.regexp_substr("text", F.lit(_array_start(key)))
    end = F.regexp_instr("text", F.lit(_array_start(key))) + F.length(found) - 1
    # few pieces have the name at all; each step told once, as a column
    ended = pieces.withColumn("_end", F.when(F.contains(F.col("text"), F.lit(f'"{key}"')), end))
    ahead = _plain(F.substring(F.col("text"), F.lit(1), F.col("_end")))
    outside = F.when(F.col("quoted"), F.regexp_replace("_ahead", r'\A[^"]*(?:"|\z)', "")).otherwise(F.col("_ahead"))
    opened = ended.withColumn("_ahead", F.when(F.col("_end").isNotNull(), ahead)).withColumn("_ahead", outside)
    opened = opened.withColumn("_ahead", F.regexp_replace("_ahead", _QUOTED, ""))
    reached = F.col("depth") + _deeper(F.col("_ahead"))
    return opened.withColumn(name, F.when(reached == depth, F.col("_end"))).drop("_end", "_ahead")


def _located(pieces: DataFrame, entries: str, items: str | None) -> DataFrame:
    """The pieces with the places at which entries and items begin in them, and how many of each their block ended before them.

    ``entry`` and ``item`` count inside the block; ``entry_end``, ``item_end`` and ``array_end`` say what a piece ends.
    """
    outside = ~F.col("quoted")
    # each told once, as a column
    between = outside & F.col("depth").isin(_ENTRY_DEPTH, _ITEM_DEPTH)
    next_one = F.when(between, F.nullif(F.length(F.regexp_extract("text", _NEXT_ELEMENT, 0)), F.lit(0)))

    def begins(start: str, depth: int) -> Column:
        return F.coalesce(F.col(start), F.when(F.col("depth") == depth, F.col("_next")))

    placed = _with_start(_with_place(pieces).withColumn("_next", next_one), entries, _ENTRY_DEPTH, "_entry_start")
    placed = placed.withColumn("entry_from", begins("_entry_start", _ENTRY_DEPTH)).drop("_entry_start")
    flags = {"entry_end": F.col("after") == _ENTRY_DEPTH}
    if items:
        placed = _with_start(placed, items, _ITEM_DEPTH, "array_from").withColumn("item_from", begins("array_from", _ITEM_DEPTH))
        closed = F.when(outside & (F.col("depth") == _ITEM_DEPTH), F.col("text").rlike(_ARRAY_END))
        flags |= {"item_end": F.col("after") == _ITEM_DEPTH, "array_end": closed}
    placed = placed.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in flags.items()}).drop("_next")
    counts = {n: _before(F.col(f"{n}_end").cast("int")) for n in ("entry", "item") if f"{n}_end" in flags}
    return placed.withColumns(counts)


def _text_of(parts: Column) -> Column:
    """One text from structs with a ``part``, in the order of what comes before it in them."""
    return F.array_join(F.transform(F.array_sort(parts), lambda p: p["part"]), "")


def _joined(pieces: DataFrame, keys: Sequence[str], text: str, name: str, *more: Column) -> DataFrame:
    """One text for each key: its parts of several blocks in order."""
    parts = F.collect_list(F.struct("block", "seq", F.col(text).alias("part")))
    return pieces.groupBy(*keys).agg(_text_of(parts).alias(name), *more)


def _head_text(array: bool) -> Column:
    """What of a piece belongs to its entry without the items, NULL where nothing does."""
    start = F.coalesce("entry_from", F.lit(0)) + 1
    text = F.concat(F.substring(F.col("text"), start, F.length("text")), F.lit(_PIECES_END))
    if array:
        up_to_array = F.substring(F.col("text"), start, F.col("array_from") - start + 1)
        text = F.when(F.col("array_from").isNotNull(), up_to_array).otherwise(text)
    return F.when((F.col("depth") > _ENTRY_DEPTH) | F.col("entry_from").isNotNull(), text)


def split_entries(
    spark: SparkSession, path: str, endpoint: str, start_year: int | None = None, split_bytes: int | None = None
) -> DataFrame:
    """``year`` (of the folder), ``_entry`` and the struct ``e`` of every entry of the documents' top array, as from a whole read.

    For endpoints whose entries hold no items of their own. Documents are whole lists, so places start at 0.
    """
    pieces = _located(read_pieces(spark, path, start_year, split_bytes), payload_path(endpoint).rsplit(".", 1)[-1], None)
    head = F.when(_head_text(False).isNotNull(), F.struct("seq", _head_text(False).alias("part")))
    parts = pieces.groupBy(*_BLOCK, "entry").agg(
        _text_of(F.collect_list(head)).alias("head"),
        F.max(head.isNotNull()).alias("_any"),
        F.min("seq").alias("seq"),
        F.sum(F.col("entry_end").cast("int")).alias("entries"),
        F.first("year").alias("year"),
    )
    parts = stage(parts, "parts")
    ahead = _ahead(parts.groupBy(*_BLOCK).agg(F.sum("entries").alias("_entries")), ["_entries"])
    numbered = parts.filter("_any").join(few(ahead), _BLOCK).withColumn("entry", F.col("entry") + F.col("_entries"))
    whole = _joined(numbered, ["file", "entry"], "head", "whole", F.first("year").alias("year"))
    return whole.select(
        "year",
        F.lit(0).cast("bigint").alias("_offset"),
        F.col("entry").cast("int").alias("_entry"),
        F.from_json("whole", entry_schema(endpoint)).alias("e"),
    )


def _parts(pieces: DataFrame, endpoint: str) -> DataFrame:
    """What each block holds of every item and of every entry without its items; stored.

    A piece is in an array if the last one that begins or ends an array, at or before it, begins one. Where the block has
    none before a piece (``leading``), the blocks before tell: such pieces are kept as parts of an item and of an entry.
    ``begun`` are those known to be in an array, and ``whole`` the parts that are all of an item. Entries that lie in one
    block have their ``season`` and ``round`` on all of their parts. ``last`` is the last begin or end of an array.
    """
    at = F.when(F.col("array_from").isNotNull(), F.struct("seq", F.lit(True).alias("open"), F.col("item").alias("first")))
    at = at.when(F.col("array_end"), F.struct("seq", F.lit(False).alias("open"), F.lit(None).cast("bigint").alias("first")))
    marked = pieces.withColumn("_at", at).withColumn("_state", F.last("_at", True).over(_in_block()[1]))
    begun, leading = F.coalesce(F.col("_state.open"), F.lit(False)), F.col("_state").isNull()
    marked = marked.withColumns({"begun": begun, "leading": leading})
    item = F.concat(F.substring(F.col("text"), F.coalesce("item_from", F.lit(0)) + 1, F.length("text")), F.lit(_PIECES_END))
    marked = marked.withColumns(
        {
            "_item": F.when(F.col("leading") | F.col("begun"), F.struct("seq", item.alias("part"))),
            "_head": F.when(~F.col("begun") | F.col("array_from").isNotNull(), _head_text(True)),
        }
    )
    head = F.when(F.col("_head").isNotNull(), F.struct("seq", F.col("_head").alias("part")))
    parts = marked.groupBy(*_BLOCK, "leading", "begun", "entry", "item").agg(
        F.collect_list("_item").alias("_items"),
        F.collect_list(head).alias("_heads"),
        (F.max(F.col("item_from").isNotNull()) & F.max("item_end")).alias("whole"),
        F.max("_state.first").alias("first"),
        F.max(F.col("entry_from").isNotNull()).alias("_begins"),
        F.max("entry_end").alias("_ends"),
        F.max("_at").alias("last"),
        F.sum(F.col("entry_end").cast("int")).alias("entries"),
        F.sum(F.col("item_end").cast("int")).alias("items"),
        F.first("year").alias("year"),
    )
    # an entry that begins in the block is not in an array of one before it
    entry = Window.partitionBy(*_BLOCK, "entry")
    complete = F.max("_begins").over(entry) & F.max("_ends").over(entry)
    parts = parts.withColumn("complete", complete)
    # the few parts that hold any, and only of entries that lie here: each of an entry's many items is given them
    text = _text_of(F.flatten(F.collect_list(F.when(F.col("complete") & (F.size("_heads") > 0), F.col("_heads"))).over(entry)))
    parts = parts.withColumn("_entry", text)
    e = F.from_json("_entry", entry_schema(endpoint))
    told = {n: F.when(F.col("complete"), e[n].cast("int")) for n in ("season", "round")}
    parts = parts.withColumns(told).withColumns(
        {"text": F.when(F.size("_items") > 0, _text_of(F.col("_items"))), "head": F.when((F.size("_heads") > 0) & ~F.col("complete"), _text_of(F.col("_heads")))}
    )
    seq = F.coalesce(F.get(F.array_sort("_heads"), F.lit(0))["seq"], F.lit(0)).alias("seq")
    return stage(parts.select(*_PARTS, seq), "parts")


_PARTS = [*_BLOCK, "leading", "begun", "entry", "item", "whole", "first", "last", "entries", "items", "year", "complete", "season", "round", "text", "head"]


def _numbered(parts: DataFrame) -> DataFrame:
    """The parts with the numbers of their entry and item in the file, the array's first item, and what a leading part is of."""
    sizes = parts.groupBy(*_BLOCK).agg(F.sum("entries").alias("_entries"), F.sum("items").alias("_items"), F.max("last").alias("_last"))
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    counted = {n: F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in ("_entries", "_items")}
    state = F.when(F.col("_last").isNotNull(), F.struct(F.col("_last.open"), (F.col("_last.first") + F.col("_items")).alias("first")))
    sizes = sizes.withColumns(counted).withColumn("_last", state).withColumn("_open", F.last("_last", True).over(earlier))
    ahead = settle(sizes.select(*_BLOCK, "_entries", "_items", F.coalesce("_open.open", F.lit(False)).alias("_open"), F.col("_open.first").alias("_first")))
    numbered = parts.drop("last", "entries", "items").join(few(ahead), _BLOCK)
    return numbered.withColumns(
        {
            "entry": F.col("entry") + F.col("_entries"),
            "item": F.col("item") + F.col("_items"),
            "first": F.when(F.col("leading"), F.col("_first")).otherwise(F.col("first") + F.col("_items")),
            "begun": F.when(F.col("leading"), F.col("_open")).otherwise(F.col("begun")),
            "head": F.when(~(F.col("leading") & F.col("_open")), F.col("head")),
        }
    ).drop("_entries", "_items", "_open", "_first")


def split_items(
    spark: SparkSession, path: str, endpoint: str, start_year: int | None = None, split_bytes: int | None = None
) -> DataFrame:
    """``year``, ``_entry``, ``_item``, ``season``, ``round`` and the struct ``i`` of every item of the documents' entries.

    The same rows as from a whole read. Items and, without them, entries are put together from their pieces; a quoted
    text may hold brackets, quotes and names of arrays. Entries without items give no rows. Only what lies in several
    blocks moves once more.
    """
    key = ROUND_ENDPOINTS[endpoint]
    parts = _numbered(_parts(_located(read_pieces(spark, path, start_year, split_bytes), payload_path(endpoint).rsplit(".", 1)[-1], key), endpoint))
    own = ["year", "file", "entry", "first", "season", "round", "complete"]
    items = parts.filter("begun AND text IS NOT NULL")
    cut = _joined(items.filter("NOT whole"), ["file", "item"], "text", "text", *[F.first(c).alias(c) for c in own if c != "file"])
    items = items.filter("whole").select("item", "text", *own).unionByName(cut.select("item", "text", *own))

    heads = _joined(parts.filter("head IS NOT NULL AND NOT complete"), ["file", "entry"], "head", "whole")
    e = F.from_json("whole", entry_schema(endpoint))
    heads = settle(heads.select("file", "entry", e.alias("e")).select("file", "entry", *[F.col(f"e.{n}").cast("int").alias(n) for n in ("season", "round")]))
    apart = items.filter("NOT complete").drop("season", "round").join(few(heads), ["file", "entry"])
    return items.filter("complete").unionByName(apart).select(
        "year",
        F.col("entry").cast("int").alias("_entry"),
        (F.col("item") - F.col("first")).alias("_item"),
        "season",
        "round",
        F.from_json("text", ROUND_ITEMS[endpoint]).alias("i"),
    )


def write_documents(
    items: DataFrame, path: str, endpoint: str, year: str, head: Sequence[str], ordinal: str, payload: Column
) -> None:
    """One document for each ``year``, in a folder of its number, with the grand total of its items.

    ``head`` names the columns of an entry, in whose order entries come; ``payload`` is an item's struct and ``ordinal``
    its place in the entry, 1, 2, ... Missing fields are left out. A document is written line by line from sorted rows,
    so neither a year nor an entry is ever one value; a year is one file, as its readers expect.
    """
    table, entries = payload_path(endpoint).split(".")[1:]
    rows = items.select(year, *[h for h in head if h != year], F.col(ordinal).cast("bigint").alias("_n"), payload.alias("_i"))
    rows = stage(rows, "items")
    sizes = rows.groupBy(*{year: 0, **dict.fromkeys(head, 0)}).agg(F.count(F.lit(1)).alias("_size"))
    entry = F.struct(*[F.col(h) for h in head])
    years = sizes.groupBy(year).agg(F.sum("_size").cast("string").alias("_total"), F.min(entry).alias("_least"))
    years = settle(years)
    sizes = sizes.join(years.select(year, "_least"), year)
    text = F.to_json(F.struct(*[F.col(h).cast("string").alias(h) for h in head]))
    opened = F.concat(F.regexp_replace(text, r"\}\z", ""), F.lit(f',"{ROUND_ENDPOINTS[endpoint]}":['))
    top = F.concat(F.lit('{"MRData":{"total":"'), F.col("_total"), F.lit(f'","{table}":{{"{entries}":['))

    def lines(df: DataFrame, level: int, kind: int, line: Column) -> DataFrame:
        types = dict(rows.dtypes)
        keys = [F.col(h) if h in df.columns else F.lit(None).cast(types[h]).alias(h) for h in head if h != year]
        place = F.col("_n") if "_n" in df.columns else F.lit(0).cast("bigint").alias("_n")
        return df.select(year, F.lit(level).alias("_level"), *keys, F.lit(kind).alias("_kind"), place, line.alias("_line"))

    parts = [
        lines(years, 0, 0, top),
        lines(sizes, 1, 0, F.concat(F.when(entry == F.col("_least"), "").otherwise(","), opened)),
        lines(rows, 1, 1, F.concat(F.when(F.col("_n") == 1, "").otherwise(","), F.to_json("_i"))),
        lines(sizes, 1, 2, F.lit("]}")),
        lines(years, 2, 0, F.lit("]}}}")),
    ]
    order = [year, "_level", *[h for h in head if h != year], "_kind", "_n"]
    ordered = reduce(DataFrame.unionByName, parts).repartition(year).sortWithinPartitions(*order)
    ordered.select(F.col(year).alias("year"), "_line").write.partitionBy("year").text(path)


def write_entries(rows: DataFrame, path: str, endpoint: str, year: str, order: Sequence[str], entry: Column) -> None:
    """One document for each ``year`` whose top array holds ``entry`` of every row, by ``order`` (a total one)."""
    table, entries = payload_path(endpoint).split(".")[1:]
    place = F.struct(*order)
    lined = stage(rows.select(year, *[o for o in order if o != year], F.to_json(entry).alias("_e")), "entries")
    years = settle(lined.groupBy(year).agg(F.count(F.lit(1)).cast("string").alias("_total"), F.min(place).alias("_least")))
    top = F.concat(F.lit('{"MRData":{"total":"'), F.col("_total"), F.lit(f'","{table}":{{"{entries}":['))
    lined = lined.join(years, year).withColumn("_e", F.concat(F.when(place == F.col("_least"), "").otherwise(","), "_e"))
    parts = [
        years.select(year, F.lit(0).alias("_level"), F.lit(None).cast(lined.select(place.alias("p")).schema[0].dataType).alias("_at"), top.alias("_line")),
        lined.select(year, F.lit(1), place, "_e"),
        years.select(year, F.lit(2), F.lit(None).cast(lined.select(place.alias("p")).schema[0].dataType), F.lit("]}}}")),
    ]
    ordered = reduce(DataFrame.union, parts).repartition(year).sortWithinPartitions(year, "_level", "_at")
    ordered.select(F.col(year).alias("year"), "_line").write.partitionBy("year").text(path)
