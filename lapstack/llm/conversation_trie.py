"""Conversation prefix trie, built by the recursion of van Emde Boas.

A sequence of up to 2^k turns is cut at half depth: the turns before the cut belong to an upper trie, those after it to
a lower forest whose trees hang below the prefixes that were cut. A level of the recursion holds the pieces of all
tries and forests of one height in one frame, each distinct piece once under its root, and cuts them all in parallel;
after the last cut a piece is one edge. Totals go back the other way: the total below a cut prefix is grafted onto its
root, height after height, and then handed down to every node between the two.

Names are digests of 16 bytes. A block is named by its two halves, a prefix by the prefix before its last aligned
block and that block, so that a depth read in binary gives one name to a prefix, whatever the height it was cut at.
No row holds a conversation: rows are turns, blocks, pieces and nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import bounded_batches, with_value_by_key
from lapstack.operators.scans import ordered_scan, row_number
from lapstack.session import stage

_EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_BLOCK, _PREFIX, _TURN = b"b", b"p", b"t"
_PIECE = ("root", "depth", "block", "size", "words", "end", "conv", "n")


def _named(tag: bytes, *parts: Column) -> Column:
    whole = F.concat(F.lit(tag), *parts)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def _root() -> Column:
    return F.lit(bytes(16))


def placed_turns(turns: DataFrame) -> DataFrame:
    """``conv``, ``at`` (from 0), ``token`` (a digest of role and text) and ``words`` of every turn, stored.

    Turns come by ``turn`` (NULL first), then role, then text; a NULL role or text is empty; repeated rows are repeated
    turns. Rows without a ``conv_id`` belong to no conversation and are left out, other columns as well. A conversation
    with a large share of all turns is ordered in chunks.
    """
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    number = ordered_scan(rows, ["conv"], order, {"place": row_number()})
    size = F.octet_length("role").cast("string").cast("binary")
    token = _named(_TURN, size, F.lit(b":"), F.col("role").cast("binary"), F.col("text").cast("binary"))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    return stage(number.select("conv", (F.col("place") - 1).alias("at"), token.alias("token"), words.alias("words")), "turns")


def lengths(placed: DataFrame) -> DataFrame:
    """``conv`` and ``n``, its number of turns."""
    return placed.groupBy("conv").agg((F.max("at") + 1).alias("n"))


def rebuilt(placed: DataFrame, period: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations that begin with the turns of another one.

    The first ``h`` turns of conversation ``conv - conv % period`` (all if fewer, none if absent) come before the own
    turns after the first ``h``; ``h`` is the CRC-32 of the decimal id modulo ``most``. A conversation may have no turn.
    The remainder of a negative id is negative, as in SQL.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    base = F.col("conv") - F.col("conv") % period
    # at most most - 1 turns of each conversation that others begin with
    heads = placed.filter((F.col("conv") % period == 0) & (F.col("at") < most - 1))
    heads = heads.groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("at", "token", "words"))).alias("heads")
    )
    whole = lengths(placed).withColumns({"h": h, "base": base}).join(heads, "base", "left")
    none = F.col("heads").isNull()
    whole = whole.withColumn("heads", F.when(none, F.array().cast(heads.schema["heads"].dataType)).otherwise(F.slice("heads", F.lit(1), F.col("h"))))
    whole = stage(whole.withColumn("k", F.size("heads").cast("bigint")).drop("base"), "whole")
    front = whole.select("conv", F.explode("heads").alias("x")).select("conv", "x.*")
    rear = placed.filter(F.col("at") >= h).join(whole.select("conv", "h", "k"), "conv")
    rear = rear.select("conv", (F.col("at") - F.col("h") + F.col("k")).alias("at"), "token", "words")
    sizes = whole.select("conv", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return stage(front.unionByName(rear), "rebuilt"), stage(sizes, "sizes")


def _blocks(turns: DataFrame, sizes: DataFrame, height: int) -> list[DataFrame]:
    """Aligned blocks of 2^k turns for every k, each level from the one below; the last block may be shorter.

    A conversation leaves off at the first level at which it is one block.
    """
    low = turns.join(sizes, "conv").select(
        "conv", "at", "n", F.col("token").alias("block"), F.lit(1).cast("bigint").alias("size"), "words"
    )
    levels = [stage(low, "blocks")]
    half = F.struct("block", "size", "words")
    even = F.col("at") % 2 == 0
    for k in range(1, height + 1):
        pairs = (
            levels[-1]
            .filter(F.col("n") > 1 << (k - 1))
            .groupBy("conv", F.shiftright("at", 1).alias("at"), "n")
            .agg(F.max(F.when(even, half)).alias("left"), F.max(F.when(~even, half)).alias("right"))
        )
        levels.append(
            stage(
                pairs.select(
                    "conv",
                    "at",
                    "n",
                    _named(_BLOCK, F.col("left.block"), F.coalesce("right.block", F.lit(b""))).alias("block"),
                    (F.col("left.size") + F.coalesce("right.size", F.lit(0))).alias("size"),
                    F.lit(0).cast("bigint").alias("words"),
                    "left",
                    "right",
                ),
                "blocks",
            )
        )
    return levels


def _pieces(blocks: list[DataFrame]) -> tuple[list[DataFrame], dict[int, DataFrame]]:
    """The distinct pieces of every height under their roots, and the cuts of the full ones.

    A piece has its ``root`` (a prefix of ``depth`` turns), the block below it, the ``end`` (the prefix that a full
    piece ends at), the number of conversations that go through it and the smallest of them. ``cuts[k]`` has the end of
    every full piece of height 2^k and the prefix ``cut`` at half depth.
    """
    height = len(blocks) - 1
    pieces: list[DataFrame] = [None] * (height + 1)
    cuts: dict[int, DataFrame] = {}
    passed: list[DataFrame] = []
    for k in range(height, -1, -1):
        whole = (F.col("at") == 0) & (F.col("n") <= 1 << k) & (F.col("n") > ((1 << k) >> 1))
        entering = blocks[k].filter(whole).select(
            _root().alias("root"),
            F.lit(0).cast("bigint").alias("depth"),
            "block",
            "size",
            "words",
            F.when(F.col("size") == 1 << k, _named(_PREFIX, _root(), F.col("block"))).alias("end"),
            "conv",
            F.lit(1).cast("bigint").alias("n"),
        )
        every = reduce(DataFrame.unionByName, [entering, *passed])
        pieces[k] = stage(
            every.groupBy("root", "block").agg(
                F.max("depth").alias("depth"),
                F.max("size").alias("size"),
                F.max("words").alias("words"),
                F.max("end").alias("end"),
                F.min("conv").alias("conv"),
                F.sum("n").alias("n"),
            ),
            "pieces",
        )
        if not k:
            break
        # a block is looked up once under each root, so only equal blocks below different roots share a key
        halves = blocks[k].groupBy("block").agg(F.max("left").alias("left"), F.max("right").alias("right"))
        cut = stage(
            pieces[k].drop("size", "words").join(halves, "block").withColumn("cut", _named(_PREFIX, F.col("root"), F.col("left.block"))),
            "cuts",
        )
        middle = 1 << (k - 1)
        upper = cut.select("root", "depth", "left.*", F.when(F.col("left.size") == middle, F.col("cut")).alias("end"), "conv", "n")
        lower = cut.filter("right IS NOT NULL").select(
            F.col("cut").alias("root"), (F.col("depth") + middle).alias("depth"), "right.*", "end", "conv", "n"
        )
        passed = [upper.select(*_PIECE), lower.select(*_PIECE)]
        cuts[k] = cut.filter("end IS NOT NULL").select("end", "cut")
    return pieces, cuts


def _grafted(pieces: list[DataFrame], cuts: dict[int, DataFrame], own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``end``, leaves, saved): what lies below each node; and the one row of totals below the root.

    ``own`` has ``root`` (the parent), leaves and saved of every node.
    """
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    totals = [stage(own.groupBy("root").agg(*sums), "totals")]
    height = len(pieces) - 1
    for k in range(height):
        # trees of height 2^k whose root was cut go to the root of the piece that ends there
        upper = pieces[k].filter(F.col("end").isNotNull() & (F.shiftright("depth", k) % 2 == 0))
        roots = upper.select(F.col("end").alias("root"), F.col("root").alias("above"))
        joined = totals[k].join(roots, "root", "left").select(F.coalesce("above", "root").alias("root"), "leaves", "saved")
        totals.append(stage(joined.groupBy("root").agg(*sums), "totals"))
    below = None
    for k in range(height - 1, -1, -1):
        upper = pieces[k].filter(F.col("end").isNotNull() & (F.shiftright("depth", k) % 2 == 0))
        grafts = totals[k].join(upper.select(F.col("end").alias("root")), "root").withColumnRenamed("root", "end")
        if below is not None:
            # what lies below the end of a piece lies below all its nodes: both halves get it
            first = below.join(cuts[k + 1], "end").select(F.col("cut").alias("end"), "leaves", "saved")
            grafts = grafts.unionByName(below).unionByName(first)
        below = stage(grafts.groupBy("end").agg(*sums), "below")
    return below, totals[height]


def _last_nodes(blocks: list[DataFrame], sizes: DataFrame) -> DataFrame:
    """``conv`` and the node it ends at: the blocks that its length has in binary, named one after the other."""
    parts = [
        b.filter((F.shiftright("n", k) % 2 == 1) & (F.col("at") == F.shiftleft(F.shiftright("n", k + 1), 1))).select(
            "conv", F.lit(k).alias("k"), "block"
        )
        for k, b in enumerate(blocks)
    ]
    gathered = reduce(DataFrame.unionByName, parts).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("k", "block")), asc=False).alias("parts")  # one for each bit of a length
    )
    node = F.aggregate("parts", _root(), lambda name, part: _named(_PREFIX, name, part["block"]))
    turnless = sizes.filter("n = 0").select("conv", _root().alias("node"))
    return stage(gathered.select("conv", node.alias("node")).unionByName(turnless), "ends")


def _id_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        grouped = rows.groupby("node", sort=False)["conv"]
        made = [(node, ids.iloc[0], ",".join(map(str, ids.tolist()))) for node, ids in grouped]
        yield pd.DataFrame(made, columns=["node", "first", "ids"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    current, state = None, None
    for rows in batches:
        done = []
        for node, ids in zip(rows["node"], rows["ids"]):
            if node == current:
                state.update(b",")
            else:
                if state is not None:
                    done.append((current, state.hexdigest()))
                current, state = node, hashlib.sha256()
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=["node", "ends_sha256"])
    if state is not None:
        yield pd.DataFrame([(current, state.hexdigest())], columns=["node", "ends_sha256"])


def member_digests(ends: DataFrame) -> DataFrame:
    """``node``, ``ends_sha256``: the ids (``conv``) of a node in numeric order with commas between, digested.

    Ids are sorted and written out by range, so a node with very many takes many tasks; what one task reads of a node,
    batch by batch, is a text for each few hundred ids.
    """
    bounded_batches(ends.sparkSession)
    texts = (
        ends.repartitionByRange("node", "conv")
        .sortWithinPartitions("node", "conv")
        .select("node", "conv")
        .mapInPandas(_id_texts, "node binary, first bigint, ids string")
    )
    return (
        texts.repartition("node")
        .sortWithinPartitions("node", "first")
        .mapInPandas(_digests, "node binary, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations, the root (no turn) included.

    ``turns`` has ``conv``, ``at`` (0 to n - 1), ``token`` and ``words``; ``sizes`` has ``conv`` and ``n``, also for
    conversations without a turn; both stored. ``conv_id`` is the smallest member, ``parent_conv_id`` that of the
    parent (NULL for the root), ``n_leaves`` and ``saved_tokens`` cover the subtree with its top, ``ends_sha256`` the
    ids of the conversations that end at the node. Without conversations there are no rows.
    """
    known = sizes.agg(F.count(F.lit(1)).alias("n"), F.max("n").alias("longest"), F.min("conv").alias("conv")).first()
    height = max((known["longest"] or 1) - 1, 0).bit_length()
    blocks = _blocks(turns, sizes, height)
    pieces, cuts = _pieces(blocks)
    children = pieces[0].groupBy("root").agg(F.count(F.lit(1)).alias("n_children"))
    nodes = pieces[0].join(children.withColumnRenamed("root", "end"), "end", "left").select(
        "end", "root", "conv", "n", (F.col("depth") + 1).alias("depth"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("bigint").alias("leaves"),
        ((F.col("n") - 1) * F.col("words")).alias("saved"),
    )
    nodes = stage(nodes, "nodes")
    below, whole = _grafted(pieces, cuts, nodes)
    if below is not None:
        more = below.select("end", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        nodes = nodes.join(more, "end", "left").withColumns(
            {
                "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)),
                "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
            }
        )
    root = sizes.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).filter("n > 0")
    top = pieces[0].filter(F.col("root") == _root()).agg(F.count(F.lit(1)).alias("n_children"))
    root = root.crossJoin(top).join(whole.filter(F.col("root") == _root()).select("leaves", "saved"), F.lit(True), "left")
    root = root.select(
        _root().alias("end"), F.lit(None).cast("binary").alias("root"), "conv", "n",
        F.lit(0).cast("bigint").alias("depth"), "n_children",
        F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
    )
    digests = member_digests(_last_nodes(blocks, sizes)).withColumnRenamed("node", "end")
    made = nodes.select(*root.columns).unionByName(root).join(digests, "end", "left")
    made = stage(made.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY_SHA256))), "trie")
    parents = made.filter("n_children > 0").select(F.col("end").alias("root"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("_n"))
    total = made.count()
    linked = with_value_by_key(made, parents, "root", "_n", total)
    return linked.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


_CRC32 = """list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda s, b:
    list_reduce(range(8), lambda r, i: xor(r >> 1, (r & 1) * 3988292384), xor(s, b)), 4294967295::BIGINT)"""

TRIE_SQL = rf"""
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor({_CRC32}, 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)),
made AS (
  SELECT ids.conv_id, 0 AS part, i, role, text FROM ids JOIN placed ON placed.conv_id = base AND i <= h
  UNION ALL
  SELECT ids.conv_id, 1, i, role, text FROM ids JOIN placed ON placed.conv_id = ids.conv_id AND i > h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d FROM made),
lists AS (SELECT conv_id, list([role, text] ORDER BY d) AS turns FROM numbered GROUP BY conv_id),
every AS (SELECT ids.conv_id, coalesce(turns, []::VARCHAR[][]) AS turns FROM ids LEFT JOIN lists USING (conv_id)),
prefixes AS (
  SELECT conv_id, d, sha256(to_json(turns[1:d])::VARCHAR) AS node, d = len(turns) AS ended,
    CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d][2], '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM every, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)),
nodes AS (
  SELECT node, min(conv_id) AS conv, any_value(d) AS d, count(*) AS n, (count(*) - 1) * any_value(words) AS saved,
    string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ended) AS ended
  FROM prefixes GROUP BY node),
parents AS (
  SELECT n.node, p.node AS parent FROM nodes n JOIN prefixes p ON p.conv_id = n.conv AND p.d = n.d - 1),
children AS (SELECT parent AS node, count(*) AS n FROM parents GROUP BY parent),
below AS (
  SELECT a.node, sum(n.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM nodes n JOIN prefixes a ON a.conv_id = n.conv AND a.d <= n.d LEFT JOIN children c ON c.node = n.node
  GROUP BY a.node)
SELECT n.conv AS conv_id, n.d AS depth, up.conv AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children,
  b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ended, '')) AS ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN children c USING (node) LEFT JOIN parents p USING (node)
  LEFT JOIN nodes up ON up.node = p.parent
"""
