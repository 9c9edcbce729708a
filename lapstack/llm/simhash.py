"""SimHash near-duplicates: a binary trie self-join under a budget of differing bits.

Two fingerprints within ``max_bits`` of each other, cut into ``max_bits + k`` blocks, agree on at least ``k`` of
them. Every choice of ``k`` blocks gives one trie whose upper levels hold those blocks: below them only equal nodes
are paired (no error is spent), so the sub-tries are independent and Spark deals them out by node. Inside a sub-trie
node pairs are walked together, the bits that differ add up, and a pair over the budget, or whose leaves are linked
already, is pruned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import bits_of, bounded_batches, connected_components, free_name, text_of, with_value_by_key
from lapstack.session import stage

BITS = 64
SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SLICE = 100_000  # shingles whose bits are unpacked at once
_PAIRS = 1_000_000  # leaf pairs compared at once
_LEAF = 1024  # node pairs of at most so many leaf pairs are compared directly
_NODE_TARGET = 1024  # fingerprints an independent sub-trie should hold
_NODE_LIMIT = 50_000  # above this a sub-trie is cut by further blocks


def fingerprint(text: str, shingle: int = 4) -> int:
    """The 64-bit SimHash of the word shingles of a text (unsigned); zero without words."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(flat, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, _SLICE):
        spans = zip(starts[at : at + _SLICE], ends[at : at + _SLICE])
        hashes = np.array([digest(flat[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint_column(column: Column, shingle: int = 4) -> Column:
    @F.pandas_udf("bigint")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = np.array([fingerprint(t, shingle) for t in batch], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return prints(column)


def _tables(width: int, budget: int, exact: int) -> list[tuple[list[tuple[int, int]], list[tuple[int, int]]]]:
    """For each choice of ``exact`` of ``budget + exact`` blocks: (shift, width) of those blocks and of the others."""
    blocks = budget + exact
    cuts = [width * i // blocks for i in range(blocks + 1)]
    spans = [(width - b, b - a) for a, b in zip(cuts, cuts[1:])]
    return [
        ([spans[i] for i in chosen], [spans[i] for i in range(blocks) if i not in chosen])
        for chosen in combinations(range(blocks), exact)
    ]


def _pieces(value: Column, spans: list[tuple[int, int]]) -> Column:
    return bits_of([(F.shiftrightunsigned(value, s).bitwiseAND(F.lit((1 << w) - 1)), w) for s, w in spans])


def _into_tries(rows: DataFrame, width: int, budget: int, exact: int) -> tuple[DataFrame, int]:
    """A row per trie: ``node`` (a hash of the path so far and the blocks that must be equal) and the bits left."""
    tables = _tables(width, budget, exact)
    choices = F.array(
        *[
            F.struct(F.lit(i).alias("trie"), _pieces(F.col("rest"), own).alias("top"), _pieces(F.col("rest"), others).alias("low"))
            for i, (own, others) in enumerate(tables)
        ]
    )
    left = max(sum(w for _, w in others) for _, others in tables)
    out = rows.withColumn("t", F.explode(choices))
    return out.select(F.xxhash64("node", "t.trie", "t.top").alias("node"), F.col("t.low").alias("rest"), "fp"), left


def _exact_blocks(n: int, width: int, budget: int) -> int:
    """The fewest equal blocks under which evenly spread fingerprints make sub-tries of the target size."""
    exact = 1
    while exact < 4 and n / 2 ** (width * exact / (budget + exact)) > _NODE_TARGET:
        exact += 1
    return exact


def _joined(comp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The labels (smallest position of the component) after linking positions a and b."""
    while True:
        x, y = comp[a], comp[b]
        apart = x != y
        if not apart.any():
            return comp
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        parent = np.arange(len(comp))
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        comp = parent[comp]


def _leaf_pairs(al, ah, bl, bh):
    """All (i, j) with i of the first and j of the second range; i < j where both are the same range."""
    wide = bh - bl
    count = (ah - al) * wide
    owner = np.repeat(np.arange(len(al)), count)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    i, j = al[owner] + at // wide[owner], bl[owner] + at % wide[owner]
    keep = (al[owner] != bl[owner]) | (i < j)
    return i[keep], j[keep]


def trie_components(starts: np.ndarray, rest: np.ndarray, fp: np.ndarray, width: int, budget: int) -> np.ndarray:
    """Labels of the fingerprints linked inside each sub-trie; ``rest`` is sorted within every group from ``starts``."""
    n = len(rest)
    comp, ends = np.arange(n), np.append(starts[1:], n)
    group = np.repeat(np.arange(len(starts)), ends - starts)
    following = np.flatnonzero((group[1:] == group[:-1]) & (np.bitwise_count(fp[1:] ^ fp[:-1]) <= budget))
    comp = _joined(comp, following, following + 1)
    zero = np.zeros(len(starts), np.int64)
    stack = [(starts, ends, starts, ends, zero, 0)]
    while stack:
        al, ah, bl, bh, used, depth = stack.pop()
        steps = np.concatenate([[0], np.cumsum(comp[1:] != comp[:-1])])
        linked = (steps[ah - 1] == steps[al]) & (steps[bh - 1] == steps[bl]) & (comp[al] == comp[bl])
        go = ~linked & ((al != bl) | (ah - al > 1))
        al, ah, bl, bh, used = al[go], ah[go], bl[go], bh[go], used[go]
        if not len(al):
            continue
        size = (ah - al) * (bh - bl)
        if len(al) > 1 and size.sum() > _PAIRS:
            # in halves, so that the links of the first prune the second
            half = max(1, min(len(al) - 1, int(np.searchsorted(np.cumsum(size), size.sum() / 2))))
            for part in (slice(half, None), slice(0, half)):
                stack.append((al[part], ah[part], bl[part], bh[part], used[part], depth))
            continue
        leaf = (size <= _LEAF) | (depth >= width)
        if leaf.any():
            i, j = _leaf_pairs(al[leaf], ah[leaf], bl[leaf], bh[leaf])
            near = np.bitwise_count(fp[i] ^ fp[j]) <= budget
            comp = _joined(comp, i[near], j[near])
        if leaf.all():
            continue
        al, ah, bl, bh, used = (x[~leaf] for x in (al, ah, bl, bh, used))
        bit = np.uint64(1) << np.uint64(width - 1 - depth)
        am, bm = _first_with(rest, al, ah, bit), _first_with(rest, bl, bh, bit)
        same = (al == bl) & (ah == bh)
        pairs = [
            (al, am, bl, bm, used, np.ones(len(al), bool)),
            (am, ah, bm, bh, used, np.ones(len(al), bool)),
            (al, am, bm, bh, used + 1, np.ones(len(al), bool)),
            (am, ah, bl, bm, used + 1, ~same),
        ]
        cols = [np.concatenate([p[k][(p[1] > p[0]) & (p[3] > p[2]) & (p[4] <= budget) & p[5]] for p in pairs]) for k in range(5)]
        if len(cols[0]):
            stack.append((*cols, depth + 1))
    return comp


def _first_with(rest: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """In each range, whose higher bits are equal, the first position that has the bit: a binary search of all at once."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        has = (rest[np.minimum(mid, len(rest) - 1)] & bit) != 0
        hi = np.where(open_ & has, mid, hi)
        lo = np.where(open_ & ~has, mid + 1, lo)


def _linked_batches(width: int, budget: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            cut = np.flatnonzero(np.diff(held["node"].to_numpy())) + 1
            if len(cut) and len(held) >= 5000:
                yield links_of(held.iloc[: cut[-1]])
                held = held.iloc[cut[-1] :]
        if held is not None and len(held):
            yield links_of(held)

    def links_of(rows: pd.DataFrame) -> pd.DataFrame:
        node = rows["node"].to_numpy()
        rest, fp = (rows[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("rest", "fp"))
        starts = np.append(0, np.flatnonzero(np.diff(node)) + 1)
        comp = trie_components(starts, rest, fp, width, budget)
        other = np.flatnonzero(comp != np.arange(len(comp)))
        signed = fp.view(np.int64)
        return pd.DataFrame({"a": signed[other], "b": signed[comp[other]]})

    return run


def near_links(prints: DataFrame, budget: int = 4) -> DataFrame:
    """A spanning set of links ``a``, ``b`` between distinct fingerprints ``fp`` at most ``budget`` bits apart.

    Links are found inside every sub-trie; a sub-trie with more than ``_NODE_LIMIT`` fingerprints is cut by blocks of
    its remaining bits, so that no task holds an unbounded one. Within a sub-trie links that only repeat a known
    connection are not returned: the components are those of all pairs.
    """
    spark = prints.sparkSession
    n = prints.count()
    rows, width = prints.select(F.lit(0).cast("bigint").alias("node"), F.col("fp").alias("rest"), "fp"), BITS
    exact, found = _exact_blocks(n, width, budget), []
    while True:
        rows, width = _into_tries(rows, width, budget, exact)
        if n > _NODE_LIMIT:
            rows = stage(rows, "tries")
            crowded = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > _NODE_LIMIT)
            # at most rows / limit nodes; a shuffle join, split by adaptive execution, where they are many
            crowded = stage(crowded.select("node"), "crowded")
            hot = crowded.count() if width > 2 * budget else 0
        else:
            hot = 0
        part = rows if not hot else rows.join(crowded, "node", "left_anti")
        dealt = part.repartition("node").sortWithinPartitions("node", "rest")
        found.append(dealt.mapInPandas(_linked_batches(width, budget), "a bigint, b bigint"))
        if not hot:
            break
        rows, exact = rows.join(crowded, "node", "left_semi"), 1
    spark_links = found[0]
    for more in found[1:]:
        spark_links = spark_links.union(more)
    return spark_links


def _rows_with_class(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """``doc_id``, ``fp``, ``root`` (one fingerprint of the class, the same for all of it) and ``component_id`` of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    prints = stage(docs.select("doc_id", fingerprint_column(text_of(), shingle).alias("fp")), "simhash")
    total = prints.count()
    classes = stage(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low")), "classes")
    roots = connected_components(near_links(classes.select("fp"), max_bits), "simhash-links")
    rooted = stage(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")),
        "rooted",
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    # only classes that are not a lone document have to be looked up
    several = (F.col("n") > 1) | (F.col("root") != F.col("fp")) | ~F.col("component_id").eqNullSafe(F.col("low"))
    lookup = stage(rooted.join(lowest, "root").filter(several).select("fp", "n", "root", "component_id"), "lookup")
    found = with_value_by_key(prints, lookup, "fp", "n", max(total, 1))
    return found.select(
        "doc_id",
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def simhash_classes(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document row.

    Components join documents whose fingerprints differ in at most ``max_bits`` bits, directly or through others;
    the id is the smallest ``doc_id`` reachable. Equal fingerprints are one node, however many documents have them.
    NULL texts count as empty; texts without words share the fingerprint zero; repeated rows stay, each with the same
    class; rows with a NULL ``doc_id`` take part but never name a class (a class of such rows alone has NULL). An
    empty table gives an empty result. Other columns are not read.
    """
    rows = _rows_with_class(docs, shingle, max_bits)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_class(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The document with the smallest ``doc_id`` of every class, with all its columns.

    Rows that share that ``doc_id`` count as copies within a class; one of them stays. Rows of one ``doc_id`` in several
    classes are judged in each of them. Classes without any ``doc_id`` stay whole; a row without one goes where its
    class has a document with one.
    """
    times, print_, root = (free_name(docs.columns, n) for n in ("times", "print", "class"))
    rows = _rows_with_class(docs, shingle, max_bits)
    naming = rows.filter("component_id = doc_id")
    ids = rows.filter("doc_id IS NOT NULL").groupBy("doc_id")
    stays = ids.agg(F.count(F.lit(1)).alias(times), F.max(F.col("component_id") == F.col("doc_id")).alias("names"))
    stays = stage(stays.filter("names").select("doc_id", times), "stays")
    # as many ids as documents stay, so they are shuffled at every size
    kept = docs.join(stays.hint("merge"), "doc_id", "inner").select(*docs.columns, times)
    out = kept.filter(F.col(times) == 1).drop(times)
    prints = fingerprint_column(text_of(), shingle)
    again = stays.filter(F.col(times) > 1)
    if not again.isEmpty():
        named = naming.join(again, "doc_id", "left_semi").select("doc_id", F.col("fp").alias(print_), F.col("root").alias(root))
        repeated = kept.filter(F.col(times) > 1).withColumn(print_, prints).join(stage(named.distinct(), "named"), ["doc_id", print_])
        out = out.unionByName(repeated.dropDuplicates(["doc_id", root]).select(*docs.columns))
    without = docs.filter("doc_id IS NULL")
    if not without.isEmpty():
        bare = stage(rows.filter("doc_id IS NULL AND component_id IS NULL").select(F.col("fp").alias(print_)).distinct(), "bare")
        out = out.unionByName(without.withColumn(print_, prints).join(bare, print_, "left_semi").select(*docs.columns))
    return out
