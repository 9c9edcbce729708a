"""Vector code compression: product codes whose nearest entries are found by equal-average search.

A vector becomes integers, is cut into equal parts, and each part is coded by the nearest entry of its position's
codebook. Entries are sorted by the sum of their components. For a part of ``d`` components the squared distance to an
entry is at least (difference of the sums)^2 / d, so a search starts at the part's own sum and goes outward on both
sides, until that bound is strictly over the best distance: an entry that ties is still met, and the lower index wins.
All parts of a batch advance together in numpy; a round sends back one sum and count for each used codebook component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import free_name, with_value_by_key
from lapstack.session import stage

_FAR = np.int64((1 << 63) - 1)
_PARTIAL = "part int, entry int, place int, total bigint, n bigint"


@dataclass(frozen=True)
class Settings:
    parts: int = 8
    entries: int = 16  # of each part position, 256 at most: an index is two hex digits
    rounds: int = 6
    scale: int = 4096


@dataclass(frozen=True)
class Codebooks:
    """Entries as integers, ``values[part, entry, place]``; the entries of all parts are equally many."""

    values: np.ndarray
    scale: int

    def digest(self) -> str:
        """SHA-256 of the components in decimal by part, entry and place, with a comma between."""
        return hashlib.sha256(",".join(map(str, self.values.ravel().tolist())).encode()).hexdigest()


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and the squared distance to it for each row; a tie goes to the lower index."""
    n, d = vectors.shape
    order = np.lexsort((np.arange(len(entries)), entries.sum(1)))
    sums = entries.sum(1)[order]
    own = vectors.sum(1)
    right = np.searchsorted(sums, own)
    left = right - 1
    best, where = np.full(n, _FAR), np.full(n, len(entries))
    active = np.arange(n)
    while active.size:
        l, r, s = left[active], right[active], own[active]
        below = np.where(l >= 0, s - sums[np.maximum(l, 0)], _FAR)
        above = np.where(r < len(sums), sums[np.minimum(r, len(sums) - 1)] - s, _FAR)
        gap = np.minimum(below, above)
        got = best[active]
        # no entry left on either side, or the nearer one is too far by its sum
        more = (gap < _FAR) & ((got == _FAR) | (np.where(gap < _FAR, gap, 0) ** 2 <= np.where(got < _FAR, got, 0) * d))
        active, down = active[more], (below <= above)[more]
        at = np.where(down, left[active], right[active])
        left[active] -= down
        right[active] += ~down
        entry = order[at]
        far = ((vectors[active] - entries[entry]) ** 2).sum(1)
        better = (far < best[active]) | ((far == best[active]) & (entry < where[active]))
        best[active[better]], where[active[better]] = far[better], entry[better]
    return where, best


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros; a result that would leave a long is an error."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    limit = (1 << 30) // max(width, 1)
    if flat.size and max(int(flat.max()), -int(flat.min())) > limit:
        raise ValueError(f"a scaled component is over {limit}: its squared error would not fit a long")
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _integers(column: str, scale: int) -> Column:
    return F.transform(F.col(column), lambda x: F.floor(x.cast("double") * scale))


def usable(column: str) -> Column:
    """The vector is there and all its components are finite."""
    whole = F.forall(F.col(column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(column).isNotNull() & whole


def train(vectors: DataFrame, settings: Settings = Settings(), key: str = "vec_id", column: str = "embedding") -> Codebooks:
    """Codebooks from all rows with a usable vector: they start as the parts of the first rows by ``key``.

    Rows with equal keys come by their integers, rows without a key last. Vectors shorter than the longest count as
    filled up with zeros, and the length as rounded up to a multiple of the parts. With fewer rows than entries there
    are as many entries as rows; without rows there are none.
    """
    if not 1 <= settings.entries <= 256:
        raise ValueError("1 to 256 entries")
    kept = vectors.filter(usable(column))
    kept = stage(kept.select(F.col(key).alias("k"), _integers(column, settings.scale).alias("v")), "vectors")
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    parts, each = settings.parts, -(-longest // settings.parts)
    first = kept.orderBy(F.col("k").asc_nulls_last(), "v").limit(settings.entries).select("v").collect()
    start = _matrix(pa.array([r["v"] for r in first], pa.list_(pa.int64())), parts * each)
    books = start.reshape(len(first), parts, each).transpose(1, 0, 2).copy()
    if not len(first):
        return Codebooks(books, settings.scale)
    for _ in range(settings.rounds):
        sums = kept.select("v").mapInArrow(_sums(books), _PARTIAL).groupBy("part", "entry", "place")
        # as many rows as the codebooks have components
        for r in sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():
            books[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return Codebooks(books, settings.scale)


def _sums(books: np.ndarray):
    parts, entries, each = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), parts * each)
            for p in range(parts):
                own = rows[:, p * each : (p + 1) * each]
                at, _ = nearest(own, books[p])
                np.add.at(totals[p], at, own)
                counts[p] += np.bincount(at, minlength=entries)
        p, e, i = (x.ravel() for x in np.indices(books.shape))
        used = counts[p, e] > 0
        p, e, i = p[used], e[used], i[used]
        columns = [p.astype(np.int32), e.astype(np.int32), i.astype(np.int32), totals[p, e, i], counts[p, e]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["part", "entry", "place", "total", "n"])

    return run


def with_codes(vectors: DataFrame, books: Codebooks, column: str = "embedding") -> DataFrame:
    """The rows with a usable vector, with ``code`` (two hex digits a part) and ``error`` (sum of squared distances).

    Columns of these two names are replaced, others stay. Vectors must not be longer than those of the codebooks.
    """
    values = books.values
    parts, entries, each = values.shape
    kind = pa.struct([("code", pa.string()), ("error", pa.int64())])

    @F.arrow_udf("code string, error bigint")
    def coded(rows: pa.Array) -> pa.Array:
        found = _matrix(rows, parts * each)
        codes, error = np.zeros((len(found), parts), np.uint8), np.zeros(len(found), np.int64)
        for p in range(parts):
            codes[:, p], far = nearest(found[:, p * each : (p + 1) * each], values[p])
            error += far
        digits = codes.tobytes().hex()
        texts = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(error)], fields=list(kind))

    rows = vectors.filter(usable(column))
    made = coded(_integers(column, books.scale))
    if not entries:  # nothing was learnt, so there was no row
        made = F.lit(None).cast("struct<code:string,error:bigint>")
    name = free_name([*vectors.columns, "code", "error"], "made")
    return rows.withColumn(name, made).withColumns({"code": F.col(name)["code"], "error": F.col(name)["error"]}).drop(name)


def compress(vectors: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, Codebooks]:
    """``vec_id``, ``label``, ``code``, ``error`` and ``label_error`` of every usable vector, and the codebooks.

    ``label_error`` is the error of all rows with that label, rows without a label together. Repeated rows are coded
    and counted each. Other columns are left out; an empty table gives no rows. The coded rows are stored, and a
    label with many of them is joined by broadcast, so they never meet in one task.
    """
    books = train(vectors, settings)
    coded = stage(with_codes(vectors.select("vec_id", "label", "embedding"), books).drop("embedding"), "codes")
    text = F.col("label").cast("string")
    keyed = coded.withColumn("k", F.coalesce(F.concat(F.lit("="), text), F.lit("")))
    errors = keyed.groupBy("k").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    errors = stage(errors, "label-errors")
    joined = with_value_by_key(keyed, errors, "k", "n", coded.count())
    return joined.select("vec_id", "label", "code", "error", "label_error"), books


def codes_sql(settings: Settings = Settings()) -> str:
    """The same by all distances, one pair of steps for each round."""
    d = "list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))"
    steps = []
    for k in range(settings.rounds + 1):
        steps.append(
            f"a{k} AS MATERIALIZED (SELECT x.rn, x.p, any_value(x.v) AS v, min([{d}, b.e]) AS best"
            f" FROM cut x JOIN b{k} b USING (p) GROUP BY x.rn, x.p)"
        )
        if k < settings.rounds:
            steps.append(
                f"m{k} AS (SELECT p, best[2] AS e, i, sum(v[i]) AS s, count(*) AS n"
                f" FROM a{k}, LATERAL (SELECT unnest(range(1, len(v) + 1)) AS i) GROUP BY ALL),\n"
                f"n{k} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM m{k} GROUP BY p, e),\n"
                f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM b{k} b LEFT JOIN n{k} n USING (p, e))"
            )
    last, parts = settings.rounds, settings.parts
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {settings.scale})::BIGINT) AS v,
    row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rn
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT rn, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v FROM kept, range({parts}) r(p)),
b0 AS MATERIALIZED (SELECT p, rn - 1 AS e, v FROM cut WHERE rn <= {settings.entries}),
{("," + chr(10)).join(steps)},
books AS (SELECT sha256(string_agg(c, ',' ORDER BY p, e)) AS h
  FROM (SELECT p, e, array_to_string(v, ',') AS c FROM b{last})),
coded AS (SELECT rn, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
  FROM a{last} GROUP BY rn)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (rn), books
"""
