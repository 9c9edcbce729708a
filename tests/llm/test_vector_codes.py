from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from lapstack.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def by_hand(rows, parts=8, entries=16, rounds=6):
    """Plain loops over all distances, in Python integers."""
    kept = [
        (i, [math.floor(4096 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    width = -(-max(len(r[1]) for r in kept) // parts) * parts
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    each = width // parts
    cut = [[v[p * each : (p + 1) * each] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assigned():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            for c in cut
        ]

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    found = assigned()
    errors = [sum(d for d, _ in f) for f in found]
    label_errors = {}
    for (_, _, label), e in zip(kept, errors):
        label_errors[label] = label_errors.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [
        (i, "".join(f"{k:02x}" for _, k in f), e, label_errors[label])
        for (i, _, label), f, e in zip(kept, found, errors)
    ]
    return sorted(out, key=repr), digest


def run(spark, rows, schema=SCHEMA):
    coded, books = vc.compress(spark.createDataFrame(rows, schema))
    got = [(r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()]
    return sorted(got, key=repr), books.digest()


def test_nearest_equals_all_distances():
    rng = np.random.default_rng(1)
    for d in (1, 3, 8):
        for scale in (2, 50, 4000):
            entries = rng.integers(-scale, scale + 1, (16, d))
            entries[5] = entries[2]  # a tie goes to the lower index
            rows = np.concatenate([rng.integers(-2 * scale, 2 * scale + 1, (400, d)), entries])
            far = ((rows[:, None] - entries[None]) ** 2).sum(2)
            where, best = vc.nearest(rows, entries)
            assert (where == far.argmin(1)).all() and (best == far.min(1)).all()


def test_bound_stops_only_when_strictly_over():
    # own sum 0; entry 1 at distance 2 with sum gap 2: 2 * 2 / 2 == 2 is not over, and entry 0 ties with it
    entries = np.array([[1, 1], [-1, -1], [5, -5]])
    where, best = vc.nearest(np.array([[0, 0]]), entries)
    assert (where[0], best[0]) == (0, 2)
    where, best = vc.nearest(np.array([[0, 0]]), entries[[1, 0, 2]])
    assert (where[0], best[0]) == (0, 2)


def test_codes_equal_plain_loops(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16)], int(i % 3) if i % 5 else None) for i in range(120)]
    same = [0.25] * 16
    rows += [(1000 + i, same, 1) for i in range(60)] + [(7, same, 2), (7, same, 2), (None, [0.5] * 16, None)]
    rows += [(500, None, 1), (501, [0.1] * 15 + [None], 1), (502, [0.1] * 15 + [float("nan")], None)]
    rows += [(503, [float("inf")] + [0.1] * 15, 2), (-4, [-0.0001] * 16, 0)]
    assert run(spark, rows) == by_hand(rows)


def test_short_and_few_vectors(spark):
    rows = [(1, [0.5, -0.25, 1.0], 0), (2, [0.1] * 10, 0), (3, [], None), (3, [0.1] * 10, 4)]
    assert run(spark, rows) == by_hand(rows)
    assert run(spark, [(1, [], 1)])[0] == [(1, "00" * 8, 0, 0)]


def test_empty_tables(spark):
    assert run(spark, [])[0] == []
    assert run(spark, [(1, None, 0), (2, [None], 0)])[0] == []
    empty = vc.with_codes(spark.createDataFrame([], SCHEMA), vc.train(spark.createDataFrame([], SCHEMA)))
    assert empty.columns == ["vec_id", "embedding", "label", "code", "error"] and empty.count() == 0


def test_other_columns_stay_and_clashing_ones_are_replaced(spark):
    rows = [(i, [float(i)] * 8, 0, "x", -1, "m") for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA + ", code string, error int, _made string")
    got = vc.with_codes(df, vc.train(df))
    assert sorted(got.columns) == sorted(df.columns)
    assert {(r._made, r.code, r.error) for r in got.collect()} == {("m", f"{i:02x}" * 8, 0) for i in range(5)}
    assert vc.compress(df)[0].columns == ["vec_id", "label", "code", "error", "label_error"]


def test_components_beyond_a_long_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        vc.train(spark.createDataFrame([(1, [3e30] * 8, 0)], SCHEMA))
