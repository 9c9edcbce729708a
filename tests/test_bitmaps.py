"""Lost keys by bitmaps against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from lapstack.operators.bitmaps import (
    Link,
    distinct_bitmaps,
    distinct_counts,
    lost_keys,
    merged_bitmaps,
    rows_with_lost_keys,
)

from conftest import rows


def frame(spark, values, name="k", kind="string"):
    return spark.createDataFrame([(None if v is None else str(v) if kind == "string" else v,) for v in values], f"{name} {kind}")


def by_hand(child, parent):
    known = {str(p) for p in parent if p is not None}
    lost = [str(c) for c in child if c is not None and str(c) not in known]
    return sorted((k, lost.count(k)) for k in set(lost))


CASES = {
    "dense": (range(0, 5000, 7), [*range(0, 5000, 14), 3, 3, 9, 4999, 5000, 10**15, -1, None]),
    "negative": (range(-40_000, 40_000, 3), [*range(-39_999, 39_000, 300), -32_768, -32_767, -1, 0, 1, 32_767, 32_768]),
    "sparse": ([k * 10**12 for k in range(60)], [k * 10**12 + (k % 9 == 0) for k in range(60)] * 2),
    "texts": (["a", "b", "7", "007", "1.0", ""], ["a", "c", "7", "07", "007", "1", "1.0", "", " 7", None]),
    "far": ([-(2**63), 2**63 - 1, 0], [0, 1, 2**63 - 1, -(2**63), 5]),
    "no parents": ([], [1, 2, 2]),
    "no children": ([1, 2], [None]),
    "whole": (range(100_000), range(99_999, -1, -3)),
}


@pytest.mark.parametrize("name", CASES)
def test_equals_plain_sets(spark, name):
    parent, child = CASES[name]
    got = lost_keys({"c": frame(spark, child)}, [Link("c", "k", frame(spark, parent, "id"), "id")])
    assert sorted((r.key, r.n) for r in got.collect()) == by_hand(child, parent)


def test_several_children_and_keys(spark):
    rng = random.Random(2)
    drivers = frame(spark, range(0, 1000, 2), "driver", "bigint")
    races = frame(spark, [f"{y}" for y in range(2000, 2030)], "race")
    made = {n: [(rng.randrange(1010), str(rng.randrange(1998, 2031))) for _ in range(300)] for n in ("a", "b")}
    children = {n: spark.createDataFrame(v, "driver bigint, race string") for n, v in made.items()}
    links = [Link("a", "driver", drivers, "driver"), Link("a", "race", races, "race"), Link("b", "driver", drivers, "driver")]
    got = {}
    for r in lost_keys(children, links).collect():
        got.setdefault((r.child, r.column), []).append((r.key, r.n))
    assert set(got) == {("a", "driver"), ("a", "race"), ("b", "driver")}
    for (n, c), found in got.items():
        values = [v[c == "race"] for v in made[n]]
        assert sorted(found) == by_hand(values, range(0, 1000, 2) if c == "driver" else range(2000, 2030))
    parents = {"driver": (drivers, "driver"), "race": (races, "race")}
    bad = rows(rows_with_lost_keys(children["a"], parents))
    assert bad == sorted((v for v in made["a"] if v[0] % 2 or v[0] >= 1000 or not 2000 <= int(v[1]) < 2030), key=repr)
    assert rows(rows_with_lost_keys(children["a"].filter("driver % 2 = 0 and driver < 1000"), {"driver": (drivers, "driver")})) == []


def test_null_keys(spark):
    child = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id int, k int")
    parent = {"k": (spark.createDataFrame([(5,)], "p int"), "p")}
    assert [r.id for r in rows_with_lost_keys(child, parent).collect()] == [3]
    assert sorted(r.id for r in rows_with_lost_keys(child, parent, null_is_lost=True).collect()) == [1, 3]
    assert lost_keys({"c": child.filter(F.lit(False))}, [Link("c", "k", *parent["k"])]).count() == 0


def test_distinct_counts_roll_up(spark):
    rng = random.Random(4)
    made = [(rng.randrange(4), rng.randrange(3), rng.choice([None, rng.randrange(-100_000, 100_000), 7]), rng.randrange(9)) for _ in range(400)]
    frame = spark.createDataFrame(made, "a int, b int, x bigint, y int")
    fine = distinct_bitmaps(frame, ["a", "b"], ["x", "y"])
    for bitmaps, keys in ((fine, ["a", "b"]), (merged_bitmaps(fine, ["a"]), ["a"]), (merged_bitmaps(fine, []), [])):
        got = {tuple(r[k] for k in keys): (r.x, r.y) for r in distinct_counts(bitmaps, keys, ["x", "y"]).collect()}
        at = ["ab".index(k) for k in keys]
        for key, counts in got.items():
            own = [m for m in made if tuple(m[i] for i in at) == key]
            assert counts == (len({m[2] for m in own} - {None}), len({m[3] for m in own}))
        assert set(got) == {tuple(m[i] for i in at) for m in made}
