import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapstack.operators.groups import (
    best_per_key,
    distinct_list,
    five_numbers,
    pivot_matrix,
    rank_with_gap,
    with_group_stats,
)
from lapstack.operators.scans import (
    bounded_scan,
    dense_ids,
    leading,
    ordered_scan,
    previous,
    profile_groups,
    row_number,
    running_sum,
)

from conftest import rows

SCANS = {"n": row_number(), "total": running_sum("v"), "before": previous("v"), "head": leading("v")}


def order():
    return [F.col("o").desc_nulls_last(), F.col("i").asc()]


def frame(spark, data):
    numbered = [(k, o, v, i) for i, (k, o, v) in enumerate(data)]
    return spark.createDataFrame(numbered, "k string, o int, v int, i int")


def skewed(n=400):
    """Half the rows share one key; ties and NULLs in every column."""
    dice = random.Random(7)
    return [
        (
            "hot" if dice.random() < 0.5 else dice.choice(["a", "b", None]),
            dice.choice([None, 1, 2, 3]),
            dice.choice([None, 5, -1, 8]),
        )
        for _ in range(n)
    ]


def test_chunked_equals_plain(spark, tiny_groups):
    df = frame(spark, skewed())
    assert profile_groups(df, ["k"]).hot_groups == 4
    assert rows(ordered_scan(df, ["k"], order(), SCANS)) == rows(bounded_scan(df, ["k"], order(), SCANS))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-9, 9))),
        min_size=5,
        max_size=30,
    )
)
def test_chunked_equals_plain_on_any_data(spark, tiny_groups, data):
    df = frame(spark, data)
    assert rows(ordered_scan(df, ["k"], order(), SCANS)) == rows(bounded_scan(df, ["k"], order(), SCANS))


def test_only_hot_groups_are_chunked(spark, tiny_groups):
    df = frame(spark, [("hot", i, i) for i in range(20)] + [("cold", 1, 1)])
    profile = profile_groups(df, ["k"])
    assert (profile.hot_groups, profile.hot_rows) == (1, 20)
    got = {(r["k"], r["i"]): r["n"] for r in ordered_scan(df, ["k"], order(), SCANS).collect()}
    assert got[("hot", 19)] == 1 and got[("hot", 0)] == 20 and got[("cold", 20)] == 1


def test_dense_ids_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(6)
    numbered = dense_ids(df, [F.col("x").desc()], "row", start=50)
    assert numbered.filter(F.col("row") != 50 + 1000 - F.col("x")).count() == 0
    assert numbered.count() == 1000


def test_copies_are_split_over_chunks(spark, tiny_groups):
    copies = spark.range(60).select(F.lit("k").alias("k"), F.lit(1).alias("o"), F.lit(2).alias("v"))
    scanned = ordered_scan(copies, ["k"], [F.col("o").asc()], SCANS)
    assert sorted((r["n"], r["total"]) for r in scanned.collect()) == [(i, 2 * i) for i in range(1, 61)]
    numbered = dense_ids(copies, [F.col("o").asc()], "row")
    assert sorted(r["row"] for r in numbered.collect()) == list(range(1, 61))
    assert numbered.columns == ["k", "o", "v", "row"]


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.range(0), [F.col("id").asc()], "row").count() == 0


def test_best_row_is_limited_before_the_shuffle(spark):
    df = frame(spark, skewed())
    plan = best_per_key(df, ["k"], order())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_group_stats_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5), (None, None)], "k string, v int")
    got = rows(with_group_stats(df, ["k"], {"top": F.max("v"), "n": F.count(F.lit(1))}))
    assert got == sorted([("a", 1, 3, 2), ("a", 3, 3, 2), (None, 5, 5, 2), (None, None, 5, 2)], key=repr)


@pytest.mark.parametrize("hot", [False, True])
def test_rank_with_gap_breaks_ties_by_id(spark, request, hot):
    if hot:
        request.getfixturevalue("tiny_groups")
    df = spark.createDataFrame([(1, 10), (2, 25), (3, 25), (4, 0), (5, None)], "id int, points int")
    ranked = rank_with_gap(
        df.withColumn("g", F.lit(1)), ["g"], [F.col("points").desc_nulls_last(), F.col("id").asc()], "points"
    )
    got = rows(ranked, "id", "championship_position", "points_behind_leader")
    assert got == [(1, 3, 15), (2, 1, 0), (3, 2, 0), (4, 4, 25), (5, 5, None)]


@pytest.mark.parametrize("hot", [False, True])
def test_five_numbers_interpolate(spark, request, hot):
    if hot:
        request.getfixturevalue("tiny_groups")
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4, 4, 10)] + [("b", 7), ("b", None)], "k string, v int")
    assert rows(five_numbers(df, ["k"], "v")) == [("a", 1.0, 2.25, 3.5, 4.0, 10.0), ("b", 7.0, 7.0, 7.0, 7.0, 7.0)]


def test_distinct_list_is_sorted(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "z")], "k int, v string")
    assert rows(distinct_list(df, ["k"], "v", "l")) == [(1, "a, b"), (2, "z")]


def test_pivot_has_a_column_per_listed_value(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 3), (1, 3, 9), (2, 2, 4)], "d int, r int, p int")
    assert rows(pivot_matrix(df, ["d"], "r", [1, 2, 3], "p", "r")) == [(1, 3, None, 9), (2, None, 4, None)]
