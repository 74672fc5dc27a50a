from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiweave.operators import expectations as X
from kpiweave.operators.distinct import conditional_distinct, daily_distinct
from kpiweave.operators.funnel import step_rows
from kpiweave.operators.hotkeys import join_key_stats
from kpiweave.operators.percentile import exact_percentiles
from kpiweave.operators.zscore import series_stats, zscore

START = dt.date(2024, 1, 1)


def brute_rolling(rows, length):
    days = sorted({d for _, d in rows})
    span = dt.timedelta(days=length - 1)
    return {d: len({u for u, x in rows if d - span <= x <= d}) for d in days}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rolling_distinct_equals_range_join(spark, seed):
    rng = random.Random(seed)
    # Gaps between days, repeated rows, one user on nearly every day.
    rows = [("hot", START + dt.timedelta(days=d)) for d in range(60) if d % 11]
    rows += [
        (f"u{rng.randrange(25)}", START + dt.timedelta(days=rng.choice([0, 1, 2, 9, 20, 44, 58])))
        for _ in range(120)
    ]
    rows += rows[:40]
    df = spark.createDataFrame([*rows, (None, START)], "u string, d date")
    got = daily_distinct(df, "u", "d", "n", {"is_hot": F.col("u") == "hot"}, {"w7": 7, "w30": 30})
    result = {r["d"]: r for r in got.collect()}
    seven, thirty, one = brute_rolling(rows, 7), brute_rolling(rows, 30), brute_rolling(rows, 1)
    assert set(result) == set(one)
    for day, row in result.items():
        assert (row["n"], row["w7"], row["w30"]) == (one[day], seven[day], thirty[day])
        assert row["is_hot"] == int(("hot", day) in rows)


def test_conditional_distinct_skips_null_entity(spark):
    rows = [("a", "x", 1), ("a", "x", 5), ("a", "y", 1), ("a", None, 9), ("b", None, 9)]
    df = spark.createDataFrame(rows, "k string, u string, v int")
    got = conditional_distinct(
        df, ["k"], "u", "users", {"big": F.col("v") > 4}, {"n": ("sum", F.count("*"))}
    )
    assert {tuple(r) for r in got.collect()} == {("a", 2, 1, 4), ("b", 0, 0, 1)}


@pytest.mark.parametrize("width", [1, 7, 1000, 10**9])
def test_percentiles_equal_a_full_sort(spark, width):
    rng = np.random.default_rng(width)
    groups = {
        "skewed": np.concatenate([np.full(300, 42), rng.integers(-500, 5000, 301)]),
        "two": np.array([10, 20]),
        "one": np.array([-3]),
        None: np.array([1, 2, 1000000]),
    }
    rows = [(k, int(v)) for k, values in groups.items() for v in values] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, v bigint")
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", probs, width).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert got[key]["n"] == len(values)
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(values, p), abs=1e-6)


@pytest.mark.parametrize("share", [1e-9, 0.05, 0.5])
def test_hot_key_join_is_an_inner_join(spark, share):
    rows = [("hot", i) for i in range(400)] + [(f"u{i % 90}", i) for i in range(600)]
    facts = spark.createDataFrame([*rows, (None, 1)], "k string, v int")
    stats = (
        facts.where(F.col("k").isNotNull()).groupBy("k").agg(F.count("*").alias("n"), F.max("v"))
    )
    got = join_key_stats(facts, stats, "k", "n", share)
    want = facts.join(stats, "k")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    some = join_key_stats(facts, stats, "k", "n", share, where=lambda s: F.col("v") * 2 > s["n"])
    kept = want.where("v * 2 > n")
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, kept.collect()))


def test_step_rows_without_starters(spark):
    totals = spark.createDataFrame([(0, 3)], "a bigint, b bigint")
    names = ("label", "step", "users", "from_start", "from_prev")
    rows = step_rows(totals, ["A", "B"], ["a", "b"], names, 1).collect()
    assert [tuple(r) for r in rows] == [("A", 1, 0, 100.0, 100.0), ("B", 2, 3, None, None)]


def test_zscore_of_flat_or_single_series_is_null(spark):
    flat = spark.createDataFrame([(1, 5.0), (2, 5.0)], "d int, x double")
    assert [r[0] for r in series_stats(flat, ["x"]).select(zscore("x")).collect()] == [None, None]
    single = flat.limit(1)
    assert [r[0] for r in series_stats(single, ["x"]).select(zscore("x")).collect()] == [None]


def test_expectations(spark):
    rows = [(1, "a", 5), (2, "b", 0), (2, "zz", 7), (None, None, None)]
    df = spark.createDataFrame(rows, "id int, name string, x int")
    results = X.evaluate(
        df,
        [
            X.row_count_between(1, 3),
            X.not_null("id", mostly=0.7),
            X.unique("id"),
            X.in_set("name", ["a", "b"]),
            X.match_regex("name", "^.$"),
            X.between("x", 1, 7),
            X.pair_greater("x", "id"),
            X.pair_greater("x", "id", or_equal=True),
            X.unique_proportion_between("id", 0.1, 0.5),
        ],
    )
    got = [(r["expectation"], r["success"], r["observed"]) for r in results.collect()]
    assert got == [
        ("row_count_between", False, 4.0),
        ("not_null", True, 0.75),
        ("unique", False, 2.0),
        ("in_set", False, 1.0),
        ("match_regex", False, 1.0),
        ("between", False, 1.0),
        ("pair_greater", False, 1.0),
        ("pair_greater", False, 1.0),
        ("unique_proportion_between", False, 2 / 3),
    ]


def test_expectations_on_an_empty_table(spark):
    df = spark.createDataFrame([], "id int")
    checks = [X.not_null("id"), X.unique("id"), X.between("id", 1, 2), X.row_count_between(0, 0)]
    assert all(r["success"] for r in X.evaluate(df, checks).collect())
