from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kpiweave.operators import bitmaps, ranges
from kpiweave.operators.distinct import daily_distinct
from kpiweave.streaming import sinks
from tests import helpers as H

WINDOWS = {"d1": 1, "d7": 7, "d30": 30, "d8": 8}


def activity(spark, n=3000, seed=2):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.paretovariate(0.5)) % 80)
        rows.append((day, f"u{int(rng.paretovariate(0.4)) % 700}", rng.choice(["ios", "web", None])))
    rows += [(None, "u1", "ios"), (dt.date(2024, 1, 1), None, "ios")]
    return spark.createDataFrame(rows, "day date, user string, platform string")


def test_numbers_are_dense_and_last(spark, tmp_path):
    df = activity(spark).repartition(7)
    numbers = bitmaps.dense_numbers(df, "user", str(tmp_path / "a"))
    users = {r.user for r in df.collect()} - {None}
    assert sorted(r.number for r in numbers.collect()) == list(range(1, len(users) + 1))
    more = spark.createDataFrame([("u1",), ("new",), ("newer",), (None,)], "user string")
    grown = bitmaps.added_numbers(numbers, more.where("user IS NOT NULL"), "user", str(tmp_path / "b"))
    assert {r.number for r in grown.where("user LIKE 'new%'").collect()} == {len(users) + 1, len(users) + 2}
    before = {r.user: r.number for r in numbers.collect()}
    assert before.items() <= {r.user: r.number for r in grown.collect()}.items()


def test_trailing_users_by_segment_are_exact(spark, tmp_path):
    df = activity(spark)
    numbers = bitmaps.dense_numbers(df, "user", str(tmp_path / "n"))
    path = str(tmp_path / "bits")
    for part in ("day < '2024-01-20' OR day IS NULL", "day >= '2024-01-15'"):  # they overlap
        bits = bitmaps.day_bitmaps(df.where(part), numbers, "user", "day", ["platform"])
        bits.write.mode("append").parquet(path)
    stored = bitmaps.united(spark.read.parquet(path), "day", ["platform"])
    found = bitmaps.trailing_users(stored, "day", WINDOWS, ["platform"])
    mine = {(r.day, r.platform): tuple(r[n] for n in WINDOWS) for r in found.collect()}
    theirs = {}
    for platform in ("ios", "web", None):
        own = df.where(F.col("platform").eqNullSafe(platform))
        for r in daily_distinct(own, "user", "day", windows=WINDOWS).collect():
            theirs[r.day, platform] = tuple(r[n] for n in WINDOWS)
    assert mine == theirs
    everyone = bitmaps.united(stored.drop("platform"), "day")
    whole = bitmaps.trailing_users(everyone, "day", WINDOWS)
    exact = daily_distinct(df, "user", "day", windows=WINDOWS)
    assert H.dicts(whole, "day") == H.dicts(exact.select(whole.columns), "day")


def test_numbers_beyond_one_bitmap(spark, tmp_path):
    df = spark.range(70_000).select(F.col("id").cast("string").alias("user"), F.lit("2024-01-01").cast("date").alias("day"))
    numbers = bitmaps.dense_numbers(df, "user", str(tmp_path / "n"))
    bits = bitmaps.day_bitmaps(df, numbers, "user", "day")
    assert bits.count() == 3
    assert bitmaps.trailing_users(bits, "day", {"d7": 7}).first().d7 == 70_000


def brute(points, intervals, keyed):
    return sorted(
        ((p, i) for p in points for i in intervals if None not in (p[1], *i[1:3]) and i[1] <= p[1] <= i[2] and (not keyed or (p[2] == i[3] and p[2] is not None))),
        key=repr,
    )


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("hot", [ranges.HOT_POINTS, 5])
def test_range_join_against_all_pairs(spark, keyed, hot):
    rng = random.Random(6)
    points = [(i, rng.choice([rng.randint(-900, 900), 7]), rng.choice("ab")) for i in range(300)]
    points += [(900, None, "a"), (901, 0, None), (902, -(2**40), "a"), (903, 2**40, "b")]
    intervals = []
    for j in range(60):
        low = rng.randint(-1000, 900)
        intervals.append((j, low, low + int(rng.paretovariate(0.4)) % 3000 - 1, rng.choice("ab")))
    intervals += [(70, 7, 7, "a"), (71, -(2**41), 2**41, "b"), (72, 5, 4, "a"), (73, None, 9, "a"), (74, 0, None, "a")]
    p = spark.createDataFrame(points, "p int, at bigint, k string")
    i = spark.createDataFrame(intervals, f"i int, low bigint, high bigint, {'k' if keyed else 'other'} string")
    joined = ranges.range_join(p, i, "at", "low", "high", ["k"] if keyed else (), hot)
    got = sorted(((r.p, r.i) for r in joined.collect()), key=repr)
    assert got == sorted(((a[0], b[0]) for a, b in brute(points, intervals, keyed)), key=repr)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_of_nothing(spark):
    p = spark.createDataFrame([(1, 5)], "p int, at bigint")
    none = spark.createDataFrame([], "i int, low bigint, high bigint")
    assert ranges.range_join(p, none, "at", "low", "high").count() == 0


def test_a_clock_set_back_does_not_bring_an_older_row_back(spark, tmp_path):
    log = str(tmp_path / "log")
    for batch, at in ((0, "2024-01-01T10:00:00"), (1, "2024-01-01T09:00:00")):
        row = spark.createDataFrame([("k", batch, H.ts(at))], "key string, v int, stored_at timestamp")
        row.write.parquet(f"{log}/run=a/batch={batch}")
    assert [tuple(r) for r in sinks.latest(spark, log, ["key"]).collect()] == [("k", 1)]
