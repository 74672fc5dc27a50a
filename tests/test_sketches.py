from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpiweave.operators import sketches as S
from kpiweave.operators.distinct import daily_distinct
from kpiweave.plans import activity, funnels, revenue, staging
from kpiweave.streaming import sinks, transforms
from tests import helpers as H
from tests.test_streaming import arrive, sends, stream

N = 60_000


def values(spark):
    """Uniform, skewed and tied values, and a short group."""
    base = spark.range(N).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(10**9)))
    columns = {
        "even": F.col("h"),
        "skewed": (F.lit(10**12) / (F.col("h") + 1)).cast("bigint"),
        "tied": F.col("h") % 3,
        None: F.when(F.col("id") < 7, F.col("id")),
    }
    pairs = [F.struct(F.lit(k).cast("string").alias("k"), v.alias("v")) for k, v in columns.items()]
    return base.select(F.inline(F.array(*pairs)))


@pytest.mark.parametrize("p", [0.02, 0.5, 0.95])
def test_ranks_keep_their_bound(spark, p):
    df = values(spark)
    found = S.approx_percentiles(df, ["k"], "v", {"q": p}, 0.005)
    assert {r.k: r.n for r in found.collect()} == {"even": N, "skewed": N, "tied": N, None: 7}
    # Four times the bound that one sketch in a hundred may miss.
    near = S.within(S.ranks(df, ["k"], "v", found, "q"), ["k"], p, 0.02, "near")
    assert [r.near for r in near.collect()] == [True] * 4


def test_merged_parts_stay_small_and_near(spark):
    df = values(spark).withColumn("part", F.pmod(F.xxhash64("v"), F.lit(20)))
    parts = S.quantile_sketches(df, ["k", "part"], "v", 0.005)
    whole = S.merged(parts, ["k"], 0.005).where("k = 'even'")
    row = whole.select("n", F.octet_length("sketch").alias("size")).first()
    assert row.n == N and row.size < 40_000
    few = S.quantile_sketches(df.where("k = 'even'").limit(N // 10), ["k"], "v", 0.005)
    assert row.size < 2 * few.select(F.octet_length("sketch")).first()[0]
    found = whole.select("k", S.quantile("sketch", 0.5).alias("q"))
    near = S.within(S.ranks(df, ["k"], "v", found, "q"), ["k"], 0.5, 0.02, "near")
    assert [r.near for r in near.collect()] == [True]


def test_sizes_follow_from_the_error():
    assert S.rank_error(S.size_for(0.01)) <= 0.01 < S.rank_error(S.size_for(0.01) - 1)
    assert S.size_for(0.9) == S.LEAST_K and S.registers_for(0.004) == 17
    for wrong in (0, -1, 1e-9):
        with pytest.raises(ValueError):
            S.size_for(wrong)
    with pytest.raises(ValueError):
        S.registers_for(1e-9)


def test_trailing_distinct_of_sketches(spark):
    rows = [(dt.date(2024, 1, d), f"u{u}") for d in (1, 2, 9, 30) for u in range(d * 40)]
    df = spark.createDataFrame(rows, "day date, user string")
    days = df.groupBy("day").agg(F.hll_sketch_agg("user", 14).alias("s"))
    windows = {"d1": 1, "d7": 7, "d30": 30}
    about = {r.day: r for r in S.trailing_distinct(days, "day", "s", windows).collect()}
    exact = daily_distinct(df, "user", "day", windows=windows).collect()
    assert len(about) == len(exact) == 4
    for row in exact:
        for name in windows:
            assert abs(about[row.day][name] - row[name]) <= 0.03 * row[name]


def test_the_stream_of_sketches_agrees_with_the_batch_and_keeps_a_sketch_per_day(spark, tmp_path):
    source, log = tmp_path / "in", str(tmp_path / "log")
    for part in ("event_timestamp < '2024-01-10'", "event_timestamp >= '2024-01-10'"):
        arrive(sends(spark).where(part), source)
        sketches = transforms.sender_sketches(stream(spark, source))
        query = sinks.changelog(sketches, log, str(tmp_path / "cp"), once=True)
    states = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert max(states) <= 11  # the days of a batch, not its users
    about = transforms.sliding_senders(sinks.latest(spark, log, ["day"]))
    exact = activity.weekly_active_senders(staging.stg_events(sends(spark)))
    assert H.dicts(about, "date") == H.dicts(exact, "date")


def test_marts_from_sketches_of_few_rows_are_exact_values(spark):
    rows = [{"at": "2024-01-05T00:00:00", "amount": a, "user_id": f"usr_{a}"} for a in (5, 9, 11)]
    money = staging.stg_transactions(H.transactions(spark, rows))
    assert revenue.mart_revenue(money, 0.01).first().median_amount == 9.0
    at = [H.ts("2024-01-01T00:00:00"), H.ts("2024-01-01T00:10:00")]
    funnel = spark.createDataFrame(
        [(*at, None, None)],
        "signup_started_at timestamp_ntz, signup_completed_at timestamp_ntz,"
        " identity_verified_at timestamp_ntz, first_transfer_completed_at timestamp_ntz",
    )
    row = funnels.time_to_convert(funnel, 0.01).first()
    assert (row.n, row.p50) == (1, 10.0)


def test_timeliness_with_a_sketch(spark):
    rows = [
        {"at": "2024-01-01T00:00:00", "received_at": H.ts(f"2024-01-01T00:0{i // 60}:{i % 60:02d}")}
        for i in range(100)
    ]
    events = H.events(spark, rows)
    exact = transforms.timeliness(events).first()
    about = transforms.timeliness(events, rank_error=0.005).first()
    assert exact.asDict() == about.asDict() and exact.p95_s == 94.0
