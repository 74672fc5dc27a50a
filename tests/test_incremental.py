"""Stored partial sums: the marts that come from them, replays, compaction."""

from __future__ import annotations

import datetime as dt

import pytest

from kpiweave.plans import activity, kpi, revenue, staging
from kpiweave.streaming import incremental
from tests import helpers as H
from tests.test_streaming import arrive, stream

DAY = dt.date


def logins(*rows):
    return [{"at": f"2024-{day}T01:00:00", "user_id": f"usr_{user}"} for day, user in rows]


def moves(n, day="01-05"):
    kinds = ("transfer", "qr_payment", "charge", None)
    states = ("completed", "completed", "failed", "pending")
    return [
        {
            "at": f"2024-{day}T0{i % 10}:00:00",
            "user_id": f"usr_{i % 7}",
            "transaction_type": kinds[i % 4],
            "status": states[i % 3],
            "amount": 100 * (i % 5) + i,
            "fee": (i % 3) * 10 or None,
        }
        for i in range(n)
    ]


@pytest.fixture
def lake(spark, tmp_path):
    users = H.users(spark, [{"user_id": "usr_1", "signup_date": DAY(2024, 1, 1)}])
    return incremental.Lake(spark, str(tmp_path / "lake"), staging.stg_users(users, H.AS_OF))


def whole_kpi(spark, lake, events, transactions):
    every = staging.stg_events(H.events(spark, events))
    money = staging.stg_transactions(H.transactions(spark, transactions))
    return kpi.mart_daily_kpi(activity.int_daily_active_users(every, lake.users), money)


def same(stored, whole, *order):
    assert H.dicts(stored.select(whole.columns), *order) == H.dicts(whole, *order)


def test_late_logins_refresh_the_marts_without_any_raw_row(spark, lake, tmp_path):
    """The files of earlier batches are gone when a late login arrives."""
    first = logins(("01-01", 1), ("01-05", 1), ("01-30", 2), ("02-28", 3))
    late = logins(("01-02", 9), ("01-05", 1), ("02-20", 1))
    tx, cp = H.transactions(spark, []), str(tmp_path / "cp")
    arrive(H.events(spark, first), tmp_path / "in")
    incremental.feed_events(lake, stream(spark, tmp_path / "in"), tx.schema, cp, once=True)
    schema = H.events(spark, []).schema
    for file in (tmp_path / "in").glob("*.parquet"):
        file.unlink()
    H.events(spark, late).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    incremental.feed_events(lake, source, tx.schema, cp, once=True)
    same(spark.read.parquet(lake.daily_kpi_path), whole_kpi(spark, lake, first + late, []), "date")
    plan = incremental.daily_kpi_between(lake, DAY(2024, 1, 2), DAY(2024, 1, 31))
    assert all("/user_days/" in f or "/day_sums/" in f for f in plan.inputFiles())
    assert len(plan.inputFiles()) == 5  # days out of reach are not listed


def test_transactions_of_several_batches_give_the_marts(spark, lake):
    parts = [moves(40), moves(25, "01-31"), moves(30, "02-01"), moves(10)]
    events = logins(("01-05", 1), ("01-31", 2), ("02-01", 3))
    incremental.add_events(lake, H.events(spark, events), "r", 0)
    for i, rows in enumerate(parts):
        incremental.add_transactions(lake, H.transactions(spark, rows), "r", i)
    every = [row for rows in parts for row in rows]
    span = (DAY(2024, 1, 1), DAY(2024, 2, 29))
    same(incremental.daily_kpi_between(lake, *span), whole_kpi(spark, lake, events, every), "date")
    money = staging.stg_transactions(H.transactions(spark, every))
    found = incremental.revenue_between(lake, *span)
    same(found, revenue.mart_revenue(money), "transaction_month", "transaction_type")


def test_a_replayed_batch_counts_once(spark, lake):
    rows = H.events(spark, logins(("01-05", 1), ("01-05", 2)))
    for _ in range(2):
        assert incremental.add_events(lake, rows, "r", 3) == [DAY(2024, 1, 5)]
    read = lake.logins.read(DAY(2024, 1, 1), DAY(2024, 1, 9))
    assert sorted(r.login_count for r in read.collect()) == [1, 1]


def counted(lake):
    rows = lake.logins.read(DAY(2024, 1, 1), DAY(2024, 1, 31)).collect()
    return {(r.day.day, r.user_id): r.login_count for r in rows}


def test_compaction_changes_no_sum(spark, lake, monkeypatch):
    parts = [logins(("01-05", 1), ("01-06", 1)), logins(("01-05", 1)), logins(("01-05", 2), ("01-20", 1))]
    for i, rows in enumerate(parts):
        incremental.add_events(lake, H.events(spark, rows), "r", i)
    before = counted(lake)
    assert before == {(5, "usr_1"): 2, (5, "usr_2"): 1, (6, "usr_1"): 1, (20, "usr_1"): 1}

    # A job that is lost before it wrote the log leaves a part that does not count.
    real = lake.logins._log_path
    with monkeypatch.context() as m:
        m.setattr(type(lake.logins), "_log_path", property(lambda self: "/dev/null/nowhere"))
        with pytest.raises(Exception):
            lake.logins.compact(DAY(2024, 1, 10))
    assert lake.logins._log_path == real and counted(lake) == before

    assert lake.logins.compact(DAY(2024, 1, 10)) == 1 and counted(lake) == before
    assert lake.logins.compact(DAY(2024, 1, 10)) == 0
    # A replay of a batch taken in does not count again; a late batch of the closed day does.
    incremental.add_events(lake, H.events(spark, parts[1]), "r", 1)
    assert counted(lake) == before
    incremental.add_events(lake, H.events(spark, logins(("01-05", 2))), "r", 9)
    assert counted(lake) == {**before, (5, "usr_2"): 2}
    assert lake.logins.compact(DAY(2024, 1, 10)) == 1
    assert lake.logins.vacuum() == 5 and counted(lake) == {**before, (5, "usr_2"): 2}


def test_rows_without_a_day_are_left_out_and_an_empty_lake_has_no_days(spark, lake):
    nothing = incremental.daily_kpi_between(lake, DAY(2024, 1, 1), DAY(2024, 1, 31))
    assert nothing.count() == 0
    assert incremental.add_events(lake, H.events(spark, []), "r", 0) == []
    assert lake.logins.days() == [] and lake.logins.compact(DAY(2030, 1, 1)) == 0
