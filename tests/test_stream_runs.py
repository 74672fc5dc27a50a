"""Stored stream parts over several checkpoints and sources."""

from __future__ import annotations

import datetime as dt

from kpiweave.plans import activity, kpi, staging
from kpiweave.streaming import incremental, sinks, transforms
from tests import helpers as H
from tests.test_streaming import arrive, stream


def test_a_new_checkpoint_or_source_replaces_nothing(spark, tmp_path):
    out = str(tmp_path / "log")
    for i, day in enumerate(("2024-01-01", "2024-01-03")):
        arrive(H.events(spark, [{"at": f"{day}T01:00:00"}] * (i + 1)), tmp_path / f"in{i}")
        counts = transforms.event_counts(stream(spark, tmp_path / f"in{i}"))
        sinks.changelog(counts, out, str(tmp_path / f"cp{i}"), once=True)
    keys = ["window_start", "event_name"]
    rows = {r.window_start: r.n for r in sinks.latest(spark, out, keys).collect()}
    assert rows == {dt.datetime(2024, 1, 1): 1, dt.datetime(2024, 1, 3): 2}
    base = str(tmp_path / "base")
    sinks.compact(spark, out, keys, base)
    assert {r.window_start: r.n for r in sinks.latest(spark, base, keys).collect()} == rows


def test_all_late_rows_are_counted(spark, tmp_path):
    counter = sinks.LateRows()
    spark.streams.addListener(counter)
    for day in ("2024-01-01", "2024-01-09", "2024-01-01", "2024-01-02"):
        arrive(H.events(spark, [{"at": f"{day}T01:00:00"}]), tmp_path / "in")
        counts = transforms.event_counts(stream(spark, tmp_path / "in"))
        query = sinks.changelog(counts, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    spark.streams.removeListener(counter)
    assert counter.rows[str(query.id)] == 2


def test_one_lake_fed_by_two_checkpoints(spark, tmp_path):
    users = staging.stg_users(H.users(spark, []), H.AS_OF)
    lake = incremental.Lake(spark, str(tmp_path / "lake"), users)
    tx = H.transactions(spark, [])
    parts = [
        [{"at": "2024-01-02T00:00:00", "user_id": "usr_1"}],
        [{"at": "2024-01-02T00:00:00", "user_id": "usr_2"}],
        [{"at": "1970-01-02T00:00:00", "user_id": "usr_3"}],
    ]
    for i, rows in enumerate(parts):
        arrive(H.events(spark, rows), tmp_path / f"in{i}")
        source = stream(spark, tmp_path / f"in{i}")
        incremental.feed_events(lake, source, tx.schema, str(tmp_path / f"cp{i}"), once=True)
    every = staging.stg_events(H.events(spark, [r for rows in parts for r in rows]))
    whole = kpi.mart_daily_kpi(
        activity.int_daily_active_users(every, users), staging.stg_transactions(tx)
    )
    stored = spark.read.parquet(lake.daily_kpi_path).select(whole.columns)
    assert H.dicts(stored, "date") == H.dicts(whole, "date")


def test_touched_days_become_spans():
    day = dt.date
    days = [day(2024, 1, 5), day(1970, 1, 1), day(2024, 1, 1), day(2024, 1, 7)]
    reach = dt.timedelta(days=1)
    assert incremental.spans(days, reach) == [
        (day(1970, 1, 1), day(1970, 1, 2)),
        (day(2024, 1, 1), day(2024, 1, 2)),
        (day(2024, 1, 5), day(2024, 1, 8)),
    ]
    assert incremental.months(days)[0] == (day(2024, 1, 1), day(2024, 1, 7))
