from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kpiweave.operators.distinct import daily_distinct
from kpiweave.plans import activity, anomaly, kpi, staging
from kpiweave.streaming import incremental, sinks, transforms
from tests import helpers as H


def arrive(df, path):
    """One file, as one arrival."""
    df.coalesce(1).write.mode("append").parquet(str(path))


def stream(spark, path):
    return sinks.read_stream(spark, str(path), files_per_trigger=1)


def test_repeats_across_batches_are_dropped(spark, tmp_path):
    first = H.events(spark, [{"at": "2024-01-01T00:00:00", "event_id": i} for i in "abc"])
    arrive(first, tmp_path / "in")
    source, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    sinks.append_files(transforms.dedup(stream(spark, source)), out, cp, once=True)
    arrive(H.events(spark, [{"at": "2024-01-01T00:00:03", "event_id": i} for i in "bcd"]), source)
    sinks.append_files(transforms.dedup(stream(spark, source)), out, cp, once=True)
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == list("abcd")


def test_counts_survive_updates_and_late_rows_are_counted(spark, tmp_path):
    source, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        counts = transforms.event_counts(stream(spark, source))
        return sinks.changelog(counts, out, cp, once=True)

    arrive(H.events(spark, [{"at": "2024-01-01T16:00:00"}] * 2), source)
    run()
    arrive(H.events(spark, [{"at": "2024-01-01T17:00:00"}]), source)
    run()
    arrive(H.events(spark, [{"at": "2024-01-09T00:00:00"}]), source)
    run()
    # The window of the first days has closed by now.
    arrive(H.events(spark, [{"at": "2024-01-01T18:00:00"}]), source)
    late = run()
    rows = sinks.latest(spark, out, ["window_start", "event_name"])
    got = {r["window_start"]: r["n"] for r in rows.collect()}
    # 16:00 UTC is already the next day in Korea.
    assert got == {dt.datetime(2024, 1, 2): 3, dt.datetime(2024, 1, 9): 1}
    assert sinks.late_rows(late) == 1


def test_changelog_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([("k", 1)], "key string, v int")
    rows.write.mode("overwrite").parquet(f"{out}/batch=0")
    rows.write.mode("overwrite").parquet(f"{out}/batch=0")
    rows.withColumn("v", F.lit(9)).write.mode("overwrite").parquet(f"{out}/batch=10")
    rows.withColumn("v", F.lit(5)).write.mode("overwrite").parquet(f"{out}/batch=9")
    assert [tuple(r) for r in sinks.latest(spark, out, ["key"]).collect()] == [("k", 9)]


def test_validation_routes_rows(spark, tmp_path):
    uuid = "550e8400-e29b-41d4-a716-446655440000"
    rows = [
        {"at": "2024-01-01T00:00:00", "event_id": uuid},
        {"at": "2024-01-01T01:00:00", "event_id": uuid, "received_at": H.ts("2024-01-01T00:00:00")},
        {"at": "2024-01-01T00:00:00", "event_id": None},
    ]
    arrive(H.events(spark, rows), tmp_path / "in")
    routed = transforms.validate(stream(spark, tmp_path / "in"))
    sinks.append_files(routed, str(tmp_path / "out"), str(tmp_path / "cp"), ["route"], once=True)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.where("route = 'valid'").count() == 1
    reasons = {tuple(r["reasons"]) for r in stored.where("route = 'quarantine'").collect()}
    assert reasons == {("future_timestamp",), ("required:event_id",)}


def sends(spark):
    rows = []
    for day in range(1, 20):
        for user in range(day % 5 + 1):
            at = f"2024-01-{day:02d}T{user:02d}:00:00"
            row = {"at": at, "user_id": f"usr_{user}", "event_name": "payment_transfer_completed"}
            rows += [row, dict(row)]
    rows.append({**rows[0], "user_id": "usr_test1"})
    return H.events(spark, rows)


def test_sender_days_and_sketch_agree_with_the_batch(spark, tmp_path):
    batch = activity.weekly_active_senders(staging.stg_events(sends(spark)))
    exact = {r["date"]: r["was_7d"] for r in batch.collect()}
    source = tmp_path / "in"
    arrive(sends(spark).where("event_timestamp < '2024-01-10'"), source)
    days = transforms.sender_days(stream(spark, source))
    sinks.append_files(days, str(tmp_path / "d"), str(tmp_path / "dcp"), once=True)
    arrive(sends(spark).where("event_timestamp >= '2024-01-10'"), source)
    days = transforms.sender_days(stream(spark, source))
    sinks.append_files(days, str(tmp_path / "d"), str(tmp_path / "dcp"), once=True)
    stored = spark.read.parquet(str(tmp_path / "d"))
    assert stored.count() == stored.distinct().count()
    rolling = daily_distinct(stored, "user_id", "day", windows={"was_7d": 7})
    assert {r["day"]: r["was_7d"] for r in rolling.collect()} == exact

    sketch = transforms.approx_active_senders(stream(spark, source))
    sinks.changelog(sketch, str(tmp_path / "s"), str(tmp_path / "scp"), once=True)
    newest = sinks.latest(spark, str(tmp_path / "s"), ["date"])
    got = {r["date"]: r["was_7d"] for r in newest.collect()}
    assert all(got[d] == n for d, n in exact.items())


def test_alerts(spark):
    rows = [{"at": "2024-01-02T00:00:00"}] * 8
    rows += [{"at": "2024-01-02T00:00:00", "status": "failed", "error_code": "ERR_1"}] * 2
    tx = H.transactions(spark, rows)
    baseline = spark.createDataFrame([("error_surge:ERR_1", 1.5)], "rule string, limit double")
    found = transforms.alerts(transforms.transaction_signals(tx), baseline).collect()
    assert {(r["rule"], r["value"], r["alert"]) for r in found} == {
        ("success_rate", 80.0, True),
        ("error_surge:ERR_1", 2.0, True),
    }
    none = transforms.error_baseline(anomaly.daily_errors(tx)).collect()
    assert [r["limit"] for r in none] == [None]


def test_late_login_refreshes_the_days_it_reaches(spark, tmp_path):
    users = staging.stg_users(H.users(spark, []), H.AS_OF)
    lake = incremental.Lake(spark, str(tmp_path / "lake"), users)
    early = [{"at": f"2024-01-{d:02d}T00:00:00", "user_id": f"usr_{d}"} for d in (1, 5, 30)]
    late = [
        {"at": "2024-01-02T00:00:00", "user_id": "usr_99"},
        {"at": "2024-02-20T00:00:00", "user_id": "usr_1"},
    ]
    tx = H.transactions(spark, [{"at": "2024-01-05T00:00:00", "amount": 700}])
    source = tmp_path / "in"
    arrive(H.events(spark, early), source)
    cp = str(tmp_path / "cp")
    incremental.feed_events(lake, stream(spark, source), tx.schema, cp, once=True)
    arrive(H.events(spark, late), source)
    incremental.feed_events(lake, stream(spark, source), tx.schema, cp, once=True)
    arrive(tx, tmp_path / "tx")
    money, schema = stream(spark, tmp_path / "tx"), H.events(spark, []).schema
    incremental.feed_transactions(lake, money, schema, str(tmp_path / "cp2"), once=True)
    whole = kpi.mart_daily_kpi(
        activity.int_daily_active_users(
            staging.stg_events(H.events(spark, early + late)), users
        ),
        staging.stg_transactions(tx),
    )
    stored = spark.read.parquet(lake.daily_kpi_path).select(whole.columns)
    assert H.dicts(stored, "date") == H.dicts(whole, "date")
    assert spark.read.parquet(lake.revenue_path).first()["gmv"] == 700
