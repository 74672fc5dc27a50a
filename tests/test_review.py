"""Rows and tables that the derived tables do not have: odd ids, times, columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kpiweave.plans import funnels
from kpiweave.quality import checks, monitors, report
from kpiweave.sources import readers
from tests import helpers

HEADER = (
    "prop_step,event_id,event_name,event_timestamp,received_at,user_id,session_id,device_id,"
    "platform,app_version,os_version,device_model,prop_amount"
)


def test_repeated_null_ids_are_a_duplicate(spark):
    events = helpers.events(
        spark, [{"at": "2024-01-05T00:00:00", "event_id": i} for i in (None, None, "a", "b", "b")]
    )
    found = {r.event_id: r.cnt for r in checks.duplicates(events, "event_id").collect()}
    assert found == {None: 2, "b": 2}


def test_events_file_with_unknown_and_missing_columns_and_a_bad_time(spark, tmp_path):
    rows = [
        "7,e1,screen_viewed,2024-01-05T01:02:03Z,2024-01-05T01:02:04Z,usr_1,s,d,ios,1.0.0,o,m,50.0",
        "8,e2,screen_viewed,not a time,2024-01-05T01:02:04Z,usr_1,s,d,ios,1.0.0,o,m,",
        "9,e3,screen_viewed,2024-01-05T10:02:03+09:00,,usr_1,s,d,ios,1.0.0,o,m,",
    ]
    path = tmp_path / "events.csv"
    path.write_text("\n".join([HEADER, *rows]) + "\n")
    events = readers.read_events(spark, str(path))
    found = {r.event_id: r for r in events.collect()}
    assert {k: r.prop_step for k, r in found.items()} == {"e1": "7", "e2": "8", "e3": "9"}
    assert found["e1"].prop_amount == 50 and found["e1"].prop_fee is None
    assert found["e2"].event_timestamp is None
    assert found["e3"].event_timestamp == dt.datetime(2024, 1, 5, 1, 2, 3)
    raw = spark.read.csv(str(path), header=True)
    bad = readers.malformed_times(raw, "event_timestamp", "received_at").collect()
    assert [(r.event_id, r.malformed) for r in bad] == [("e2", ["event_timestamp"])]


def test_absent_columns_are_violations(spark):
    events = helpers.events(spark, [{"at": "2024-01-05T00:00:00"}]).drop("received_at", "session_id")
    broken = monitors.schema_compliance(events, None).first().violations
    assert {"required:received_at", "required:session_id"} <= set(broken)
    assert not any("event_properties" in rule for rule in broken)
    bare = events.drop(*[c for c in events.columns if c.startswith("prop_")])
    assert "required:event_properties" in monitors.schema_compliance(bare, None).first().violations


def test_an_erring_check_is_one_failed_row(spark):
    events = helpers.events(spark, [{"at": "2024-01-05T00:00:00"}])
    money = helpers.transactions(spark, [{"at": "2024-01-05T00:00:00"}]).drop("fee")
    users = helpers.users(spark, [{"user_id": "usr_1", "signup_date": dt.date(2024, 1, 1)}])
    rows = {r.check_name: r for r in report.quality_report(events, money, users).collect()}
    assert len(rows) == 15
    failed = {k for k, r in rows.items() if not r.passed}
    assert failed == {"txn_non_negative_fee", "txn_amount_gte_fee"}
    assert rows["txn_non_negative_fee"].details == "Error: no column fee in transactions"
    summary = report.report_summary(report.quality_report(events, money, users)).first()
    assert (summary.passed, summary.failed) == (13, 2)


def test_payload_can_be_kept(spark):
    rows = spark.sql("SELECT 'e' AS event_id, parse_json('{\"amount\": 5, \"odd\": 1}') AS event_properties")
    flat = readers.flatten_properties(rows, keep_payload=True)
    assert flat.select(F.try_variant_get("event_properties", "$.odd", "int")).first()[0] == 1
    assert flat.first().prop_amount == 5


def test_conversion_times_that_all_fall_into_one_minute(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start, start + dt.timedelta(microseconds=1_000_000 + 997 * i)) for i in range(500)]
    schema = "signup_started_at timestamp_ntz, signup_completed_at timestamp_ntz"
    none = F.lit(None).cast("timestamp_ntz")
    wide = spark.createDataFrame(rows, schema).withColumns(
        {"identity_verified_at": none, "first_transfer_completed_at": none}
    )
    got = funnels.time_to_convert(wide).first()
    values = sorted((b - a).total_seconds() / 60 for a, b in rows)
    assert got.n == 500
    assert abs(got.p50 - (values[249] + values[250]) / 2) < 1e-9
