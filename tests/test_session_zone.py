"""Results do not depend on the zone of the session, nor on its daylight saving."""

from __future__ import annotations

import pytest

from kpiweave.plans import activity, funnels, kpi, staging
from kpiweave.streaming import transforms
from tests import helpers as H


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


def results(spark):
    # Around the spring change in New York, 2024-03-10 02:00 local.
    rows = [
        {"at": "2024-03-10T01:30:00", "event_name": "auth_signup_started"},
        {"at": "2024-03-10T03:30:00", "event_name": "auth_signup_completed"},
        {"at": "2024-03-10T02:30:00"},
        {"at": "2024-03-11T02:30:00"},
    ]
    events = H.events(spark, rows)
    ev = staging.stg_events(events)
    us = staging.stg_users(H.users(spark, []), H.AS_OF)
    tx = [{"at": "2024-03-10T01:59:59", "completed_at": H.ts("2024-03-10T03:00:01")}]
    txn = staging.stg_transactions(H.transactions(spark, tx))
    return [
        H.dicts(ev, "event_id"),
        H.dicts(funnels.int_funnel_conversion(ev)),
        H.dicts(txn),
        H.dicts(kpi.mart_daily_kpi(activity.int_daily_active_users(ev, us), txn), "date"),
        H.dicts(transforms.event_counts(events), "window_start", "event_name"),
        H.dicts(transforms.timeliness(events), "window_start"),
    ]


def test_zone_independence(spark, zone):
    zone("UTC")
    utc = results(spark)
    assert utc[1][0]["minutes_to_signup"] == 120.0
    assert utc[2][0]["processing_seconds"] == 3602.0
    for name in ("America/New_York", "Asia/Seoul"):
        zone(name)
        assert results(spark) == utc
