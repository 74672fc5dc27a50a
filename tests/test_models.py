"""Edge cases of the models on hand-made tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpiweave.plans import activity, anomaly, cohorts, funnels, kpi, revenue, staging
from kpiweave.quality import checks, contracts, monitors, report, suites
from tests import helpers as H


def staged(spark, events, users=()):
    ev = staging.stg_events(events)
    us = staging.stg_users(H.users(spark, list(users)), H.AS_OF)
    return ev, us


def test_staging_drops_test_anonymous_and_unnamed(spark):
    rows = [
        {"at": "2024-01-01T15:00:00", "event_name": "screen_viewed"},
        {"at": "2024-01-01T15:00:00", "user_id": "usr_test9"},
        {"at": "2024-01-01T15:00:00", "user_id": None},
        {"at": "2024-01-01T15:00:00", "event_name": None},
    ]
    (row,) = staging.stg_events(H.events(spark, rows)).collect()
    assert row["event_date_kst"] == dt.date(2024, 1, 2) and row["event_hour_kst"] == 0
    assert row["event_domain"] == "screen"
    other = staging.stg_events(H.events(spark, rows), tz_offset_hours=0).first()
    assert other["event_date_kst"] == dt.date(2024, 1, 1)


def test_text_amounts_are_cast_safely(spark):
    texts = ["50000", "50000.0", "abc", None]
    rows = [{"at": "2024-01-01T00:00:00", "prop_amount": t} for t in texts]
    staged_events = staging.stg_events(H.events(spark, rows, amount="string"))
    assert [r["amount"] for r in staged_events.collect()] == [50000, 50000, None, None]


def test_staged_transactions(spark):
    rows = [
        {"at": "2024-03-03T05:00:00", "fee": None, "completed_at": H.ts("2024-03-03T05:00:01.5")},
        {"at": "2024-03-03T05:00:00", "status": "odd"},
        {"at": "2024-03-03T05:00:00", "amount": 0},
        {"at": "2024-03-03T05:00:00", "amount": -5},
        {"at": "2024-03-03T05:00:00", "user_id": None},
    ]
    first, second = H.dicts(staging.stg_transactions(H.transactions(spark, rows)), "transaction_id")
    assert first["fee"] == 0 and first["processing_seconds"] == 1.5
    assert first["transaction_dow"] == 0 and first["status_label"] == "완료"
    assert second["status_label"] == "기타" and second["processing_seconds"] is None


def test_masking_keeps_joins(spark):
    us = H.users(spark, [{"user_id": "usr_1"}, {"user_id": "usr_2"}])
    tx = H.transactions(spark, [{"at": "2024-01-01T00:00:00"}])
    masked_users = staging.mask_pii(us, "salt")
    masked_tx = staging.mask_pii(tx, "salt", ("user_id",))
    assert masked_users.join(masked_tx, "user_id").count() == 1
    assert masked_users.where(F.col("user_id").startswith("usr_")).count() == 0
    assert staging.mask_pii(us, "other").join(masked_tx, "user_id").count() == 0


def test_empty_tables_give_empty_marts(spark):
    ev, us = staged(spark, H.events(spark, []))
    tx = H.transactions(spark, [])
    logins = activity.int_daily_active_users(ev, us)
    assert kpi.mart_daily_kpi(logins, staging.stg_transactions(tx)).count() == 0
    assert revenue.mart_revenue(staging.stg_transactions(tx)).count() == 0
    assert cohorts.mart_retention(cohorts.int_user_cohort(us, ev)).count() == 0
    assert anomaly.volume_zscore(tx).count() == 0
    assert anomaly.high_value_txn(tx).count() == 0
    funnel = H.dicts(funnels.mart_funnel(funnels.int_funnel_conversion(ev)))
    assert [r["users"] for r in funnel] == [0] * 6
    assert [r["conversion_from_start"] for r in funnel] == [100.0] + [None] * 5
    results = report.quality_report(H.events(spark, []), tx, H.users(spark, []))
    assert report.report_summary(results).first()["quality_score"] == 100.0


def test_daily_kpi_counts_a_user_once_and_keeps_its_spine(spark):
    ev, us = staged(
        spark,
        H.events(
            spark,
            [
                {"at": "2024-01-01T00:00:00"},
                {"at": "2024-01-01T01:00:00", "platform": "web"},
                {"at": "2024-01-01T02:00:00", "user_id": "usr_2"},
                {"at": "2024-01-09T02:00:00", "user_id": "usr_3"},
            ],
        ),
        [{"user_id": "usr_1", "signup_date": dt.date(2024, 1, 1)}],
    )
    tx = [
        {"at": "2024-01-01T00:00:00", "amount": 1000, "fee": 300},
        {"at": "2024-01-01T00:00:00", "amount": 500, "transaction_type": "charge"},
        {"at": "2024-01-01T00:00:00", "status": "failed"},
        # No login on that day: the day is not part of the mart.
        {"at": "2024-01-05T00:00:00"},
    ]
    mart = kpi.mart_daily_kpi(
        activity.int_daily_active_users(ev, us), staging.stg_transactions(H.transactions(spark, tx))
    )
    first, second = H.dicts(mart, "date")
    assert (first["dau"], first["new_users"], first["returning_users"]) == (2, 1, 1)
    # One user on two platforms counts on both.
    assert (first["dau_ios"], first["dau_android"], first["dau_web"]) == (2, 0, 1)
    assert first["gmv"] == 1500 and first["fee_revenue"] == 300
    assert first["success_rate"] == 66.67 and first["day_name"] == "월"
    assert (second["dau"], second["wau_7d"], second["mau_30d"]) == (1, 1, 3)
    assert second["gmv"] == 0 and second["avg_transaction_amount"] is None
    assert second["success_rate"] == 0.0
    broken = contracts.gmv_parts_add_up(mart).collect()
    assert [(r["date"], r["diff"]) for r in broken] == [(dt.date(2024, 1, 1), 500)]
    assert contracts.dau_positive(mart).count() == 0


def test_rows_against_calendar_days(spark):
    """A missing day shortens the calendar window but not the row window."""
    days = ["01", "02", "03", "04", "05", "06", "20"]
    rows = [{"at": f"2024-01-{d}T00:00:00", "user_id": f"usr_{d}"} for d in days]
    events = H.events(spark, rows)
    by_rows = H.dicts(activity.rolling_wau(events), "login_date")
    assert by_rows[-1]["wau_7d_sum"] == 7 and by_rows[-1]["wau_7d_avg"] == 1.0
    ev, us = staged(spark, events)
    by_days = H.dicts(
        activity.rolling_users(activity.int_daily_active_users(ev, us)), "activity_date"
    )
    assert by_days[-1]["wau_7d"] == 1 and by_days[-1]["mau_30d"] == 7


def test_week_across_a_month_end_splits_the_mart_cohort(spark):
    # Monday 2024-01-29 .. Sunday 2024-02-04
    signups = [
        {"user_id": "usr_1", "signup_date": dt.date(2024, 1, 31)},
        {"user_id": "usr_2", "signup_date": dt.date(2024, 2, 1)},
        {"user_id": "usr_3", "signup_date": dt.date(2024, 2, 1)},
    ]
    rows = [
        {"at": "2024-02-01T00:00:00", "user_id": "usr_1"},
        {"at": "2024-02-02T00:00:00", "user_id": "usr_2"},
        {"at": "2024-01-30T00:00:00", "user_id": "usr_2"},
    ]
    events = H.events(spark, rows)
    ev, us = staged(spark, events, signups)
    mart = H.dicts(cohorts.mart_retention(cohorts.int_user_cohort(us, ev)), "signup_month")
    assert [(r["signup_week"], r["signup_month"], r["cohort_size"]) for r in mart] == [
        (dt.date(2024, 1, 29), dt.date(2024, 1, 1), 1),
        (dt.date(2024, 1, 29), dt.date(2024, 2, 1), 2),
    ]
    # Never-active users stay in the base; a login before the signup is no retention.
    assert [r["retention_d1"] for r in mart] == [100.0, 50.0]
    (weekly,) = cohorts.classic_retention(H.users(spark, signups), events).collect()
    assert (weekly["cohort_size"], weekly["d1_users"]) == (2, 2)
    curve = cohorts.cohort_curve(H.users(spark, signups), events).collect()
    assert [(r["day_n"], r["active_users"], r["cohort_size"]) for r in curve] == [(1, 2, 3)]


def test_funnel_is_unordered(spark):
    rows = [
        {"at": "2024-01-02T00:00:00", "event_name": "auth_signup_completed"},
        {"at": "2024-01-01T00:00:00", "event_name": "payment_transfer_completed"},
    ]
    ev, _ = staged(spark, H.events(spark, rows))
    (row,) = funnels.int_funnel_conversion(ev).collect()
    assert row["hours_to_first_transfer"] == -24.0 and not row["reached_signup_start"]
    everyone = [r for r in funnels.signup_conversion_7d(ev).collect() if r["segment"] == "all"]
    assert (everyone[0]["signups"], everyone[0]["converted"]) == (1, 0)


def test_single_day_has_no_zscore_and_no_alert(spark):
    (row,) = anomaly.volume_zscore(H.transactions(spark, [{"at": "2024-01-01T00:00:00"}])).collect()
    assert row["txn_count_zscore"] is None and row["txn_alert"].endswith("OK")


def test_volume_spike_is_reported(spark):
    rows = [{"at": f"2024-01-{d:02d}T00:00:00"} for d in range(1, 26)]
    rows += [{"at": "2024-01-26T00:00:00"}] * 40
    tx = H.transactions(spark, rows)
    flagged = [r for r in anomaly.volume_zscore(tx).collect() if "ALERT" in r["txn_alert"]]
    assert [r["txn_date"] for r in flagged] == [dt.date(2024, 1, 26)]
    (found,) = [r for r in anomaly.metric_anomaly(tx).collect() if r["metric"] == "txn_count"]
    assert found["direction"].endswith("급증")
    events = H.events(spark, [{**r, "user_id": "usr_1"} for r in rows])
    assert [r["dt"] for r in checks.volume_anomalies(checks.daily_events(events)).collect()] == [
        dt.date(2024, 1, 26)
    ]
    assert monitors.latest_day_volume(events).first()["ok"] is False
    names = {
        r["check_name"]: r["violations"]
        for r in checks.run_checks(events, tx, H.users(spark, [])).collect()
    }
    assert names["events_daily_volume_anomaly"] == 1 and names["txn_users_exist"] == 1


def test_high_value_finds_all_partners_of_a_hot_user(spark):
    hot = [{"at": "2024-01-01T00:00:00", "amount": 10} for _ in range(300)]
    hot += [{"at": "2024-01-01T00:00:00", "amount": 1000 + i} for i in range(3)]
    rare = [{"at": "2024-01-01T00:00:00", "user_id": "usr_2", "amount": a} for a in (1, 1, 1, 90)]
    rare += [{"at": "2024-01-01T00:00:00", "user_id": "usr_3", "amount": 1} for _ in range(20)]
    rare += [{"at": "2024-01-01T00:00:00", "user_id": "usr_3", "amount": 90}]
    tx = H.transactions(spark, hot + rare)
    found = anomaly.high_value_txn(tx, top=None).collect()
    # usr_2 has fewer than five transactions.
    assert sorted(r["amount"] for r in found) == [90, 1000, 1001, 1002]
    assert anomaly.high_value_txn(tx, top=2).count() == 2


def test_tiers(spark):
    rows = [
        {"at": "2024-01-01T00:00:00", "user_id": "usr_1", "fee": 2000},
        {"at": "2024-01-01T00:00:00", "user_id": "usr_2", "fee": 499},
        {"at": "2024-01-01T00:00:00", "user_id": "usr_3", "fee": 500},
        {"at": "2024-01-01T00:00:00", "user_id": "usr_4", "fee": None},
        {"at": "2024-01-01T00:00:00", "user_id": "usr_5", "fee": 800, "status": "failed"},
    ]
    tiers = revenue.user_tier_revenue(H.transactions(spark, rows)).collect()
    users = {r["user_tier"].split(" ")[0]: r["users"] for r in tiers}
    assert users == {"Heavy": 1, "Medium": 1, "Light": 1, "Free": 2}
    assert sum(r["revenue_share_pct"] or 0 for r in tiers) == pytest.approx(100, abs=0.02)


def test_period_filter(spark):
    rows = [(dt.date(2024, 1, d), p) for d in (1, 2, 8) for p in ("ios", "web")]
    df = spark.createDataFrame(rows, "date date, platform string")
    assert kpi.period_filter(df, days=7).count() == 4
    assert kpi.period_filter(df, days=7, platform="web").count() == 2


def test_schema_rules(spark):
    uuid = "550e8400-e29b-41d4-a716-446655440000"
    rows = [
        {"at": "2024-01-01T00:00:00", "event_id": uuid},
        {
            "at": "2024-01-01T00:10:00",
            "event_id": "7",
            "platform": "tv",
            "app_version": "1",
            "user_id": "bob",
            "session_id": None,
            "received_at": H.ts("2024-01-01T00:00:00"),
        },
    ]
    events = H.events(spark, rows)
    (bad,) = monitors.schema_compliance(events).collect()
    assert sorted(bad["violations"]) == [
        "enum:platform",
        "format:event_id",
        "pattern:app_version",
        "pattern:user_id",
        "required:session_id",
    ]
    assert [r["event_id"] for r in monitors.future_timestamp(events).collect()] == ["7"]
    extra = events.withColumn("surprise", F.lit(1))
    assert monitors.schema_compliance(extra).count() == 2


def test_schema_drift(spark):
    before = spark.createDataFrame([], "a int, b string, c int")
    now = spark.createDataFrame([(1, 2, None)], "a int, b int, d string")
    rows = monitors.schema_drift(now, monitors.schema_snapshot(before), "t").collect()
    assert {(r["column"], r["change"], r["rows"]) for r in rows} == {
        ("b", "type string -> int", 1),
        ("c", "removed", 0),
        ("d", "added", 0),
    }
    assert monitors.schema_drift(now, monitors.schema_snapshot(now), "t").count() == 0


def test_alert_levels(spark):
    rows = [(79.9, 0), (85.0, 0), (95.0, 0), (95.0, 1)]
    summary = spark.createDataFrame(rows, "quality_score double, critical_failed int")
    levels = [r["level"] for r in report.alert_level(summary).collect()]
    assert levels == ["critical", "warning", "none", "critical"]


def test_suites_cover_both_tables(spark):
    events = H.events(spark, [{"at": "2024-01-01T00:00:00"}])
    tx = H.transactions(spark, [{"at": "2024-01-01T00:00:00"}])
    results = suites.run_suites(events, tx)
    assert results.count() == 21
    failed = {r["expectation"] for r in results.where("not success").collect()}
    assert failed == {"row_count_between"}


def test_decompositions_multiply_back(spark, sf_dir):
    from verification.queries_models import Tables

    t = Tables(spark, sf_dir)
    for r in revenue.gmv_decomposition(t.stg_txn).collect():
        assert r["users"] * r["per_user"] * r["avg_amount"] == pytest.approx(r["gmv"])
    for r in activity.daily_users(t.int_dau).collect():
        # A user is new or returning on a day, never both.
        assert r["new_users"] + r["returning_users"] == r["dau"]


def test_monthly_users_over_several_months(spark):
    rows = [
        {"at": "2024-01-30T00:00:00", "user_id": "usr_1"},
        {"at": "2024-01-31T00:00:00", "user_id": "usr_1"},
        {"at": "2024-01-31T00:00:00", "user_id": "usr_2"},
        {"at": "2024-02-01T00:00:00", "user_id": "usr_1"},
        {"at": "2024-04-01T00:00:00", "user_id": "usr_2"},
        # Nobody known: a day without users, no user of the month.
        {"at": "2024-04-02T00:00:00", "user_id": None},
    ]
    got = H.dicts(activity.stickiness(H.events(spark, rows)), "dt")
    assert [(r["dau"], r["mau"]) for r in got] == [(1, 2), (2, 2), (1, 1), (1, 1), (0, 1)]
