"""Registered Spark queries: checks, expectations, contracts, monitors, report."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.plans import activity, anomaly, funnels, revenue
from kpiweave.quality import checks, contracts, monitors, report, suites
from verification.queries_models import Tables, on_tables

AS_OF = dt.datetime(2024, 3, 1)

# What an older load of the events looked like: no transfer type, a text amount, one more column.
OLD_EVENTS_CHANGES = {"prop_transfer_type": None, "prop_amount": "string", "legacy_id": "string"}


def old_snapshot(t: Tables) -> str:
    columns = json.loads(monitors.schema_snapshot(t.events))
    for name, kind in OLD_EVENTS_CHANGES.items():
        if kind is None:
            columns.pop(name)
        else:
            columns[name] = kind
    return json.dumps(columns)


def event_rule(t: Tables, name: str) -> DataFrame:
    return checks.violation_counts(t.events, {name: checks.EVENT_ROW_RULES[name]()})


def txn_rule(t: Tables, name: str) -> DataFrame:
    return checks.violation_counts(t.transactions, {name: checks.TXN_ROW_RULES[name]()})


def suite(t: Tables, *kinds: str) -> DataFrame:
    return suites.run_suites(t.events, t.transactions, kinds)


def scored_report(t: Tables) -> DataFrame:
    return report.with_score(report.quality_report(t.events, t.transactions, t.users))


def extracts_valid(t: Tables) -> DataFrame:
    """The rules of the four extracts, over the extracts as they were stored."""
    get = t.marts.get
    return contracts.export_validation(
        get("export_daily_kpi", lambda: t.export_kpi),
        get("export_retention", lambda: t.curve),
        get("export_funnel", lambda: funnels.export_funnel(t.events)),
        get("export_txn_summary", lambda: revenue.export_txn_summary(t.transactions)),
    )


def listed(df: DataFrame, column: str) -> DataFrame:
    """An array of names as sorted text, to compare across engines."""
    return df.withColumn(column, F.array_join(F.sort_array(column), ","))


_QUALITY = {
    "d1_event_id_not_null": lambda t: event_rule(t, "events_not_null_event_id"),
    "d2_event_id_unique": lambda t: checks.duplicates(t.events, "event_id"),
    "d3_event_name_in_taxonomy": lambda t: checks.outside_set(
        t.events, "event_name", V.EVENT_NAMES
    ),
    "d4_platform_in_set": lambda t: checks.outside_set(t.events, "platform", V.PLATFORMS),
    "d5_event_timestamp_not_null": lambda t: event_rule(t, "events_not_null_timestamp"),
    "d6_user_id_null_rate": lambda t: checks.null_rate(t.events, "user_id"),
    "d7_transaction_id_not_null": lambda t: txn_rule(t, "txn_not_null_transaction_id"),
    "d8_transaction_id_unique": lambda t: checks.duplicates(t.transactions, "transaction_id"),
    "d9_amount_positive": lambda t: txn_rule(t, "txn_positive_amount"),
    "d10_fee_not_negative": lambda t: txn_rule(t, "txn_non_negative_fee"),
    "d11_status_in_set": lambda t: checks.outside_set(
        t.transactions, "status", V.TRANSACTION_STATUSES
    ),
    "d12_type_in_set": lambda t: checks.outside_set(
        t.transactions, "transaction_type", V.TRANSACTION_TYPES
    ),
    "d13_amount_at_least_fee": lambda t: txn_rule(t, "txn_amount_gte_fee"),
    "d14_transaction_users_exist": lambda t: checks.orphans(t.transactions, t.users, "user_id"),
    "d15_daily_volume_anomaly": lambda t: checks.volume_anomalies(
        checks.daily_events(t.events)
    ),
    "d16_row_count_between": lambda t: suite(t, "row_count_between"),
    "d17_not_null": lambda t: suite(t, "not_null"),
    "d18_unique": lambda t: suite(t, "unique"),
    "d19_in_set": lambda t: suite(t, "in_set"),
    "d20_match_regex": lambda t: suite(t, "match_regex"),
    "d21_unique_proportion_between": lambda t: suite(t, "unique_proportion_between"),
    "d22_between": lambda t: suite(t, "between"),
    "d23_pair_greater": lambda t: suite(t, "pair_greater"),
    "d24_source_tests": lambda t: suites.source_tests(t.events, t.transactions, t.users),
    "d25_dau_positive": lambda t: contracts.dau_positive(t.daily_kpi),
    "d26_revenue_not_negative": lambda t: contracts.revenue_not_negative(t.revenue),
    "d27_freshness": lambda t: monitors.freshness(t.events, t.transactions, AS_OF),
    "d28_latest_day_volume": lambda t: monitors.latest_day_volume(t.events),
    "d29_latest_success_rate": lambda t: monitors.latest_success_rate(t.transactions),
    "d30_schema_drift": lambda t: monitors.schema_drift(t.events, old_snapshot(t), "events"),
    "d31_export_validation": extracts_valid,
    "d32_dau_within_mau": lambda t: contracts.dau_within_mau(activity.stickiness(t.events)),
    "d33_gmv_parts_add_up": lambda t: contracts.gmv_parts_add_up(t.daily_kpi),
    "d34_retention_decreases": lambda t: contracts.retention_decreases(t.retention),
    "d35_conversion_in_range": lambda t: contracts.conversion_in_range(t.funnel),
    "d36_schema_compliance": lambda t: listed(
        monitors.schema_compliance(t.events), "violations"
    ),
    "d37_future_timestamp": lambda t: monitors.future_timestamp(t.events),
    "d38_day_over_day_volume": lambda t: monitors.day_over_day_volume(t.events),
    "d39_null_rate_by_column": lambda t: monitors.null_rate_by_column(t.events),
    "d40_quality_report": scored_report,
    # The derived tables number their events, so the id format is left out of the score.
    "d41_dq_score": lambda t: report.dq_score(t.events, event_id_pattern=None),
    "d42_alert_level": lambda t: report.alert_level(
        report.report_summary(report.quality_report(t.events, t.transactions, t.users))
    ),
    "d43_metric_anomaly": lambda t: anomaly.metric_anomaly(t.transactions),
    "d44_required_properties": lambda t: listed(
        monitors.required_properties(t.events), "missing"
    ),
}

QUALITY_QUERIES = {key: on_tables(fn) for key, fn in _QUALITY.items()}
