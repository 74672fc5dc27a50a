"""The scored report, the data-quality score and the alert level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import labelled, pct
from kpiweave.quality.checks import run_checks
from kpiweave.quality.monitors import broken_rules, envelope_rules, missing_field, on_time


#: the columns that each check reads, by table
CHECK_COLUMNS = {
    "events_not_null_event_id": [("events", "event_id")],
    "events_unique_event_id": [("events", "event_id")],
    "events_valid_event_name": [("events", "event_name")],
    "events_valid_platform": [("events", "platform")],
    "events_not_null_timestamp": [("events", "event_timestamp")],
    "events_null_rate_user_id": [("events", "user_id")],
    "events_daily_volume_anomaly": [("events", "event_timestamp")],
    "txn_not_null_transaction_id": [("transactions", "transaction_id")],
    "txn_unique_transaction_id": [("transactions", "transaction_id")],
    "txn_positive_amount": [("transactions", "amount")],
    "txn_non_negative_fee": [("transactions", "fee")],
    "txn_valid_status": [("transactions", "status")],
    "txn_valid_type": [("transactions", "transaction_type")],
    "txn_amount_gte_fee": [("transactions", "amount"), ("transactions", "fee")],
    "txn_users_exist": [("transactions", "user_id"), ("users", "user_id")],
}
COLUMN_TYPES = {"event_timestamp": "timestamp_ntz", "amount": "bigint", "fee": "bigint"}


def quality_report(events: DataFrame, transactions: DataFrame, users: DataFrame) -> DataFrame:
    """One row per check: name, expectation, severity, passed, details, violations.

    A check whose columns are not there fails by itself, with the reason; the others go on.
    """
    tables = {"events": events, "transactions": transactions, "users": users}
    broken: dict[str, str] = {}
    for check, needs in CHECK_COLUMNS.items():
        for name, column in needs:
            if column not in tables[name].columns:
                broken.setdefault(check, f"Error: no column {column} in {name}")
    for name, column in {need for needs in CHECK_COLUMNS.values() for need in needs}:
        if column not in tables[name].columns:
            nothing = F.lit(None).cast(COLUMN_TYPES.get(column, "string"))
            tables[name] = tables[name].withColumn(column, nothing)
    results = run_checks(tables["events"], tables["transactions"], tables["users"])
    name, n = F.col("check_name"), F.col("violations")
    failed = F.concat(n.cast("string"), F.lit(V.CHECK_FAILED))
    if broken:
        error = labelled(name, broken)
        return results.select(
            name,
            labelled(name, {k: text for k, (text, _) in V.CHECKS.items()}).alias("expectation"),
            labelled(name, {k: level for k, (_, level) in V.CHECKS.items()}).alias("severity"),
            (error.isNull() & (n == 0)).alias("passed"),
            F.coalesce(error, F.when(n == 0, V.CHECK_PASSED).otherwise(failed)).alias("details"),
            F.when(error.isNull(), n).alias("violations"),
        )
    return results.select(
        name,
        labelled(name, {k: text for k, (text, _) in V.CHECKS.items()}).alias("expectation"),
        labelled(name, {k: severity for k, (_, severity) in V.CHECKS.items()}).alias("severity"),
        (n == 0).alias("passed"),
        F.when(n == 0, V.CHECK_PASSED).otherwise(failed).alias("details"),
        n,
    )


def _totals() -> list:
    critical = ~F.col("passed") & (F.col("severity") == "critical")
    return [
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        pct(F.count_if("passed"), F.count("*"), 1).alias("quality_score"),
        F.count_if(critical).alias("critical_failed"),
    ]


def report_summary(report: DataFrame) -> DataFrame:
    """total_checks, passed, failed, quality_score and how many critical checks failed."""
    return report.agg(*_totals())


def report_document(report: DataFrame, run_at: str) -> DataFrame:
    """The totals with the list of the fifteen check results, as one row."""
    run = F.lit(run_at)
    result = F.struct(*report.columns, run.alias("run_at"))
    document = report.agg(*_totals(), F.sort_array(F.collect_list(result)).alias("results"))
    return document.select(run.alias("run_timestamp"), "*")


def with_score(report: DataFrame) -> DataFrame:
    """The report with the score beside every check; fifteen rows, so one window is fine."""
    everything = Window.partitionBy()
    passed = F.count_if("passed").over(everything)
    return report.withColumn("quality_score", pct(passed, F.count("*").over(everything), 1))


def alert_level(summary: DataFrame, critical_below: float = 80.0, warning_below: float = 90.0):
    """score, level: by the score, and critical whenever a critical check failed."""
    score = F.col("quality_score")
    level = (
        F.when((score < critical_below) | (F.col("critical_failed") > 0), "critical")
        .when(score < warning_below, "warning")
        .otherwise("none")
    )
    return summary.select(score.alias("score"), level.alias("level"))


def dq_score(
    events: DataFrame,
    event_id_pattern: str | None = V.UUID_PATTERN,
    on_time_seconds: float = 300.0,
) -> DataFrame:
    """Weighted score of completeness, uniqueness, envelope compliance and timeliness.

    Completeness is over the required envelope fields. The row measures take one scan; the
    duplicate rate takes one key shuffle.
    """
    flat = any(c.startswith("prop_") for c in events.columns)
    required = [c for c in V.ENVELOPE_REQUIRED if c != "event_properties" or not flat]
    nulls = F.sum(sum(missing_field(events, c).cast("int") for c in required))
    broken = broken_rules(envelope_rules(events, event_id_pattern))
    rows = events.agg(
        F.count("*").alias("_rows"),
        nulls.alias("_nulls"),
        F.count_if(F.size(broken) == 0).alias("_compliant"),
        F.count_if(on_time(on_time_seconds)).alias("_on_time"),
    )
    ids = (
        events.where(F.col("event_id").isNotNull())
        .groupBy("event_id")
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))
    )

    def rate(part, times: int = 1):
        return F.try_divide(F.col(part).cast("double"), (F.col("_rows") * times).cast("double"))

    measured = rows.withColumn("_copies", ids.scalar()).select(
        rate("_nulls", len(required)).alias("null_rate"),
        rate("_copies").alias("duplicate_rate"),
        rate("_compliant").alias("compliance_rate"),
        rate("_on_time").alias("timeliness_rate"),
    )
    score = (
        (1 - F.col("null_rate")) * 0.3
        + (1 - F.col("duplicate_rate")) * 0.2
        + F.col("compliance_rate") * 0.3
        + F.col("timeliness_rate") * 0.2
    )
    digits = [F.round(c, 6).alias(c) for c in measured.columns]
    return measured.select(*digits, F.round(score, 4).alias("dq_score"))
