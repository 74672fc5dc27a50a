"""The two expectation suites and the source tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.operators import expectations as X

# --- Fixed values: what the suites demand ---------------------------------------
EVENTS_SUITE = [
    X.row_count_between(100_000, 10_000_000),
    X.not_null("event_id"),
    X.unique("event_id"),
    X.not_null("event_name"),
    X.in_set("event_name", V.EVENT_NAMES),
    X.not_null("event_timestamp"),
    X.in_set("platform", V.PLATFORMS),
    X.match_regex("app_version", V.APP_VERSION_PATTERN),
    X.unique_proportion_between("user_id", 0.001, 1.0),
    X.not_null("session_id", mostly=0.99),
]
TRANSACTIONS_SUITE = [
    X.row_count_between(50_000, 5_000_000),
    X.not_null("transaction_id"),
    X.unique("transaction_id"),
    X.not_null("user_id"),
    X.in_set("transaction_type", V.TRANSACTION_TYPES),
    X.between("amount", 1, 100_000_000),
    X.between("fee", 0, 10_000),
    X.in_set("status", V.TRANSACTION_STATUSES),
    X.in_set("currency", V.CURRENCIES),
    X.not_null("created_at"),
    X.pair_greater("amount", "fee", or_equal=True),
]
SOURCE_TESTS = {
    "events": [X.not_null("event_id"), X.not_null("event_name")],
    "transactions": [X.not_null("transaction_id"), X.unique("transaction_id")],
    "users": [X.not_null("user_id"), X.unique("user_id")],
}
# ----------------------------------------------------------------------------------


def _named(table: str, results: DataFrame) -> DataFrame:
    return results.select(F.lit(table).alias("table"), "*")


def run_suites(
    events: DataFrame, transactions: DataFrame, kinds: Sequence[str] | None = None
) -> DataFrame:
    """table, expectation, column, success, observed; optionally some kinds only."""
    parts = []
    tables = (
        ("events", events, EVENTS_SUITE),
        ("transactions", transactions, TRANSACTIONS_SUITE),
    )
    for table, df, suite in tables:
        chosen = [e for e in suite if kinds is None or e.kind in kinds]
        if chosen:
            parts.append(_named(table, X.evaluate(df, chosen)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def source_tests(events: DataFrame, transactions: DataFrame, users: DataFrame) -> DataFrame:
    """table, check, column, ok for the raw tables."""
    out = None
    for table, df in (("events", events), ("transactions", transactions), ("users", users)):
        part = _named(table, X.evaluate(df, SOURCE_TESTS[table]))
        out = part if out is None else out.unionByName(part)
    return out.select(
        "table", F.col("expectation").alias("check"), "column", F.col("success").alias("ok")
    )
