"""Cleaned views of the three raw tables. One projection and one filter each, no shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import (
    kst,
    labelled,
    month_start,
    safe_int,
    safe_long,
    seconds_between,
    week_start,
    weekday0,
)

NTZ = "timestamp_ntz"


def not_test_account(name: str = "user_id"):
    """Drops test accounts, and rows without a user (NULL is not "unlike" anything)."""
    return ~F.col(name).startswith(V.TEST_ACCOUNT_PREFIX)


def _text(events: DataFrame, name: str):
    """A property as text; NULL where the events have no such column."""
    there = f"prop_{name}" in events.columns
    return (F.col(f"prop_{name}") if there else F.lit(None).cast("string")).alias(name)


def stg_events(events: DataFrame, tz_offset_hours: int = 9) -> DataFrame:
    utc = F.col("event_timestamp").try_cast(NTZ)
    local = kst(utc, tz_offset_hours)
    return events.where(not_test_account() & F.col("event_name").isNotNull()).select(
        "event_id",
        "event_name",
        utc.alias("event_timestamp_utc"),
        local.alias("event_timestamp_kst"),
        local.cast("date").alias("event_date_kst"),
        F.hour(local).alias("event_hour_kst"),
        F.col("received_at").try_cast(NTZ).alias("received_at"),
        "user_id",
        "session_id",
        "device_id",
        "platform",
        "app_version",
        "os_version",
        "device_model",
        F.split_part("event_name", F.lit("_"), F.lit(1)).alias("event_domain"),
        safe_long(events, "prop_amount").alias("amount"),
        F.col("prop_screen_name").alias("screen_name"),
        F.col("prop_merchant_id").alias("merchant_id"),
        F.col("prop_merchant_category").alias("merchant_category"),
        F.col("prop_error_code").alias("error_code"),
        F.col("prop_signup_method").alias("signup_method"),
        F.col("prop_transfer_type").alias("transfer_type"),
        safe_long(events, "prop_fee").alias("fee"),
        safe_int(events, "prop_latency_ms").alias("latency_ms"),
        *[_text(events, name) for name in ("referrer", "campaign_id", "login_method")],
    )


def stg_transactions(transactions: DataFrame) -> DataFrame:
    created = F.col("created_at").try_cast(NTZ)
    completed = F.col("completed_at").try_cast(NTZ)
    day = created.cast("date")
    # Only positive amounts pass, so their absolute value is the amount itself.
    return transactions.where((F.col("amount") > 0) & F.col("user_id").isNotNull()).select(
        "transaction_id",
        "user_id",
        "transaction_type",
        F.col("amount").cast("bigint").alias("amount"),
        F.coalesce(F.col("fee"), F.lit(0)).cast("bigint").alias("fee"),
        "currency",
        "status",
        labelled(F.col("status"), V.STATUS_LABELS, V.STATUS_LABEL_OTHER).alias("status_label"),
        "bank_code",
        "bank_name",
        created.alias("created_at"),
        day.alias("transaction_date"),
        month_start(day).alias("transaction_month"),
        F.hour(created).alias("transaction_hour"),
        weekday0(day).alias("transaction_dow"),
        completed.alias("completed_at"),
        seconds_between(created, completed).alias("processing_seconds"),
        "error_code",
        "merchant_id",
        "merchant_category",
    )


def stg_users(users: DataFrame, as_of_date: dt.date) -> DataFrame:
    signup = F.col("signup_date").cast("date")
    return users.where(not_test_account()).select(
        "user_id",
        "device_id",
        "platform",
        "device_model",
        signup.alias("signup_date"),
        week_start(signup).alias("signup_week"),
        month_start(signup).alias("signup_month"),
        "signup_method",
        F.datediff(F.lit(as_of_date), signup).alias("days_since_signup"),
    )


def mask_pii(df: DataFrame, salt: str, columns: tuple[str, ...] = ("user_id", "device_id")):
    """Replaces identifiers by salted hashes; equal identifiers stay equal, so joins hold.

    Apply it after the test-account filter: the prefix is not visible any more.
    """
    hashed = {c: F.sha2(F.concat(F.lit(salt), F.col(c)), 256) for c in columns}
    return df.withColumns(hashed)
