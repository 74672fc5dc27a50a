"""Hand-made raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

EVENTS = (
    "event_id string, event_name string, event_timestamp timestamp_ntz, received_at timestamp_ntz,"
    " user_id string, session_id string, device_id string, platform string, app_version string,"
    " os_version string, device_model string, prop_amount {amount}, prop_fee bigint,"
    " prop_latency_ms int, prop_screen_name string, prop_merchant_id string,"
    " prop_merchant_category string, prop_error_code string, prop_signup_method string,"
    " prop_transfer_type string, prop_duration_ms bigint"
)
USERS = (
    "user_id string, device_id string, platform string, device_model string, signup_date date,"
    " signup_method string"
)
TRANSACTIONS = (
    "transaction_id string, user_id string, transaction_type string, amount bigint, fee bigint,"
    " currency string, status string, bank_code string, bank_name string,"
    " created_at timestamp_ntz, completed_at timestamp_ntz, error_code string,"
    " merchant_id string, merchant_category string"
)
AS_OF = dt.date(2024, 2, 28)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def events(spark: SparkSession, rows: list[dict], amount: str = "bigint") -> DataFrame:
    full = []
    for i, row in enumerate(rows):
        at = row["event_timestamp"] = ts(row["at"])
        base = {
            "event_id": f"e{i}",
            "event_name": "auth_login_completed",
            "received_at": at,
            "user_id": "usr_1",
            "session_id": f"sess_{i}",
            "device_id": "dev_1",
            "platform": "ios",
            "app_version": "1.0.0",
        }
        full.append({**base, **{k: v for k, v in row.items() if k != "at"}})
    return _frame(spark, full, EVENTS.format(amount=amount))


def users(spark: SparkSession, rows: list[dict]) -> DataFrame:
    base = {"platform": "ios", "device_id": "dev_1", "signup_method": "phone"}
    return _frame(spark, [{**base, **r} for r in rows], USERS)


def transactions(spark: SparkSession, rows: list[dict]) -> DataFrame:
    full = []
    for i, row in enumerate(rows):
        base = {
            "transaction_id": f"t{i}",
            "user_id": "usr_1",
            "transaction_type": "transfer",
            "amount": 100,
            "fee": 0,
            "currency": "KRW",
            "status": "completed",
            "created_at": ts(row["at"]),
        }
        full.append({**base, **{k: v for k, v in row.items() if k != "at"}})
    return _frame(spark, full, TRANSACTIONS)


def _frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def dicts(df: DataFrame, *order: str) -> list[dict]:
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows
