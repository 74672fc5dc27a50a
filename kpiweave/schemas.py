"""Explicit schemas of the raw files. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()

# Times arrive as ISO-8601 text in UTC and are cast on the way in.
_ENVELOPE = [
    ("event_id", S),
    ("event_name", S),
    ("event_timestamp", S),
    ("received_at", S),
    ("user_id", S),
    ("session_id", S),
    ("device_id", S),
    ("platform", S),
    ("app_version", S),
    ("os_version", S),
    ("device_model", S),
]

# Properties that become columns of the staged events; others stay in the payload.
PROPERTIES = {
    "amount": L,
    "fee": L,
    "latency_ms": I,
    "screen_name": S,
    "merchant_id": S,
    "merchant_category": S,
    "error_code": S,
    "signup_method": S,
    "transfer_type": S,
    "duration_ms": L,
    "referrer": S,
    "campaign_id": S,
    "login_method": S,
}


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


EVENTS_JSON = _struct([*_ENVELOPE, ("event_properties", T.VariantType())])

# Numbers in the flat file may read "50000.0", so properties stay text until they are cast.
EVENTS_CSV = _struct([*_ENVELOPE, *[(f"prop_{name}", S) for name in PROPERTIES]])

USERS_CSV = _struct(
    [
        ("user_id", S),
        ("device_id", S),
        ("platform", S),
        ("device_model", S),
        ("signup_date", T.DateType()),
        ("signup_method", S),
    ]
)

TRANSACTIONS_CSV = _struct(
    [
        ("transaction_id", S),
        ("user_id", S),
        ("transaction_type", S),
        ("amount", S),
        ("fee", S),
        ("currency", S),
        ("status", S),
        ("bank_code", S),
        ("bank_name", S),
        ("created_at", S),
        ("completed_at", S),
        ("error_code", S),
        ("merchant_id", S),
        ("merchant_category", S),
    ]
)
