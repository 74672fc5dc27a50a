"""The three raw tables, derived from the driver's tables by one set of SQL expressions.

Both engines read the same expression text, so a Spark query and its twin see equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns used of the driver's tables. Given schemas save a look into the files.
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "customer": "c_custkey bigint",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double",
}

EVENT_STEP = """CASE event_type WHEN 'signup' THEN 1 + event_id % 4
    WHEN 'click' THEN CASE WHEN event_id % 4 = 0 THEN 5 END
    WHEN 'purchase' THEN CASE WHEN event_id % 4 < 2 THEN 6 END END"""

# A filter on the name repeats this text in the plan, and a long text makes generated methods
# too large to be compiled well: the steps are folded into the types, ``step`` is used once.
EVENT_NAME = """CASE WHEN event_id % 211 = 5 THEN 'legacy_unknown'
    WHEN step > user_id % 7 THEN 'screen_exited'
    ELSE CASE event_type
    WHEN 'view' THEN CASE event_id % 2 WHEN 0 THEN 'auth_login_completed'
        ELSE 'screen_viewed' END
    WHEN 'click' THEN CASE event_id % 4 WHEN 0 THEN 'payment_transfer_started'
        WHEN 1 THEN 'payment_transfer_confirmed' WHEN 2 THEN 'system_push_received'
        ELSE 'system_push_clicked' END
    WHEN 'purchase' THEN CASE event_id % 4 WHEN 2 THEN 'payment_qr_completed'
        WHEN 3 THEN 'payment_charge_completed' ELSE 'payment_transfer_completed' END
    WHEN 'signup' THEN CASE event_id % 4 WHEN 0 THEN 'auth_signup_started'
        WHEN 1 THEN 'auth_signup_submitted' WHEN 2 THEN 'auth_signup_completed'
        ELSE 'auth_identity_verified' END
    ELSE CASE event_id % 2 WHEN 0 THEN 'payment_transfer_failed'
        ELSE 'system_error_occurred' END END END"""

EVENT_COLUMNS = {
    "event_id": "CAST(event_id AS STRING)",
    "event_name": "event_name",
    "event_timestamp": "ts",
    "received_at": """ts + CAST(CASE WHEN copy_no = 1 THEN 3 WHEN event_id % 50 = 0 THEN 600
        ELSE event_id % 3 END AS INT) * INTERVAL '1' SECOND""",
    "user_id": """CASE WHEN event_id % 50 = 7 THEN NULL ELSE
        CASE WHEN user_id % 13 = 12 THEN 'usr_test' ELSE 'usr_' END
        || CAST(user_id AS STRING) END""",
    "session_id": """CASE WHEN event_id % 101 = 3 THEN NULL
        ELSE 'sess_' || CAST(event_id AS STRING) END""",
    "device_id": "'dev_' || CAST(user_id AS STRING)",
    "platform": """CASE WHEN (user_id + event_id % 2) % 10 < 5 THEN 'ios'
        WHEN (user_id + event_id % 2) % 10 < 9 THEN 'android' ELSE 'web' END""",
    "app_version": """CASE WHEN event_id % 97 = 0 THEN '3.2'
        WHEN event_id % 2 = 0 THEN '3.2.1' ELSE '3.1.9' END""",
    "os_version": "CASE WHEN user_id % 2 = 0 THEN 'iOS 17.2' ELSE 'Android 14' END",
    "device_model": "CASE WHEN user_id % 2 = 0 THEN 'iPhone 15' ELSE 'Pixel 8' END",
    "prop_amount": """CASE WHEN event_name LIKE 'payment%completed'
        THEN CAST(ROUND(value * 100) AS BIGINT) END""",
    "prop_fee": """CASE WHEN event_name = 'payment_transfer_completed'
        THEN CAST(500 * (event_id % 2) AS BIGINT) END""",
    "prop_latency_ms": """CASE WHEN event_name = 'payment_transfer_completed'
        THEN CAST(150 + event_id % 650 AS INT) END""",
    "prop_screen_name": """CASE WHEN event_name LIKE 'screen%' THEN
        CASE event_id % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'qr_scan' ELSE 'my_page' END END""",
    "prop_merchant_id": """CASE WHEN event_name = 'payment_qr_completed'
        THEN 'mrc_' || CAST(event_id % 40 AS STRING) END""",
    "prop_merchant_category": """CASE WHEN event_name = 'payment_qr_completed' THEN
        CASE event_id % 3 WHEN 0 THEN 'cafe' WHEN 1 THEN 'grocery' ELSE 'restaurant' END END""",
    "prop_error_code": """CASE WHEN event_type = 'error'
        THEN 'TRF_' || CAST(event_id % 3 AS STRING) END""",
    "prop_signup_method": """CASE WHEN event_name LIKE 'auth_signup%' THEN
        CASE user_id % 2 WHEN 0 THEN 'phone' ELSE 'email' END END""",
    "prop_transfer_type": """CASE WHEN event_name = 'payment_transfer_completed' THEN
        CASE event_id % 3 WHEN 0 THEN 'scheduled' ELSE 'instant' END END""",
    "prop_duration_ms": "CASE WHEN event_name = 'screen_exited' THEN 3000 + event_id % 57000 END",
    "prop_referrer": """CASE WHEN event_name IN ('auth_signup_started', 'auth_signup_completed') THEN
        CASE user_id % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'friend_invite' END END""",
    "prop_campaign_id": """CASE WHEN event_name LIKE 'system_push%'
        THEN 'camp_' || CAST(event_id % 9 AS STRING) END""",
    "prop_login_method": """CASE WHEN event_name = 'auth_login_completed' AND event_id % 10 <> 0
        THEN CASE event_id % 3 WHEN 0 THEN 'pin' ELSE 'biometric' END END""",
}

USER_FILTER = "c_custkey % 50 <> 49"
USER_COLUMNS = {
    "user_id": """CASE WHEN c_custkey % 13 = 12 THEN 'usr_test' ELSE 'usr_' END
        || CAST(c_custkey AS STRING)""",
    "device_id": "'dev_' || CAST(c_custkey AS STRING)",
    "platform": """CASE WHEN c_custkey % 10 < 5 THEN 'ios'
        WHEN c_custkey % 10 < 9 THEN 'android' ELSE 'web' END""",
    "device_model": "CASE WHEN c_custkey % 2 = 0 THEN 'iPhone 15' ELSE 'Pixel 8' END",
    "signup_date": "CAST(DATE '2023-12-25' + CAST(c_custkey % 28 AS INT) AS DATE)",
    "signup_method": """CASE c_custkey % 4 WHEN 0 THEN 'phone' WHEN 1 THEN 'email'
        WHEN 2 THEN 'social_kakao' ELSE 'social_apple' END""",
}

TRANSACTION_HELPERS = {
    "status": """CASE WHEN (o_orderkey * 7 + o_custkey) % 100 < 93 THEN 'completed'
        WHEN (o_orderkey * 7 + o_custkey) % 100 < 97 THEN 'failed'
        WHEN (o_orderkey * 7 + o_custkey) % 100 < 99 THEN 'pending' ELSE 'cancelled' END""",
    "transaction_type": """CASE WHEN o_orderkey % 20 < 10 THEN 'transfer'
        WHEN o_orderkey % 20 < 15 THEN 'qr_payment'
        WHEN o_orderkey % 20 < 18 THEN 'charge' ELSE 'withdraw' END""",
    "base_amount": """CAST(FLOOR(o_totalprice) AS BIGINT)
        * CASE WHEN o_orderkey % 200 = 1 THEN 200 ELSE 1 END""",
    "created_at": """{ntz} '2023-12-01 00:00:00'
        + CAST(o_orderkey * 37 % 129600 AS INT) * INTERVAL '1' MINUTE""",
}
_BANKS = ["088", "004", "003", "011", "020", "090", "092"]


def _bank(prefix: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{prefix}{b}'" for i, b in enumerate(_BANKS[:-1]))
    return f"CASE o_custkey % 7 {whens} ELSE '{prefix}{_BANKS[-1]}' END"


TRANSACTION_COLUMNS = {
    "transaction_id": "'txn_' || CAST(o_orderkey AS STRING)",
    "user_id": """CASE WHEN o_custkey % 13 = 12 THEN 'usr_test' ELSE 'usr_' END
        || CAST(o_custkey AS STRING)""",
    "transaction_type": "transaction_type",
    "amount": "CASE WHEN o_orderkey % 500 = 3 THEN -base_amount ELSE base_amount END",
    "fee": """CASE WHEN o_orderkey % 41 = 0 THEN NULL
        WHEN base_amount >= 100000 AND o_orderkey % 3 = 0
        THEN CAST(300 + 200 * (o_orderkey % 2) AS BIGINT) ELSE CAST(0 AS BIGINT) END""",
    "currency": "'KRW'",
    "status": "status",
    "bank_code": _bank(""),
    "bank_name": _bank("bank_"),
    "created_at": "created_at",
    "completed_at": """CASE WHEN status = 'completed'
        THEN created_at + CAST(1 + o_orderkey % 5 AS INT) * INTERVAL '1' SECOND END""",
    "error_code": """CASE WHEN status = 'failed'
        THEN 'ERR_' || CAST(100 + o_orderkey % 5 AS STRING) END""",
    "merchant_id": """CASE WHEN transaction_type = 'qr_payment'
        THEN 'mrc_' || CAST(o_orderkey % 40 AS STRING) END""",
    "merchant_category": """CASE WHEN transaction_type = 'qr_payment' THEN
        CASE o_orderkey % 3 WHEN 0 THEN 'cafe' WHEN 1 THEN 'grocery'
        ELSE 'restaurant' END END""",
}


def _items(columns: dict[str, str], engine: str) -> list[str]:
    ntz = "TIMESTAMP_NTZ" if engine == "spark" else "TIMESTAMP"
    return [f"{expr.replace('{ntz}', ntz)} AS {name}" for name, expr in columns.items()]


# --- Spark side ---------------------------------------------------------------


def events_from(rows: DataFrame) -> DataFrame:
    """``rows``: the driver's events, as a batch or a stream. Resends come from a Generate,
    so the table is read once; the name is computed below it, once per source row."""
    copies = "explode(CASE WHEN event_id % 400 = 9 THEN array(0, 1) ELSE array(0) END) AS copy_no"
    return (
        rows.selectExpr("*", f"{EVENT_STEP} AS step")
        .selectExpr("*", f"{EVENT_NAME} AS event_name")
        .selectExpr("*", copies)
        .selectExpr(*_items(EVENT_COLUMNS, "spark"))
    )


def transactions_from(rows: DataFrame) -> DataFrame:
    helped = rows.selectExpr("*", *_items(TRANSACTION_HELPERS, "spark"))
    return helped.selectExpr(*_items(TRANSACTION_COLUMNS, "spark"))


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from(source(spark, sf_dir, "events"))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = source(spark, sf_dir, "customer")
    return customers.where(USER_FILTER).selectExpr(*_items(USER_COLUMNS, "spark"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from(source(spark, sf_dir, "orders"))


# --- DuckDB side ----------------------------------------------------------------


def duckdb_ctes() -> dict[str, str]:
    def listed(columns: dict[str, str]) -> str:
        return ",\n  ".join(_items(columns, "duckdb"))

    return {
        "stepped_events": f"SELECT *, {EVENT_STEP} AS step FROM events",
        "copied_events": f"""SELECT *, {EVENT_NAME} AS event_name, 0 AS copy_no FROM stepped_events
            UNION ALL
            SELECT *, {EVENT_NAME} AS event_name, 1 AS copy_no FROM stepped_events
            WHERE event_id % 400 = 9""",
        "raw_events": f"SELECT {listed(EVENT_COLUMNS)} FROM copied_events",
        "raw_users": f"SELECT {listed(USER_COLUMNS)} FROM customer WHERE {USER_FILTER}",
        "helped_orders": f"SELECT *, {listed(TRANSACTION_HELPERS)} FROM orders",
        "raw_transactions": f"SELECT {listed(TRANSACTION_COLUMNS)} FROM helped_orders",
    }
