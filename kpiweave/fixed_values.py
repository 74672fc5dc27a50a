"""Values that results depend on: names, enums, labels, patterns, limits."""

# --- Fixed values -----------------------------------------------------------
# The event taxonomy: every event name with the properties it must carry.
REQUIRED_PROPERTIES = {
    "auth_signup_started": ["device_type", "referrer"],
    "auth_signup_submitted": ["signup_method"],
    "auth_signup_completed": ["user_id", "signup_method"],
    "auth_login_attempted": ["login_method"],
    "auth_login_completed": ["user_id", "login_method"],
    "auth_identity_verified": ["verification_type"],
    "payment_transfer_started": [],
    "payment_transfer_amount_entered": ["amount"],
    "payment_transfer_confirmed": ["amount", "recipient_type"],
    "payment_transfer_completed": ["amount", "fee", "transfer_type"],
    "payment_transfer_failed": ["error_code", "error_message"],
    "payment_charge_completed": ["amount", "charge_method"],
    "payment_withdraw_completed": ["amount"],
    "payment_qr_scanned": ["merchant_id"],
    "payment_qr_completed": ["amount", "merchant_id"],
    "product_list_viewed": ["category"],
    "product_detail_viewed": ["product_id", "product_type"],
    "product_compared": ["product_ids"],
    "product_applied": ["product_id"],
    "product_application_completed": ["product_id"],
    "screen_viewed": ["screen_name"],
    "screen_exited": ["screen_name", "duration_ms"],
    "screen_tab_clicked": ["tab_name"],
    "screen_banner_clicked": ["banner_id", "position"],
    "screen_search_performed": ["query", "results_count"],
    "system_error_occurred": ["error_code", "error_type"],
    "system_push_received": ["push_type", "campaign_id"],
    "system_push_clicked": ["push_type", "campaign_id"],
}

LOGIN = "auth_login_completed"
LOGIN_ATTEMPT = "auth_login_attempted"
SIGNUP_DONE = "auth_signup_completed"
TRANSFER_DONE = "payment_transfer_completed"
TRANSFER_CONFIRMED = "payment_transfer_confirmed"
QR_DONE = "payment_qr_completed"
CHARGE_DONE = "payment_charge_completed"
COMPLETED_PAYMENTS = [
    "payment_transfer_completed",
    "payment_charge_completed",
    "payment_withdraw_completed",
    "payment_qr_completed",
]
ERROR_EVENTS = ["payment_transfer_failed", "system_error_occurred"]

PLATFORMS = ["ios", "android", "web"]
TRANSACTION_TYPES = ["transfer", "qr_payment", "charge", "withdraw"]
TRANSACTION_STATUSES = ["completed", "failed", "pending", "cancelled"]
CURRENCIES = ["KRW"]

# The signup funnel: event name and printed label of each step, in order.
FUNNEL = [
    ("auth_signup_started", "Step 1: 가입 시작"),
    ("auth_signup_submitted", "Step 2: 정보 제출"),
    ("auth_signup_completed", "Step 3: 가입 완료"),
    ("auth_identity_verified", "Step 4: 본인인증"),
    ("payment_transfer_started", "Step 5: 첫 송금 시도"),
    ("payment_transfer_completed", "Step 6: 첫 송금 완료"),
]

STATUS_LABELS = {
    "completed": "완료",
    "failed": "실패",
    "pending": "처리중",
    "cancelled": "취소",
}
STATUS_LABEL_OTHER = "기타"

# Sunday first, as day-of-week 0..6.
DAY_LABELS = ["일", "월", "화", "수", "목", "금", "토"]

RETENTION_DAYS = [1, 3, 7, 14, 30]

# Monthly fee from which a user belongs to a tier, highest first.
TIERS = [
    (2000, "Heavy (₩2,000+)"),
    (500, "Medium (₩500~2,000)"),
    (1, "Light (₩1~500)"),
]
TIER_FREE = "Free"

# Lower bound of a retention rate (percent) and its band, highest first.
RETENTION_BANDS = [(60, "양호"), (30, "보통"), (None, "주의")]

ALERT = "🔴 ALERT"
OK = "✅ OK"
HIGH_VALUE_LABEL = "⚠️ 고액 거래"
ERROR_SURGE_LABEL = "🔴 에러 급증"
SURGE_UP = "📈 급증"
SURGE_DOWN = "📉 급감"

TEST_ACCOUNT_PREFIX = "usr_test"
USER_ID_PATTERN = "^usr_[a-zA-Z0-9]+$"
SESSION_ID_PATTERN = "^sess_[a-zA-Z0-9]+$"
DEVICE_ID_PATTERN = "^dev_[a-zA-Z0-9]+$"
APP_VERSION_PATTERN = r"^\d+\.\d+\.\d+$"
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

ENVELOPE = [
    "event_id",
    "event_name",
    "event_timestamp",
    "received_at",
    "user_id",
    "session_id",
    "device_id",
    "platform",
    "app_version",
    "os_version",
    "device_model",
    "event_properties",
]
ENVELOPE_REQUIRED = [
    "event_id",
    "event_name",
    "event_timestamp",
    "received_at",
    "session_id",
    "device_id",
    "platform",
    "app_version",
    "event_properties",
]

# The standing checks: name -> (expectation as printed in the report, severity).
CHECKS = {
    "events_not_null_event_id": ("event_id should never be NULL", "critical"),
    "events_unique_event_id": ("event_id should be unique (no duplicates)", "critical"),
    "events_valid_event_name": ("event_name should be in the defined taxonomy", "critical"),
    "events_valid_platform": ("platform should be ios, android, or web", "warning"),
    "events_not_null_timestamp": ("event_timestamp should never be NULL", "critical"),
    "events_null_rate_user_id": ("user_id null rate should be less than 5%", "warning"),
    "txn_not_null_transaction_id": ("transaction_id should never be NULL", "critical"),
    "txn_unique_transaction_id": ("transaction_id should be unique", "critical"),
    "txn_positive_amount": ("amount should be positive", "critical"),
    "txn_non_negative_fee": ("fee should be non-negative", "critical"),
    "txn_valid_status": ("status should be in the valid set", "critical"),
    "txn_valid_type": ("transaction_type should be in the valid set", "warning"),
    "txn_amount_gte_fee": ("amount should always be >= fee", "warning"),
    "txn_users_exist": ("All transaction user_ids should exist in users table", "warning"),
    "events_daily_volume_anomaly": (
        "Daily event volume should not deviate more than 3 std from mean",
        "warning",
    ),
}
CHECK_PASSED = "No violations found"
CHECK_FAILED = " violations found"

# Stated targets of the headline metrics (percent, won, users).
TARGETS = {
    "dau": 100_000.0,
    "signup_conversion_7d": 40.0,
    "retention_d1": 60.0,
    "retention_d7": 40.0,
    "retention_d30": 25.0,
    "arppu": 2_500.0,
    "monthly_gmv": 50_000_000_000.0,
}
# --- End of fixed values ----------------------------------------------------

EVENT_NAMES = list(REQUIRED_PROPERTIES)
FUNNEL_EVENTS = [name for name, _ in FUNNEL]
FUNNEL_LABELS = [text for _, text in FUNNEL]
