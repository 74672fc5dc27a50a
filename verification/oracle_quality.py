"""DuckDB twins of the data-quality queries."""

from __future__ import annotations

from kpiweave import fixed_values as V
from verification.fixture import EVENT_COLUMNS
from verification.oracle_base import CTES, pct, rnd
from verification.oracle_models import quoted

NAMES = quoted(V.EVENT_NAMES)
UUID = V.UUID_PATTERN
SEMVER = V.APP_VERSION_PATTERN


def _counted(table: str, name: str, where: str) -> str:
    return f"SELECT '{name}' AS check_name, COUNT(*) AS violations FROM {table} WHERE {where}"


def _outside(table: str, column: str, values) -> str:
    return f"""SELECT {column}, COUNT(*) AS cnt FROM {table}
    WHERE {column} NOT IN ({quoted(values)}) GROUP BY {column}"""


def _twice(table: str, key: str) -> str:
    return f"""SELECT {key}, COUNT(*) AS cnt FROM {table}
    GROUP BY {key} HAVING COUNT(*) > 1"""


def _expect(table: str, kind: str, column: str, observed: str, success: str) -> str:
    return f"""SELECT '{table}' AS "table", '{kind}' AS expectation, '{column}' AS "column",
      {success.format(o=observed)} AS success, CAST({observed} AS DOUBLE) AS observed
    FROM raw_{table}"""


def _present(table: str, column: str, mostly: float = 1.0) -> str:
    rate = f"CAST(COUNT({column}) AS DOUBLE) / COUNT(*)"
    return _expect(table, "not_null", column, rate, f"{{o}} >= {mostly}")


def _bad(table: str, kind: str, column: str, where: str) -> str:
    return _expect(table, kind, column, f"COUNT(*) FILTER ({where})", "{o} = 0")


def _unique(table: str, column: str) -> str:
    copies = f"""(SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM raw_{table}
      WHERE {column} IS NOT NULL GROUP BY {column}) WHERE n > 1)"""
    return f"""SELECT '{table}' AS "table", 'unique' AS expectation, '{column}' AS "column",
      {copies} = 0 AS success, CAST({copies} AS DOUBLE) AS observed"""


def _all(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _in_set(table: str, column: str, values) -> str:
    return _bad(table, "in_set", column, f"{column} NOT IN ({quoted(values)})")


SOURCE_TESTS = _all(
    _present("events", "event_id"),
    _present("events", "event_name"),
    _present("transactions", "transaction_id"),
    _unique("transactions", "transaction_id"),
    _present("users", "user_id"),
    _unique("users", "user_id"),
)

_RULES = {
    **{
        f"required:{c}": f"{c} IS NULL" for c in V.ENVELOPE_REQUIRED if c != "event_properties"
    },
    "format:event_id": f"NOT regexp_matches(event_id, '{UUID}')",
    "enum:event_name": f"event_name NOT IN ({NAMES})",
    "enum:platform": f"platform NOT IN ({quoted(V.PLATFORMS)})",
    "pattern:user_id": f"NOT regexp_matches(user_id, '{V.USER_ID_PATTERN}')",
    "pattern:session_id": f"NOT regexp_matches(session_id, '{V.SESSION_ID_PATTERN}')",
    "pattern:device_id": f"NOT regexp_matches(device_id, '{V.DEVICE_ID_PATTERN}')",
    "pattern:app_version": f"NOT regexp_matches(app_version, '{SEMVER}')",
}


def _named_list(rules: dict[str, str]) -> str:
    items = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules.items())
    return f"COALESCE(array_to_string(list_sort([{items}]), ','), '')"


def _demands() -> dict[str, str]:
    names: dict[str, list[str]] = {}
    for event, properties in V.REQUIRED_PROPERTIES.items():
        for p in properties:
            names.setdefault(p, []).append(event)
    out = {}
    for p, events in names.items():
        column = p if p in V.ENVELOPE else f"prop_{p}"
        absent = f"{column} IS NULL" if column in EVENT_COLUMNS else "TRUE"
        out[p] = f"(event_name IN ({quoted(events)}) AND {absent})"
    return out


_NO_ID_FORMAT = {k: v for k, v in _RULES.items() if k != "format:event_id"}

_TXN_RULES = {
    "txn_not_null_transaction_id": "transaction_id IS NULL",
    "txn_positive_amount": "amount <= 0",
    "txn_non_negative_fee": "fee < 0",
    "txn_amount_gte_fee": "amount < fee",
}

CTES.update(
    {
        "event_days": """SELECT CAST(event_timestamp AS DATE) AS dt, COUNT(*) AS cnt
        FROM raw_events GROUP BY 1""",
        "event_day_z": """SELECT dt, cnt, m AS mean_cnt, s AS std_cnt,
          (cnt - m) / NULLIF(s, 0) AS z
        FROM event_days, (SELECT AVG(cnt) AS m, STDDEV(cnt) AS s FROM event_days)""",
        "orphan_users": """SELECT DISTINCT user_id FROM raw_transactions
        WHERE user_id NOT IN (SELECT user_id FROM raw_users)""",
        "check_results": _all(
            _counted("raw_events", "events_not_null_event_id", "event_id IS NULL"),
            _counted(
                f"({_twice('raw_events', 'event_id')})", "events_unique_event_id", "TRUE"
            ),
            _counted(
                f"({_outside('raw_events', 'event_name', V.EVENT_NAMES)})",
                "events_valid_event_name",
                "TRUE",
            ),
            _counted(
                f"({_outside('raw_events', 'platform', V.PLATFORMS)})",
                "events_valid_platform",
                "TRUE",
            ),
            _counted("raw_events", "events_not_null_timestamp", "event_timestamp IS NULL"),
            _counted(
                f"""(SELECT {pct('COUNT(*) FILTER (user_id IS NULL)', 'COUNT(*)')} AS p
                  FROM raw_events)""",
                "events_null_rate_user_id",
                "p > 5",
            ),
            _counted("raw_transactions", "txn_not_null_transaction_id", "transaction_id IS NULL"),
            _counted(
                f"({_twice('raw_transactions', 'transaction_id')})",
                "txn_unique_transaction_id",
                "TRUE",
            ),
            _counted("raw_transactions", "txn_positive_amount", "amount <= 0"),
            _counted("raw_transactions", "txn_non_negative_fee", "fee < 0"),
            _counted(
                f"({_outside('raw_transactions', 'status', V.TRANSACTION_STATUSES)})",
                "txn_valid_status",
                "TRUE",
            ),
            _counted(
                f"({_outside('raw_transactions', 'transaction_type', V.TRANSACTION_TYPES)})",
                "txn_valid_type",
                "TRUE",
            ),
            _counted("raw_transactions", "txn_amount_gte_fee", "amount < fee"),
            _counted("orphan_users", "txn_users_exist", "TRUE"),
            _counted("event_day_z", "events_daily_volume_anomaly", "abs(z) > 3"),
        ),
        "check_texts": "SELECT * FROM (VALUES "
        + ", ".join(f"('{n}', '{text}', '{sev}')" for n, (text, sev) in V.CHECKS.items())
        + ") v(check_name, expectation, severity)",
        "check_score": f"""SELECT
          {pct('COUNT(*) FILTER (violations = 0)', 'COUNT(*)', 1)} AS quality_score,
          COUNT(*) FILTER (violations > 0 AND severity = 'critical') AS critical_failed
        FROM check_results JOIN check_texts USING (check_name)""",
        "score_parts": f"""SELECT
          CAST(SUM({' + '.join(f'CAST({c} IS NULL AS INT)' for c in V.ENVELOPE_REQUIRED
                               if c != 'event_properties')}) AS DOUBLE)
            / (COUNT(*) * {len(V.ENVELOPE_REQUIRED) - 1}) AS null_rate,
          CAST(COUNT(event_id) - COUNT(DISTINCT event_id) AS DOUBLE) / COUNT(*) AS duplicate_rate,
          CAST(COUNT(*) FILTER ({_named_list(_NO_ID_FORMAT)} = '') AS DOUBLE) / COUNT(*)
            AS compliance_rate,
          CAST(COUNT(*) FILTER (epoch(received_at - event_timestamp) <= 300) AS DOUBLE) / COUNT(*)
            AS timeliness_rate
        FROM raw_events""",
    }
)

QUALITY: dict[str, str] = {
    "d1_event_id_not_null": _counted("raw_events", "events_not_null_event_id", "event_id IS NULL"),
    "d2_event_id_unique": _twice("raw_events", "event_id"),
    "d3_event_name_in_taxonomy": _outside("raw_events", "event_name", V.EVENT_NAMES),
    "d4_platform_in_set": _outside("raw_events", "platform", V.PLATFORMS),
    "d5_event_timestamp_not_null": _counted(
        "raw_events", "events_not_null_timestamp", "event_timestamp IS NULL"
    ),
    "d6_user_id_null_rate": f"""SELECT null_pct, null_pct <= 5 AS ok FROM (SELECT
      {pct('COUNT(*) FILTER (user_id IS NULL)', 'COUNT(*)')} AS null_pct FROM raw_events)""",
    "d7_transaction_id_not_null": _counted(
        "raw_transactions", "txn_not_null_transaction_id", "transaction_id IS NULL"
    ),
    "d8_transaction_id_unique": _twice("raw_transactions", "transaction_id"),
    "d9_amount_positive": _counted("raw_transactions", "txn_positive_amount", "amount <= 0"),
    "d10_fee_not_negative": _counted("raw_transactions", "txn_non_negative_fee", "fee < 0"),
    "d11_status_in_set": _outside("raw_transactions", "status", V.TRANSACTION_STATUSES),
    "d12_type_in_set": _outside("raw_transactions", "transaction_type", V.TRANSACTION_TYPES),
    "d13_amount_at_least_fee": _counted(
        "raw_transactions", "txn_amount_gte_fee", "amount < fee"
    ),
    "d14_transaction_users_exist": "SELECT user_id FROM orphan_users",
    "d15_daily_volume_anomaly": f"""SELECT dt, cnt, mean_cnt, {rnd('z')} AS zscore
    FROM event_day_z WHERE abs(z) > 3""",
    "d16_row_count_between": _all(
        _expect("events", "row_count_between", "*", "COUNT(*)", "{o} BETWEEN 100000 AND 10000000"),
        _expect(
            "transactions", "row_count_between", "*", "COUNT(*)", "{o} BETWEEN 50000 AND 5000000"
        ),
    ),
    "d17_not_null": _all(
        _present("events", "event_id"),
        _present("events", "event_name"),
        _present("events", "event_timestamp"),
        _present("events", "session_id", 0.99),
        _present("transactions", "transaction_id"),
        _present("transactions", "user_id"),
        _present("transactions", "created_at"),
    ),
    "d18_unique": _all(_unique("events", "event_id"), _unique("transactions", "transaction_id")),
    "d19_in_set": _all(
        _in_set("events", "event_name", V.EVENT_NAMES),
        _in_set("events", "platform", V.PLATFORMS),
        _in_set("transactions", "transaction_type", V.TRANSACTION_TYPES),
        _in_set("transactions", "status", V.TRANSACTION_STATUSES),
        _in_set("transactions", "currency", V.CURRENCIES),
    ),
    "d20_match_regex": _bad(
        "events", "match_regex", "app_version", f"NOT regexp_matches(app_version, '{SEMVER}')"
    ),
    "d21_unique_proportion_between": _expect(
        "events",
        "unique_proportion_between",
        "user_id",
        "CAST(COUNT(DISTINCT user_id) AS DOUBLE) / COUNT(user_id)",
        "{o} BETWEEN 0.001 AND 1.0",
    ),
    "d22_between": _all(
        _bad("transactions", "between", "amount", "amount NOT BETWEEN 1 AND 100000000"),
        _bad("transactions", "between", "fee", "fee NOT BETWEEN 0 AND 10000"),
    ),
    "d23_pair_greater": _bad("transactions", "pair_greater", "amount,fee", "amount < fee"),
    "d24_source_tests": f"""SELECT "table", expectation AS "check", "column", success AS ok
    FROM ({SOURCE_TESTS})""",
    "d25_dau_positive": "SELECT date, dau FROM daily_kpi WHERE dau <= 0",
    "d26_revenue_not_negative": """SELECT transaction_month, transaction_type, fee_revenue
    FROM revenue_mart WHERE fee_revenue < 0""",
    "d27_freshness": """SELECT "table", latest,
      latest >= TIMESTAMP '2024-03-01' - INTERVAL 48 HOUR AS ok
    FROM (SELECT 'events' AS "table", MAX(event_timestamp) AS latest FROM raw_events
      UNION ALL SELECT 'transactions', MAX(created_at) FROM raw_transactions)""",
    "d28_latest_day_volume": f"""SELECT dt, cnt, {rnd('mean_cnt', 4)} AS mean_cnt,
      {rnd('std_cnt', 4)} AS std_cnt, {rnd('z')} AS zscore, NOT COALESCE(abs(z) > 3, FALSE) AS ok
    FROM event_day_z WHERE dt = (SELECT MAX(dt) FROM event_days)""",
    "d29_latest_success_rate": f"""SELECT *, success_rate >= 85 AS ok FROM (SELECT
      {pct("COUNT(*) FILTER (status = 'completed')", 'COUNT(*)')} AS success_rate,
      COUNT(*) AS total FROM raw_transactions WHERE CAST(created_at AS DATE) =
        (SELECT MAX(CAST(created_at AS DATE)) FROM raw_transactions))""",
    "d30_schema_drift": """SELECT 'events' AS "table", 'prop_transfer_type' AS "column",
      'added' AS change, COUNT(prop_transfer_type) AS rows FROM raw_events
    UNION ALL SELECT 'events', 'prop_amount', 'type string -> bigint', COUNT(prop_amount)
      FROM raw_events
    UNION ALL SELECT 'events', 'legacy_id', 'removed', 0""",
    "d31_export_validation": """
    SELECT 'daily_kpi' AS extract, 'not_empty' AS rule, COUNT(*) > 0 AS ok FROM export_kpi
    UNION ALL SELECT 'daily_kpi', 'dau_positive', MIN(dau) > 0 FROM export_kpi
    UNION ALL SELECT 'daily_kpi', 'gmv_not_negative', MIN(gmv) >= 0 FROM export_kpi
    UNION ALL SELECT 'retention_cohort', 'not_empty', COUNT(*) > 0 FROM curve
    UNION ALL SELECT 'retention_cohort', 'rate_at_most_100', MAX(retention_rate) <= 100 FROM curve
    UNION ALL SELECT 'funnel_data', 'six_steps', COUNT(*) = 6 FROM utc_funnel
    UNION ALL SELECT 'funnel_data', 'starts_at_100', arg_min(pct_from_start, step_order) = 100
      FROM utc_funnel
    UNION ALL SELECT 'transaction_summary', 'not_empty', COUNT(*) > 0 FROM export_txn
    UNION ALL SELECT 'transaction_summary', 'totals_not_negative', MIN(total_amount) >= 0
      FROM export_txn""",
    "d32_dau_within_mau": """SELECT dt, CAST(date_trunc('month', dt) AS DATE) AS month, dau, mau
    FROM stickiness WHERE dau > mau""",
    "d33_gmv_parts_add_up": """SELECT date, gmv, gmv - transfer_gmv - qr_payment_gmv AS diff
    FROM daily_kpi WHERE abs(gmv - transfer_gmv - qr_payment_gmv) > 100""",
    "d34_retention_decreases": """SELECT signup_week, signup_month, platform, retention_d1,
      retention_d3, retention_d7, retention_d14, retention_d30 FROM retention_mart
    WHERE NOT (retention_d1 >= retention_d3 AND retention_d3 >= retention_d7
      AND retention_d7 >= retention_d14 AND retention_d14 >= retention_d30)""",
    "d35_conversion_in_range": """SELECT step_order, users, conversion_from_start,
      conversion_from_prev FROM funnel_mart
    WHERE conversion_from_start NOT BETWEEN 0 AND 100
      OR conversion_from_prev NOT BETWEEN 0 AND 100""",
    "d36_schema_compliance": f"""SELECT * FROM (SELECT event_id, {_named_list(_RULES)}
      AS violations FROM raw_events) WHERE violations <> ''""",
    "d37_future_timestamp": """SELECT event_id, event_timestamp, received_at FROM raw_events
    WHERE event_timestamp - INTERVAL 5 MINUTE > received_at""",
    "d38_day_over_day_volume": f"""SELECT dt, cnt, pct_change,
      COALESCE(abs(pct_change) > 30, FALSE) AS alert
    FROM (SELECT dt, cnt, {pct('cnt - lag(cnt) OVER o', 'lag(cnt) OVER o')} AS pct_change
      FROM event_days WINDOW o AS (ORDER BY dt))""",
    "d39_null_rate_by_column": f"""SELECT "column", null_pct, null_pct <= 5 AS ok FROM (
      {_all(*[f'''SELECT '{c}' AS "column", {pct(f'COUNT(*) FILTER ({c} IS NULL)', 'COUNT(*)')}
        AS null_pct FROM raw_events''' for c in EVENT_COLUMNS])})""",
    "d40_quality_report": f"""SELECT check_name, expectation, severity, violations = 0 AS passed,
      CASE WHEN violations = 0 THEN '{V.CHECK_PASSED}'
        ELSE CAST(violations AS STRING) || '{V.CHECK_FAILED}' END AS details,
      violations, quality_score
    FROM check_results JOIN check_texts USING (check_name), check_score""",
    "d41_dq_score": f"""SELECT {rnd('null_rate', 6)} AS null_rate,
      {rnd('duplicate_rate', 6)} AS duplicate_rate, {rnd('compliance_rate', 6)} AS compliance_rate,
      {rnd('timeliness_rate', 6)} AS timeliness_rate,
      {rnd('''(1 - null_rate) * 0.3::DOUBLE + (1 - duplicate_rate) * 0.2::DOUBLE
        + compliance_rate * 0.3::DOUBLE + timeliness_rate * 0.2::DOUBLE''', 4)} AS dq_score
    FROM score_parts""",
    "d42_alert_level": """SELECT quality_score AS score, CASE
      WHEN quality_score < 80 OR critical_failed > 0 THEN 'critical'
      WHEN quality_score < 90 THEN 'warning' ELSE 'none' END AS level FROM check_score""",
    "d43_metric_anomaly": f"""SELECT txn_date, metric, value, {rnd('expected', 4)} AS expected,
      {pct('value - expected', 'expected', 1)} AS pct, {rnd('z')} AS z,
      CASE WHEN z > 0 THEN '{V.SURGE_UP}' ELSE '{V.SURGE_DOWN}' END AS direction
    FROM (SELECT txn_date, 'txn_count' AS metric, CAST(txn_count AS DOUBLE) AS value,
        m1 AS expected, z1 AS z FROM utc_volume_z
      UNION ALL SELECT txn_date, 'daily_gmv', CAST(daily_gmv AS DOUBLE), m2, z2 FROM utc_volume_z
      UNION ALL SELECT txn_date, 'error_rate', error_rate, m3, z3 FROM utc_volume_z)
    WHERE abs(z) > 2""",
    "d44_required_properties": f"""SELECT * FROM (SELECT event_id, event_name,
      {_named_list(_demands())} AS missing FROM raw_events) WHERE missing <> ''""",
}
