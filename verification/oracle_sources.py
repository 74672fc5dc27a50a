"""DuckDB twins of the source, sink and profile queries."""

from __future__ import annotations

from kpiweave import fixed_values as V
from verification.fixture import EVENT_COLUMNS, TRANSACTION_COLUMNS, USER_COLUMNS
from verification.oracle_base import big, pct, rnd

_ENVELOPE = ", ".join(c for c in EVENT_COLUMNS if not c.startswith("prop_"))
_SIZES = {"users": USER_COLUMNS, "events": EVENT_COLUMNS, "transactions": TRANSACTION_COLUMNS}

SOURCES: dict[str, str] = {
    "s1_ingest_users": """SELECT *, CAST(weekofyear(signup_date) AS INT) AS signup_week,
      CAST(date_trunc('month', signup_date) AS DATE) AS signup_month FROM raw_users""",
    "s2_ingest_events": "SELECT * FROM raw_events",
    "s3_ingest_transactions": "SELECT * FROM raw_transactions",
    "s4_ingest_events_json": f"SELECT {_ENVELOPE}, prop_amount AS event_properties FROM raw_events",
    "s5_flatten_properties": "SELECT * FROM raw_events",
    "s6_load_summary": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", COUNT(*) AS rows, {len(c)} AS columns FROM raw_{t}"""
        for t, c in _SIZES.items()
    ),
    "s7_event_profile": """SELECT event_name, COUNT(*) AS n FROM raw_events GROUP BY 1
      ORDER BY n DESC, event_name LIMIT 15""",
    "s8_transaction_profile": f"""SELECT 'type' AS section, transaction_type AS key,
      COUNT(*) AS n, {rnd('AVG(amount)', 0)} AS value FROM raw_transactions GROUP BY 2
    UNION ALL SELECT 'total', 'gmv', COUNT(*), CAST({big('SUM(amount)')} AS DOUBLE)
      FROM raw_transactions WHERE status = 'completed'
    UNION ALL SELECT 'total', 'fee', COUNT(*), CAST({big('SUM(fee)')} AS DOUBLE)
      FROM raw_transactions WHERE status = 'completed'
    UNION ALL SELECT 'status', status, COUNT(*),
      {pct('COUNT(*)', '(SELECT COUNT(*) FROM raw_transactions)', 1)}
      FROM raw_transactions GROUP BY 2""",
    "s9_time_ordered_write": "SELECT * FROM raw_events",
    "s10_mart_write": "SELECT * FROM daily_kpi",
    "s11_csv_export": "SELECT * FROM export_kpi",
    "s12_report_json": f"""SELECT '2024-03-01T00:00:00' AS run_timestamp,
      (SELECT COUNT(*) FROM check_results) AS total_checks,
      (SELECT COUNT(*) FROM check_results WHERE violations > 0) AS failed, quality_score,
      check_name, expectation, severity, violations = 0 AS passed,
      CASE WHEN violations = 0 THEN '{V.CHECK_PASSED}'
        ELSE CAST(violations AS STRING) || '{V.CHECK_FAILED}' END AS details, violations
    FROM check_results JOIN check_texts USING (check_name), check_score""",
}
