"""DuckDB twins of the streams: what a batch over the same rows gives."""

from __future__ import annotations

from kpiweave.quality.checks import EVENT_ROW_RULES, TXN_ROW_RULES
from verification.fixture import EVENT_COLUMNS
from verification.oracle_base import CTES, rnd
from verification.oracle_quality import _NO_ID_FORMAT, QUALITY, _named_list

_ROUTE_RULES = {
    **_NO_ID_FORMAT,
    "future_timestamp": "event_timestamp - INTERVAL 5 MINUTE > received_at",
}
_ROW_RULES = ", ".join(f"'{name}'" for name in [*EVENT_ROW_RULES, *TXN_ROW_RULES])
_KEPT = ", ".join(c for c in EVENT_COLUMNS if c != "received_at")

CTES["judged_events"] = f"""SELECT event_id, event_name, {_named_list(_ROUTE_RULES)} AS reasons
FROM raw_events"""

STREAMS: dict[str, str] = {
    "w1_stream_validate": """SELECT *, CASE reasons WHEN '' THEN 'valid' ELSE 'quarantine' END
      AS route FROM judged_events""",
    "w2_stream_dedup": f"SELECT DISTINCT {_KEPT} FROM raw_events",
    "w2_stream_dedup_any_delay": f"SELECT DISTINCT {_KEPT} FROM raw_events",
    "w3_stream_event_counts": """SELECT
      date_trunc('day', event_timestamp + INTERVAL 9 HOUR) AS window_start, event_name,
      COUNT(*) AS n FROM raw_events GROUP BY ALL""",
    "w4_stream_active_senders": "SELECT * FROM active_senders",
    "w4_stream_sender_sketches": "SELECT *, TRUE AS near FROM active_senders",
    "w5_timeliness_sketch": f"""SELECT date_trunc('day', event_timestamp) AS window_start,
      COUNT(*) AS n, {rnd('AVG(epoch(received_at - event_timestamp))', 6)} AS mean_s,
      {rnd('AVG(CAST(epoch(received_at - event_timestamp) <= 300 AS INT))', 6)} AS on_time_rate,
      TRUE AS p95_near FROM raw_events GROUP BY 1""",
    "w5_timeliness": f"""SELECT date_trunc('day', event_timestamp) AS window_start, COUNT(*) AS n,
      {rnd('AVG(epoch(received_at - event_timestamp))', 6)} AS mean_s,
      quantile_disc(epoch(received_at - event_timestamp), 0.95) AS p95_s,
      {rnd('''AVG(CAST(epoch(received_at - event_timestamp) <= 300 AS INT))''', 6)} AS on_time_rate
    FROM raw_events GROUP BY 1""",
    "w6_stream_alerts": f"""SELECT *, value < 85 AS alert FROM (
      SELECT date_trunc('day', created_at) AS window_start, 'success_rate' AS rule,
        {rnd("COUNT(*) FILTER (status = 'completed') * 100.0 / COUNT(*)")} AS value
      FROM raw_transactions GROUP BY 1)
    UNION ALL SELECT CAST(error_date AS TIMESTAMP), 'error_surge:' || error_code,
      CAST(error_count AS DOUBLE), COALESCE(error_count > surge_limit, FALSE)
    FROM error_days JOIN error_limits USING (error_code)""",
    # A window closes when the watermark, ten minutes behind the newest row, has passed its end.
    "w6_stream_alerts_past_only": f"""SELECT window_start, rule, value, alert FROM (
      SELECT *, value < 85 AS alert FROM (
        SELECT date_trunc('day', created_at) AS window_start, 'success_rate' AS rule,
          {rnd("COUNT(*) FILTER (status = 'completed') * 100.0 / COUNT(*)")} AS value
        FROM raw_transactions GROUP BY 1)
      UNION ALL SELECT CAST(error_date AS TIMESTAMP), 'error_surge:' || error_code,
        CAST(error_count AS DOUBLE),
        COALESCE(error_count > AVG(error_count) OVER p + 2 * STDDEV_SAMP(error_count) OVER p, FALSE)
      FROM error_days WINDOW p AS (PARTITION BY error_code ORDER BY error_date
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    WHERE window_start + INTERVAL 1 DAY <=
      (SELECT MAX(created_at) - INTERVAL 10 MINUTE FROM raw_transactions)""",
    "d39_ingest_null_rate": QUALITY["d39_null_rate_by_column"],
    "d40_ingest_row_rules": f"""SELECT * EXCLUDE (quality_score) FROM ({QUALITY["d40_quality_report"]})
    WHERE check_name IN ({_ROW_RULES})""",
    "w7_incremental_daily_kpi": "SELECT * FROM daily_kpi",
    "w7_late_daily_kpi": "SELECT * FROM daily_kpi",
    "q1_stream_new_returning": "SELECT * FROM new_returning",
    "w7_incremental_revenue": "SELECT * FROM revenue_mart",
}
