"""DuckDB twins of the models, analyses, extracts and metric formulas."""

from __future__ import annotations

from kpiweave import fixed_values as V
from verification.oracle_base import CTES, big, pct, ratio, rnd

AS_OF_DATE = "2024-02-28"
SALT = "pepper"


def seconds(start: str, end: str) -> str:
    """Elapsed seconds as the double nearest to the microsecond count."""
    return f"(CAST(epoch_us({end}) - epoch_us({start}) AS DOUBLE) / 1e6)"


def quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def cases(column: str, labels: dict, other: str | None = None) -> str:
    whens = " ".join(
        f"WHEN {k if isinstance(k, int) else repr(k)} THEN '{v}'" for k, v in labels.items()
    )
    return f"CASE {column} {whens} {'' if other is None else f'ELSE {other!r} '}END"


CTES.update(
    {
        "stg_events": """SELECT event_id, event_name,
          event_timestamp AS event_timestamp_utc,
          event_timestamp + INTERVAL 9 HOUR AS event_timestamp_kst,
          CAST(event_timestamp + INTERVAL 9 HOUR AS DATE) AS event_date_kst,
          CAST(hour(event_timestamp + INTERVAL 9 HOUR) AS INT) AS event_hour_kst,
          received_at, user_id, session_id, device_id, platform, app_version, os_version,
          device_model, string_split(event_name, '_')[1] AS event_domain,
          prop_amount AS amount, prop_screen_name AS screen_name,
          prop_merchant_id AS merchant_id, prop_merchant_category AS merchant_category,
          prop_error_code AS error_code, prop_signup_method AS signup_method,
          prop_transfer_type AS transfer_type, prop_fee AS fee, prop_latency_ms AS latency_ms,
          prop_referrer AS referrer, prop_campaign_id AS campaign_id,
          prop_login_method AS login_method
        FROM raw_events WHERE NOT starts_with(user_id, 'usr_test') AND event_name IS NOT NULL""",
        "stg_txn": f"""SELECT transaction_id, user_id, transaction_type, amount,
          COALESCE(fee, 0) AS fee, currency, status,
          {cases('status', V.STATUS_LABELS, V.STATUS_LABEL_OTHER)} AS status_label,
          bank_code, bank_name, created_at, CAST(created_at AS DATE) AS transaction_date,
          CAST(date_trunc('month', created_at) AS DATE) AS transaction_month,
          CAST(hour(created_at) AS INT) AS transaction_hour,
          CAST(dayofweek(created_at) AS INT) AS transaction_dow, completed_at,
          {seconds('created_at', 'completed_at')} AS processing_seconds,
          error_code, merchant_id, merchant_category
        FROM raw_transactions WHERE amount > 0 AND user_id IS NOT NULL""",
        "stg_users": f"""SELECT user_id, device_id, platform, device_model, signup_date,
          CAST(date_trunc('week', signup_date) AS DATE) AS signup_week,
          CAST(date_trunc('month', signup_date) AS DATE) AS signup_month, signup_method,
          CAST(DATE '{AS_OF_DATE}' - signup_date AS INT) AS days_since_signup
        FROM raw_users WHERE NOT starts_with(user_id, 'usr_test')""",
        "int_dau": """SELECT l.activity_date, l.user_id, l.platform,
          CASE WHEN u.signup_date = l.activity_date THEN 'new' ELSE 'returning' END AS user_type,
          l.login_count, u.signup_date
        FROM (SELECT event_date_kst AS activity_date, user_id, platform, COUNT(*) AS login_count
              FROM stg_events WHERE event_name = 'auth_login_completed' GROUP BY ALL) l
        LEFT JOIN stg_users u USING (user_id)""",
        "per_user_steps": """SELECT user_id,
          MIN(event_timestamp_kst) FILTER (event_name = 'auth_signup_started') AS t1,
          MIN(event_timestamp_kst) FILTER (event_name = 'auth_signup_submitted') AS t2,
          MIN(event_timestamp_kst) FILTER (event_name = 'auth_signup_completed') AS t3,
          MIN(event_timestamp_kst) FILTER (event_name = 'auth_identity_verified') AS t4,
          MIN(event_timestamp_kst) FILTER (event_name = 'payment_transfer_started') AS t5,
          MIN(event_timestamp_kst) FILTER (event_name = 'payment_transfer_completed') AS t6
        FROM stg_events GROUP BY user_id
        HAVING COALESCE(t1, t2, t3, t4, t5, t6) IS NOT NULL""",
        "int_funnel": f"""SELECT user_id, t1 AS signup_started_at, t3 AS signup_completed_at,
          t4 AS identity_verified_at, t6 AS first_transfer_completed_at,
          t1 IS NOT NULL AS reached_signup_start, t2 IS NOT NULL AS reached_signup_submit,
          t3 IS NOT NULL AS reached_signup_complete, t4 IS NOT NULL AS reached_identity_verify,
          t5 IS NOT NULL AS reached_first_transfer_start,
          t6 IS NOT NULL AS reached_first_transfer_complete,
          {seconds('t1', 't3')} / 60 AS minutes_to_signup,
          {seconds('t3', 't6')} / 3600 AS hours_to_first_transfer
        FROM per_user_steps""",
        "step_gaps": f"""SELECT * FROM (SELECT 'signup_started_to_completed' AS transition,
          {seconds('t1', 't3')} / 60 AS minutes
        FROM per_user_steps
      UNION ALL SELECT 'signup_completed_to_verified', {seconds('t3', 't4')} / 60 FROM per_user_steps
      UNION ALL SELECT 'signup_completed_to_transfer', {seconds('t3', 't6')} / 60 FROM per_user_steps)
        WHERE minutes IS NOT NULL""",
        "login_days_kst": """SELECT DISTINCT user_id, event_date_kst AS activity_date
        FROM stg_events WHERE event_name = 'auth_login_completed'""",
        "signup_days": """SELECT u.user_id, u.signup_date, u.signup_week, u.signup_month, u.platform,
          a.activity_date, CAST(a.activity_date - u.signup_date AS INT) AS days_since_signup
        FROM stg_users u LEFT JOIN login_days_kst a USING (user_id)""",
        "int_cohort": "SELECT *, "
        + ", ".join(
            f"CAST(COALESCE(days_since_signup = {n}, FALSE) AS INT) AS retained_d{n}"
            for n in V.RETENTION_DAYS
        )
        + " FROM signup_days",
        "daily_users": """SELECT activity_date, COUNT(DISTINCT user_id) AS dau,
          COUNT(DISTINCT user_id) FILTER (user_type = 'new') AS new_users,
          COUNT(DISTINCT user_id) FILTER (user_type = 'returning') AS returning_users,
          COUNT(DISTINCT user_id) FILTER (platform = 'ios') AS dau_ios,
          COUNT(DISTINCT user_id) FILTER (platform = 'android') AS dau_android,
          COUNT(DISTINCT user_id) FILTER (platform = 'web') AS dau_web
        FROM int_dau GROUP BY activity_date""",
        "login_spine": "SELECT DISTINCT activity_date FROM int_dau",
        "rolling_users": """SELECT s.activity_date,
          COUNT(DISTINCT d.user_id) FILTER (d.activity_date > s.activity_date - 7) AS wau_7d,
          COUNT(DISTINCT d.user_id) AS mau_30d
        FROM login_spine s
        JOIN int_dau d ON d.activity_date > s.activity_date - 30
          AND d.activity_date <= s.activity_date
        GROUP BY s.activity_date""",
        "daily_transactions": f"""SELECT transaction_date,
          COUNT(*) AS total_transactions,
          COUNT(*) FILTER (status = 'completed') AS completed_transactions,
          COUNT(*) FILTER (status = 'failed') AS failed_transactions,
          {big("COALESCE(SUM(amount) FILTER (status = 'completed'), 0)")} AS gmv,
          {big('''COALESCE(SUM(amount) FILTER (status = 'completed'
            AND transaction_type = 'transfer'), 0)''')} AS transfer_gmv,
          {big('''COALESCE(SUM(amount) FILTER (status = 'completed'
            AND transaction_type = 'qr_payment'), 0)''')} AS qr_payment_gmv,
          {big("COALESCE(SUM(fee) FILTER (status = 'completed'), 0)")} AS total_fee_revenue,
          AVG(amount) FILTER (status = 'completed') AS avg_transaction_amount,
          AVG(amount) FILTER (status = 'completed' AND transaction_type = 'transfer')
            AS avg_transfer_amount,
          COUNT(*) FILTER (status = 'completed' AND transaction_type = 'transfer')
            AS transfer_count,
          COUNT(*) FILTER (status = 'completed' AND transaction_type = 'qr_payment')
            AS qr_payment_count,
          COUNT(*) FILTER (status = 'completed' AND transaction_type = 'charge') AS charge_count,
          {pct("COUNT(*) FILTER (status = 'completed')", 'COUNT(*)')} AS success_rate
        FROM stg_txn GROUP BY transaction_date""",
        "daily_kpi": f"""SELECT u.activity_date AS date,
          CAST(dayofweek(u.activity_date) AS INT) AS day_of_week,
          {cases('dayofweek(u.activity_date)', dict(enumerate(V.DAY_LABELS)))} AS day_name,
          u.dau, u.new_users, u.returning_users, u.dau_ios, u.dau_android, u.dau_web,
          r.wau_7d, r.mau_30d, {pct('u.dau', 'r.mau_30d')} AS stickiness_ratio,
          COALESCE(t.total_transactions, 0) AS total_transactions,
          COALESCE(t.completed_transactions, 0) AS completed_transactions,
          COALESCE(t.failed_transactions, 0) AS failed_transactions,
          COALESCE(t.success_rate, 0) AS success_rate,
          COALESCE(t.gmv, 0) AS gmv, COALESCE(t.transfer_gmv, 0) AS transfer_gmv,
          COALESCE(t.qr_payment_gmv, 0) AS qr_payment_gmv,
          COALESCE(t.total_fee_revenue, 0) AS fee_revenue,
          t.avg_transaction_amount, t.avg_transfer_amount,
          COALESCE(t.transfer_count, 0) AS transfer_count,
          COALESCE(t.qr_payment_count, 0) AS qr_payment_count,
          COALESCE(t.charge_count, 0) AS charge_count,
          {rnd(ratio('COALESCE(t.gmv, 0)', 'u.dau'), 0)} AS gmv_per_dau,
          {rnd(ratio('COALESCE(t.total_transactions, 0)', 'u.dau'), 2)} AS txn_per_dau
        FROM daily_users u
        LEFT JOIN daily_transactions t ON t.transaction_date = u.activity_date
        LEFT JOIN rolling_users r ON r.activity_date = u.activity_date""",
        "funnel_counts": f"""SELECT COUNT(t1) AS n1, COUNT(t2) AS n2, COUNT(t3) AS n3,
          COUNT(t4) AS n4, COUNT(t5) AS n5, COUNT(t6) AS n6,
          AVG({seconds('t1', 't3')} / 60) AS m3,
          AVG({seconds('t3', 't6')} / 3600) * 60 AS m6
        FROM per_user_steps""",
        "funnel_steps": "SELECT * FROM (VALUES "
        + ", ".join(f"({i}, '{text}')" for i, text in enumerate(V.FUNNEL_LABELS, 1))
        + ") v(step_order, label)",
        "funnel_mart": f"""SELECT label AS funnel_step, step_order, users,
          CASE step_order WHEN 1 THEN 100.0::DOUBLE ELSE {pct('users', 'n1')} END
            AS conversion_from_start,
          CASE step_order WHEN 1 THEN 100.0::DOUBLE ELSE {pct('users', 'before')} END
            AS conversion_from_prev,
          {rnd('minutes', 6)} AS avg_time_minutes
        FROM (SELECT s.label, s.step_order, c.n1,
                [c.n1, c.n2, c.n3, c.n4, c.n5, c.n6][s.step_order] AS users,
                [c.n1, c.n1, c.n2, c.n3, c.n4, c.n5][s.step_order] AS before,
                CASE s.step_order WHEN 3 THEN c.m3 WHEN 6 THEN c.m6 END AS minutes
              FROM funnel_steps s, funnel_counts c)""",
        "retention_mart": "SELECT signup_week, signup_month, platform, cohort_size, "
        + ", ".join(f"retained_d{n}_users" for n in V.RETENTION_DAYS)
        + ", "
        + ", ".join(
            f"{pct(f'retained_d{n}_users', 'cohort_size')} AS retention_d{n}"
            for n in V.RETENTION_DAYS
        )
        + """ FROM (SELECT signup_week, signup_month, platform,
          COUNT(DISTINCT user_id) AS cohort_size, """
        + ", ".join(
            f"COUNT(DISTINCT user_id) FILTER (retained_d{n} = 1) AS retained_d{n}_users"
            for n in V.RETENTION_DAYS
        )
        + " FROM int_cohort GROUP BY ALL)",
        "revenue_base": f"""SELECT transaction_month, transaction_type,
          COUNT(*) AS total_transactions,
          COUNT(*) FILTER (status = 'completed') AS completed_count,
          {big("COALESCE(SUM(amount) FILTER (status = 'completed'), 0)")} AS gmv,
          {big("COALESCE(SUM(fee) FILTER (status = 'completed'), 0)")} AS fee_revenue,
          COUNT(DISTINCT user_id) AS unique_users,
          COUNT(DISTINCT user_id) FILTER (status = 'completed' AND fee > 0) AS paying_users,
          AVG(amount) FILTER (status = 'completed') AS avg_amount,
          quantile_cont(amount, 0.5) FILTER (status = 'completed') AS median_amount
        FROM stg_txn GROUP BY ALL""",
        "revenue_mart": f"""SELECT b.*,
          {rnd(ratio('fee_revenue', 'paying_users'), 0)} AS arppu,
          {rnd(ratio('fee_revenue', 'unique_users'), 0)} AS arpu,
          {pct('gmv', 'monthly_total_gmv')} AS gmv_share_pct,
          monthly_total_gmv, monthly_total_fee_revenue
        FROM revenue_base b JOIN (
          SELECT transaction_month, {big('SUM(gmv)')} AS monthly_total_gmv,
            {big('SUM(fee_revenue)')} AS monthly_total_fee_revenue
          FROM revenue_base GROUP BY transaction_month) m USING (transaction_month)""",
        "utc_logins": """SELECT CAST(event_timestamp AS DATE) AS login_date, user_id, platform
        FROM raw_events WHERE event_name = 'auth_login_completed'""",
        "utc_dau": "SELECT login_date, COUNT(DISTINCT user_id) AS dau FROM utc_logins GROUP BY 1",
        "utc_month_users": """SELECT date_trunc('month', login_date) AS month,
          COUNT(DISTINCT user_id) AS mau FROM utc_logins GROUP BY 1""",
        "stickiness": f"""SELECT login_date AS dt, dau, mau, {pct('dau', 'mau')} AS stickiness_pct
        FROM utc_dau JOIN utc_month_users ON month = date_trunc('month', login_date)""",
        "utc_steps": "SELECT "
        + ", ".join(
            f"COUNT(*) FILTER (list_contains(names, '{e}')) AS n{i}"
            for i, e in enumerate(V.FUNNEL_EVENTS, 1)
        )
        + f""" FROM (SELECT user_id, list(DISTINCT event_name) AS names FROM raw_events
          WHERE event_name IN ({quoted(V.FUNNEL_EVENTS)}) GROUP BY user_id)""",
        "utc_funnel": f"""SELECT label, step_order, users,
          CASE step_order WHEN 1 THEN 100.0::DOUBLE ELSE {pct('users', 'n1', 1)} END
            AS pct_from_start,
          CASE step_order WHEN 1 THEN 100.0::DOUBLE ELSE {pct('users', 'before', 1)} END
            AS pct_from_prev
        FROM (SELECT s.label, s.step_order, c.n1,
                [c.n1, c.n2, c.n3, c.n4, c.n5, c.n6][s.step_order] AS users,
                [c.n1, c.n1, c.n2, c.n3, c.n4, c.n5][s.step_order] AS before
              FROM funnel_steps s, utc_steps c)""",
        "utc_signup_days": """SELECT u.user_id,
          CAST(date_trunc('week', u.signup_date) AS DATE) AS cohort_week,
          CAST(l.login_date - u.signup_date AS INT) AS day_n
        FROM raw_users u JOIN (SELECT DISTINCT user_id, login_date FROM utc_logins) l
        USING (user_id)""",
        "cohort_sizes": """SELECT CAST(date_trunc('week', signup_date) AS DATE) AS cohort_week,
          COUNT(DISTINCT user_id) AS cohort_size FROM raw_users GROUP BY 1""",
        "curve": f"""SELECT cohort_week, day_n, active_users, cohort_size,
          {pct('active_users', 'cohort_size')} AS retention_rate
        FROM (SELECT cohort_week, day_n, COUNT(DISTINCT user_id) AS active_users
              FROM utc_signup_days WHERE day_n BETWEEN 0 AND 30 GROUP BY ALL)
        JOIN cohort_sizes USING (cohort_week)""",
        "retention_means": f"""SELECT day_n, {rnd('AVG(retention_rate)')} AS mean_rate
        FROM curve WHERE day_n IN (1, 7, 30) GROUP BY day_n""",
        "txn_months": """SELECT *, CAST(date_trunc('month', created_at) AS DATE) AS month
        FROM raw_transactions""",
        "arppu_months": f"""SELECT month, total_users, paying_users, total_gmv, total_fee_revenue,
          completed_txns, {rnd('mean_amount', 0)} AS avg_txn_amount,
          {rnd(ratio('total_fee_revenue', 'paying_users'), 0)} AS arppu,
          {rnd(ratio('total_fee_revenue', 'total_users'), 0)} AS arpu,
          {pct('paying_users', 'total_users')} AS paying_user_ratio
        FROM (SELECT month, COUNT(DISTINCT user_id) AS total_users,
            COUNT(DISTINCT user_id) FILTER (fee > 0) AS paying_users,
            {big("SUM(amount) FILTER (status = 'completed')")} AS total_gmv,
            {big("SUM(fee) FILTER (status = 'completed')")} AS total_fee_revenue,
            COUNT(*) FILTER (status = 'completed') AS completed_txns,
            AVG(amount) FILTER (status = 'completed') AS mean_amount
          FROM txn_months GROUP BY month)""",
        "utc_volume": f"""SELECT CAST(created_at AS DATE) AS txn_date, COUNT(*) AS txn_count,
          {big("COALESCE(SUM(amount) FILTER (status = 'completed'), 0)")} AS daily_gmv,
          {pct("COUNT(*) FILTER (status = 'failed')", 'COUNT(*)')} AS error_rate
        FROM raw_transactions GROUP BY 1""",
        "utc_volume_z": """SELECT v.*, m1, m2, m3,
          (txn_count - m1) / NULLIF(s1, 0) AS z1, (daily_gmv - m2) / NULLIF(s2, 0) AS z2,
          (error_rate - m3) / NULLIF(s3, 0) AS z3
        FROM utc_volume v, (SELECT AVG(txn_count) AS m1, STDDEV(txn_count) AS s1,
            AVG(daily_gmv) AS m2, STDDEV(daily_gmv) AS s2,
            AVG(error_rate) AS m3, STDDEV(error_rate) AS s3 FROM utc_volume)""",
        "error_days": """SELECT CAST(created_at AS DATE) AS error_date, error_code,
          COUNT(*) AS error_count FROM raw_transactions
        WHERE status = 'failed' AND error_code IS NOT NULL GROUP BY ALL""",
        "error_limits": """SELECT error_code, AVG(error_count) AS mean_count,
          AVG(error_count) + 2 * STDDEV(error_count) AS surge_limit
        FROM error_days GROUP BY error_code""",
        "export_kpi": f"""SELECT u.login_date AS date, dayname(u.login_date) AS day_name, u.dau,
          u.dau_ios, u.dau_android, u.dau_web,
          COALESCE(t.n, 0) AS total_transactions, COALESCE(t.done, 0) AS completed_transactions,
          COALESCE(t.gmv, 0) AS gmv, COALESCE(t.transfer_gmv, 0) AS transfer_gmv,
          COALESCE(t.qr_gmv, 0) AS qr_payment_gmv, COALESCE(t.fees, 0) AS fee_revenue,
          COALESCE(t.transfers, 0) AS transfer_count, COALESCE(t.qrs, 0) AS qr_payment_count,
          COALESCE(t.success_rate, 0) AS success_rate,
          {rnd(ratio('COALESCE(t.gmv, 0)', 'u.dau'), 0)} AS gmv_per_dau
        FROM (SELECT login_date, COUNT(DISTINCT user_id) AS dau,
            COUNT(DISTINCT user_id) FILTER (platform = 'ios') AS dau_ios,
            COUNT(DISTINCT user_id) FILTER (platform = 'android') AS dau_android,
            COUNT(DISTINCT user_id) FILTER (platform = 'web') AS dau_web
          FROM utc_logins GROUP BY 1) u
        LEFT JOIN (SELECT CAST(created_at AS DATE) AS dt, COUNT(*) AS n,
            COUNT(*) FILTER (status = 'completed') AS done,
            {big("SUM(amount) FILTER (status = 'completed')")} AS gmv,
            {big('''SUM(amount) FILTER (status = 'completed'
              AND transaction_type = 'transfer')''')} AS transfer_gmv,
            {big('''SUM(amount) FILTER (status = 'completed'
              AND transaction_type = 'qr_payment')''')} AS qr_gmv,
            {big("SUM(fee) FILTER (status = 'completed')")} AS fees,
            COUNT(*) FILTER (status = 'completed' AND transaction_type = 'transfer') AS transfers,
            COUNT(*) FILTER (status = 'completed' AND transaction_type = 'qr_payment') AS qrs,
            {pct("COUNT(*) FILTER (status = 'completed')", 'COUNT(*)')} AS success_rate
          FROM raw_transactions GROUP BY 1) t ON t.dt = u.login_date""",
        "export_txn": f"""SELECT month, transaction_type, status, bank_name, merchant_category,
          CAST(hour(created_at) AS INT) AS hour, CAST(dayofweek(created_at) AS INT) AS day_of_week,
          COUNT(*) AS txn_count, {big('SUM(amount)')} AS total_amount,
          {big('SUM(fee)')} AS total_fee, AVG(amount) AS avg_amount,
          COUNT(DISTINCT user_id) AS unique_users
        FROM txn_months GROUP BY ALL""",
        "platform_days": " UNION ALL ".join(
            f"SELECT date, '{p}' AS platform, dau_{p} AS dau, "
            f"{pct(f'dau_{p}', 'dau')} AS share_pct FROM daily_kpi"
            for p in V.PLATFORMS
        ),
        "sender_days": """SELECT DISTINCT user_id, event_date_kst AS day FROM stg_events
        WHERE event_name = 'payment_transfer_completed'""",
        "new_returning": """SELECT login_date, COUNT(DISTINCT user_id) AS dau,
      COUNT(DISTINCT user_id) FILTER (login_date = first_day) AS new_users,
      COUNT(DISTINCT user_id) FILTER (login_date > first_day) AS returning_users,
      COUNT(DISTINCT user_id) FILTER (platform = 'ios') AS dau_ios,
      COUNT(DISTINCT user_id) FILTER (platform = 'android') AS dau_android,
      COUNT(DISTINCT user_id) FILTER (platform = 'web') AS dau_web
    FROM (SELECT *, MIN(login_date) OVER (PARTITION BY user_id) AS first_day FROM utc_logins
          WHERE NOT starts_with(user_id, 'usr_test')) GROUP BY login_date""",
        "segment_logins": """SELECT DISTINCT event_date_kst AS date, s.segment, COALESCE(s.value, 'unknown') AS value, user_id
      FROM stg_events, unnest([{'segment': 'platform', 'value': platform},
        {'segment': 'app_version', 'value': app_version}]) AS u(s)
      WHERE event_name = 'auth_login_completed'""",
        "active_senders": """SELECT s.day AS date, COUNT(DISTINCT d.user_id) AS was_7d
        FROM (SELECT DISTINCT day FROM sender_days) s
        JOIN sender_days d ON d.day BETWEEN s.day - 6 AND s.day GROUP BY s.day""",
        "kst_month_users": """SELECT CAST(date_trunc('month', activity_date) AS DATE) AS month,
          COUNT(DISTINCT user_id) AS mau FROM login_days_kst GROUP BY 1""",
        "first_signups": """SELECT user_id, MIN(event_timestamp_kst) AS signed_at,
          arg_min(signup_method, (event_timestamp_kst, signup_method, platform)) AS signup_method,
          arg_min(platform, (event_timestamp_kst, signup_method, platform)) AS platform
        FROM stg_events WHERE event_name = 'auth_signup_completed' GROUP BY user_id""",
        "first_sends": """SELECT user_id, MIN(event_timestamp_kst) AS sent_at FROM stg_events
        WHERE event_name = 'payment_transfer_completed' GROUP BY user_id""",
        "converted_signups": """SELECT f.*, COALESCE(
          sent_at BETWEEN signed_at AND signed_at + INTERVAL 7 DAY, FALSE) AS converted
        FROM first_signups f LEFT JOIN first_sends USING (user_id)""",
        "conversion": f"""SELECT segment, value, COUNT(*) AS signups,
          COUNT(*) FILTER (converted) AS converted,
          {pct('COUNT(*) FILTER (converted)', 'COUNT(*)')} AS rate
        FROM (SELECT 'all' AS segment, 'all' AS value, converted FROM converted_signups
          UNION ALL SELECT 'signup_method', COALESCE(signup_method, 'unknown'), converted
            FROM converted_signups
          UNION ALL SELECT 'platform', COALESCE(platform, 'unknown'), converted
            FROM converted_signups)
        GROUP BY segment, value""",
        "referrer_signups": """SELECT user_id, MIN(event_timestamp_kst) AS signed_at,
          arg_min(COALESCE(referrer, 'unknown'),
            (event_timestamp_kst, referrer IS NOT NULL, referrer)) AS referrer
        FROM stg_events WHERE event_name = 'auth_signup_completed' GROUP BY user_id""",
        "segment_gmv": f"""SELECT event_date_kst AS day, segment, value, {big('SUM(amount)')} AS gmv
        FROM (SELECT event_date_kst, amount, 'transaction_type' AS segment,
            CASE event_name WHEN 'payment_qr_completed' THEN 'qr_payment' ELSE 'transfer' END
              AS value FROM stg_events
            WHERE event_name IN ('payment_transfer_completed', 'payment_qr_completed')
          UNION ALL SELECT event_date_kst, amount, 'platform', COALESCE(platform, 'unknown')
            FROM stg_events
            WHERE event_name IN ('payment_transfer_completed', 'payment_qr_completed'))
        GROUP BY ALL""",
        "event_gmv": f"""SELECT grain, period, {big('SUM(amount)')} AS gmv
        FROM (SELECT amount, 'day' AS grain, event_date_kst AS period FROM stg_events
            WHERE event_name IN ('payment_transfer_completed', 'payment_qr_completed')
          UNION ALL SELECT amount, 'week', CAST(date_trunc('week', event_date_kst) AS DATE)
            FROM stg_events
            WHERE event_name IN ('payment_transfer_completed', 'payment_qr_completed')
          UNION ALL SELECT amount, 'month', CAST(date_trunc('month', event_date_kst) AS DATE)
            FROM stg_events
            WHERE event_name IN ('payment_transfer_completed', 'payment_qr_completed'))
        GROUP BY grain, period""",
        "fee_months": f"""SELECT user_id, transaction_month AS month,
          {big("COALESCE(SUM(fee) FILTER (status = 'completed'), 0)")} AS fee,
          COALESCE(bool_or(status = 'completed' AND fee > 0), FALSE) AS pays
        FROM stg_txn GROUP BY ALL""",
    }
)


def tier(fee: str) -> str:
    return f"""CASE WHEN {fee} >= 2000 THEN '{V.TIERS[0][1]}'
      WHEN {fee} >= 500 THEN '{V.TIERS[1][1]}'
      WHEN {fee} > 0 THEN '{V.TIERS[2][1]}' ELSE '{V.TIER_FREE}' END"""


def _rate(base: str, base_name: str, done: str, done_name: str) -> str:
    return f"""SELECT *, {pct(done_name, base_name)} AS rate FROM (
      SELECT COUNT(*) FILTER (event_name = '{base}') AS {base_name},
        COUNT(*) FILTER (event_name = '{done}') AS {done_name} FROM stg_events)"""


def _daily_pair(a: str, a_name: str, b: str, b_name: str, rate: str, part: str, whole: str) -> str:
    return f"""SELECT *, {pct(part, whole)} AS {rate} FROM (
      SELECT event_date_kst AS date, COUNT(*) FILTER (event_name = '{a}') AS {a_name},
        COUNT(*) FILTER (event_name = '{b}') AS {b_name}
      FROM stg_events WHERE event_name IN ('{a}', '{b}') GROUP BY 1)"""


N_DAYS = V.RETENTION_DAYS

MODELS: dict[str, str] = {
    "st1_stg_events": "SELECT * FROM stg_events",
    "st2_stg_transactions": "SELECT * FROM stg_txn",
    "st3_stg_users": "SELECT * FROM stg_users",
    "st4_mask_pii": f"""SELECT * REPLACE (sha256('{SALT}' || user_id) AS user_id,
      sha256('{SALT}' || device_id) AS device_id) FROM raw_users""",
    "i1_int_daily_active_users": "SELECT * FROM int_dau",
    "i2_int_funnel_conversion": "SELECT * FROM int_funnel",
    "i3_int_user_cohort": "SELECT * FROM int_cohort",
    "m1_mart_daily_kpi": "SELECT * FROM daily_kpi",
    "m1a_daily_users": "SELECT * FROM daily_users",
    "m1b_daily_transactions": "SELECT * FROM daily_transactions",
    "m1c_rolling_users": "SELECT * FROM rolling_users",
    "m2_mart_funnel": "SELECT * FROM funnel_mart",
    "m3_mart_retention": "SELECT * FROM retention_mart",
    "m3_retention_by_signup_method": "SELECT signup_week, signup_method, cohort_size, "
    + ", ".join(f"retained_d{n}_users" for n in V.RETENTION_DAYS)
    + ", "
    + ", ".join(
        f"{pct(f'retained_d{n}_users', 'cohort_size')} AS retention_d{n}" for n in V.RETENTION_DAYS
    )
    + " FROM (SELECT c.signup_week, u.signup_method, COUNT(DISTINCT c.user_id) AS cohort_size, "
    + ", ".join(
        f"COUNT(DISTINCT c.user_id) FILTER (retained_d{n} = 1) AS retained_d{n}_users"
        for n in V.RETENTION_DAYS
    )
    + " FROM int_cohort c JOIN stg_users u USING (user_id) GROUP BY 1, 2)",
    "m4_mart_revenue": "SELECT * FROM revenue_mart",
    "m1c_rolling_users_by_segment": """SELECT a.date, a.segment, a.value,
      COUNT(DISTINCT b.user_id) FILTER (b.date > a.date - 7) AS users_7d,
      COUNT(DISTINCT b.user_id) AS users_30d
    FROM (SELECT DISTINCT date, segment, value FROM segment_logins) a JOIN segment_logins b
      ON a.segment = b.segment AND a.value = b.value AND b.date BETWEEN a.date - 29 AND a.date
    GROUP BY ALL""",
    "p1_range_join_errors_near_failures": f"""SELECT transaction_id, COUNT(*) AS errors
    FROM raw_transactions JOIN raw_events ON event_timestamp
      BETWEEN created_at - INTERVAL 1 HOUR AND created_at + INTERVAL 1 HOUR
    WHERE status = 'failed' AND event_name IN ({", ".join(f"'{n}'" for n in V.ERROR_EVENTS)})
    GROUP BY transaction_id""",
    "m4_mart_revenue_sketch": """SELECT * EXCLUDE (median_amount),
      CASE WHEN completed_count > 0 THEN TRUE END AS median_near FROM revenue_mart""",
    "q1_dau_new_returning": "SELECT * FROM new_returning",
    "q2_rolling_wau": f"""SELECT login_date, dau,
      {big('SUM(dau) OVER w')} AS wau_7d_sum, AVG(dau) OVER w AS wau_7d_avg
    FROM utc_dau WINDOW w AS (ORDER BY login_date ROWS 6 PRECEDING)""",
    "q3_stickiness": "SELECT * FROM stickiness",
    "q4_funnel_overall": """SELECT label AS funnel_step, users, pct_from_start, pct_from_prev
    FROM utc_funnel""",
    "q5_funnel_by_platform": f"""SELECT *,
      {pct('signup_completed', 'signup_started', 1)} AS signup_rate,
      {pct('first_transfer', 'signup_started', 1)} AS full_conversion_rate
    FROM (SELECT platform,
        COUNT(*) FILTER (list_contains(names, 'auth_signup_started')) AS signup_started,
        COUNT(*) FILTER (list_contains(names, 'auth_signup_completed')) AS signup_completed,
        COUNT(*) FILTER (list_contains(names, 'payment_transfer_completed')) AS first_transfer
      FROM (SELECT user_id, platform, list(DISTINCT event_name) AS names FROM raw_events
        WHERE event_name IN ('auth_signup_started', 'auth_signup_completed',
          'payment_transfer_completed') GROUP BY ALL) GROUP BY platform)""",
    "q6_classic_retention": "SELECT *, "
    + ", ".join(f"{pct(f'd{n}_users', 'cohort_size')} AS d{n}_retention" for n in N_DAYS)
    + " FROM (SELECT cohort_week, COUNT(DISTINCT user_id) AS cohort_size, "
    + ", ".join(f"COUNT(DISTINCT user_id) FILTER (day_n = {n}) AS d{n}_users" for n in N_DAYS)
    + " FROM utc_signup_days GROUP BY cohort_week)",
    "q7_retention_curve": "SELECT * FROM curve",
    "q8_monthly_arppu": "SELECT * FROM arppu_months",
    "q9_revenue_by_type": f"""SELECT month, transaction_type, COUNT(*) AS txn_count,
      {big("SUM(amount) FILTER (status = 'completed')")} AS gmv,
      {big("SUM(fee) FILTER (status = 'completed')")} AS fee_revenue,
      COUNT(DISTINCT user_id) AS unique_users,
      {rnd("AVG(amount) FILTER (status = 'completed')", 0)} AS avg_amount
    FROM txn_months GROUP BY ALL""",
    "q10_user_tier_revenue": f"""SELECT month, user_tier, users, total_fee, avg_fee,
      {pct('total_fee', 'SUM(total_fee) OVER (PARTITION BY month)')} AS revenue_share_pct
    FROM (SELECT month, {tier('monthly_fee')} AS user_tier, COUNT(user_id) AS users,
        {big('SUM(monthly_fee)')} AS total_fee, {rnd('AVG(monthly_fee)', 0)} AS avg_fee
      FROM (SELECT user_id, month,
          {big("SUM(CASE status WHEN 'completed' THEN fee ELSE 0 END)")} AS monthly_fee
        FROM txn_months GROUP BY ALL) GROUP BY ALL)""",
    "q11_volume_zscore": f"""SELECT txn_date, txn_count, daily_gmv, error_rate,
      {rnd('z1')} AS txn_count_zscore, {rnd('z2')} AS gmv_zscore, {rnd('z3')} AS error_rate_zscore,
      CASE WHEN abs(z1) > 2 THEN '{V.ALERT}' ELSE '{V.OK}' END AS txn_alert,
      CASE WHEN abs(z3) > 2 THEN '{V.ALERT}' ELSE '{V.OK}' END AS error_alert
    FROM utc_volume_z""",
    "q12_high_value_txn": f"""SELECT transaction_id, user_id, transaction_type, amount, created_at,
      mean_amount AS user_avg_amount, {rnd('amount / mean_amount', 1)} AS amount_ratio,
      {rnd('(amount - mean_amount) / NULLIF(std_amount, 0)')} AS user_zscore,
      '{V.HIGH_VALUE_LABEL}' AS alert_type
    FROM (SELECT *, AVG(amount) OVER w AS mean_amount, STDDEV(amount) OVER w AS std_amount,
        COUNT(*) OVER w AS n FROM raw_transactions WHERE status = 'completed'
      WINDOW w AS (PARTITION BY user_id))
    WHERE n >= 5 AND amount > mean_amount * 10
    ORDER BY amount_ratio DESC, transaction_id LIMIT 50""",
    "q13_error_surge": f"""SELECT error_date, error_code, error_count,
      mean_count AS avg_daily_errors, '{V.ERROR_SURGE_LABEL}' AS alert
    FROM error_days JOIN error_limits USING (error_code) WHERE error_count > surge_limit""",
    "x1_export_daily_kpi": "SELECT * FROM export_kpi",
    "x2_export_retention_cohort": "SELECT * FROM curve",
    "x3_export_funnel": """SELECT step_order, label AS step_name, users, pct_from_start,
      pct_from_prev FROM utc_funnel""",
    "x4_export_txn_summary": "SELECT * FROM export_txn",
    "b1_kpi_trend": f"""SELECT date, dau, {rnd('AVG(dau) OVER (o ROWS 6 PRECEDING)')} AS dau_ma7,
      gmv, {big('SUM(gmv) OVER (o ROWS UNBOUNDED PRECEDING)')} AS gmv_cum,
      {pct('dau - lag(dau, 7) OVER o', 'lag(dau, 7) OVER o')} AS wow_pct
    FROM export_kpi WINDOW o AS (ORDER BY date)""",
    "b2_platform_share": "SELECT * FROM platform_days",
    "b3_funnel_dropoff": f"""SELECT step_order, users, before - users AS dropoff_users,
      {pct('before - users', 'before')} AS dropoff_pct,
      COALESCE(before - users = MAX(before - users) OVER (), FALSE) AS is_largest
    FROM (SELECT step_order, users, lag(users) OVER (ORDER BY step_order) AS before
      FROM funnel_mart)""",
    "b4_time_to_convert": f"""SELECT transition, COUNT(*) AS n,
      {rnd('quantile_cont(minutes, 0.25)', 6)} AS p25,
      {rnd('quantile_cont(minutes, 0.5)', 6)} AS p50,
      {rnd('quantile_cont(minutes, 0.75)', 6)} AS p75
    FROM step_gaps GROUP BY transition""",
    "b4_time_to_convert_sketch": """SELECT transition, COUNT(*) AS n, TRUE AS p25_near,
      TRUE AS p50_near, TRUE AS p75_near FROM step_gaps GROUP BY transition""",
    "b4_time_to_convert_histogram": """SELECT transition,
      CAST(floor(minutes / 1440) AS BIGINT) * 1440 AS from_minutes, COUNT(*) AS n
    FROM step_gaps GROUP BY ALL""",
    "b5_retention_kpi": """SELECT *, CASE WHEN mean_rate >= 60 THEN '양호'
      WHEN mean_rate >= 30 THEN '보통' ELSE '주의' END AS band FROM retention_means""",
    "b6_hour_dow_heatmap": """SELECT transaction_dow AS dow, transaction_hour AS hour,
      COUNT(*) AS txn_count FROM stg_txn GROUP BY ALL""",
    "b7_bank_distribution": "SELECT bank_name, COUNT(*) AS txn_count FROM stg_txn GROUP BY 1",
    "b8_txn_mix": f"""SELECT *, {pct('txn_count', 'SUM(txn_count) OVER ()')} AS share_pct,
      {pct('amount', 'SUM(amount) OVER ()')} AS amount_share_pct
    FROM (SELECT transaction_type, COUNT(*) AS txn_count, {big('SUM(amount)')} AS amount
      FROM stg_txn GROUP BY 1)""",
    "b9_period_filter": """SELECT * FROM platform_days WHERE platform = 'ios'
      AND date > (SELECT MAX(date) FROM platform_days) - 7""",
    "k1_weekly_active_senders": "SELECT * FROM active_senders",
    "k2_signup_conversion_7d": "SELECT * FROM conversion",
    "k3_dau_by_segment": """SELECT date, segment, value, COUNT(DISTINCT user_id) AS dau
    FROM (SELECT event_date_kst AS date, e.user_id, UNNEST([
          {'segment': 'platform', 'value': COALESCE(e.platform, 'unknown')},
          {'segment': 'app_version', 'value': COALESCE(e.app_version, 'unknown')},
          {'segment': 'signup_cohort',
           'value': COALESCE(CAST(u.signup_week AS STRING), 'unknown')}], recursive := true)
      FROM stg_events e LEFT JOIN stg_users u USING (user_id)
      WHERE e.event_name = 'auth_login_completed') GROUP BY ALL""",
    "k2_signup_conversion_by_referrer": f"""SELECT segment, value, COUNT(*) AS signups,
      COUNT(*) FILTER (converted) AS converted,
      {pct('COUNT(*) FILTER (converted)', 'COUNT(*)')} AS rate
    FROM (SELECT x.segment, x.value, c.converted FROM (SELECT f.referrer, COALESCE(
          sent_at BETWEEN signed_at AND signed_at + INTERVAL 7 DAY, FALSE) AS converted
        FROM referrer_signups f LEFT JOIN first_sends USING (user_id)) c,
      LATERAL (SELECT 'all' AS segment, 'all' AS value
        UNION ALL SELECT 'referrer', c.referrer) x)
    GROUP BY segment, value""",
    "k4_gmv_event_based": "SELECT * FROM event_gmv",
    "k4_gmv_by_segment": """SELECT segment, value, 'day' AS grain, day AS period, gmv FROM segment_gmv
    UNION ALL SELECT segment, value, 'week', CAST(date_trunc('week', day) AS DATE),
      CAST(SUM(gmv) AS BIGINT) FROM segment_gmv GROUP BY ALL
    UNION ALL SELECT segment, value, 'month', CAST(date_trunc('month', day) AS DATE),
      CAST(SUM(gmv) AS BIGINT) FROM segment_gmv GROUP BY ALL""",
    "k5_arppu_by_segment": f"""SELECT month, segment, value, {big('SUM(fee)')} AS fee,
      COUNT(*) FILTER (pays) AS payers,
      {rnd(ratio('SUM(fee)', 'COUNT(*) FILTER (pays)'), 0)} AS arppu
    FROM (SELECT month, fee, pays, 'user_tier' AS segment, {tier('fee')} AS value FROM fee_months
      UNION ALL SELECT month, fee, pays, 'signup_cohort',
        COALESCE(CAST(signup_month AS STRING), 'unknown')
      FROM fee_months LEFT JOIN stg_users USING (user_id)) GROUP BY ALL""",
    "k6_mau": "SELECT * FROM kst_month_users",
    "k7_dau_mau_ratio": f"""SELECT activity_date AS date, dau, mau, {pct('dau', 'mau')} AS ratio
    FROM (SELECT activity_date, COUNT(*) AS dau FROM login_days_kst GROUP BY 1)
    JOIN kst_month_users ON month = date_trunc('month', activity_date)""",
    "k8_signup_completion_rate": _rate(
        "auth_signup_started", "started", "auth_signup_completed", "completed"
    ),
    "k9_identity_rate": _rate(
        "auth_signup_completed", "completed", "auth_identity_verified", "verified"
    ),
    "k10_transfer_success_rate": _rate(
        "payment_transfer_confirmed", "confirmed", "payment_transfer_completed", "completed"
    ),
    "k11_avg_transfer_amount": f"""SELECT event_date_kst AS date, {rnd('AVG(amount)')} AS avg_amount
    FROM stg_events WHERE event_name = 'payment_transfer_completed' GROUP BY 1""",
    "k12_charge_frequency": f"""SELECT *, {rnd(ratio('charges', 'users'))} AS freq FROM (
      SELECT CAST(date_trunc('month', event_date_kst) AS DATE) AS month, COUNT(*) AS charges,
        COUNT(DISTINCT user_id) AS users FROM stg_events
      WHERE event_name = 'payment_charge_completed' GROUP BY 1)""",
    "k13_qr_share": f"""SELECT *, {pct('qr', 'payments')} AS share FROM (
      SELECT event_date_kst AS date, COUNT(*) FILTER (event_name = 'payment_qr_completed') AS qr,
        COUNT(*) AS payments FROM stg_events
      WHERE event_name IN ({quoted(V.COMPLETED_PAYMENTS)}) GROUP BY 1)""",
    "k14_error_rate": f"""SELECT *, {pct('errors', 'total')} AS rate FROM (
      SELECT event_date_kst AS date, COUNT(*) FILTER (event_name IN ('payment_transfer_failed',
        'system_error_occurred')) AS errors, COUNT(*) AS total FROM stg_events GROUP BY 1)""",
    "k15_push_ctr": _daily_pair(
        "system_push_received", "received", "system_push_clicked", "clicked",
        "ctr", "clicked", "received",
    ),
    "k15_push_ctr_by_campaign": f"""SELECT *, {pct('clicked', 'received')} AS ctr FROM (
      SELECT event_date_kst AS date, campaign_id,
        COUNT(*) FILTER (event_name = 'system_push_received') AS received,
        COUNT(*) FILTER (event_name = 'system_push_clicked') AS clicked FROM stg_events
      WHERE event_name IN ('system_push_received', 'system_push_clicked') GROUP BY 1, 2)""",
    "k16_gmv_decomposition": f"""SELECT date, kind, users, {ratio('n', 'users')} AS per_user,
      {ratio('gmv', 'n')} AS avg_amount, gmv
    FROM (SELECT transaction_date AS date, transaction_type AS kind,
        COUNT(DISTINCT user_id) AS users, COUNT(*) AS n, {big('SUM(amount)')} AS gmv FROM stg_txn
      WHERE status = 'completed' AND transaction_type IN ('transfer', 'qr_payment')
      GROUP BY ALL)""",
    "k17_dau_decomposition": """SELECT activity_date AS date, dau, new_users, returning_users,
      dau - lag(dau) OVER o AS dau_change, new_users - lag(new_users) OVER o AS new_users_change,
      returning_users - lag(returning_users) OVER o AS returning_users_change
    FROM daily_users WINDOW o AS (ORDER BY activity_date)""",
    "k18_revenue_decomposition": f"""SELECT month, type, paid_txns,
      {rnd(ratio('revenue', 'paid_txns'))} AS avg_fee, revenue
    FROM (SELECT transaction_month AS month, transaction_type AS type,
        COUNT(*) FILTER (status = 'completed' AND fee > 0) AS paid_txns,
        {big("COALESCE(SUM(fee) FILTER (status = 'completed'), 0)")} AS revenue
      FROM stg_txn GROUP BY ALL)""",
    "k19_period_growth": f"""SELECT *, {pct('value - prev', 'prev')} AS growth_pct
    FROM (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY period) AS prev FROM (
        SELECT 'weekly_active_senders' AS metric,
          CAST(date_trunc('month', date) AS DATE) AS period, arg_max(was_7d, date) AS value
        FROM active_senders GROUP BY 2
        UNION ALL
        SELECT 'fee_revenue', transaction_month, {big('SUM(fee_revenue)')}
        FROM revenue_base GROUP BY 2))""",
    "k20_kpi_vs_target": f"""SELECT metric, value, target, COALESCE(value >= target, FALSE) AS met
    FROM (SELECT 'dau' AS metric, CAST(arg_max(dau, date) AS DOUBLE) AS value FROM daily_kpi
        UNION ALL SELECT 'signup_conversion_7d', rate FROM conversion WHERE segment = 'all'
        UNION ALL SELECT 'retention_d' || day_n, mean_rate FROM retention_means
        UNION ALL SELECT 'arppu', arg_max(arppu, month) FROM arppu_months
        UNION ALL SELECT 'monthly_gmv', CAST(arg_max(gmv, period) AS DOUBLE) FROM event_gmv
          WHERE grain = 'month')
    JOIN (VALUES {", ".join(f"('{k}', {v!r}::DOUBLE)" for k, v in V.TARGETS.items())})
      t(metric, target) USING (metric)""",
    "k21_screen_dwell": f"""SELECT prop_screen_name AS screen_name,
      COUNT(*) FILTER (event_name = 'screen_viewed') AS views,
      COUNT(*) FILTER (event_name = 'screen_exited') AS exits,
      {rnd("AVG(prop_duration_ms) FILTER (event_name = 'screen_exited')")} AS avg_ms
    FROM raw_events WHERE event_name IN ('screen_viewed', 'screen_exited') GROUP BY 1""",
    "k22_login_success_rate": _daily_pair(
        "auth_login_attempted", "attempted", "auth_login_completed", "completed",
        "rate", "completed", "attempted",
    ),
}
