"""Rules over finished marts and extracts. Frames here hold one row per day, month or step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import month_start


def dau_positive(daily_kpi: DataFrame) -> DataFrame:
    return daily_kpi.where(F.col("dau") <= 0).select("date", "dau")


def revenue_not_negative(revenue: DataFrame) -> DataFrame:
    return revenue.where(F.col("fee_revenue") < 0).select(
        "transaction_month", "transaction_type", "fee_revenue"
    )


def dau_within_mau(stickiness: DataFrame) -> DataFrame:
    return stickiness.where(F.col("dau") > F.col("mau")).select(
        "dt", month_start(F.col("dt")).alias("month"), "dau", "mau"
    )


def gmv_parts_add_up(daily_kpi: DataFrame, tolerance: int = 100) -> DataFrame:
    """Days on which transfer and QR amounts do not make up the total."""
    diff = F.col("gmv") - F.col("transfer_gmv") - F.col("qr_payment_gmv")
    return daily_kpi.select("date", "gmv", diff.alias("diff")).where(F.abs("diff") > tolerance)


def retention_decreases(retention: DataFrame) -> DataFrame:
    """Cohorts in which more users are back on a later day than on an earlier one."""
    rates = [f"retention_d{n}" for n in V.RETENTION_DAYS]
    rises = F.lit(False)
    for earlier, later in zip(rates, rates[1:]):
        rises = rises | (F.col(later) > F.col(earlier))
    return retention.where(rises).select("signup_week", "signup_month", "platform", *rates)


def conversion_in_range(funnel: DataFrame) -> DataFrame:
    def outside(name: str):
        return ~F.col(name).between(0, 100)

    bad = outside("conversion_from_start") | outside("conversion_from_prev")
    return funnel.where(bad).select(
        "step_order", "users", "conversion_from_start", "conversion_from_prev"
    )


def export_validation(
    daily: DataFrame, retention: DataFrame, funnel: DataFrame, summary: DataFrame
) -> DataFrame:
    """extract, rule, ok for the four BI extracts, each read once."""

    def rules(extract: str, df: DataFrame, checks: dict) -> DataFrame:
        rows = [
            F.struct(
                F.lit(extract).alias("extract"),
                F.lit(rule).alias("rule"),
                F.coalesce(F.col(rule), F.lit(False)).alias("ok"),
            )
            for rule in checks
        ]
        one = df.agg(*[check.alias(rule) for rule, check in checks.items()])
        return one.select(F.inline(F.array(*rows)))

    not_empty = F.count("*") > 0
    first = F.min_by("pct_from_start", "step_order") == 100.0
    return (
        rules(
            "daily_kpi",
            daily,
            {
                "not_empty": not_empty,
                "dau_positive": F.min("dau") > 0,
                "gmv_not_negative": F.min("gmv") >= 0,
            },
        )
        .unionByName(
            rules(
                "retention_cohort",
                retention,
                {"not_empty": not_empty, "rate_at_most_100": F.max("retention_rate") <= 100},
            )
        )
        .unionByName(
            rules(
                "funnel_data",
                funnel,
                {"six_steps": F.count("*") == len(V.FUNNEL), "starts_at_100": first},
            )
        )
        .unionByName(
            rules(
                "transaction_summary",
                summary,
                {"not_empty": not_empty, "totals_not_negative": F.min("total_amount") >= 0},
            )
        )
    )
