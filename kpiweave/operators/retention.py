"""Retention of signup cohorts from (user, day) activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.functions import pct


def signup_activity(signups: DataFrame, activity: DataFrame, how: str) -> DataFrame:
    """Signups joined with their distinct active days and the days since signup.

    ``activity`` holds a user at most once per day, so a busy user adds no more rows than
    the calendar has days.
    """
    days = F.datediff("activity_date", "signup_date").alias("days_since_signup")
    return signups.join(activity, "user_id", how).select("*", days)


def n_day_flags(days: Sequence[int], prefix: str, column: str = "days_since_signup") -> list:
    return [F.max(F.when(F.col(column) == n, 1).otherwise(0)).alias(f"{prefix}{n}") for n in days]


def n_day_retention(
    joined: DataFrame,
    cohort: Sequence[str],
    days: Sequence[int],
    users_name: str,
    rate_name: str,
    size: str = "cohort_size",
) -> DataFrame:
    """Per cohort: size, users back on day n, and the rate; names take ``{n}``."""
    per_user = joined.groupBy(*cohort, "user_id").agg(*n_day_flags(days, "_d"))
    sums = [F.sum(f"_d{n}").alias(users_name.format(n=n)) for n in days]
    sized = per_user.groupBy(*cohort).agg(F.count("user_id").alias(size), *sums)
    rates = [
        pct(F.col(users_name.format(n=n)), F.col(size)).alias(rate_name.format(n=n)) for n in days
    ]
    return sized.select(*cohort, size, *[users_name.format(n=n) for n in days], *rates)


def retention_curve(
    signups: DataFrame, activity: DataFrame, cohort: str = "cohort_week", last_day: int = 30
) -> DataFrame:
    """Cohort x day 0..last_day with the share of all signups of the cohort."""
    active = (
        signup_activity(signups, activity, "inner")
        .where(F.col("days_since_signup").between(0, last_day))
        .groupBy(cohort, "days_since_signup", "user_id")
        .agg(F.lit(1).alias("_one"))
        .groupBy(cohort, F.col("days_since_signup").alias("day_n"))
        .agg(F.count("user_id").alias("active_users"))
    )
    sizes = (
        signups.groupBy(cohort, "user_id")
        .agg(F.lit(1).alias("_one"))
        .groupBy(cohort)
        .agg(F.count("user_id").alias("cohort_size"))
    )
    rate = pct(F.col("active_users"), F.col("cohort_size")).alias("retention_rate")
    return active.join(sizes, cohort).select(
        cohort, "day_n", "active_users", "cohort_size", rate
    )
