"""Signup cohorts and N-day retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import week_start
from kpiweave.operators.retention import (
    n_day_flags,
    n_day_retention,
    retention_curve,
    signup_activity,
)
from kpiweave.plans.activity import raw_logins

COHORT = ["signup_week", "signup_month", "platform"]


def int_user_cohort(
    stg_users: DataFrame, stg_events: DataFrame, cohort: Sequence[str] = COHORT
) -> DataFrame:
    """Every signup with each of its active local days; users never seen keep one row.

    ``cohort``: columns of the users that make up a cohort."""
    activity = (
        stg_events.where(F.col("event_name") == V.LOGIN)
        .select("user_id", F.col("event_date_kst").alias("activity_date"))
        .distinct()
    )
    signups = stg_users.select("user_id", "signup_date", *cohort)
    keys = ["user_id", "signup_date", *cohort, "activity_date", "days_since_signup"]
    joined = signup_activity(signups, activity, "left")
    # The join left the rows by user, so this grouping needs no further exchange.
    return joined.groupBy(*keys).agg(*n_day_flags(V.RETENTION_DAYS, "retained_d"))


def mart_retention(int_cohort: DataFrame, cohort: Sequence[str] = COHORT) -> DataFrame:
    """Per cohort: all signups are the base, also the never active."""
    return n_day_retention(
        int_cohort, cohort, V.RETENTION_DAYS, "retained_d{n}_users", "retention_d{n}"
    )


def _raw_signups(users: DataFrame) -> DataFrame:
    signup = F.col("signup_date").cast("date")
    return users.select(
        "user_id", signup.alias("signup_date"), week_start(signup).alias("cohort_week")
    )


def _raw_activity(events: DataFrame) -> DataFrame:
    return (
        raw_logins(events)
        .where(F.col("user_id").isNotNull())
        .select("user_id", F.col("login_date").alias("activity_date"))
        .distinct()
    )


def classic_retention(users: DataFrame, events: DataFrame) -> DataFrame:
    """Weekly cohorts over UTC days; only users with some login are in the base."""
    joined = signup_activity(_raw_signups(users), _raw_activity(events), "inner")
    return n_day_retention(
        joined, ["cohort_week"], V.RETENTION_DAYS, "d{n}_users", "d{n}_retention"
    )


def cohort_curve(users: DataFrame, events: DataFrame) -> DataFrame:
    """Cohort x day 0..30 in long form; the base is every signup of the week."""
    return retention_curve(_raw_signups(users), _raw_activity(events))


def retention_kpi(curve: DataFrame, days: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """Mean rate over the cohorts on the headline days, with its band."""
    mean = curve.where(F.col("day_n").isin(*days)).groupBy("day_n").agg(
        F.round(F.avg("retention_rate"), 2).alias("mean_rate")
    )
    (high, good), (middle, fair), (_, low) = V.RETENTION_BANDS
    rate = F.col("mean_rate")
    return mean.withColumn(
        "band", F.when(rate >= high, good).when(rate >= middle, fair).otherwise(low)
    )
