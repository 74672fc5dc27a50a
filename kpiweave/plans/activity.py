"""Active users: per day, rolling, new against returning, by segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import month_start, pct, per
from kpiweave.operators.distinct import conditional_distinct, daily_distinct
from kpiweave.plans.staging import NTZ, not_test_account


def daily_logins(stg_events: DataFrame) -> DataFrame:
    """Logins per (local day, user, platform). Parts of a day add up."""
    logins = stg_events.where(F.col("event_name") == V.LOGIN)
    keys = [F.col("event_date_kst").alias("activity_date"), "user_id", "platform"]
    return logins.groupBy(*keys).agg(F.count("*").alias("login_count"))


def tagged_logins(daily_logins: DataFrame, stg_users: DataFrame) -> DataFrame:
    """``daily_logins``, each new on the signup day or else returning."""
    is_new = F.col("activity_date") == F.col("signup_date")
    signups = stg_users.select("user_id", "signup_date")
    return daily_logins.join(signups, "user_id", "left").select(
        "activity_date",
        "user_id",
        "platform",
        F.when(is_new, "new").otherwise("returning").alias("user_type"),
        "login_count",
        "signup_date",
    )


def int_daily_active_users(stg_events: DataFrame, stg_users: DataFrame) -> DataFrame:
    """Logins per (local day, user, platform), tagged new on the signup day."""
    return tagged_logins(daily_logins(stg_events), stg_users)


def _daily_flags() -> dict:
    return {
        "new_users": F.col("user_type") == "new",
        "returning_users": F.col("user_type") == "returning",
        **{f"dau_{p}": F.col("platform") == p for p in V.PLATFORMS},
    }


ROLLING = {"wau_7d": 7, "mau_30d": 30}


def daily_users(int_dau: DataFrame) -> DataFrame:
    return daily_distinct(int_dau, "user_id", "activity_date", "dau", _daily_flags())


def rolling_users(int_dau: DataFrame) -> DataFrame:
    """True distinct users of the trailing 7 and 30 calendar days, on each login day."""
    return daily_distinct(int_dau, "user_id", "activity_date", windows=ROLLING)


def daily_and_rolling_users(int_dau: DataFrame) -> DataFrame:
    """``daily_users`` and ``rolling_users`` from one pass over the user-days."""
    return daily_distinct(int_dau, "user_id", "activity_date", "dau", _daily_flags(), ROLLING)


# --- ad-hoc analyses: UTC days ------------------------------------------------


def raw_logins(events: DataFrame) -> DataFrame:
    """Logins on UTC days, test accounts and anonymous rows included."""
    return events.where(F.col("event_name") == V.LOGIN).select(
        F.col("event_timestamp").cast(NTZ).cast("date").alias("login_date"), "user_id", "platform"
    )


def dau_new_returning(events: DataFrame) -> DataFrame:
    """New on the first login ever seen; later logins are returning."""
    user_days = (
        raw_logins(events)
        .where(not_test_account())
        .groupBy("user_id", "login_date")
        .agg(*[F.max((F.col("platform") == p).cast("int")).alias(f"dau_{p}") for p in V.PLATFORMS])
    )
    # A user has at most one row per calendar day here, however busy.
    first = F.min("login_date").over(Window.partitionBy("user_id"))
    is_first = (F.col("login_date") == first).cast("int")
    return (
        user_days.withColumn("is_first", is_first)
        .groupBy("login_date")
        .agg(
            F.count("*").alias("dau"),
            F.sum("is_first").alias("new_users"),
            F.sum(1 - F.col("is_first")).alias("returning_users"),
            *[F.coalesce(F.sum(f"dau_{p}"), F.lit(0)).alias(f"dau_{p}") for p in V.PLATFORMS],
        )
    )


def _raw_dau(events: DataFrame) -> DataFrame:
    return conditional_distinct(raw_logins(events), ["login_date"], "user_id", "dau")


def rolling_wau(events: DataFrame) -> DataFrame:
    """Moving sum and mean of DAU over seven *rows* (a missing day is not a zero)."""
    last7 = Window.orderBy("login_date").rowsBetween(-6, Window.currentRow)
    return _raw_dau(events).select(
        "login_date",
        "dau",
        F.sum("dau").over(last7).alias("wau_7d_sum"),
        F.avg("dau").over(last7).alias("wau_7d_avg"),
    )


def _daily_and_monthly(logins: DataFrame, day: str) -> DataFrame:
    """day, dau, mau from one pass and without a join.

    A user is new to a month on the first active day in it; the month's users are the sum of
    those over its days.
    """
    dated = logins.where(F.col(day).isNotNull())
    user_days = dated.groupBy("user_id", day).agg(F.lit(1).alias("_one"))
    before = F.lag(day).over(Window.partitionBy("user_id").orderBy(day))
    month = month_start(F.col(day))
    new_to_month = F.coalesce(month_start(F.col("_before")) < month, F.lit(True))
    daily = (
        user_days.withColumn("_before", before)
        .groupBy(day)
        .agg(
            F.count("user_id").alias("dau"),
            F.count_if(F.col("user_id").isNotNull() & new_to_month).alias("_new"),
        )
    )
    users = F.sum("_new").over(Window.partitionBy(month)).alias("mau")
    return daily.select(day, "dau", users)


def stickiness(events: DataFrame) -> DataFrame:
    """DAU against the distinct users of the same calendar month."""
    rate = pct(F.col("dau"), F.col("mau")).alias("stickiness_pct")
    return _daily_and_monthly(raw_logins(events), "login_date").select(
        F.col("login_date").alias("dt"), "dau", "mau", rate
    )


# --- metric dictionary ----------------------------------------------------------


def weekly_active_senders(stg_events: DataFrame) -> DataFrame:
    """Distinct users with a completed transfer in the trailing seven days."""
    done = stg_events.where(F.col("event_name") == V.TRANSFER_DONE)
    return daily_distinct(done, "user_id", "event_date_kst", windows={"was_7d": 7}).select(
        F.col("event_date_kst").alias("date"), "was_7d"
    )


def dau_by_segment(stg_events: DataFrame, stg_users: DataFrame) -> DataFrame:
    """DAU by platform, app version and signup week, one row per segment value."""
    login = stg_events.where(F.col("event_name") == V.LOGIN)
    user_days = login.groupBy(
        F.col("event_date_kst").alias("date"), "user_id", "platform", "app_version"
    ).agg(F.lit(1).alias("_one"))
    cohorts = stg_users.select("user_id", "signup_week")
    unknown = F.lit("unknown")

    def pair(segment: str, value):
        return F.struct(
            F.lit(segment).alias("segment"), F.coalesce(value, unknown).alias("value")
        )

    segments = F.array(
        pair("platform", F.col("platform")),
        pair("app_version", F.col("app_version")),
        pair("signup_cohort", F.col("signup_week").cast("string")),
    )
    long = user_days.join(cohorts, "user_id", "left").select(
        "date", "user_id", F.inline(segments)
    )
    return conditional_distinct(long, ["date", "segment", "value"], "user_id", "dau")


def mau(stg_events: DataFrame) -> DataFrame:
    login = stg_events.where(F.col("event_name") == V.LOGIN)
    months = login.select(month_start(F.col("event_date_kst")).alias("month"), "user_id")
    return conditional_distinct(months, ["month"], "user_id", "mau")


def dau_mau_ratio(stg_events: DataFrame) -> DataFrame:
    login = stg_events.where(F.col("event_name") == V.LOGIN)
    days = login.select(F.col("event_date_kst").alias("date"), "user_id")
    ratio = pct(F.col("dau"), F.col("mau")).alias("ratio")
    return _daily_and_monthly(days, "date").select("date", "dau", "mau", ratio)


def dau_decomposition(daily: DataFrame) -> DataFrame:
    """New and returning users and what each adds to the change since the day before."""
    order = Window.orderBy("activity_date")

    def change(name: str):
        return (F.col(name) - F.lag(name).over(order)).cast("bigint").alias(f"{name}_change")

    return daily.select(
        F.col("activity_date").alias("date"),
        "dau",
        "new_users",
        "returning_users",
        change("dau"),
        change("new_users"),
        change("returning_users"),
    )


def charge_frequency(stg_events: DataFrame) -> DataFrame:
    """Charges per charging user and month."""
    charges = stg_events.where(F.col("event_name") == V.CHARGE_DONE).select(
        month_start(F.col("event_date_kst")).alias("month"), "user_id"
    )
    counted = conditional_distinct(
        charges, ["month"], "user_id", "users", partials={"charges": ("sum", F.count("*"))}
    )
    return counted.select(
        "month", "charges", "users", per(F.col("charges"), F.col("users"), 2).alias("freq")
    )


