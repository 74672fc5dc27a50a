"""Registered Spark queries: models, analyses, extracts, metric formulas."""

from __future__ import annotations

import datetime as dt
import tempfile
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import epoch_micros
from kpiweave.operators import bitmaps, ranges, sketches
from kpiweave.plans import activity, anomaly, cohorts, funnels, kpi, revenue, staging
from kpiweave.sources.mart_store import MartStore
from kpiweave.sources.writers import SHARED_DIR, scratch_path
from verification import fixture

AS_OF_DATE = dt.date(2024, 2, 28)
METHOD_COHORT = ["signup_week", "signup_method"]
SALT = "pepper"


class Tables:
    """The raw and staged tables of one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self):
        return fixture.raw_events(self.spark, self.sf_dir)

    @cached_property
    def users(self):
        return fixture.raw_users(self.spark, self.sf_dir)

    @cached_property
    def transactions(self):
        return fixture.raw_transactions(self.spark, self.sf_dir)

    @cached_property
    def stg_events(self):
        return staging.stg_events(self.events)

    @cached_property
    def stg_users(self):
        return staging.stg_users(self.users, AS_OF_DATE)

    @cached_property
    def stg_txn(self):
        return staging.stg_transactions(self.transactions)

    @cached_property
    def int_dau(self):
        return activity.int_daily_active_users(self.stg_events, self.stg_users)

    @cached_property
    def int_funnel(self):
        return funnels.int_funnel_conversion(self.stg_events)

    @cached_property
    def int_cohort(self):
        return cohorts.int_user_cohort(self.stg_users, self.stg_events)

    @cached_property
    def daily_kpi(self):
        return kpi.mart_daily_kpi(self.int_dau, self.stg_txn)

    @cached_property
    def funnel(self):
        return funnels.mart_funnel(self.int_funnel)

    @cached_property
    def retention(self):
        return cohorts.mart_retention(self.int_cohort)

    @cached_property
    def revenue(self):
        return revenue.mart_revenue(self.stg_txn)

    @cached_property
    def export_kpi(self):
        return kpi.export_daily_kpi(self.events, self.transactions)

    @cached_property
    def marts(self):
        """Stored marts of this run; only what asks for them is computed."""
        return MartStore(self.spark, scratch_path(self.spark, "marts"), "2024-02-28")

    @cached_property
    def curve(self):
        return cohorts.cohort_curve(self.users, self.events)


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Doubles whose last bit depends on summation order are compared to six decimals."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def on_tables(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # A local session may come without the shared folder that a cluster must name.
        if spark.sparkContext.master.startswith("local[") and not spark.conf.get(SHARED_DIR, None):
            spark.conf.set(SHARED_DIR, tempfile.mkdtemp(prefix="kpiweave-"))
        return fn(Tables(spark, sf_dir))

    return run


def rolling_by_segment(t: Tables) -> DataFrame:
    """Users of the trailing 7 and 30 days by platform and app version, from stored bitmaps."""
    root = scratch_path(t.spark, "bitmaps")
    login = t.stg_events.where(F.col("event_name") == V.LOGIN)
    pairs = [
        F.struct(F.lit(s).alias("segment"), F.coalesce(s, F.lit("unknown")).alias("value"))
        for s in ("platform", "app_version")
    ]
    long = login.select("user_id", F.col("event_date_kst").alias("date"), F.inline(F.array(*pairs)))
    numbers = bitmaps.dense_numbers(login, "user_id", f"{root}/users")
    by = ["segment", "value"]
    days = bitmaps.day_bitmaps(long, numbers, "user_id", "date", by)
    days.write.parquet(f"{root}/days")
    stored = t.spark.read.parquet(f"{root}/days")
    return bitmaps.trailing_users(stored, "date", {"users_7d": 7, "users_30d": 30}, by)


def errors_near_failures(t: Tables) -> DataFrame:
    """Per failed transaction: error events within an hour before or after, of any user."""
    hour = 3600 * 1_000_000
    at = epoch_micros(F.col("created_at"))
    failed = t.transactions.where("status = 'failed'")
    spans = failed.select("transaction_id", (at - hour).alias("low"), (at + hour).alias("high"))
    errors = t.events.where(F.col("event_name").isin(*V.ERROR_EVENTS))
    points = errors.select("event_id", epoch_micros(F.col("event_timestamp")).alias("at"))
    near = ranges.range_join(points, spans, "at", "low", "high")
    return near.groupBy("transaction_id").agg(F.count("*").alias("errors"))


def targets_met(t: Tables) -> DataFrame:
    """The headline figures against their targets, from the stored marts of a run."""
    get = t.marts.get
    return kpi.kpi_vs_target(
        get("daily_kpi", lambda: t.daily_kpi),
        get("signup_conversion", lambda: funnels.signup_conversion_7d(t.stg_events)),
        get("retention_kpi", lambda: cohorts.retention_kpi(t.curve)),
        get("arppu", lambda: revenue.monthly_arppu(t.transactions)),
        get("gmv", lambda: revenue.gmv_event_based(t.stg_events)),
    )


#: Sketches are asked for ranks this exact, and must keep within the tolerance in every group.
RANK_ERROR, TOLERANCE = 0.005, 0.02


def sketched_revenue(t: Tables) -> DataFrame:
    """The mart with medians from sketches, which are told to be near instead of shown."""
    keys = list(revenue.REVENUE_KEYS)
    mart = revenue.mart_revenue(t.stg_txn, RANK_ERROR)
    done = t.stg_txn.where("status = 'completed'")
    ranked = sketches.ranks(done, keys, "amount", mart, "median_amount")
    near = sketches.within(ranked, keys, 0.5, TOLERANCE, "median_near")
    return mart.drop("median_amount").join(near, keys, "left")


def sketched_conversion(t: Tables) -> DataFrame:
    found = funnels.time_to_convert(t.int_funnel, RANK_ERROR)
    gaps = funnels.step_minutes(t.int_funnel)
    out = found.select("transition", "n")
    for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        ranked = sketches.ranks(gaps, ["transition"], "minutes", found, name)
        near = sketches.within(ranked, ["transition"], p, TOLERANCE, f"{name}_near")
        out = out.join(near, "transition")
    return out


_MODELS: dict[str, Callable[[Tables], DataFrame]] = {
    "st1_stg_events": lambda t: t.stg_events,
    "st2_stg_transactions": lambda t: t.stg_txn,
    "st3_stg_users": lambda t: t.stg_users,
    "st4_mask_pii": lambda t: staging.mask_pii(t.users, SALT),
    "i1_int_daily_active_users": lambda t: t.int_dau,
    "i2_int_funnel_conversion": lambda t: t.int_funnel,
    "i3_int_user_cohort": lambda t: t.int_cohort,
    "m1_mart_daily_kpi": lambda t: t.daily_kpi,
    "m1a_daily_users": lambda t: activity.daily_users(t.int_dau),
    "m1b_daily_transactions": lambda t: revenue.daily_transactions(t.stg_txn),
    "m1c_rolling_users_by_segment": rolling_by_segment,
    "p1_range_join_errors_near_failures": errors_near_failures,
    "m1c_rolling_users": lambda t: activity.rolling_users(t.int_dau),
    "m2_mart_funnel": lambda t: rounded(t.funnel, ["avg_time_minutes"]),
    "m3_mart_retention": lambda t: t.retention,
    "m3_retention_by_signup_method": lambda t: cohorts.mart_retention(
        cohorts.int_user_cohort(t.stg_users, t.stg_events, METHOD_COHORT), METHOD_COHORT
    ),
    "m4_mart_revenue": lambda t: t.revenue,
    "m4_mart_revenue_sketch": sketched_revenue,
    "q1_dau_new_returning": lambda t: activity.dau_new_returning(t.events),
    "q2_rolling_wau": lambda t: activity.rolling_wau(t.events),
    "q3_stickiness": lambda t: activity.stickiness(t.events),
    "q4_funnel_overall": lambda t: funnels.funnel_overall(t.events),
    "q5_funnel_by_platform": lambda t: funnels.funnel_by_platform(t.events),
    "q6_classic_retention": lambda t: cohorts.classic_retention(t.users, t.events),
    "q7_retention_curve": lambda t: t.curve,
    "q8_monthly_arppu": lambda t: revenue.monthly_arppu(t.transactions),
    "q9_revenue_by_type": lambda t: revenue.revenue_by_type(t.transactions),
    "q10_user_tier_revenue": lambda t: revenue.user_tier_revenue(t.transactions),
    "q11_volume_zscore": lambda t: anomaly.volume_zscore(t.transactions),
    "q12_high_value_txn": lambda t: anomaly.high_value_txn(t.transactions),
    "q13_error_surge": lambda t: anomaly.error_surge(t.transactions),
    "x1_export_daily_kpi": lambda t: t.export_kpi,
    "x2_export_retention_cohort": lambda t: t.curve,
    "x3_export_funnel": lambda t: funnels.export_funnel(t.events),
    "x4_export_txn_summary": lambda t: revenue.export_txn_summary(t.transactions),
    "b1_kpi_trend": lambda t: kpi.kpi_trend(t.export_kpi),
    "b2_platform_share": lambda t: kpi.platform_share(t.daily_kpi),
    "b3_funnel_dropoff": lambda t: kpi.funnel_dropoff(t.funnel),
    "b4_time_to_convert": lambda t: rounded(
        funnels.time_to_convert(t.int_funnel), ["p25", "p50", "p75"]
    ),
    "b4_time_to_convert_sketch": sketched_conversion,
    "b4_time_to_convert_histogram": lambda t: funnels.time_to_convert_histogram(t.int_funnel),
    "b5_retention_kpi": lambda t: cohorts.retention_kpi(t.curve),
    "b6_hour_dow_heatmap": lambda t: revenue.hour_dow_heatmap(t.stg_txn),
    "b7_bank_distribution": lambda t: revenue.bank_distribution(t.stg_txn),
    "b8_txn_mix": lambda t: revenue.txn_mix(t.stg_txn),
    "b9_period_filter": lambda t: kpi.period_filter(
        kpi.platform_share(t.daily_kpi), days=7, platform="ios"
    ),
    "k1_weekly_active_senders": lambda t: activity.weekly_active_senders(t.stg_events),
    "k2_signup_conversion_7d": lambda t: funnels.signup_conversion_7d(t.stg_events),
    "k2_signup_conversion_by_referrer": lambda t: funnels.signup_conversion_7d(
        t.stg_events, ("referrer",)
    ),
    "k3_dau_by_segment": lambda t: activity.dau_by_segment(t.stg_events, t.stg_users),
    "k4_gmv_event_based": lambda t: revenue.gmv_event_based(t.stg_events),
    "k4_gmv_by_segment": lambda t: revenue.gmv_by_segment(t.stg_events),
    "k5_arppu_by_segment": lambda t: revenue.arppu_by_segment(t.stg_txn, t.stg_users),
    "k6_mau": lambda t: activity.mau(t.stg_events),
    "k7_dau_mau_ratio": lambda t: activity.dau_mau_ratio(t.stg_events),
    "k8_signup_completion_rate": lambda t: funnels.signup_completion_rate(t.stg_events),
    "k9_identity_rate": lambda t: funnels.identity_rate(t.stg_events),
    "k10_transfer_success_rate": lambda t: funnels.transfer_success_rate(t.stg_events),
    "k11_avg_transfer_amount": lambda t: revenue.avg_transfer_amount(t.stg_events),
    "k12_charge_frequency": lambda t: activity.charge_frequency(t.stg_events),
    "k13_qr_share": lambda t: revenue.qr_share(t.stg_events),
    "k14_error_rate": lambda t: kpi.error_rate(t.stg_events),
    "k15_push_ctr": lambda t: kpi.push_ctr(t.stg_events),
    "k15_push_ctr_by_campaign": lambda t: kpi.push_ctr(t.stg_events, "campaign_id"),
    "k16_gmv_decomposition": lambda t: revenue.gmv_decomposition(t.stg_txn),
    "k17_dau_decomposition": lambda t: activity.dau_decomposition(
        activity.daily_users(t.int_dau)
    ),
    "k18_revenue_decomposition": lambda t: revenue.revenue_decomposition(t.stg_txn),
    "k19_period_growth": lambda t: kpi.period_growth(
        activity.weekly_active_senders(t.stg_events), t.revenue
    ),
    "k20_kpi_vs_target": targets_met,
    "k21_screen_dwell": lambda t: kpi.screen_dwell(t.events),
    "k22_login_success_rate": lambda t: kpi.login_success_rate(t.stg_events),
}

MODEL_QUERIES = {key: on_tables(fn) for key, fn in _MODELS.items()}
