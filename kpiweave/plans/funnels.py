"""Signup-to-first-transfer funnels and step conversion rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import count_where, micros_between, pct, seconds_between
from kpiweave.operators.funnel import first_times, step_rows
from kpiweave.operators.percentile import exact_percentiles
from kpiweave.operators.sketches import approx_percentiles

STEP_TIMES = {
    "signup_started_at": "auth_signup_started",
    "signup_submitted_at": "auth_signup_submitted",
    "signup_completed_at": "auth_signup_completed",
    "identity_verified_at": "auth_identity_verified",
    "first_transfer_started_at": "payment_transfer_started",
    "first_transfer_completed_at": "payment_transfer_completed",
}
STEP_FLAGS = {
    "reached_signup_start": "signup_started_at",
    "reached_signup_submit": "signup_submitted_at",
    "reached_signup_complete": "signup_completed_at",
    "reached_identity_verify": "identity_verified_at",
    "reached_first_transfer_start": "first_transfer_started_at",
    "reached_first_transfer_complete": "first_transfer_completed_at",
}
KEPT_TIMES = [
    "signup_started_at",
    "signup_completed_at",
    "identity_verified_at",
    "first_transfer_completed_at",
]


def int_funnel_conversion(stg_events: DataFrame) -> DataFrame:
    """Per user: first time of each step, whether it was reached, and two durations.

    Steps count in any order, so a duration can be negative.
    """
    per_user = first_times(
        stg_events, ["user_id"], "event_name", "event_timestamp_kst", STEP_TIMES
    )
    signup = seconds_between(F.col("signup_started_at"), F.col("signup_completed_at"))
    transfer = seconds_between(F.col("signup_completed_at"), F.col("first_transfer_completed_at"))
    return per_user.select(
        "user_id",
        *KEPT_TIMES,
        *[F.col(t).isNotNull().alias(flag) for flag, t in STEP_FLAGS.items()],
        (signup / 60).alias("minutes_to_signup"),
        (transfer / 3600).alias("hours_to_first_transfer"),
    )


def mart_funnel(int_funnel: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col(flag)).alias(flag) for flag in STEP_FLAGS]
    totals = int_funnel.agg(
        *counts,
        F.avg("minutes_to_signup").alias("signup_minutes"),
        (F.avg("hours_to_first_transfer") * 60).alias("transfer_minutes"),
    )
    names = ("funnel_step", "step_order", "users", "conversion_from_start", "conversion_from_prev")
    times = {"avg_time_minutes": {3: "signup_minutes", 6: "transfer_minutes"}}
    return step_rows(totals, V.FUNNEL_LABELS, list(STEP_FLAGS), names, 2, times)


def _raw_step_totals(events: DataFrame) -> DataFrame:
    """Users per step over the raw events; rows without a user count as one user."""
    steps = {f"s{i}": name for i, name in enumerate(V.FUNNEL_EVENTS, start=1)}
    reached = [F.max((F.col("event_name") == e).cast("int")).alias(s) for s, e in steps.items()]
    per_user = (
        events.where(F.col("event_name").isin(*V.FUNNEL_EVENTS)).groupBy("user_id").agg(*reached)
    )
    return per_user.agg(*[F.sum(s).alias(s) for s in steps])


def funnel_overall(events: DataFrame) -> DataFrame:
    names = ("funnel_step", "step_order", "users", "pct_from_start", "pct_from_prev")
    counts = [f"s{i}" for i in range(1, len(V.FUNNEL) + 1)]
    return step_rows(_raw_step_totals(events), V.FUNNEL_LABELS, counts, names, 1).drop("step_order")


def export_funnel(events: DataFrame) -> DataFrame:
    names = ("step_name", "step_order", "users", "pct_from_start", "pct_from_prev")
    counts = [f"s{i}" for i in range(1, len(V.FUNNEL) + 1)]
    return step_rows(_raw_step_totals(events), V.FUNNEL_LABELS, counts, names, 1)


def funnel_by_platform(events: DataFrame) -> DataFrame:
    steps = {
        "signup_started": "auth_signup_started",
        "signup_completed": V.SIGNUP_DONE,
        "first_transfer": V.TRANSFER_DONE,
    }
    reached = [F.max((F.col("event_name") == e).cast("int")).alias(s) for s, e in steps.items()]
    sums = (
        events.where(F.col("event_name").isin(*steps.values()))
        .groupBy("platform", "user_id")
        .agg(*reached)
        .groupBy("platform")
        .agg(*[F.sum(s).alias(s) for s in steps])
    )
    started = F.col("signup_started")
    return sums.select(
        "platform",
        *steps,
        pct(F.col("signup_completed"), started, 1).alias("signup_rate"),
        pct(F.col("first_transfer"), started, 1).alias("full_conversion_rate"),
    )


MINUTE = 60_000_000  # microseconds


def _step_gaps(int_funnel: DataFrame) -> DataFrame:
    """transition, micros: the time between funnel steps, several rows per user."""

    def gap(name: str, start: str, end: str):
        micros = micros_between(F.col(start), F.col(end))
        return F.struct(F.lit(name).alias("transition"), micros.alias("micros"))

    gaps = F.array(
        gap("signup_started_to_completed", "signup_started_at", "signup_completed_at"),
        gap("signup_completed_to_verified", "signup_completed_at", "identity_verified_at"),
        gap("signup_completed_to_transfer", "signup_completed_at", "first_transfer_completed_at"),
    )
    return int_funnel.select(F.inline(gaps)).where(F.col("micros").isNotNull())


def step_minutes(int_funnel: DataFrame) -> DataFrame:
    """transition, minutes: each time between funnel steps, in the unit of ``time_to_convert``."""
    minutes = (F.col("micros").cast("double") / MINUTE).alias("minutes")
    return _step_gaps(int_funnel).select("transition", minutes)


def time_to_convert(int_funnel: DataFrame, rank_error: float | None = None) -> DataFrame:
    """Quartiles, in minutes, of the time between funnel steps: exact, or from sketches with
    ranks that may be off by ``rank_error``."""
    gaps, keys = _step_gaps(int_funnel), ["transition"]
    wanted = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    if rank_error is None:
        # A second holds at most a million microseconds, and a month as many seconds or so: a
        # task's share is bounded on both levels, whatever the resolution of the times.
        quartiles = exact_percentiles(gaps, keys, "micros", wanted, bucket_width=1_000_000)
    else:
        quartiles = approx_percentiles(gaps, keys, "micros", wanted, rank_error)
    minutes = [(F.col(p) / MINUTE).alias(p) for p in ("p25", "p50", "p75")]
    return quartiles.select("transition", "n", *minutes)


def time_to_convert_histogram(int_funnel: DataFrame, bin_minutes: int = 1440) -> DataFrame:
    """transition, from_minutes, n: users per bin of equal width (negative before zero)."""
    width = bin_minutes * MINUTE
    start = F.floor(F.col("micros") / F.lit(width)).cast("bigint") * bin_minutes
    return (
        _step_gaps(int_funnel)
        .groupBy("transition", start.alias("from_minutes"))
        .agg(F.count("*").alias("n"))
    )


def signup_conversion_7d(
    stg_events: DataFrame,
    segments: Sequence[str] = ("signup_method", "platform"),
    within_days: int = 7,
) -> DataFrame:
    """Signed-up users whose first transfer came within seven days, overall and by segment.

    A user's segment is what the first signup event says.
    """
    signed = F.col("event_name") == V.SIGNUP_DONE
    sent = F.col("event_name") == V.TRANSFER_DONE
    ts = F.col("event_timestamp_kst")
    # Per (user, segment values) only times are aggregated, which hashing can do; the first
    # signup with its segment values is then picked from the few rows left per user.
    narrowed = (
        stg_events.where(signed | sent)
        .groupBy("user_id", *segments)
        .agg(
            F.min(F.when(signed, ts)).alias("signed_at"),
            F.min(F.when(sent, ts)).alias("sent_at"),
        )
    )
    first_signup = F.struct(F.col("signed_at").alias("at"), *segments)
    per_user = (
        narrowed.groupBy("user_id")
        .agg(
            F.min(F.when(F.col("signed_at").isNotNull(), first_signup)).alias("signup"),
            F.min("sent_at").alias("sent_at"),
        )
        .where(F.col("signup").isNotNull())
    )
    limit = F.col("signup.at") + F.make_dt_interval(days=F.lit(within_days))
    converted = F.coalesce(F.col("sent_at").between(F.col("signup.at"), limit), F.lit(False))

    def pair(segment, value):
        return F.struct(F.lit(segment).alias("segment"), value.alias("value"))

    pairs = [pair("all", F.lit("all"))]
    pairs += [pair(s, F.coalesce(F.col(f"signup.{s}"), F.lit("unknown"))) for s in segments]
    return (
        per_user.select(converted.alias("converted"), F.inline(F.array(*pairs)))
        .groupBy("segment", "value")
        .agg(F.count("*").alias("signups"), count_where(F.col("converted")).alias("converted"))
        .withColumn("rate", pct(F.col("converted"), F.col("signups")))
    )


def _rate(stg_events: DataFrame, base: str, base_name: str, done: str, done_name: str):
    name = F.col("event_name")
    return stg_events.agg(
        count_where(name == base).alias(base_name),
        count_where(name == done).alias(done_name),
    ).withColumn("rate", pct(F.col(done_name), F.col(base_name)))


def signup_completion_rate(stg_events: DataFrame) -> DataFrame:
    return _rate(stg_events, "auth_signup_started", "started", V.SIGNUP_DONE, "completed")


def identity_rate(stg_events: DataFrame) -> DataFrame:
    return _rate(stg_events, V.SIGNUP_DONE, "completed", "auth_identity_verified", "verified")


def transfer_success_rate(stg_events: DataFrame) -> DataFrame:
    return _rate(stg_events, V.TRANSFER_CONFIRMED, "confirmed", V.TRANSFER_DONE, "completed")
