"""Stream transformations. Each takes and returns a DataFrame; all also run on batches.

Times are zone-free UTC wall clocks in the tables. Watermarks need an instant, so each
operator derives ``event_at`` from them, independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import instant, kst, micros_between, per, utc_wall
from kpiweave.operators.sketches import quantile, registers_for, size_for, trailing_distinct
from kpiweave.plans.staging import not_test_account
from kpiweave.quality.monitors import broken_rules, envelope_rules, is_future, on_time

DELAY = "10 minutes"


def _day_offset(tz_offset_hours: int) -> str:
    """Local midnight as an offset from UTC midnight."""
    return f"{-tz_offset_hours % 24} hours"


def timed(df: DataFrame, column: str, delay: str = DELAY) -> DataFrame:
    return df.withColumn("event_at", instant(F.col(column))).withWatermark("event_at", delay)


def validate(
    events: DataFrame, event_id_pattern: str | None = V.UUID_PATTERN, minutes: int = 5
) -> DataFrame:
    """Adds ``reasons`` (rules broken) and ``route`` (valid or quarantine)."""
    rules = envelope_rules(events, event_id_pattern) | {"future_timestamp": is_future(minutes)}
    reasons = events.withColumn("reasons", broken_rules(rules))
    return reasons.withColumn(
        "route", F.when(F.size("reasons") == 0, "valid").otherwise("quarantine")
    )


def dedup(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Drops repeats of an event_id that arrive within the watermark delay.

    State is one key per event of the delay, whatever the age of the stream. Rows without an
    id belong to the quarantine of ``validate`` and must not get here.
    """
    once = timed(events, "event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])
    return once.drop("event_at")


def event_counts(
    events: DataFrame, length: str = "1 day", tz_offset_hours: int = 9, delay: str = DELAY
) -> DataFrame:
    """window_start (local wall clock), event_name, n over tumbling windows."""
    offset = _day_offset(tz_offset_hours)
    window = F.window("event_at", length, length, offset).alias("window")
    counted = timed(events, "event_timestamp", delay).groupBy(window, "event_name").agg(
        F.count("*").alias("n")
    )
    start = kst(utc_wall(F.col("window.start")), tz_offset_hours).alias("window_start")
    return counted.select(start, "event_name", "n")


def sender_days(events: DataFrame, tz_offset_hours: int = 9, delay: str = DELAY) -> DataFrame:
    """Each (user, local day) with a completed transfer, once.

    The day window carries the watermark, so a key leaves the state when its day is over.
    Feed the stored result to ``daily_distinct`` for exact trailing windows.
    """
    window = F.window("event_at", "1 day", "1 day", _day_offset(tz_offset_hours))
    sent = events.where((F.col("event_name") == V.TRANSFER_DONE) & not_test_account())
    days = timed(sent, "event_timestamp", delay).select("user_id", window.alias("window"))
    once = days.dropDuplicates(["user_id", "window"])
    day = kst(utc_wall(F.col("window.start")), tz_offset_hours).cast("date")
    return once.select("user_id", day.alias("day"))


def approx_active_senders(
    events: DataFrame, tz_offset_hours: int = 9, delay: str = DELAY, error: float = 0.02
) -> DataFrame:
    """Distinct senders over sliding seven-day windows, from constant-size sketches."""
    window = F.window("event_at", "7 days", "1 day", _day_offset(tz_offset_hours))
    sent = events.where((F.col("event_name") == V.TRANSFER_DONE) & not_test_account())
    counted = timed(sent, "event_timestamp", delay).groupBy(window.alias("window")).agg(
        F.approx_count_distinct("user_id", error).alias("was_7d")
    )
    last = kst(utc_wall(F.col("window.end")), tz_offset_hours).cast("date")
    return counted.select(F.date_sub(last, 1).alias("date"), "was_7d")


def sender_sketches(
    events: DataFrame, tz_offset_hours: int = 9, delay: str = DELAY, error: float = 0.004
) -> DataFrame:
    """day and a distinct-count sketch of the day's senders, with the standard error ``error``.

    State is one sketch per open day. ``sliding_senders`` unites the stored sketches."""
    window = F.window("event_at", "1 day", "1 day", _day_offset(tz_offset_hours))
    sent = events.where((F.col("event_name") == V.TRANSFER_DONE) & not_test_account())
    sketch = F.hll_sketch_agg("user_id", registers_for(error))
    days = timed(sent, "event_timestamp", delay).groupBy(window.alias("window"))
    day = kst(utc_wall(F.col("window.start")), tz_offset_hours).cast("date")
    return days.agg(sketch.alias("senders")).select(day.alias("day"), "senders")


def sliding_senders(sketches: DataFrame, days: int = 7) -> DataFrame:
    """date, was_7d: about how many senders the trailing days had, from ``sender_sketches``."""
    found = trailing_distinct(sketches, "day", "senders", {"was_7d": days})
    return found.withColumnRenamed("day", "date")


def timeliness(
    events: DataFrame,
    length: str = "1 day",
    limit_seconds: float = 300.0,
    delay: str = DELAY,
    rank_error: float | None = None,
) -> DataFrame:
    """Delay from event to receipt per window: mean, 95th percentile, share on time.

    The exact percentile's state is a count per distinct delay of the window. With ``rank_error``
    it is a sketch of fixed size, and the percentile's rank is off by that share at most (once in
    a hundred windows more)."""
    micros = micros_between(F.col("event_timestamp"), F.col("received_at"))
    if rank_error is None:
        late = F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY delay)")
        p95 = F.col("p95")
    else:
        late = F.kll_sketch_agg_bigint("delay", size_for(rank_error))
        p95 = quantile("p95", 0.95)
    counted = (
        timed(events, "event_timestamp", delay)
        .withColumn("delay", micros)
        .groupBy(F.window("event_at", length).alias("window"))
        .agg(
            F.count("*").alias("n"),
            F.sum(micros).alias("micros"),
            late.alias("p95"),
            F.count_if(on_time(limit_seconds)).alias("punctual"),
        )
    )
    return counted.select(
        utc_wall(F.col("window.start")).alias("window_start"),
        "n",
        F.round(F.col("micros") / F.col("n") / 1e6, 6).alias("mean_s"),
        (p95 / 1e6).alias("p95_s"),
        F.round(per(F.col("punctual"), F.col("n")), 6).alias("on_time_rate"),
    )


def transaction_signals(
    transactions: DataFrame, length: str = "1 day", delay: str = DELAY
) -> DataFrame:
    """window_start, rule, hits, n: success of all transactions and count per error code.

    Each transaction feeds its rules as rows, so one stateful aggregate serves them all.
    """
    failed = (F.col("status") == "failed") & F.col("error_code").isNotNull()

    def signal(rule, hit):
        return F.struct(rule.alias("rule"), hit.cast("int").alias("hit"))

    success = signal(F.lit("success_rate"), F.col("status") == "completed")
    error = signal(F.concat(F.lit("error_surge:"), F.col("error_code")), F.lit(True))
    signals = F.when(failed, F.array(success, error)).otherwise(F.array(success))
    counted = (
        timed(transactions, "created_at", delay)
        .select("event_at", F.inline(signals))
        .groupBy(F.window("event_at", length).alias("window"), "rule")
        .agg(F.sum("hit").alias("hits"), F.count("*").alias("n"))
    )
    start = utc_wall(F.col("window.start")).alias("window_start")
    return counted.select(start, "rule", "hits", "n")


def alerts(signals: DataFrame, baseline: DataFrame, least_success_pct: float = 85.0) -> DataFrame:
    """window_start, rule, value, alert. ``baseline``: rule, limit (one row per error code)."""
    rate = F.col("rule") == "success_rate"
    share = F.round(F.col("hits") * 100.0 / F.col("n"), 2)
    value = F.when(rate, share).otherwise(F.col("n").cast("double"))
    low = rate & (F.col("value") < least_success_pct)
    surge = ~rate & (F.col("value") > F.col("limit"))
    return (
        signals.join(baseline, "rule", "left")
        .withColumn("value", value)
        .withColumn("alert", F.coalesce(low | surge, F.lit(False)))
        .select("window_start", "rule", "value", "alert")
    )


def error_baseline(daily_errors: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """rule, limit from the history of daily counts per error code."""
    limit = F.avg("error_count") + F.lit(sigmas) * F.stddev_samp("error_count")
    return daily_errors.groupBy("error_code").agg(limit.alias("limit")).select(
        F.concat(F.lit("error_surge:"), F.col("error_code")).alias("rule"), "limit"
    )
