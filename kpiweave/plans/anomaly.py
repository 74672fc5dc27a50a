"""Unusual days, unusual transactions, unusual error counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import count_where, exact_avg, pct, sum_where
from kpiweave.operators.hotkeys import join_key_stats
from kpiweave.operators.zscore import series_stats, zscore
from kpiweave.plans.staging import NTZ


def _daily_volume(transactions: DataFrame) -> DataFrame:
    done, failed = F.col("status") == "completed", F.col("status") == "failed"
    daily = transactions.groupBy(F.col("created_at").cast(NTZ).cast("date").alias("txn_date")).agg(
        F.count("*").alias("txn_count"),
        sum_where(F.col("amount"), done).alias("daily_gmv"),
        pct(count_where(failed), F.count("*")).alias("error_rate"),
    )
    return series_stats(daily, ["txn_count", "daily_gmv", "error_rate"])


def volume_zscore(transactions: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """Daily count, GMV and error rate with z-scores; an unknown z-score is not an alert."""

    def flag(metric: str):
        return F.when(F.abs(zscore(metric)) > sigmas, V.ALERT).otherwise(V.OK)

    return _daily_volume(transactions).select(
        "txn_date",
        "txn_count",
        "daily_gmv",
        "error_rate",
        F.round(zscore("txn_count"), 2).alias("txn_count_zscore"),
        F.round(zscore("daily_gmv"), 2).alias("gmv_zscore"),
        F.round(zscore("error_rate"), 2).alias("error_rate_zscore"),
        flag("txn_count").alias("txn_alert"),
        flag("error_rate").alias("error_alert"),
    )


def metric_anomaly(transactions: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """One row per metric and unusual day: value, expectation, change and direction."""
    metrics = ["txn_count", "daily_gmv", "error_rate"]
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m).cast("double").alias("value"),
            F.col(f"mean_{m}").alias("expected"),
            zscore(m).alias("z"),
        )
        for m in metrics
    ]
    long = _daily_volume(transactions).select("txn_date", F.inline(F.array(*rows)))
    return long.where(F.abs("z") > sigmas).select(
        "txn_date",
        "metric",
        "value",
        F.round("expected", 4).alias("expected"),
        pct(F.col("value") - F.col("expected"), F.col("expected"), 1).alias("pct"),
        F.round("z", 2).alias("z"),
        F.when(F.col("z") > 0, V.SURGE_UP).otherwise(V.SURGE_DOWN).alias("direction"),
    )


def high_value_txn(
    transactions: DataFrame, times: int = 10, min_txns: int = 5, top: int | None = 50
) -> DataFrame:
    """Completed amounts far above the user's own mean; the ``top`` by ratio."""
    done = transactions.where((F.col("status") == "completed") & F.col("user_id").isNotNull())
    per_user = (
        done.groupBy("user_id")
        .agg(
            exact_avg(F.col("amount")).alias("user_avg_amount"),
            F.stddev_samp("amount").alias("_std"),
            F.count("*").alias("_txns"),
            F.max("amount").alias("_most"),
        )
        # Only users whose largest amount qualifies can have a row: few are left to join.
        .where((F.col("_txns") >= min_txns) & (F.col("_most") > F.col("user_avg_amount") * times))
        .drop("_most")
    )
    # What is at or below ``times`` the smallest mean of those is dropped in the scan.
    lowest = per_user.agg(F.min("user_avg_amount")).scalar()
    facts = done.where(F.col("amount") > lowest * times).select(
        "transaction_id", "user_id", "transaction_type", "amount", "created_at"
    )
    ratio = F.col("amount") / F.nullif(F.col("user_avg_amount"), F.lit(0.0))
    gap = (F.col("amount") - F.col("user_avg_amount")) / F.nullif(F.col("_std"), F.lit(0.0))

    def is_high(stats):
        enough = stats["_txns"] >= min_txns
        return enough & (F.col("amount") > stats["user_avg_amount"] * times)

    found = (
        join_key_stats(facts, per_user, "user_id", "_txns", where=is_high)
        .select(
            "transaction_id",
            "user_id",
            "transaction_type",
            "amount",
            "created_at",
            "user_avg_amount",
            F.round(ratio, 1).alias("amount_ratio"),
            F.round(gap, 2).alias("user_zscore"),
            F.lit(V.HIGH_VALUE_LABEL).alias("alert_type"),
        )
    )
    if top is None:
        return found
    return found.orderBy(F.desc("amount_ratio"), "transaction_id").limit(top)


def daily_errors(transactions: DataFrame) -> DataFrame:
    failed = (F.col("status") == "failed") & F.col("error_code").isNotNull()
    day = F.col("created_at").cast(NTZ).cast("date").alias("error_date")
    return transactions.where(failed).groupBy(day, "error_code").agg(
        F.count("*").alias("error_count")
    )


def error_surge(transactions: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """Days on which an error code is far above its own daily mean."""
    scored = series_stats(daily_errors(transactions), ["error_count"], by=["error_code"])
    limit = F.col("mean_error_count") + F.lit(sigmas) * F.col("std_error_count")
    return scored.where(F.col("error_count") > limit).select(
        "error_date",
        "error_code",
        "error_count",
        F.col("mean_error_count").alias("avg_daily_errors"),
        F.lit(V.ERROR_SURGE_LABEL).alias("alert"),
    )
