"""The fifteen standing checks.

All row rules of a table, its value sets and its daily volume come from one scan that
groups by the few enumerated columns. Only uniqueness and references need a key shuffle.
Counts are whole: nothing is capped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import pct
from kpiweave.operators.zscore import series_stats, zscore
from kpiweave.plans.staging import NTZ

EVENT_ROW_RULES = {
    "events_not_null_event_id": lambda: F.col("event_id").isNull(),
    "events_not_null_timestamp": lambda: F.col("event_timestamp").isNull(),
}
TXN_ROW_RULES = {
    "txn_not_null_transaction_id": lambda: F.col("transaction_id").isNull(),
    "txn_positive_amount": lambda: F.col("amount") <= 0,
    "txn_non_negative_fee": lambda: F.col("fee") < 0,
    "txn_amount_gte_fee": lambda: F.col("amount") < F.col("fee"),
}


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """check_name, violations: all rules of a table in one pass."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.col(name).alias("violations"))
        for name in rules
    ]
    return counts.select(F.inline(F.array(*rows)))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, NULL among them; copies are combined before the
    shuffle."""
    counted = df.groupBy(key).agg(F.count("*").alias("cnt"))
    return counted.where(F.col("cnt") > 1)


def outside_set(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the set with their row counts; NULL is not a violation."""
    return df.where(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count("*").alias("cnt"))


def null_rate(df: DataFrame, column: str, limit_pct: float = 5.0) -> DataFrame:
    rate = df.agg(pct(F.count_if(F.col(column).isNull()), F.count("*")).alias("null_pct"))
    return rate.withColumn("ok", ~(F.col("null_pct") > limit_pct))


def orphans(facts: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``facts`` without a parent. Keys are made distinct before the join,
    so a key that owns much of the facts is one row in it."""
    return facts.select(key).distinct().join(parents.select(key), key, "left_anti")


def _event_day() -> Column:
    return F.col("event_timestamp").cast(NTZ).cast("date").alias("dt")


def daily_events(events: DataFrame) -> DataFrame:
    return events.groupBy(_event_day()).agg(F.count("*").alias("cnt"))


def volume_anomalies(daily: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Days whose event count is beyond ``sigmas`` deviations."""
    return series_stats(daily, ["cnt"]).where(F.abs(zscore("cnt")) > sigmas).select(
        "dt", "cnt", F.col("mean_cnt"), F.round(zscore("cnt"), 2).alias("zscore")
    )


def run_checks(events: DataFrame, transactions: DataFrame, users: DataFrame) -> DataFrame:
    """check_name, violations for all fifteen checks."""
    # One scan of the events. The small profile is then summed per day, per name, per
    # platform and in all, as rows, so that every rule reads the same result.
    measures = ["cnt", "no_user", *EVENT_ROW_RULES]
    profile = events.groupBy("event_name", "platform", _event_day()).agg(
        F.count("*").alias("cnt"),
        F.count_if(F.col("user_id").isNull()).alias("no_user"),
        *[F.count_if(rule()).alias(name) for name, rule in EVENT_ROW_RULES.items()],
    )

    def scope(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("scope"), value.cast("string").alias("value"))

    scopes = F.array(
        scope("day", F.col("dt")),
        scope("name", F.col("event_name")),
        scope("platform", F.col("platform")),
        scope("all", F.lit(None)),
    )
    summed = (
        profile.select(*measures, F.inline(scopes))
        .groupBy("scope", "value")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    # The days form one series (a row per calendar day); names and platforms, which may be
    # many in a broken table, stay apart from it and from each other.
    series = F.when(F.col("scope") == "day", "day").otherwise(F.concat_ws(":", "scope", "value"))
    scored = series_stats(summed.withColumn("series", series), ["cnt"], by=["series"])

    def within(name: str, condition: Column) -> Column:
        return F.count_if((F.col("scope") == name) & condition)

    def total(column: str) -> Column:
        return F.sum(F.when(F.col("scope") == "all", F.col(column)))

    event_counts = scored.agg(
        *[total(name).alias(name) for name in EVENT_ROW_RULES],
        within("all", pct(F.col("no_user"), F.col("cnt")) > 5).alias("events_null_rate_user_id"),
        within("name", ~F.col("value").isin(*V.EVENT_NAMES)).alias("events_valid_event_name"),
        within("platform", ~F.col("value").isin(*V.PLATFORMS)).alias("events_valid_platform"),
        within("day", F.abs(zscore("cnt")) > 3).alias("events_daily_volume_anomaly"),
    )

    unknown_status = ~F.col("status").isin(*V.TRANSACTION_STATUSES)
    unknown_type = ~F.col("transaction_type").isin(*V.TRANSACTION_TYPES)
    txn_counts = (
        transactions.groupBy("status", "transaction_type")
        .agg(*[F.count_if(rule()).alias(name) for name, rule in TXN_ROW_RULES.items()])
        .agg(
            *[F.sum(name).alias(name) for name in TXN_ROW_RULES],
            F.count_distinct(F.when(unknown_status, F.col("status"))).alias("txn_valid_status"),
            F.count_distinct(F.when(unknown_type, F.col("transaction_type"))).alias(
                "txn_valid_type"
            ),
        )
    )

    def long(counts: DataFrame) -> DataFrame:
        rows = [
            F.struct(
                F.lit(name).alias("check_name"),
                F.coalesce(F.col(name).cast("bigint"), F.lit(0)).alias("violations"),
            )
            for name in counts.columns
        ]
        return counts.select(F.inline(F.array(*rows)))

    def counted(violations: DataFrame, name: str) -> DataFrame:
        return long(violations.agg(F.count("*").alias(name)))

    return (
        long(event_counts)
        .unionByName(long(txn_counts))
        .unionByName(counted(duplicates(events, "event_id"), "events_unique_event_id"))
        .unionByName(
            counted(duplicates(transactions, "transaction_id"), "txn_unique_transaction_id")
        )
        .unionByName(counted(orphans(transactions, users, "user_id"), "txn_users_exist"))
    )
