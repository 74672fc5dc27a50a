"""Freshness, volume, schema and row-compliance monitors."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import count_where, pct, seconds_between
from kpiweave.operators.series import growth
from kpiweave.operators.zscore import series_stats, zscore
from kpiweave.plans.staging import NTZ
from kpiweave.quality.checks import daily_events


def freshness(
    events: DataFrame, transactions: DataFrame, as_of: dt.datetime, hours: int = 48
) -> DataFrame:
    """Newest row of each table and whether it is recent enough at ``as_of``."""
    oldest = F.lit(str(as_of - dt.timedelta(hours=hours))).cast(NTZ)

    def newest(table: str, df: DataFrame, ts: str) -> DataFrame:
        latest = df.agg(F.max(F.col(ts).cast(NTZ)).alias("latest"))
        return latest.select(F.lit(table).alias("table"), "latest")

    both = newest("events", events, "event_timestamp").unionByName(
        newest("transactions", transactions, "created_at")
    )
    return both.withColumn("ok", F.coalesce(F.col("latest") >= oldest, F.lit(False)))


def latest_day_volume(events: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """The newest day's event count against the history."""
    scored = series_stats(daily_events(events), ["cnt"])
    return (
        scored.select(
            "dt",
            "cnt",
            F.round("mean_cnt", 4).alias("mean_cnt"),
            F.round("std_cnt", 4).alias("std_cnt"),
            F.round(zscore("cnt"), 2).alias("zscore"),
        )
        .withColumn("ok", ~F.coalesce(F.abs("zscore") > sigmas, F.lit(False)))
        .orderBy(F.desc("dt"))
        .limit(1)
    )


def latest_success_rate(transactions: DataFrame, least_pct: float = 85.0) -> DataFrame:
    """Success rate of the newest day. The day is a scalar subquery, so its value reaches the
    scan as a filter and older row groups or partitions are skipped."""
    created = F.col("created_at").cast(NTZ)
    newest = transactions.agg(F.max(created).cast("date").cast(NTZ)).scalar()
    day = transactions.where(created >= newest)
    rate = day.agg(
        pct(count_where(F.col("status") == "completed"), F.count("*")).alias("success_rate"),
        F.count("*").alias("total"),
    )
    return rate.withColumn("ok", F.coalesce(F.col("success_rate") >= least_pct, F.lit(False)))


def schema_snapshot(df: DataFrame) -> str:
    """The column names and types to compare with next time."""
    return json.dumps({f.name: f.dataType.simpleString() for f in df.schema.fields})


def schema_drift(df: DataFrame, snapshot: str, table: str) -> DataFrame:
    """table, column, change, rows: columns added, removed or of another type since the
    snapshot, and how many rows carry a value in them."""
    before = json.loads(snapshot)
    now = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    changes = {c: "added" for c in now if c not in before}
    changes |= {c: "removed" for c in before if c not in now}
    changes |= {
        c: f"type {before[c]} -> {now[c]}" for c in now if c in before and before[c] != now[c]
    }
    if not changes:
        schema = "table string, column string, change string, rows bigint"
        return df.sparkSession.createDataFrame([], schema)
    counts = df.agg(
        *[(F.count(c) if c in now else F.lit(0).cast("bigint")).alias(c) for c in changes]
    )
    rows = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(c).alias("column"),
            F.lit(change).alias("change"),
            F.col(c).alias("rows"),
        )
        for c, change in changes.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


# --- row rules of the event envelope ------------------------------------------------


def envelope_rules(
    df: DataFrame, event_id_pattern: str | None = V.UUID_PATTERN
) -> dict[str, Column]:
    """Rule name -> condition under which a row breaks it."""

    def value(column: str) -> Column:
        return F.col(column) if column in df.columns else F.lit(None).cast("string")

    def differs(column: str, pattern: str) -> Column:
        return ~value(column).rlike(pattern)

    rules = {f"required:{c}": missing_field(df, c) for c in V.ENVELOPE_REQUIRED}
    if event_id_pattern:
        rules["format:event_id"] = differs("event_id", event_id_pattern)
    rules |= {
        "enum:event_name": ~value("event_name").isin(*V.EVENT_NAMES),
        "enum:platform": ~value("platform").isin(*V.PLATFORMS),
        "pattern:user_id": differs("user_id", V.USER_ID_PATTERN),
        "pattern:session_id": differs("session_id", V.SESSION_ID_PATTERN),
        "pattern:device_id": differs("device_id", V.DEVICE_ID_PATTERN),
        "pattern:app_version": differs("app_version", V.APP_VERSION_PATTERN),
    }
    extra = [c for c in df.columns if c not in V.ENVELOPE and not c.startswith("prop_")]
    rules |= {f"additional:{c}": F.col(c).isNotNull() for c in extra}
    return rules


def missing_field(df: DataFrame, column: str) -> Column:
    """Whether a row lacks an envelope field: always, if there is no such column. The payload
    may be there as flat ``prop_*`` columns instead."""
    if column in df.columns:
        return F.col(column).isNull()
    flat = column == "event_properties" and any(c.startswith("prop_") for c in df.columns)
    return F.lit(not flat)


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Array of the names of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))


def schema_compliance(df: DataFrame, event_id_pattern: str | None = V.UUID_PATTERN) -> DataFrame:
    """event_id, violations: the rows that break some envelope rule."""
    broken = broken_rules(envelope_rules(df, event_id_pattern)).alias("violations")
    return df.select("event_id", broken).where(F.size("violations") > 0)


def is_future(minutes: int = 5) -> Column:
    ahead = F.col("received_at") + F.make_dt_interval(mins=F.lit(minutes))
    return F.col("event_timestamp") > ahead


def future_timestamp(events: DataFrame, minutes: int = 5) -> DataFrame:
    """Events that claim to be later than their receipt plus a tolerance."""
    return events.where(is_future(minutes)).select("event_id", "event_timestamp", "received_at")


def day_over_day_volume(events: DataFrame, limit_pct: float = 30.0) -> DataFrame:
    change = growth(daily_events(events), "dt", "cnt").withColumnRenamed("growth_pct", "pct_change")
    alert = F.coalesce(F.abs("pct_change") > limit_pct, F.lit(False))
    return change.select("dt", "cnt", "pct_change", alert.alias("alert"))


def null_rate_by_column(df: DataFrame, limit_pct: float = 5.0) -> DataFrame:
    """NULL share of every column, all from one aggregate."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            pct(F.col("_rows") - F.col(c), F.col("_rows")).alias("null_pct"),
        )
        for c in df.columns
    ]
    rates = counts.select(F.inline(F.array(*rows)))
    return rates.withColumn("ok", ~(F.col("null_pct") > limit_pct))


def required_properties(events: DataFrame) -> DataFrame:
    """event_id, event_name, missing: events without a property their name demands.

    Properties are ``prop_*`` columns; a property without a column is missing everywhere.
    """
    demanded: dict[str, list[str]] = {}
    for name, properties in V.REQUIRED_PROPERTIES.items():
        for p in properties:
            demanded.setdefault(p, []).append(name)
    checks = {}
    for p, names in demanded.items():
        column = p if p in V.ENVELOPE else f"prop_{p}"
        absent = F.col(column).isNull() if column in events.columns else F.lit(True)
        checks[p] = F.col("event_name").isin(*names) & absent
    missing = broken_rules(checks).alias("missing")
    return events.select("event_id", "event_name", missing).where(F.size("missing") > 0)


def on_time(limit_seconds: float = 300.0) -> Column:
    delay = seconds_between(F.col("event_timestamp"), F.col("received_at"))
    return delay <= limit_seconds
