"""Refresh only the parts of the marts that newly arrived rows can change.

Of each batch only partial sums are kept: logins per (day, user, platform), transactions per (day,
type, status), per (month, type, user) and per (month, type, amount). The marts are computed from
these alone; no raw row is read again, not even those of the batch. A login on day d changes the
trailing 30-day users of d .. d+29, so those days are computed again from the user-days of d-29 on;
a transaction changes its day and its month. The days that a batch touches are listed, so one
stray date refreshes its own reach only. The two feeds write the same mart: run them one after
the other.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kpiweave.plans import activity, kpi, revenue
from kpiweave.plans.staging import stg_events, stg_transactions
from kpiweave.sources.writers import write_partitioned
from kpiweave.streaming.partials import Partials
from kpiweave.streaming.sinks import each_batch

REACH = dt.timedelta(days=max(activity.ROLLING.values()) - 1)


@dataclass(frozen=True)
class Lake:
    """Where the partial sums and the marts are kept."""

    spark: SparkSession
    root: str
    users: DataFrame  # staged users

    @property
    def daily_kpi_path(self) -> str:
        return f"{self.root}/mart_daily_kpi"

    @property
    def revenue_path(self) -> str:
        return f"{self.root}/mart_revenue"

    def _partials(self, name: str, fields: str, sums: tuple[str, ...]) -> Partials:
        return Partials(self.spark, f"{self.root}/{name}", fields, sums)

    @cached_property
    def logins(self) -> Partials:
        fields = "user_id string, platform string, login_count bigint"
        return self._partials("user_days", fields, ("login_count",))

    @cached_property
    def day_sums(self) -> Partials:
        fields = "transaction_type string, status string, n bigint, amount bigint, fee bigint"
        return self._partials("day_sums", fields, revenue.DAY_SUMS)

    @cached_property
    def user_months(self) -> Partials:
        sums = ", ".join(f"{name} bigint" for name in revenue.USER_MONTH_SUMS)
        fields = f"transaction_type string, user_id string, {sums}"
        return self._partials("user_months", fields, revenue.USER_MONTH_SUMS)

    @cached_property
    def amount_counts(self) -> Partials:
        fields = "transaction_type string, amount bigint, n bigint"
        return self._partials("amount_counts", fields, revenue.AMOUNT_COUNTS)

    def compact(self, before: dt.date) -> None:
        """Makes one part of the parts of each day and month that ended before ``before``."""
        self.logins.compact(before)
        self.day_sums.compact(before)
        self.user_months.compact(before.replace(day=1))
        self.amount_counts.compact(before.replace(day=1))


def spans(days: list[dt.date], reach: dt.timedelta) -> list[tuple[dt.date, dt.date]]:
    """The days ``d .. d + reach`` of all ``days``, as spans that do not touch."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if out and day <= out[-1][1] + dt.timedelta(days=1):
            out[-1] = (out[-1][0], max(out[-1][1], day + reach))
        else:
            out.append((day, day + reach))
    return out


def months(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """First and last touched day of each touched month."""
    by: dict[tuple[int, int], list[dt.date]] = {}
    for day in days:
        by.setdefault((day.year, day.month), []).append(day)
    return [(min(x), max(x)) for x in by.values()]


def daily_kpi_between(lake: Lake, first: dt.date, last: dt.date) -> DataFrame:
    """The mart days first..last from the partial sums."""
    logins = lake.logins.read(first - REACH, last).withColumnRenamed("day", "activity_date")
    users = activity.daily_and_rolling_users(activity.tagged_logins(logins, lake.users))
    sums = lake.day_sums.read(first, last).withColumnRenamed("day", "transaction_date")
    mart = kpi.daily_kpi(users, revenue.daily_transactions_of(sums))
    return mart.where(F.col("date").between(first, last))


def revenue_between(lake: Lake, first: dt.date, last: dt.date) -> DataFrame:
    """The mart months of first..last from the partial sums."""
    span = (first.replace(day=1), last.replace(day=1))
    parts = (lake.user_months.read(*span), lake.amount_counts.read(*span))
    return revenue.revenue_of(*[p.withColumnRenamed("day", "transaction_month") for p in parts])


def refresh_daily_kpi(lake: Lake, first: dt.date, last: dt.date) -> None:
    """Computes the mart days first..last again and replaces their partitions."""
    write_partitioned(daily_kpi_between(lake, first, last), lake.daily_kpi_path, ["date"])


def refresh_revenue(lake: Lake, first: dt.date, last: dt.date) -> None:
    """Computes the months of first..last again and replaces their partitions."""
    mart = revenue_between(lake, first, last)
    write_partitioned(mart, lake.revenue_path, ["transaction_month"])


def add_events(lake: Lake, events: DataFrame, run: str, batch_id: int) -> list[dt.date]:
    """Adds the logins of raw ``events`` to the lake and lists their days."""
    logins = activity.daily_logins(stg_events(events))
    return lake.logins.add(logins.withColumnRenamed("activity_date", "day"), run, batch_id)


def add_transactions(lake: Lake, rows: DataFrame, run: str, batch_id: int) -> list[dt.date]:
    """Adds the sums of raw transactions to the lake and lists their days. The batch is read
    once, for its sums per (day, type, status, user, amount); the stored tables follow from
    these."""
    staged = stg_transactions(rows)
    keys = ["transaction_date", "transaction_type", "status", "user_id", "amount"]
    fine = staged.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum("fee").alias("fee"),
        F.count_if(F.col("fee") > 0).alias("with_fee"),
    )
    path = f"{lake.root}/transactions-incoming/{run}"
    fine.write.mode("overwrite").parquet(path)
    fine = lake.spark.read.schema(fine.schema).parquet(path)
    n, done = F.col("n"), F.col("status") == "completed"
    whole = F.col("amount") * n

    def if_done(value):
        return F.sum(F.when(done, value).otherwise(F.lit(0)))

    day, month = F.col("transaction_date"), F.trunc("transaction_date", "month")
    kind = "transaction_type"
    by_day = fine.groupBy(day.alias("day"), kind, "status").agg(
        F.sum(n).alias("n"), F.sum(whole).alias("amount"), F.sum("fee").alias("fee")
    )
    by_user = fine.groupBy(month.alias("day"), kind, "user_id").agg(
        F.sum(n).alias("n"),
        if_done(n).alias("completed"),
        if_done(whole).alias("gmv"),
        if_done(F.col("fee")).alias("fee_revenue"),
        if_done(F.col("with_fee")).alias("paid"),
    )
    by_amount = fine.where(done).groupBy(month.alias("day"), kind, "amount")
    lake.user_months.add(by_user, run, batch_id)
    lake.amount_counts.add(by_amount.agg(F.sum(n).alias("n")), run, batch_id)
    return lake.day_sums.add(by_day, run, batch_id)


def feed_events(
    lake: Lake, stream: DataFrame, transactions_schema, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """``transactions_schema`` is not needed any more: no raw transaction is read."""

    def apply(batch: DataFrame, run: str, batch_id: int) -> None:
        touched = add_events(lake, batch, run, batch_id)
        for span in spans(touched, REACH):
            refresh_daily_kpi(lake, *span)

    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return each_batch(writer, apply, once)


def feed_transactions(
    lake: Lake, stream: DataFrame, events_schema, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """``events_schema`` is not needed any more: no raw event is read."""

    def apply(batch: DataFrame, run: str, batch_id: int) -> None:
        touched = add_transactions(lake, batch, run, batch_id)
        for span in spans(touched, dt.timedelta(0)):
            refresh_daily_kpi(lake, *span)
        for span in months(touched):
            refresh_revenue(lake, *span)

    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return each_batch(writer, apply, once)
