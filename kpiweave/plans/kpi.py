"""The daily KPI mart, its extract, the dashboard series on top, and KPI targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import count_where, labelled, pct, per, sum_where, weekday0
from kpiweave.operators.distinct import conditional_distinct
from kpiweave.operators.series import growth
from kpiweave.plans.activity import daily_and_rolling_users, raw_logins
from kpiweave.plans.revenue import daily_transactions
from kpiweave.plans.staging import NTZ


def mart_daily_kpi(int_dau: DataFrame, stg_transactions: DataFrame) -> DataFrame:
    """One row per local day with some login."""
    return daily_kpi(daily_and_rolling_users(int_dau), daily_transactions(stg_transactions))


def daily_kpi(users: DataFrame, money: DataFrame) -> DataFrame:
    """The mart from one row per day of users and one of transactions."""
    dow = weekday0(F.col("activity_date"))

    def or_zero(name: str, alias: str | None = None):
        zero = F.lit(0.0) if name == "success_rate" else F.lit(0)
        return F.coalesce(F.col(name), zero).alias(alias or name)

    return users.join(money, users.activity_date == money.transaction_date, "left").select(
        F.col("activity_date").alias("date"),
        dow.alias("day_of_week"),
        labelled(dow, dict(enumerate(V.DAY_LABELS))).alias("day_name"),
        "dau",
        "new_users",
        "returning_users",
        *[f"dau_{p}" for p in V.PLATFORMS],
        "wau_7d",
        "mau_30d",
        pct(F.col("dau"), F.col("mau_30d")).alias("stickiness_ratio"),
        or_zero("total_transactions"),
        or_zero("completed_transactions"),
        or_zero("failed_transactions"),
        or_zero("success_rate"),
        or_zero("gmv"),
        or_zero("transfer_gmv"),
        or_zero("qr_payment_gmv"),
        or_zero("total_fee_revenue", "fee_revenue"),
        "avg_transaction_amount",
        "avg_transfer_amount",
        or_zero("transfer_count"),
        or_zero("qr_payment_count"),
        or_zero("charge_count"),
        per(F.coalesce("gmv", F.lit(0)), F.col("dau"), 0).alias("gmv_per_dau"),
        per(F.coalesce("total_transactions", F.lit(0)), F.col("dau"), 2).alias("txn_per_dau"),
    )


def export_daily_kpi(events: DataFrame, transactions: DataFrame) -> DataFrame:
    """The same idea over raw rows and UTC days."""
    flags = {f"dau_{p}": F.col("platform") == p for p in V.PLATFORMS}
    users = conditional_distinct(raw_logins(events), ["login_date"], "user_id", "dau", flags)
    done = F.col("status") == "completed"
    transfer = F.col("transaction_type") == "transfer"
    qr = F.col("transaction_type") == "qr_payment"
    money = transactions.groupBy(F.col("created_at").cast(NTZ).cast("date").alias("dt")).agg(
        F.count("*").alias("total_transactions"),
        count_where(done).alias("completed_transactions"),
        sum_where(F.col("amount"), done).alias("gmv"),
        sum_where(F.col("amount"), done & transfer).alias("transfer_gmv"),
        sum_where(F.col("amount"), done & qr).alias("qr_payment_gmv"),
        sum_where(F.col("fee"), done).alias("fee_revenue"),
        count_where(done & transfer).alias("transfer_count"),
        count_where(done & qr).alias("qr_payment_count"),
        pct(count_where(done), F.count("*")).alias("success_rate"),
    )
    sums = [c for c in money.columns if c not in ("dt", "success_rate")]
    return users.join(money, F.col("login_date") == F.col("dt"), "left").select(
        F.col("login_date").alias("date"),
        F.date_format("login_date", "EEEE").alias("day_name"),
        "dau",
        *flags,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in sums],
        F.coalesce("success_rate", F.lit(0.0)).alias("success_rate"),
        per(F.coalesce("gmv", F.lit(0)), F.col("dau"), 0).alias("gmv_per_dau"),
    )


# --- dashboard series --------------------------------------------------------------


def kpi_trend(daily_kpi: DataFrame) -> DataFrame:
    """Seven-row moving mean of DAU, running GMV, change against seven rows before."""
    order = Window.orderBy("date")
    last7 = order.rowsBetween(-6, Window.currentRow)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    week_ago = F.lag("dau", 7).over(order)
    return daily_kpi.select(
        "date",
        "dau",
        F.round(F.avg("dau").over(last7), 2).alias("dau_ma7"),
        "gmv",
        F.sum("gmv").over(upto).alias("gmv_cum"),
        pct(F.col("dau") - week_ago, week_ago).alias("wow_pct"),
    )


def platform_share(daily_kpi: DataFrame) -> DataFrame:
    shares = [
        F.struct(
            F.lit(p).alias("platform"),
            F.col(f"dau_{p}").alias("platform_dau"),
            pct(F.col(f"dau_{p}"), F.col("dau")).alias("share_pct"),
        )
        for p in V.PLATFORMS
    ]
    return daily_kpi.select("date", F.inline(F.array(*shares))).withColumnRenamed(
        "platform_dau", "dau"
    )


def funnel_dropoff(funnel: DataFrame) -> DataFrame:
    """Users lost between consecutive steps and where the most are lost."""
    order = Window.orderBy("step_order")
    before = F.lag("users").over(order)
    lost = funnel.select("step_order", "users", before.alias("_before")).select(
        "step_order",
        "users",
        (F.col("_before") - F.col("users")).alias("dropoff_users"),
        pct(F.col("_before") - F.col("users"), F.col("_before")).alias("dropoff_pct"),
    )
    worst = F.max("dropoff_users").over(Window.partitionBy())
    return lost.withColumn("is_largest", F.coalesce(F.col("dropoff_users") == worst, F.lit(False)))


def period_filter(
    df: DataFrame, date: str = "date", days: int = 30, platform: str | None = None
) -> DataFrame:
    """The last ``days`` days up to the newest date of the frame, optionally one platform."""
    # A scalar subquery: its value reaches the scan, so old partitions are skipped.
    newest = df.agg(F.max(date)).scalar()
    kept = df.where(F.col(date) > F.date_sub(newest, days))
    return kept if platform is None else kept.where(F.col("platform") == platform)


# --- metric dictionary --------------------------------------------------------------


def error_rate(stg_events: DataFrame) -> DataFrame:
    daily = stg_events.groupBy(F.col("event_date_kst").alias("date")).agg(
        count_where(F.col("event_name").isin(*V.ERROR_EVENTS)).alias("errors"),
        F.count("*").alias("total"),
    )
    return daily.withColumn("rate", pct(F.col("errors"), F.col("total")))


def push_ctr(stg_events: DataFrame, campaign: str | None = None) -> DataFrame:
    name = F.col("event_name")
    keys = [F.col("event_date_kst").alias("date"), *([campaign] if campaign else [])]
    pushes = stg_events.where(name.isin("system_push_received", "system_push_clicked"))
    counted = pushes.groupBy(*keys).agg(
        count_where(name == "system_push_received").alias("received"),
        count_where(name == "system_push_clicked").alias("clicked"),
    )
    return counted.withColumn("ctr", pct(F.col("clicked"), F.col("received")))


def login_success_rate(stg_events: DataFrame) -> DataFrame:
    name = F.col("event_name")
    counted = (
        stg_events.where(name.isin(V.LOGIN_ATTEMPT, V.LOGIN))
        .groupBy(F.col("event_date_kst").alias("date"))
        .agg(
            count_where(name == V.LOGIN_ATTEMPT).alias("attempted"),
            count_where(name == V.LOGIN).alias("completed"),
        )
    )
    return counted.withColumn("rate", pct(F.col("completed"), F.col("attempted")))


def screen_dwell(events: DataFrame) -> DataFrame:
    """Views, exits and mean time spent per screen (needs prop_duration_ms)."""
    name = F.col("event_name")
    duration = F.when(name == "screen_exited", F.col("prop_duration_ms"))
    return (
        events.where(name.isin("screen_viewed", "screen_exited"))
        .groupBy(F.col("prop_screen_name").alias("screen_name"))
        .agg(
            count_where(name == "screen_viewed").alias("views"),
            count_where(name == "screen_exited").alias("exits"),
            per(F.sum(duration), F.count(duration), 2).alias("avg_ms"),
        )
    )


def period_growth(senders: DataFrame, revenue: DataFrame) -> DataFrame:
    """Month over month: weekly active senders on the last day of the month, and fees."""
    month = F.trunc("date", "month")
    wanted = ["metric", "period", "value"]
    month_end = (
        senders.groupBy(month.alias("period"))
        .agg(F.max_by("was_7d", "date").cast("bigint").alias("value"))
        .withColumn("metric", F.lit("weekly_active_senders"))
    )
    fees = (
        revenue.groupBy(F.col("transaction_month").alias("period"))
        .agg(F.sum("fee_revenue").cast("bigint").alias("value"))
        .withColumn("metric", F.lit("fee_revenue"))
    )
    series = month_end.select(*wanted).unionByName(fees.select(*wanted))
    return growth(series, "period", "value", ["metric"])


def kpi_vs_target(
    daily_kpi: DataFrame,
    conversion: DataFrame,
    retention: DataFrame,
    arppu: DataFrame,
    gmv: DataFrame,
    targets: dict[str, float] | None = None,
) -> DataFrame:
    """The latest value of each headline KPI against its target."""
    targets = targets or V.TARGETS
    latest = [
        daily_kpi.agg(F.max_by("dau", "date").alias("value")).select(
            F.lit("dau").alias("metric"), "value"
        ),
        conversion.where(F.col("segment") == "all").select(
            F.lit("signup_conversion_7d").alias("metric"), F.col("rate").alias("value")
        ),
        retention.select(
            F.concat(F.lit("retention_d"), F.col("day_n")).alias("metric"),
            F.col("mean_rate").alias("value"),
        ),
        arppu.agg(F.max_by("arppu", "month").alias("value")).select(
            F.lit("arppu").alias("metric"), "value"
        ),
        gmv.where(F.col("grain") == "month")
        .agg(F.max_by("gmv", "period").alias("value"))
        .select(F.lit("monthly_gmv").alias("metric"), "value"),
    ]
    values = None
    for part in latest:
        part = part.select("metric", F.col("value").cast("double").alias("value"))
        values = part if values is None else values.unionByName(part)
    target = labelled(F.col("metric"), targets)
    return values.withColumn("target", target).withColumn(
        "met", F.coalesce(F.col("value") >= F.col("target"), F.lit(False))
    )
