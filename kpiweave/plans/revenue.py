"""Transactions: daily and monthly volume, fees, revenue per user, mixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiweave import fixed_values as V
from kpiweave.functions import (
    count_where,
    exact_avg,
    month_start,
    pct,
    per,
    sum_where,
    week_start,
    weekday0,
)
from kpiweave.operators.distinct import conditional_distinct
from kpiweave.operators.percentile import exact_percentiles
from kpiweave.operators.series import share_of
from kpiweave.operators.sketches import approx_percentiles
from kpiweave.plans.staging import NTZ


def _is(status: str) -> Column:
    return F.col("status") == status


def _type(name: str) -> Column:
    return F.col("transaction_type") == name


def daily_transactions(stg_transactions: DataFrame) -> DataFrame:
    done, transfer, qr = _is("completed"), _type("transfer"), _type("qr_payment")
    amount = F.col("amount")
    return stg_transactions.groupBy("transaction_date").agg(
        F.count("*").alias("total_transactions"),
        count_where(done).alias("completed_transactions"),
        count_where(_is("failed")).alias("failed_transactions"),
        sum_where(amount, done).alias("gmv"),
        sum_where(amount, done & transfer).alias("transfer_gmv"),
        sum_where(amount, done & qr).alias("qr_payment_gmv"),
        sum_where(F.col("fee"), done).alias("total_fee_revenue"),
        exact_avg(amount, done).alias("avg_transaction_amount"),
        exact_avg(amount, done & transfer).alias("avg_transfer_amount"),
        count_where(done & transfer).alias("transfer_count"),
        count_where(done & qr).alias("qr_payment_count"),
        count_where(done & _type("charge")).alias("charge_count"),
        pct(count_where(done), F.count("*")).alias("success_rate"),
    )


#: What sums per (day, type, status) hold; parts of a day add up.
DAY_SUMS = ("n", "amount", "fee")


def daily_transactions_of(sums: DataFrame) -> DataFrame:
    """``daily_transactions`` from sums per (day, type, status): ``DAY_SUMS``."""
    done, transfer, qr = _is("completed"), _type("transfer"), _type("qr_payment")
    amount, n = F.col("amount"), F.col("n")
    completed, moved = sum_where(n, done), sum_where(n, done & transfer)
    return sums.groupBy("transaction_date").agg(
        F.sum(n).alias("total_transactions"),
        completed.alias("completed_transactions"),
        sum_where(n, _is("failed")).alias("failed_transactions"),
        sum_where(amount, done).alias("gmv"),
        sum_where(amount, done & transfer).alias("transfer_gmv"),
        sum_where(amount, done & qr).alias("qr_payment_gmv"),
        sum_where(F.col("fee"), done).alias("total_fee_revenue"),
        per(sum_where(amount, done), completed).alias("avg_transaction_amount"),
        per(sum_where(amount, done & transfer), moved).alias("avg_transfer_amount"),
        moved.alias("transfer_count"),
        sum_where(n, done & qr).alias("qr_payment_count"),
        sum_where(n, done & _type("charge")).alias("charge_count"),
        pct(completed, F.sum(n)).alias("success_rate"),
    )


REVENUE_KEYS = ("transaction_month", "transaction_type")
#: What sums per (month, type, user) and counts per (month, type, amount) hold; parts of a
#: month add up. ``paid`` counts completed transactions with a fee.
USER_MONTH_SUMS = ("n", "completed", "gmv", "fee_revenue", "paid")
AMOUNT_COUNTS = ("n",)


def revenue_of(months: DataFrame, counts: DataFrame) -> DataFrame:
    """``mart_revenue`` from ``USER_MONTH_SUMS`` and the ``AMOUNT_COUNTS`` of completed ones."""
    base = conditional_distinct(
        months,
        REVENUE_KEYS,
        "user_id",
        "unique_users",
        flags={"paying_users": F.col("paid") > 0},
        partials={
            "total_transactions": ("sum", F.sum("n")),
            "completed_count": ("sum", F.sum("completed")),
            "gmv": ("sum", F.sum("gmv")),
            "fee_revenue": ("sum", F.sum("fee_revenue")),
        },
    )
    medians = exact_percentiles(
        counts, REVENUE_KEYS, "amount", {"median_amount": 0.5}, weight="n"
    )
    return _revenue(base, medians)


def mart_revenue(stg_transactions: DataFrame, rank_error: float | None = None) -> DataFrame:
    """Month x type. Users are counted over one row per (month, type, user); the median
    comes from value counts, so no task holds the amounts of a whole month. With ``rank_error``
    it comes from a sketch, and its rank may be off by that share."""
    done = _is("completed")
    amount, fee = F.col("amount"), F.col("fee")
    base = conditional_distinct(
        stg_transactions,
        REVENUE_KEYS,
        "user_id",
        "unique_users",
        flags={"paying_users": done & (fee > 0)},
        partials={
            "total_transactions": ("sum", F.count("*")),
            "completed_count": ("sum", count_where(done)),
            "gmv": ("sum", sum_where(amount, done)),
            "fee_revenue": ("sum", sum_where(fee, done)),
        },
    )
    wanted = (stg_transactions.where(done), REVENUE_KEYS, "amount", {"median_amount": 0.5})
    if rank_error is None:
        return _revenue(base, exact_percentiles(*wanted))
    return _revenue(base, approx_percentiles(*wanted, rank_error))


def _revenue(base: DataFrame, medians: DataFrame) -> DataFrame:
    keys = REVENUE_KEYS
    medians = medians.select(*[F.col(k).alias(f"_{k}") for k in keys], "median_amount")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    month = Window.partitionBy("transaction_month")
    gmv, revenue = F.col("gmv"), F.col("fee_revenue")
    return (
        base.join(medians, same, "left")
        .withColumn("monthly_total_gmv", F.sum("gmv").over(month))
        .withColumn("monthly_total_fee_revenue", F.sum("fee_revenue").over(month))
        .select(
            *keys,
            "total_transactions",
            "completed_count",
            "gmv",
            "fee_revenue",
            "unique_users",
            "paying_users",
            # The mean over completed amounts, from the sums already there.
            per(gmv, F.col("completed_count")).alias("avg_amount"),
            "median_amount",
            per(revenue, F.col("paying_users"), 0).alias("arppu"),
            per(revenue, F.col("unique_users"), 0).alias("arpu"),
            pct(gmv, F.col("monthly_total_gmv")).alias("gmv_share_pct"),
            "monthly_total_gmv",
            "monthly_total_fee_revenue",
        )
    )


# --- ad-hoc analyses: raw rows, no filter --------------------------------------


def _with_month(transactions: DataFrame) -> DataFrame:
    created = F.col("created_at").cast(NTZ).cast("date")
    return transactions.withColumn("month", month_start(created))


def monthly_arppu(transactions: DataFrame) -> DataFrame:
    done, amount, fee = _is("completed"), F.col("amount"), F.col("fee")
    base = conditional_distinct(
        _with_month(transactions),
        ["month"],
        "user_id",
        "total_users",
        flags={"paying_users": fee > 0},
        partials={
            "total_gmv": ("sum", sum_where(amount, done)),
            "total_fee_revenue": ("sum", sum_where(fee, done)),
            "completed_txns": ("sum", count_where(done)),
            "priced": ("sum", F.count(F.when(done, amount))),
        },
    )
    revenue = F.col("total_fee_revenue")
    return base.select(
        "month",
        "total_users",
        "paying_users",
        "total_gmv",
        "total_fee_revenue",
        "completed_txns",
        per(F.col("total_gmv"), F.col("priced"), 0).alias("avg_txn_amount"),
        per(revenue, F.col("paying_users"), 0).alias("arppu"),
        per(revenue, F.col("total_users"), 0).alias("arpu"),
        pct(F.col("paying_users"), F.col("total_users")).alias("paying_user_ratio"),
    )


def revenue_by_type(transactions: DataFrame) -> DataFrame:
    done, amount = _is("completed"), F.col("amount")
    return conditional_distinct(
        _with_month(transactions),
        ["month", "transaction_type"],
        "user_id",
        "unique_users",
        partials={
            "txn_count": ("sum", F.count("*")),
            "gmv": ("sum", sum_where(amount, done)),
            "fee_revenue": ("sum", sum_where(F.col("fee"), done)),
            "priced": ("sum", F.count(F.when(done, amount))),
        },
    ).select(
        "month",
        "transaction_type",
        "txn_count",
        "gmv",
        "fee_revenue",
        "unique_users",
        per(F.col("gmv"), F.col("priced"), 0).alias("avg_amount"),
    )


def fee_tier(monthly_fee: Column) -> Column:
    chain = F
    for least, name in V.TIERS:
        chain = chain.when(monthly_fee >= least, name)
    return chain.otherwise(V.TIER_FREE)


def user_tier_revenue(transactions: DataFrame) -> DataFrame:
    """Users bucketed by the fees of their month, and what each bucket brings in."""
    fee = sum_where(F.col("fee"), _is("completed")).alias("monthly_fee")
    tiers = (
        _with_month(transactions)
        .groupBy("month", "user_id")
        .agg(fee)
        .groupBy("month", fee_tier(F.col("monthly_fee")).alias("user_tier"))
        .agg(
            F.count("user_id").alias("users"),
            F.sum("monthly_fee").alias("total_fee"),
            F.round(exact_avg(F.col("monthly_fee")), 0).alias("avg_fee"),
        )
    )
    share = share_of(F.col("total_fee"), ["month"]).alias("revenue_share_pct")
    return tiers.select("month", "user_tier", "users", "total_fee", "avg_fee", share)


def export_txn_summary(transactions: DataFrame) -> DataFrame:
    """Seven-key summary; keys may be NULL and keep their own rows."""
    created = F.col("created_at").cast(NTZ)
    keyed = _with_month(transactions).withColumns(
        {"hour": F.hour(created), "day_of_week": weekday0(created.cast("date"))}
    )
    keys = ["month", "transaction_type", "status", "bank_name", "merchant_category"]
    keys += ["hour", "day_of_week"]
    return conditional_distinct(
        keyed,
        keys,
        "user_id",
        "unique_users",
        partials={
            "txn_count": ("sum", F.count("*")),
            "total_amount": ("sum", F.sum("amount")),
            "total_fee": ("sum", F.sum("fee")),
            "priced": ("sum", F.count("amount")),
        },
    ).select(
        *keys,
        "txn_count",
        "total_amount",
        "total_fee",
        per(F.col("total_amount"), F.col("priced")).alias("avg_amount"),
        "unique_users",
    )


# --- dashboard calculations on staged transactions ------------------------------


def hour_dow_heatmap(stg_transactions: DataFrame) -> DataFrame:
    return stg_transactions.groupBy(
        F.col("transaction_dow").alias("dow"), F.col("transaction_hour").alias("hour")
    ).agg(F.count("*").alias("txn_count"))


def bank_distribution(stg_transactions: DataFrame) -> DataFrame:
    counted = stg_transactions.groupBy("bank_name").agg(F.count("*").alias("txn_count"))
    return counted.orderBy(F.desc("txn_count"), "bank_name")


def txn_mix(stg_transactions: DataFrame) -> DataFrame:
    mix = stg_transactions.groupBy("transaction_type").agg(
        F.count("*").alias("txn_count"), F.sum("amount").alias("amount")
    )
    return mix.select(
        "transaction_type",
        "txn_count",
        "amount",
        share_of(F.col("txn_count")).alias("share_pct"),
        share_of(F.col("amount")).alias("amount_share_pct"),
    )


# --- metric dictionary ------------------------------------------------------------


def gmv_event_based(stg_events: DataFrame) -> DataFrame:
    """Transfer and QR amounts from the events, by day, week and month."""
    sold = stg_events.where(F.col("event_name").isin(V.TRANSFER_DONE, V.QR_DONE))
    daily = sold.groupBy("event_date_kst").agg(F.sum("amount").alias("gmv"))
    day = F.col("event_date_kst")

    def grain(name: str, period: Column):
        return F.struct(F.lit(name).alias("grain"), period.alias("period"))

    grains = F.array(
        grain("day", day), grain("week", week_start(day)), grain("month", month_start(day))
    )
    long = daily.select("gmv", F.inline(grains))
    return long.groupBy("grain", "period").agg(F.sum("gmv").alias("gmv"))


def gmv_by_segment(stg_events: DataFrame) -> DataFrame:
    """The same by transaction type and by platform: one scan, the rest over daily sums."""
    name, day = F.col("event_name"), F.col("event_date_kst")
    sold = stg_events.where(name.isin(V.TRANSFER_DONE, V.QR_DONE))
    kind = F.when(name == V.QR_DONE, "qr_payment").otherwise("transfer")
    daily = sold.groupBy("event_date_kst", kind.alias("kind"), "platform").agg(
        F.sum("amount").alias("gmv")
    )

    def rows(**fields: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in fields.items()])

    platform = F.coalesce("platform", F.lit("unknown"))
    segments = F.array(
        rows(segment=F.lit("transaction_type"), value=F.col("kind")),
        rows(segment=F.lit("platform"), value=platform),
    )
    grains = F.array(
        rows(grain=F.lit("day"), period=day),
        rows(grain=F.lit("week"), period=week_start(day)),
        rows(grain=F.lit("month"), period=month_start(day)),
    )
    long = daily.select("event_date_kst", "gmv", F.inline(segments)).select(
        "segment", "value", "gmv", F.inline(grains)
    )
    return long.groupBy("segment", "value", "grain", "period").agg(F.sum("gmv").alias("gmv"))


def arppu_by_segment(stg_transactions: DataFrame, stg_users: DataFrame) -> DataFrame:
    """Fee revenue per paying user, by fee tier and by signup month."""
    done, fee = _is("completed"), F.col("fee")
    month = F.col("transaction_month").alias("month")
    user_months = stg_transactions.groupBy("user_id", month).agg(
        sum_where(fee, done).alias("fee"),
        F.max((done & (fee > 0)).cast("int")).alias("pays"),
    )
    cohorts = stg_users.select("user_id", "signup_month")

    def pair(segment: str, value: Column):
        return F.struct(F.lit(segment).alias("segment"), value.alias("value"))

    segments = F.array(
        pair("user_tier", fee_tier(F.col("fee"))),
        pair("signup_cohort", F.coalesce(F.col("signup_month").cast("string"), F.lit("unknown"))),
    )
    return (
        user_months.join(cohorts, "user_id", "left")
        .select("month", "fee", "pays", F.inline(segments))
        .groupBy("month", "segment", "value")
        .agg(F.sum("fee").alias("fee"), F.sum("pays").alias("payers"))
        .withColumn("arppu", per(F.col("fee"), F.col("payers"), 0))
    )


def avg_transfer_amount(stg_events: DataFrame) -> DataFrame:
    done = stg_events.where(F.col("event_name") == V.TRANSFER_DONE)
    mean = F.round(exact_avg(F.col("amount")), 2).alias("avg_amount")
    return done.groupBy(F.col("event_date_kst").alias("date")).agg(mean)


def qr_share(stg_events: DataFrame) -> DataFrame:
    paid = stg_events.where(F.col("event_name").isin(*V.COMPLETED_PAYMENTS))
    daily = paid.groupBy(F.col("event_date_kst").alias("date")).agg(
        count_where(F.col("event_name") == V.QR_DONE).alias("qr"), F.count("*").alias("payments")
    )
    return daily.withColumn("share", pct(F.col("qr"), F.col("payments")))


def gmv_decomposition(stg_transactions: DataFrame) -> DataFrame:
    """GMV = users x transactions per user x mean amount, per day, transfers and QR."""
    sold = stg_transactions.where(
        _is("completed") & F.col("transaction_type").isin("transfer", "qr_payment")
    ).select(
        F.col("transaction_date").alias("date"),
        F.col("transaction_type").alias("kind"),
        "user_id",
        "amount",
    )
    counted = conditional_distinct(
        sold,
        ["date", "kind"],
        "user_id",
        "users",
        partials={"txns": ("sum", F.count("*")), "gmv": ("sum", F.sum("amount"))},
    )
    return counted.select(
        "date",
        "kind",
        "users",
        per(F.col("txns"), F.col("users")).alias("per_user"),
        per(F.col("gmv"), F.col("txns")).alias("avg_amount"),
        "gmv",
    )


def revenue_decomposition(stg_transactions: DataFrame) -> DataFrame:
    """Fee revenue = paid transactions x mean fee, per month and type."""
    paid = _is("completed") & (F.col("fee") > 0)
    return (
        stg_transactions.groupBy(F.col("transaction_month").alias("month"), "transaction_type")
        .agg(count_where(paid).alias("paid_txns"), sum_where(F.col("fee"), paid).alias("revenue"))
        .select(
            "month",
            F.col("transaction_type").alias("type"),
            "paid_txns",
            per(F.col("revenue"), F.col("paid_txns"), 2).alias("avg_fee"),
            "revenue",
        )
    )
