"""What must hold of the physical plans for the jobs to scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from kpiweave.plans import activity, anomaly, cohorts, funnels, kpi, revenue, staging
from kpiweave.quality import monitors
from kpiweave.sources import profiles, writers
from tests import helpers as H
from verification.queries_models import Tables


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    """The raw tables as files, events by date."""
    root = str(tmp_path_factory.mktemp("lake"))
    t = Tables(spark, sf_dir)
    dated = t.events.withColumn("day", F.to_date("event_timestamp"))
    writers.write_partitioned(dated, f"{root}/events", ["day"])
    t.users.write.parquet(f"{root}/users")
    t.transactions.write.parquet(f"{root}/transactions")
    names = ("events", "users", "transactions")
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


@pytest.fixture
def no_static_broadcast(spark):
    """Tables too large to broadcast: joins must plan as shuffles."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def logins(lake):
    ev = staging.stg_events(lake["events"])
    return activity.int_daily_active_users(ev, staging.stg_users(lake["users"], H.AS_OF))


def test_daily_kpi_reads_each_table_once(lake, no_static_broadcast):
    mart = kpi.mart_daily_kpi(logins(lake), staging.stg_transactions(lake["transactions"]))
    plan = final_plan(mart)
    assert plan.count("FileScan") == 3
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Expand" not in plan
    # The users join, the per-user window and the grouping by (user, day) share one layout:
    # logins are exchanged twice, users once, and whatever follows is one row per day.
    assert len(re.findall(r"Exchange hashpartitioning\(user_id", plan)) == 2


def test_filters_and_columns_reach_the_scan(lake):
    plan = initial_plan(logins(lake))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "event_name" in line)
    assert "EqualTo(event_name,auth_login_completed)" in scan
    columns = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    names = {c.split(":")[0] for c in columns.split(",")}
    assert names == {"event_name", "event_timestamp", "user_id", "platform"}


def test_scalar_subquery_filters_the_scan(lake):
    plan = initial_plan(monitors.latest_success_rate(lake["transactions"]))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "status" in line)
    assert re.search(r"DataFilters: \[[^\]]*created_at[^\]]*subquery", scan)


def test_partition_filter_from_newest_day(spark, lake):
    recent = kpi.period_filter(lake["events"], "day", days=3)
    plan = initial_plan(recent)
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*day", scan)
    assert recent.select("day").distinct().count() == 3


def test_retention_groups_where_the_join_left_the_rows(lake, no_static_broadcast):
    ev = staging.stg_events(lake["events"])
    cohort = cohorts.int_user_cohort(staging.stg_users(lake["users"], H.AS_OF), ev)
    plan = final_plan(cohorts.mart_retention(cohort))
    # activity distinct, activity and users to the join, cohorts at the end
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("FileScan") == 2


def test_revenue_mart_shares_the_value_counts(lake, no_static_broadcast):
    mart = revenue.mart_revenue(staging.stg_transactions(lake["transactions"]))
    plan = final_plan(mart)
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan
    assert "percentile" not in plan and "Expand" not in plan


def test_funnel_is_one_scan_and_hash_aggregation(lake):
    ev = staging.stg_events(lake["events"])
    plan = final_plan(funnels.mart_funnel(funnels.int_funnel_conversion(ev)))
    assert plan.count("FileScan") == 1 and "Union" not in plan and "SortAggregate" not in plan


def test_hot_users_are_spread(lake, no_static_broadcast):
    plan = initial_plan(anomaly.high_value_txn(lake["transactions"]))
    assert "TakeOrderedAndProject" in plan
    # Hot users meet their statistics by broadcast; the shuffle has a second, spread key.
    assert "BroadcastHashJoin [user_id" in plan
    assert re.search(r"SortMergeJoin \[user_id#\d+, _spread#\d+L?\]", plan)
    assert re.search(r"hashpartitioning\(user_id#\d+, _spread", plan)


def test_daily_and_monthly_users_take_one_scan_and_no_join(lake, no_static_broadcast):
    plan = final_plan(activity.stickiness(lake["events"]))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_transaction_profile_is_one_scan(lake):
    assert final_plan(profiles.transaction_profile(lake["transactions"])).count("FileScan") == 1
