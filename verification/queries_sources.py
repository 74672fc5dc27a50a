"""Registered Spark queries: sources, sinks, profiles.

Reads of files in other formats work on files that Spark first writes from the given tables,
whole, below the shared folder of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave import schemas
from kpiweave.quality import report
from kpiweave.sources import profiles, readers, writers
from verification.queries_models import Tables, on_tables

RUN_AT = "2024-03-01T00:00:00"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _csv(df: DataFrame, name: str) -> str:
    path = writers.scratch_path(df.sparkSession, name)
    df.write.csv(path, header=True)
    return path


def _iso(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.date_format(n, ISO) for n in names})


def users_csv(t: Tables) -> DataFrame:
    return readers.read_users(t.spark, _csv(t.users, "users_csv"))


def events_csv(t: Tables) -> DataFrame:
    flat = _iso(t.events, "event_timestamp", "received_at")
    # A nullable integer column is often written with a decimal point.
    amount = F.col("prop_amount").cast("decimal(20,1)").cast("string")
    return readers.read_events(t.spark, _csv(flat.withColumn("prop_amount", amount), "events_csv"))


def transactions_csv(t: Tables) -> DataFrame:
    timed = _iso(t.transactions, "created_at", "completed_at")
    return readers.read_transactions(t.spark, _csv(timed, "transactions_csv"))


def events_json(t: Tables) -> DataFrame:
    properties = F.struct(*[F.col(f"prop_{p}").alias(p) for p in schemas.PROPERTIES])
    envelope = [c for c in t.events.columns if not c.startswith("prop_")]
    nested = t.events.select(*envelope, properties.alias("event_properties"))
    path = writers.scratch_path(t.spark, "events_json")
    _iso(nested, "event_timestamp", "received_at").write.json(path)
    return readers.read_events_json(t.spark, path)


def envelope_with_amount(t: Tables) -> DataFrame:
    """The nested payload itself has no SQL type, so one of its values stands for it."""
    amount = F.try_variant_get("event_properties", "$.amount", "bigint")
    return events_json(t).withColumn("event_properties", amount)


def time_ordered(t: Tables) -> DataFrame:
    path = writers.scratch_path(t.spark, "events_by_time")
    writers.write_time_ordered(t.events, path, "event_timestamp")
    return t.spark.read.parquet(path)


def stored_mart(t: Tables) -> DataFrame:
    path = writers.scratch_path(t.spark, "mart_daily_kpi")
    writers.write_mart(t.daily_kpi, path)
    return t.spark.read.parquet(path)


def stored_extract(t: Tables) -> DataFrame:
    path = writers.scratch_path(t.spark, "daily_kpi_csv")
    extract = t.export_kpi
    writers.write_csv_extract(extract, path, ["date"])
    return t.spark.read.schema(extract.schema).csv(path, header=True)


def stored_report(t: Tables) -> DataFrame:
    path = writers.scratch_path(t.spark, "quality_report")
    rows = report.quality_report(t.events, t.transactions, t.users)
    writers.write_report_json(rows, path, RUN_AT)
    result = (
        "array<struct<check_name string, expectation string, severity string, passed boolean,"
        " details string, violations bigint, run_at string>>"
    )
    schema = (
        "run_timestamp string, total_checks bigint, passed bigint, failed bigint,"
        f" quality_score double, critical_failed bigint, results {result}"
    )
    saved = t.spark.read.schema(schema).json(path)
    return saved.select(
        "run_timestamp", "total_checks", "failed", "quality_score", F.inline("results")
    ).drop("run_at")


_SOURCES = {
    "s1_ingest_users": users_csv,
    "s2_ingest_events": events_csv,
    "s3_ingest_transactions": transactions_csv,
    "s4_ingest_events_json": envelope_with_amount,
    "s5_flatten_properties": lambda t: readers.flatten_properties(events_json(t)),
    "s6_load_summary": lambda t: profiles.load_summary(
        {"users": t.users, "events": t.events, "transactions": t.transactions}
    ),
    "s7_event_profile": lambda t: profiles.event_profile(t.events),
    "s8_transaction_profile": lambda t: profiles.transaction_profile(t.transactions),
    "s9_time_ordered_write": time_ordered,
    "s10_mart_write": stored_mart,
    "s11_csv_export": stored_extract,
    "s12_report_json": stored_report,
}

SOURCE_QUERIES = {key: on_tables(fn) for key, fn in _SOURCES.items()}
