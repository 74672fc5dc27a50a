"""Registered streams. Each reads the whole given table as a stream until it is used up,
stores its result below the shared folder of the session, and returns what was stored."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.functions import micros_between
from kpiweave.operators import sketches
from kpiweave.operators.distinct import daily_distinct
from kpiweave.plans import activity, anomaly
from kpiweave.quality import ingest
from kpiweave.sources import writers
from kpiweave.streaming import (
    first_logins,
    id_index,
    incremental,
    past_baseline,
    sinks,
    transforms,
)
from verification import fixture
from verification.queries_models import AS_OF_DATE, RANK_ERROR, TOLERANCE, Tables, on_tables
from verification.queries_quality import listed


FILE_ROWS = 200_000  # rows of a source table in an arriving file, about
BUCKET_IDS = 1_000_000  # ids that a bucket of the id index is to hold, about


def files_per_batch(t: Tables, table: str, batches: int, least: int) -> int:
    """Files that bring a batch, so that a file, hence a task that writes one, stays of one size
    as the table grows."""
    rows = fixture.source(t.spark, t.sf_dir, table).count()
    return max(least, -(-rows // (batches * FILE_ROWS)))


def id_buckets(t: Tables, least: int = 8) -> int:
    rows = fixture.source(t.spark, t.sf_dir, "events").count()
    return max(least, -(-rows // BUCKET_IDS))


def event_stream(t: Tables) -> DataFrame:
    return fixture.events_from(sinks.read_stream(t.spark, f"{t.sf_dir}/events.parquet"))


def transaction_stream(t: Tables) -> DataFrame:
    return fixture.transactions_from(sinks.read_stream(t.spark, f"{t.sf_dir}/orders.parquet"))


def appended(t: Tables, df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    root = writers.scratch_path(t.spark, name)
    sinks.append_files(df, f"{root}/rows", f"{root}/checkpoint", by, once=True)
    return t.spark.read.parquet(f"{root}/rows")


def current(t: Tables, df: DataFrame, name: str, keys: list[str], finish=None) -> DataFrame:
    root = writers.scratch_path(t.spark, name)
    sinks.changelog(df, f"{root}/rows", f"{root}/checkpoint", finish, once=True)
    return sinks.latest(t.spark, f"{root}/rows", keys)


def validated(t: Tables) -> DataFrame:
    routed = transforms.validate(event_stream(t), event_id_pattern=None)
    stored = appended(t, routed, "w1", ("route",))
    return listed(stored.select("event_id", "event_name", "route", "reasons"), "reasons")


def deduplicated(t: Tables) -> DataFrame:
    # Either copy of a resend may come first, so the receipt time is left out.
    return appended(t, transforms.dedup(event_stream(t)), "w2").drop("received_at")


def deduplicated_at_any_delay(t: Tables) -> DataFrame:
    root = writers.scratch_path(t.spark, "w2-index")
    index = id_index.IdIndex(t.spark, f"{root}/index", buckets=id_buckets(t))
    events = mixed_arrivals(t, root)
    id_index.feed(events, index, f"{root}/checkpoint", once=True)
    return id_index.first_rows(index).drop("received_at")


def alerted_by_the_past(t: Tables) -> DataFrame:
    """Closed windows of the transactions, judged by the windows before them."""
    root = writers.scratch_path(t.spark, "w6-past")
    signals = transforms.transaction_signals(transaction_stream(t))
    sinks.append_files(signals, f"{root}/windows", f"{root}/closing", once=True)
    windows = t.spark.readStream.schema(signals.schema).parquet(f"{root}/windows")
    past_baseline.feed(windows, f"{root}/judged", f"{root}/judging", once=True)
    judged = t.spark.read.parquet(f"{root}/judged")
    return judged.select("window_start", "rule", "value", "alert")


def measured_events(t: Tables) -> DataFrame:
    """The NULL shares of the events, from the pass that writes them."""
    root = writers.scratch_path(t.spark, "d39")
    wanted = ingest.event_measures(t.events)
    found = ingest.measured_write(t.events, wanted, lambda df: df.write.parquet(f"{root}/events"))
    return ingest.null_rates(ingest.long(t.spark, found))


def measured_streams(t: Tables) -> DataFrame:
    """The row rules of both tables, from the passes that store their batches."""
    root = writers.scratch_path(t.spark, "d40")
    events = mixed_arrivals(t, root)
    parts = None
    for name, stream, wanted in (
        ("events", events, ingest.event_measures(events)),
        ("transactions", transaction_stream(t), ingest.transaction_measures(t.transactions)),
    ):
        counts = ingest.log(t.spark, f"{root}/{name}-counts")
        where = (f"{root}/{name}-rows", counts, AS_OF_DATE, f"{root}/{name}-checkpoint")
        ingest.feed(stream, wanted, *where, once=True)
        checks = ingest.row_checks(ingest.totals(counts))
        parts = checks if parts is None else parts.unionByName(checks)
    return parts


def counted(t: Tables) -> DataFrame:
    counts = transforms.event_counts(event_stream(t))
    return current(t, counts, "w3", ["window_start", "event_name"])


def active_senders(t: Tables) -> DataFrame:
    days = appended(t, transforms.sender_days(event_stream(t)), "w4")
    rolling = daily_distinct(days, "user_id", "day", windows={"was_7d": 7})
    return rolling.withColumnRenamed("day", "date")


def sketched_senders(t: Tables) -> DataFrame:
    """Each date with the exact count, and whether the sketches come within two percent."""
    days = current(t, transforms.sender_sketches(event_stream(t)), "w4-sketch", ["day"])
    about = transforms.sliding_senders(days).withColumnRenamed("was_7d", "about")
    near = F.abs(F.col("about") - F.col("was_7d")) <= F.col("was_7d") * 0.02
    exact = activity.weekly_active_senders(t.stg_events)
    return exact.join(about, "date").select("date", "was_7d", near.alias("near"))


def sketched_timeliness(t: Tables) -> DataFrame:
    stream = transforms.timeliness(event_stream(t), rank_error=RANK_ERROR)
    found = current(t, stream, "w5-sketch", ["window_start"])
    start = F.date_trunc("day", "event_timestamp").cast("timestamp_ntz").alias("window_start")
    micros = micros_between(F.col("event_timestamp"), F.col("received_at"))
    delays = t.events.select(start, (micros / 1e6).alias("delay"))
    ranked = sketches.ranks(delays, ["window_start"], "delay", found, "p95_s")
    near = sketches.within(ranked, ["window_start"], 0.95, TOLERANCE, "p95_near")
    return found.drop("p95_s").join(near, "window_start")


def punctual(t: Tables) -> DataFrame:
    return current(t, transforms.timeliness(event_stream(t)), "w5", ["window_start"])


def alerted(t: Tables) -> DataFrame:
    # Stored once: a batch reads a row per error code, not the history.
    path = writers.scratch_path(t.spark, "w6-baseline")
    transforms.error_baseline(anomaly.daily_errors(t.transactions)).write.parquet(path)
    baseline = t.spark.read.parquet(path)
    signals = transforms.transaction_signals(transaction_stream(t))

    def judge(batch: DataFrame) -> DataFrame:
        return transforms.alerts(batch, baseline)

    return current(t, signals, "w6", ["window_start", "rule"], judge)


def first_logins_fed(t: Tables) -> DataFrame:
    """New and returning users after batches that each hold rows of all days."""
    root = writers.scratch_path(t.spark, "q1")
    counts = first_logins.daily_changes(t.spark, f"{root}/counts")
    first_logins.feed(mixed_arrivals(t, root), counts, f"{root}/checkpoint", once=True)
    return first_logins.current(counts)


def mixed_arrivals(t: Tables, root: str, batches: int = 3) -> DataFrame:
    """The events as a stream of batches that each hold rows of all days, so that most rows come
    after later ones."""
    files = files_per_batch(t, "events", batches, 2)
    t.events.repartition(batches * files, F.xxhash64("event_id")).write.parquet(f"{root}/mixed")
    return sinks.read_stream(t.spark, f"{root}/mixed", files_per_trigger=files)


def time_ordered_arrivals(t: Tables, rows: DataFrame, table: str, path: str, ts: str) -> DataFrame:
    """``rows`` as a stream of two batches of files that follow each other in time, the second
    half as large as the first."""
    half = files_per_batch(t, table, 3, 1)
    writers.write_time_ordered(rows, path, ts, files=3 * half)
    return sinks.read_stream(t.spark, path, files_per_trigger=2 * half)


def late_daily_kpi(t: Tables) -> DataFrame:
    """The daily marts when every batch brings rows of all days, compacted on the way."""
    lake = fed_lake(t, with_events=False)
    root = writers.scratch_path(t.spark, "w7-late")
    events = mixed_arrivals(t, root, 2)
    incremental.feed_events(lake, events, None, f"{root}/checkpoint", once=True)
    lake.compact(dt.date(9999, 1, 1))
    days = lake.logins.days() or [AS_OF_DATE]
    return incremental.daily_kpi_between(lake, days[0], days[-1])


def fed_lake(t: Tables, with_events: bool) -> incremental.Lake:
    """A lake after its feeds have arrived in several batches, transactions first."""
    root = writers.scratch_path(t.spark, "w7")
    lake = incremental.Lake(t.spark, f"{root}/lake", t.stg_users)
    transactions = time_ordered_arrivals(t, t.transactions, "orders", f"{root}/txns", "created_at")
    schema = t.events.schema
    incremental.feed_transactions(lake, transactions, schema, f"{root}/checkpoint_txns", once=True)
    if with_events:
        events = time_ordered_arrivals(t, t.events, "events", f"{root}/events", "event_timestamp")
        incremental.feed_events(
            lake, events, transactions.schema, f"{root}/checkpoint_events", once=True
        )
    return lake


def refreshed_daily_kpi(t: Tables) -> DataFrame:
    return t.spark.read.parquet(fed_lake(t, with_events=True).daily_kpi_path)


def refreshed_revenue(t: Tables) -> DataFrame:
    return t.spark.read.parquet(fed_lake(t, with_events=False).revenue_path)


_STREAMS = {
    "w1_stream_validate": validated,
    "w2_stream_dedup": deduplicated,
    "w2_stream_dedup_any_delay": deduplicated_at_any_delay,
    "w3_stream_event_counts": counted,
    "w4_stream_active_senders": active_senders,
    "w4_stream_sender_sketches": sketched_senders,
    "w5_timeliness": punctual,
    "w5_timeliness_sketch": sketched_timeliness,
    "w6_stream_alerts": alerted,
    "w6_stream_alerts_past_only": alerted_by_the_past,
    "w7_incremental_daily_kpi": refreshed_daily_kpi,
    "w7_late_daily_kpi": late_daily_kpi,
    "w7_incremental_revenue": refreshed_revenue,
    "q1_stream_new_returning": first_logins_fed,
    "d39_ingest_null_rate": measured_events,
    "d40_ingest_row_rules": measured_streams,
}

STREAM_QUERIES = {key: on_tables(fn) for key, fn in _STREAMS.items()}
