"""Sinks: time-ordered files, mart tables, CSV extracts, the JSON report."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiweave.quality.report import report_document

SHARED_DIR = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder that the session names."""
    shared = spark.conf.get(SHARED_DIR, None)
    if shared is None:
        raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_time_ordered(df: DataFrame, path: str, ts: str, files: int | None = None) -> None:
    """Parquet files that follow each other in time, each sorted, so that a time filter skips
    files and row groups.

    Ranges come from a sample. Rows of one time are told apart by a hash of the row, so a
    time that holds much of the data is still spread over several files.
    """
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    order = [F.col(ts), F.xxhash64(*plain)]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(ts).write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replaces exactly the partitions present in ``df``; others stay.

    The rebalance keeps a partition's rows together where they are few and splits them over
    several tasks, hence files, where they are many.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_mart(df: DataFrame, path: str) -> None:
    """A finished mart: few rows, replaced as a whole."""
    df.write.mode("overwrite").parquet(path)


def save_mart(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A per-user table laid out by user: later joins and groupings by user do not shuffle."""
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def write_csv_extract(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """One CSV file with a header, for aggregated extracts.

    The single output task only receives finished rows: ``repartition`` (unlike
    ``coalesce``) leaves the computation before it parallel.
    """
    one = df.repartition(1)
    if order:
        one = one.sortWithinPartitions(*order)
    one.write.mode("overwrite").csv(path, header=True)


def write_report_json(report: DataFrame, path: str, run_at: str) -> None:
    """The report as one JSON document: the totals with the list of check results."""
    report_document(report, run_at).write.mode("overwrite").json(path)
