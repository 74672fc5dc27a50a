"""Typed reads of the raw files. Schemas are given, so no pass over the data infers them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiweave import schemas
from kpiweave.functions import month_start, safe_long, safe_number, utc_wall
from kpiweave.plans.staging import NTZ


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """Users with the ISO week number and the month of their signup."""
    users = _csv(spark, path, schemas.USERS_CSV)
    return users.withColumns(
        {
            "signup_week": F.weekofyear("signup_date"),
            "signup_month": month_start(F.col("signup_date")),
        }
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Flat events: envelope plus ``prop_*`` columns.

    The header is read, so columns may stand in any order; known ones that are missing are
    NULL, and ``prop_*`` columns that no schema names are kept as text.
    """
    header = spark.read.csv(path, header=True, enforceSchema=False)
    known = schemas.EVENTS_CSV.fieldNames()
    extra = [c for c in header.columns if c.startswith("prop_") and c not in known]
    present = set(header.columns)
    flat = header.select(
        *[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in known],
        *[f"`{c}`" for c in extra],
    )
    typed = {
        f"prop_{name}": safe_number(flat, f"prop_{name}", kind.simpleString())
        for name, kind in schemas.PROPERTIES.items()
        if not isinstance(kind, T.StringType)
    }
    return _timed(flat.withColumns(typed), "event_timestamp", "received_at")


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    rows = _csv(spark, path, schemas.TRANSACTIONS_CSV)
    money = {name: safe_long(rows, name) for name in ("amount", "fee")}
    return _timed(rows.withColumns(money), "created_at", "completed_at")


def read_events_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Envelopes with a nested payload. One document per line splits across tasks; a single
    JSON array (``multi_line``) is read by one task per file."""
    rows = spark.read.schema(schemas.EVENTS_JSON).json(path, multiLine=multi_line)
    return _timed(rows, "event_timestamp", "received_at")


def _timed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: wall_clock(F.col(name)) for name in names})


def wall_clock(text: Column) -> Column:
    """ISO-8601 text as the UTC wall clock; NULL where it is no time, so that one bad value does
    not end a load. Text without offset, or with Z, is UTC; another offset is applied."""
    zoned = text.rlike(r"[+-]\d{2}:?\d{2}$") & text.rlike(r"\d[T ]\d")
    return F.when(zoned, utc_wall(F.try_to_timestamp(text))).otherwise(text.try_cast(NTZ))


def malformed_times(rows: DataFrame, *names: str) -> DataFrame:
    """Of rows as read (times still text): those with a time that cannot be read, with the
    names of the columns, for a quarantine."""
    bad = [
        F.when(F.col(n).isNotNull() & wall_clock(F.col(n)).isNull(), F.lit(n)) for n in names
    ]
    found = rows.withColumn("malformed", F.array_compact(F.array(*bad)))
    return found.where(F.size("malformed") > 0)


def flatten_properties(
    events: DataFrame,
    properties: Mapping[str, T.DataType] | None = None,
    keep_payload: bool = False,
) -> DataFrame:
    """Turns the payload into typed ``prop_*`` columns; a value of another type is NULL.

    With ``keep_payload`` the whole payload stays beside them, so no property is lost."""
    chosen = properties or schemas.PROPERTIES
    payload = F.col("event_properties")
    flat = [
        F.try_variant_get(payload, f"$.{name}", kind.simpleString()).alias(f"prop_{name}")
        for name, kind in chosen.items()
    ]
    envelope = [c for c in events.columns if keep_payload or c != "event_properties"]
    return events.select(*envelope, *flat)
