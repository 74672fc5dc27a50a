"""Column expressions: calendar, rates, safe casts. All of them stay in generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole as a rounded double; NULL when the whole is zero."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def per(total: Column, count: Column, digits: int | None = None) -> Column:
    """total / count as a double; NULL when the count is zero."""
    ratio = total.cast("double") / F.nullif(count.cast("double"), F.lit(0.0))
    return ratio if digits is None else F.round(ratio, digits)


def exact_avg(value: Column, where: Column | None = None) -> Column:
    """Mean of integers from an integer sum, so that it does not depend on row order."""
    kept = value if where is None else F.when(where, value)
    return per(F.sum(kept), F.count(kept))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(value: Column, condition: Column) -> Column:
    """Sum of the rows that match; the others count as zero."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def one_of(column: Column, values: Iterable[str]) -> Column:
    return column.isin(*values)


def labelled(column: Column, labels: Mapping, other: str | None = None) -> Column:
    chain = F
    for key, text in labels.items():
        chain = chain.when(column == F.lit(key), F.lit(text))
    return chain if other is None else chain.otherwise(F.lit(other))


def kst(ts: Column, tz_offset_hours: int = 9) -> Column:
    """Local wall clock of a UTC timestamp; the zone has no daylight saving."""
    return ts + F.make_dt_interval(hours=F.lit(tz_offset_hours))


def weekday0(day: Column) -> Column:
    """Sunday 0 to Saturday 6."""
    return F.dayofweek(day) - F.lit(1)


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def _elapsed(start: Column, end: Column) -> Column:
    """Seconds with microseconds. The difference of zone-free times is a plain interval, so
    the session zone and its daylight saving play no part."""
    return (end - start).cast("interval second").cast("decimal(20,6)")


def seconds_between(start: Column, end: Column) -> Column:
    return _elapsed(start, end).cast("double")


def micros_between(start: Column, end: Column) -> Column:
    return (_elapsed(start, end) * F.lit(1_000_000)).cast("bigint")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp."""
    return micros_between(F.expr(EPOCH), ts)


def instant(ts: Column) -> Column:
    """The UTC instant that a zone-free UTC timestamp denotes (watermarks need one)."""
    return F.timestamp_micros(epoch_micros(ts))


def utc_wall(ts: Column) -> Column:
    """The zone-free UTC wall clock of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(EPOCH))


def safe_number(df: DataFrame, name: str, target: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        # Text of a nullable integer column often reads "50000.0".
        return F.coalesce(
            column.try_cast(target),
            F.round(column.try_cast("double"), 0).try_cast(target),
        )
    return column.try_cast(target)


def safe_long(df: DataFrame, name: str) -> Column:
    return safe_number(df, name, "bigint")


def safe_int(df: DataFrame, name: str) -> Column:
    return safe_number(df, name, "int")
