"""Generic table expectations, evaluated together.

Everything that is a count over rows shares one scan of the table; expectations about
distinct values add one key shuffle per column. NULL values are skipped, except where the
expectation is about NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """``counts`` are plain aggregates; ``observed`` and ``success`` read them by name."""

    kind: str
    column: str
    counts: dict[str, Callable[[], Column]]
    observed: Callable[[Callable[[str], Column]], Column]
    success: Callable[[Column], Column]
    distinct_of: str | None = field(default=None)


def row_count_between(low: int, high: int) -> Expectation:
    return Expectation(
        "row_count_between",
        "*",
        {"rows": lambda: F.count("*")},
        lambda get: get("rows"),
        lambda seen: seen.between(low, high),
    )


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    counts = {"rows": lambda: F.count("*"), "present": lambda: F.count(column)}
    return Expectation(
        "not_null",
        column,
        counts,
        lambda get: F.try_divide(get("present").cast("double"), get("rows").cast("double")),
        # An empty table has no offending row.
        lambda seen: F.coalesce(seen >= mostly, F.lit(True)),
    )


def _no_bad_rows(kind: str, column: str, bad: Callable[[], Column]) -> Expectation:
    return Expectation(
        kind,
        column,
        {"bad": lambda: F.count_if(bad())},
        lambda get: get("bad"),
        lambda seen: seen == 0,
    )


def in_set(column: str, values: Sequence[str]) -> Expectation:
    return _no_bad_rows("in_set", column, lambda: ~F.col(column).isin(*values))


def match_regex(column: str, pattern: str) -> Expectation:
    return _no_bad_rows("match_regex", column, lambda: ~F.col(column).rlike(pattern))


def between(column: str, low: float, high: float) -> Expectation:
    return _no_bad_rows("between", column, lambda: ~F.col(column).between(low, high))


def pair_greater(a: str, b: str, or_equal: bool = False) -> Expectation:
    def bad() -> Column:
        return F.col(a) < F.col(b) if or_equal else F.col(a) <= F.col(b)

    return _no_bad_rows("pair_greater", f"{a},{b}", bad)


def unique(column: str) -> Expectation:
    """Observed: rows whose value occurs more than once."""
    return Expectation(
        "unique", column, {}, lambda get: get("copies"), lambda seen: seen == 0, column
    )


def unique_proportion_between(column: str, low: float, high: float) -> Expectation:
    return Expectation(
        "unique_proportion_between",
        column,
        {},
        lambda get: F.try_divide(get("values").cast("double"), get("present").cast("double")),
        lambda seen: F.coalesce(seen.between(low, high), F.lit(False)),
        column,
    )


def evaluate(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """expectation, column, success, observed: one row per expectation."""
    aggs = [
        expr().alias(f"e{i}_{name}")
        for i, e in enumerate(expectations)
        for name, expr in e.counts.items()
    ]
    wide = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    for column in sorted({e.distinct_of for e in expectations if e.distinct_of}):
        stats = (
            df.where(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.count("*").alias("n"))
            .agg(
                F.struct(
                    F.count("*").alias("values"),
                    F.coalesce(F.sum("n"), F.lit(0)).alias("present"),
                    F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("copies"),
                )
            )
        )
        wide = wide.withColumn(f"{column}__distinct", stats.scalar())

    def reader(i: int, e: Expectation) -> Callable[[str], Column]:
        if e.distinct_of:
            return lambda name: F.col(f"{e.distinct_of}__distinct")[name]
        return lambda name: F.col(f"e{i}_{name}")

    rows = []
    for i, e in enumerate(expectations):
        observed = e.observed(reader(i, e)).cast("double")
        rows.append(
            F.struct(
                F.lit(e.kind).alias("expectation"),
                F.lit(e.column).alias("column"),
                e.success(observed).alias("success"),
                observed.alias("observed"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))
