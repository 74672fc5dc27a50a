"""Mergeable sketches: quantiles of integers and distinct counts, in bounded space.

A sketch of a group is a small value, whatever the group holds. Sketches of parts merge into that
of the whole, so they fit stored partial aggregates and the state of a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_K, MOST_K = 8, 65_535
#: A quantile's rank is off by more than this over k ** RANK_POWER once in a hundred times.
RANK_FACTOR, RANK_POWER = 2.296, 0.9021
#: Standard error of a distinct count times the square root of the number of registers.
DISTINCT_FACTOR = 1.04


def rank_error(k: int) -> float:
    """The share of ranks by which a quantile of a sketch of size ``k`` may be off."""
    return RANK_FACTOR / k**RANK_POWER


def size_for(error: float) -> int:
    """The least ``k`` whose rank error is at most ``error``."""
    if error <= 0:
        raise ValueError("the rank error must be positive")
    k = max(LEAST_K, int((RANK_FACTOR / error) ** (1 / RANK_POWER)))
    while k > LEAST_K and rank_error(k - 1) <= error:
        k -= 1
    while rank_error(k) > error:
        k += 1
    if k > MOST_K:
        raise ValueError(f"no sketch is as exact as {error}")
    return k


def quantile_sketches(
    df: DataFrame, keys: Sequence[str], value: str, error: float, name: str = "sketch"
) -> DataFrame:
    """keys, n and a sketch of the integers ``value`` that are not null."""
    there = df.where(F.col(value).isNotNull())
    sketch = F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), size_for(error))
    return there.groupBy(*keys).agg(F.count("*").alias("n"), sketch.alias(name))


def merged(sketches: DataFrame, keys: Sequence[str], error: float, name: str = "sketch") -> DataFrame:
    """Sketches of parts as one per ``keys``."""
    one = F.kll_merge_agg_bigint(name, size_for(error))
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), one.alias(name))


def quantile(name: str, probability: float) -> Column:
    """The value of ``probability`` in a sketch: one of the values it has seen."""
    return F.kll_sketch_get_quantile_bigint(name, F.lit(float(probability)))


def approx_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float], error: float
) -> DataFrame:
    """keys, n, one double per probability, like ``exact_percentiles`` but for the rank error.
    One shuffle of one sketch per key and task; nothing is sorted."""
    found = quantile_sketches(df, keys, value, error, "_sketch")
    values = [quantile("_sketch", p).cast("double").alias(name) for name, p in probabilities.items()]
    return found.select(*keys, "n", *values)


def ranks(df: DataFrame, keys: Sequence[str], value: str, estimates: DataFrame, name: str) -> DataFrame:
    """keys, n, and the shares of values below and up to the estimate ``name`` of the key. The
    estimates are one row per key."""
    named = estimates.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(name).alias("_e"))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    # Values are counted first, so the join sees each value of a key once.
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))

    def share(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_n")).otherwise(0)) / F.sum("_n")

    return (
        counts.join(named, same)
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("n"),
            share(F.col(value) < F.col("_e")).alias("below"),
            share(F.col(value) <= F.col("_e")).alias("upto"),
        )
    )


def within(ranked: DataFrame, keys: Sequence[str], probability: float, error: float, name: str) -> DataFrame:
    """keys and whether the rank of the estimate of ``ranks`` is off by ``error`` at most."""
    near = (F.col("below") <= probability + error) & (F.col("upto") >= probability - error)
    return ranked.select(*keys, near.alias(name))


def registers_for(error: float) -> int:
    """log2 of the registers of a distinct-count sketch with the standard error ``error``."""
    lg = 4
    while DISTINCT_FACTOR / 2 ** (lg / 2) > error:
        lg += 1
    if lg > 21:
        raise ValueError(f"no sketch is as exact as {error}")
    return lg


def trailing_distinct(sketches: DataFrame, day: str, sketch: str, windows: Mapping[str, int]) -> DataFrame:
    """Per day with a sketch: the distinct count over trailing windows, from one distinct-count
    sketch per day. Copies a day's sketch into the days that look back on it: one row per calendar
    day and window day, whatever the number of rows behind the sketches."""
    days = sketches.select(F.col(day).alias("_seen"), F.col(sketch).alias("_sketch"))
    longest = max(windows.values())
    reach = F.sequence(F.lit(0), F.lit(longest - 1))
    copies = days.select("_seen", "_sketch", F.explode(reach).alias("_ago"))
    copies = copies.withColumn(day, F.date_add("_seen", F.col("_ago")))
    united = [
        F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("_ago") < n, F.col("_sketch")))).alias(name)
        for name, n in windows.items()
    ]
    current = F.max((F.col("_ago") == 0).cast("int")).alias("_now")
    return copies.groupBy(day).agg(current, *united).where("_now = 1").drop("_now")
