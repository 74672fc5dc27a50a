"""Exact interpolated percentiles of integers from value counts, in bounded pieces."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    bucket_width: int = 65_536,
    weight: str | None = None,
) -> DataFrame:
    """keys, n, one double per probability: the same number as a full sort would give.

    Values are counted (combined on the map side), then two narrow looks find the ranks: a
    running total over coarse buckets of ``bucket_width`` says which bucket holds a wanted
    rank, a running total inside only that bucket says which value. No group is ever sorted
    or held whole by one task: a task sees the buckets of a group, or one bucket's values.
    ``weight`` names a column that says how often a row counts.
    """
    keys = list(keys)
    bucket = F.floor(F.col(value) / F.lit(bucket_width)).cast("bigint").alias("_bucket")
    times = F.sum(weight) if weight else F.count("*")
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(times.alias("_n"))

    by_group = Window.partitionBy(*keys)
    before = by_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    coarse = (
        counts.groupBy(*keys, bucket)
        .agg(F.sum("_n").alias("_in_bucket"))
        .withColumn("_below", F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_in_bucket").over(by_group))
    )

    def rank(prob: float, low: bool):
        position = F.lit(float(prob)) * (F.col("_total") - 1)
        return (F.floor(position) if low else F.ceil(position)).cast("bigint")

    def inside(wanted, start: str, length: str):
        return (wanted >= F.col(start)) & (wanted < F.col(start) + F.col(length))

    wanted = F.lit(False)
    for prob in probabilities.values():
        for low in (True, False):
            wanted = wanted | inside(rank(prob, low), "_below", "_in_bucket")
    # At most two buckets per group and probability remain.
    needed = coarse.where(wanted).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_b"), "_below", "_total"
    )
    # Null-safe equality adds no filter below the join, so both readers of ``counts`` have
    # the same plan and share one exchange.
    same = F.col("_bucket").eqNullSafe(F.col("_b"))
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    in_bucket = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    fine = (
        counts.withColumn("_bucket", F.floor(F.col(value) / F.lit(bucket_width)).cast("bigint"))
        .join(needed, same)
        .withColumn("_start", F.col("_below") + F.coalesce(F.sum("_n").over(in_bucket), F.lit(0)))
    )
    picks = [F.max("_total").alias("n")]
    for name, prob in probabilities.items():
        for side, low in (("lo", True), ("hi", False)):
            hit = inside(rank(prob, low), "_start", "_n")
            picks.append(F.max(F.when(hit, F.col(value))).alias(f"_{side}_{name}"))
    picked = fine.groupBy(*keys).agg(*picks)
    out = [*keys, "n"]
    for name, prob in probabilities.items():
        position = F.lit(float(prob)) * (F.col("n") - 1)
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return picked.select(*out)
