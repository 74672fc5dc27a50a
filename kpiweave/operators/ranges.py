"""Join of points with the intervals that hold them, without comparing all with all.

Intervals fall into classes by length: in class k they are at most 2**k long, and bins of that
width make each of them touch one or two. A point looks into one bin of each class that occurs, of
which there are 64 at most. So neither a long interval nor a short one is copied more than twice,
whatever the others are like, and the join is an equi join on (class, bin) with the bounds checked
after it. Bins that hold many points are dealt over several tasks, with their intervals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_POINTS = 1_000_000
_BIN, _CLASS, _SALT = "_bin", "_class", "_salt"


def _length_class(low: Column, high: Column) -> Column:
    """The least k with 2**k >= length, by the number of binary digits of length - 1."""
    length = high - low + 1
    return F.when(length <= 1, F.lit(0)).otherwise(F.length(F.bin(length - 1))).cast("int")


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    low: str,
    high: str,
    on: Sequence[str] = (),
    hot_points: int = HOT_POINTS,
) -> DataFrame:
    """Each row of ``points`` with each row of ``intervals`` such that ``low <= at <= high`` and,
    if given, the columns ``on`` are equal. The three are whole numbers; null ones join nothing,
    nor do intervals that end before they begin. Column names must differ but for ``on``."""
    kept = intervals.where(F.col(low) <= F.col(high))
    kept = kept.withColumn(_CLASS, _length_class(F.col(low), F.col(high)))
    # At most 64 numbers, however many intervals there are.
    classes = sorted(r[0] for r in kept.select(_CLASS).distinct().collect())
    if not classes:
        classes = [0]

    def bin_of(value: str) -> Column:
        return F.expr(f"shiftright(CAST(`{value}` AS BIGINT), {_CLASS})")

    looked = F.explode(F.array(*[F.lit(k) for k in classes]))
    seen = points.where(F.col(at).isNotNull()).withColumn(_CLASS, looked)
    seen = seen.withColumn(_BIN, bin_of(at))
    touched = F.explode(F.array_distinct(F.array(bin_of(low), bin_of(high)))).alias(_BIN)
    wide = kept.select("*", touched)

    keys = [*on, _CLASS, _BIN]
    # Only bins that some interval touches matter, so their points alone are counted.
    used = wide.select(*keys).distinct()
    counted = seen.join(used, keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("_n"))
    tasks = F.ceil(F.col("_n") / hot_points).cast("int").alias("_tasks")
    # At most the number of points over ``hot_points`` rows.
    hot = counted.where(F.col("_n") > hot_points).select(*keys, tasks)
    parts = F.coalesce(F.col("_tasks"), F.lit(1))
    spread = F.pmod(F.monotonically_increasing_id(), parts).cast("int")
    left = seen.join(hot, keys, "left").withColumn(_SALT, spread).drop("_tasks")
    copies = F.explode(F.sequence(F.lit(0), parts - 1))
    right = wide.join(hot, keys, "left").withColumn(_SALT, copies).drop("_tasks")
    joined = left.join(right, [*keys, _SALT])
    inside = F.col(at).between(F.col(low), F.col(high))
    return joined.where(inside).drop(_CLASS, _BIN, _SALT)
