"""Exact distinct counts over trailing days from stored bitmaps.

Entities get dense numbers once, so a set of them is a few bitmaps of 32,768 bits. Bitmaps of days
unite by OR, which neither counts an entity twice nor minds overlaps: spans of 2, 4, 8, ... days
are doubled up, and any window is the OR of two such spans. A window of n days thus copies a bitmap
about 2 * log2(n) times instead of n, and no row below the bitmaps is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANGE = 33  # bits of the row number within a partition, in monotonically_increasing_id


def dense_numbers(entities: DataFrame, entity: str, path: str) -> DataFrame:
    """entity, number: the distinct entities that are not null, numbered 1, 2, ... without gaps
    and without sorting. Stored at ``path``, so that a number never changes."""
    there = entities.where(F.col(entity).isNotNull()).select(entity).distinct()
    marked = f"{path}/marked"
    there.withColumn("_at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(marked)
    spark = entities.sparkSession
    rows = spark.read.parquet(marked)
    part = F.shiftrightunsigned("_at", _RANGE)
    # A row per partition: their running sum is where each partition's numbers begin.
    sums = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.col("_at").bitwiseAND((1 << _RANGE) - 1)
    numbered = rows.withColumn("_part", part).join(sums, "_part")
    numbered = numbered.select(entity, (own + F.col("_before") + 1).alias("number"))
    numbered.write.mode("overwrite").parquet(f"{path}/numbers")
    return spark.read.parquet(f"{path}/numbers")


def added_numbers(numbers: DataFrame, entities: DataFrame, entity: str, path: str) -> DataFrame:
    """``numbers`` with the entities that it lacks, which get the numbers that follow."""
    new = entities.select(entity).distinct().join(numbers, entity, "left_anti")
    last = numbers.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    fresh = dense_numbers(new, entity, path)
    return numbers.unionByName(fresh.withColumn("number", F.col("number") + last))


def day_bitmaps(
    df: DataFrame, numbers: DataFrame, entity: str, day: str, by: Sequence[str] = ()
) -> DataFrame:
    """day, by, bucket, bits: who was active, as bitmaps. Parts unite by OR (``united``)."""
    seen = df.where(F.col(entity).isNotNull() & F.col(day).isNotNull()).select(entity, day, *by)
    # One row per entity first: a busy entity meets its number once.
    numbered = seen.distinct().join(numbers, entity)
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    return numbered.groupBy(day, *by, bucket).agg(bits)


def united(bitmaps: DataFrame, day: str, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of parts as one per day, ``by`` and bucket."""
    return bitmaps.groupBy(day, *by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _reaching(bitmaps: DataFrame, day: str, by: Sequence[str], back: int) -> DataFrame:
    """The OR of each day's bitmaps and those ``back`` days before."""
    days = F.explode(F.array(F.col(day), F.date_add(day, back))).alias(day)
    return united(bitmaps.select(days, *by, "bucket", "bits"), day, by)


def spans(bitmaps: DataFrame, day: str, length: int, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of the trailing ``length`` days, also for days without a bitmap of their own."""
    reach, found = 1, bitmaps
    while reach * 2 <= length:
        found, reach = _reaching(found, day, by, reach), reach * 2
    return found if reach == length else _reaching(found, day, by, length - reach)


def trailing_users(
    bitmaps: DataFrame, day: str, windows: Mapping[str, int], by: Sequence[str] = ()
) -> DataFrame:
    """day, by and the distinct entities of each trailing window, on the days that have some
    activity of their own in ``by``. Exact, from the bitmaps alone."""
    active = F.max("_own").alias("_own")
    parts = None
    own = bitmaps.select(day, *by, F.lit(1).alias("_own"), *[F.lit(0).cast("bigint").alias(n) for n in windows])
    for name, length in windows.items():
        wide = spans(bitmaps, day, length, by)
        counts = [
            (F.bitmap_count("bits") if n == name else F.lit(0)).cast("bigint").alias(n) for n in windows
        ]
        rows = wide.select(day, *by, F.lit(0).alias("_own"), *counts)
        parts = rows if parts is None else parts.unionByName(rows)
    whole = parts.unionByName(own).groupBy(day, *by)
    summed = whole.agg(active, *[F.sum(n).alias(n) for n in windows])
    return summed.where("_own = 1").drop("_own")
