"""Join facts to per-key statistics when single keys may own a large part of the facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_key_stats(
    facts: DataFrame,
    stats: DataFrame,
    key: str,
    rows: str,
    hot_share: float = 1e-3,
    spread: int = 4096,
    where: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Inner join of ``facts`` with ``stats`` (one row per key, ``rows`` = facts of that key).

    A key that owns at least ``hot_share`` of all rows is hot. There can be no more than
    1 / hot_share such keys whatever the data size, so their statistics are broadcast. The
    facts of a hot key then carry their statistics already and go through the shuffle join
    of the others under a second, spread key that matches nothing, so that no task gets a
    hot key whole. The facts are read once.

    ``where`` is a condition over the facts and the struct of their statistics; facts of hot
    keys that fail it are dropped before the shuffle.
    """
    total = stats.agg(F.sum(rows)).scalar()
    is_hot = F.col(rows) >= F.greatest(total * F.lit(hot_share), F.lit(1.0))
    values = F.struct(*[c for c in stats.columns if c != key])

    hot = stats.where(is_hot).select(key, values.alias("_hot"))
    # The source task is part of the hash, so that copies of one row spread as well; unlike a
    # random number it is the same when a lost task runs again.
    place = F.xxhash64(F.spark_partition_id(), *facts.columns)
    met = facts.join(F.broadcast(hot), key, "left")
    if where is not None:
        met = met.where(F.col("_hot").isNull() | where(F.col("_hot")))
    flagged = met.withColumn(
        "_spread", F.when(F.col("_hot").isNull(), 0).otherwise(1 + F.pmod(place, F.lit(spread)))
    )
    # Always zero, but not a literal: the optimizer would drop a literal from the join key.
    zero = F.pmod(F.col(rows), F.lit(1)).cast("bigint")
    cold = stats.where(~is_hot).select(key, zero.alias("_spread"), values.alias("_cold"))
    joined = flagged.join(cold, [key, "_spread"], "left")
    found = joined.withColumn("_stats", F.coalesce("_hot", "_cold")).where("_stats IS NOT NULL")
    if where is not None:
        found = found.where(where(F.col("_stats")))
    return found.select(*facts.columns, "_stats.*")
