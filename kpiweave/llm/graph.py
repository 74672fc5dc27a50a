"""Connected components of a stored edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """u, v, m with m the smallest v of each u. The join's second key follows from the first:
    it makes Spark deal the grouped side anew, so that a hub can be split over tasks."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.max(F.hash("u")).alias("k"))
    return edges.withColumn("k", F.hash("u")).join(low, ["u", "k"]).drop("k")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    near = _least(both)
    return near.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    near = _least(edges)
    own = F.struct("u", F.col("m").alias("v"))
    other = F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.select(F.inline(F.array(own, other))).where("u > v")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """u, root: every node that has an edge, but for the roots themselves, with the smallest
    node it can reach. Rounds grow with the logarithm of a component's diameter; each one is
    written to the shared folder."""
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = stored(edges.select(high, low).where("u > v").distinct(), "edges")

    def mark(df: DataFrame):
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    before = mark(now)
    while before[0]:
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select("u", F.col("v").alias("root"))
