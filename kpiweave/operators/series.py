"""Small helpers over a series with one row per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.functions import pct


def growth(df: DataFrame, period: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds prev and growth_pct against the period before."""
    order = Window.partitionBy(*by).orderBy(period)
    with_prev = df.withColumn("prev", F.lag(value).over(order))
    return with_prev.withColumn("growth_pct", pct(F.col(value) - F.col("prev"), F.col("prev")))


def share_of(value: Column, by: Sequence[str] = (), digits: int = 2) -> Column:
    """Share of a column in its group total, over already aggregated rows."""
    return pct(value, F.sum(value).over(Window.partitionBy(*by)), digits)
