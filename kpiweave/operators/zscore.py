"""Distance from the mean in standard deviations, over a daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series_stats(daily: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Adds mean_<m> and std_<m> (sample) of each metric over the whole series or per ``by``.

    ``daily`` has one row per day (and ``by`` value): a window, also the one over the whole
    series, holds no more rows than the calendar has days.
    """
    scope = Window.partitionBy(*by)
    extra = {}
    for m in metrics:
        extra[f"mean_{m}"] = F.avg(m).over(scope)
        extra[f"std_{m}"] = F.stddev_samp(m).over(scope)
    return daily.withColumns(extra)


def zscore(metric: str) -> Column:
    """NULL where the deviation is zero or unknown."""
    spread = F.nullif(F.col(f"std_{metric}"), F.lit(0.0))
    return (F.col(metric) - F.col(f"mean_{metric}")) / spread
