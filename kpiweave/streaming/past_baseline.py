"""Alerts whose limits come from earlier windows only.

Windows are counted as they close, and judged in the order of time: keyed state holds, per error
code, how many windows there were, their mean and their sum of squared deviations. A window is
judged by what stood there before it, then added. Such moments merge, so windows that come together
are added together; nothing of a past window but these three numbers is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kpiweave.streaming.first_logins import PROVIDER_KEY, ROCKSDB
from kpiweave.streaming.sinks import each_batch

SCHEMA = "window_start timestamp_ntz, rule string, value double, limit double, alert boolean"
LEAST_WINDOWS = 2  # a deviation needs two


def merged(a: tuple[int, float, float], b: tuple[int, float, float]) -> tuple[int, float, float]:
    """Count, mean and sum of squared deviations of two sets as one."""
    n = a[0] + b[0]
    if not n:
        return (0, 0.0, 0.0)
    step = b[1] - a[1]
    return (n, a[1] + step * b[0] / n, a[2] + b[2] + step * step * a[0] * b[0] / n)


def limit_of(moments: tuple[int, float, float], sigmas: float) -> float | None:
    n, mean, squares = moments
    return None if n < LEAST_WINDOWS else mean + sigmas * (squares / (n - 1)) ** 0.5


class PastBaseline(StatefulProcessor):
    """Judges the closed windows of a rule. The success rate has a fixed limit and no state."""

    def __init__(self, sigmas: float, least_success_pct: float) -> None:
        self.sigmas, self.least = sigmas, least_success_pct

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.moments = handle.getValueState("moments", "n bigint, mean double, squares double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows = pd.concat(list(rows)).sort_values("window_start")  # a row per closed window
        if key[0] == "success_rate":
            value = windows["share"]
            limits, alerts = [self.least] * len(windows), (value < self.least).tolist()
        else:
            value = windows["n"].astype(float)
            state = self.moments.get() if self.moments.exists() else None
            now = tuple(state) if state else (0, 0.0, 0.0)
            limits, alerts = [], []
            for x in value:
                limit = limit_of(now, self.sigmas)
                limits.append(limit)
                alerts.append(limit is not None and x > limit)
                now = merged(now, (1, x, 0.0))
            self.moments.update(now)
        yield pd.DataFrame(
            {
                "window_start": windows["window_start"],
                "rule": key[0],
                "value": value,
                "limit": pd.array(limits, dtype="Float64"),
                "alert": alerts,
            }
        )


def judged(windows: DataFrame, sigmas: float = 2.0, least_success_pct: float = 85.0) -> DataFrame:
    """``windows``: a stream of closed windows (window_start, rule, hits, n), each once and no
    earlier than those before it, as append mode stores ``transforms.transaction_signals``."""
    share = F.round(F.col("hits") * 100.0 / F.col("n"), 2).alias("share")
    measured = windows.select("window_start", "rule", "n", share)
    return measured.groupBy("rule").transformWithStateInPandas(
        statefulProcessor=PastBaseline(sigmas, least_success_pct),
        outputStructType=SCHEMA,
        outputMode="Update",
        timeMode="None",
    )


def feed(windows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Stores the judged windows below ``path``, by query and batch: a replay replaces itself."""
    spark = windows.sparkSession

    def store(batch: DataFrame, run: str, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")

    before = spark.conf.get(PROVIDER_KEY)
    spark.conf.set(PROVIDER_KEY, ROCKSDB)
    try:
        writer = judged(windows).writeStream.outputMode("update")
        return each_batch(writer.option("checkpointLocation", checkpoint), store, once)
    finally:
        spark.conf.set(PROVIDER_KEY, before)
