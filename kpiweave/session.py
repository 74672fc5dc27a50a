"""A local session for tests and the bench, with the settings that the jobs assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles and splits skewed joins at run time. Zone-free
# timestamps make the results independent of the session zone; UTC keeps logs readable.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the call site of every column expression costs more than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", **settings: str) -> SparkSession:
    """On a cluster take the session that spark-submit gives and apply ``SETTINGS``."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("kpiweave")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
